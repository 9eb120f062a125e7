"""Writers of windows, dialogues and reports, and the folder of stage tables."""

from __future__ import annotations

import importlib.util
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnloom.runtime import cut
from turnloom.schemas import TABLES, migrate, schema

SHEET_ROWS = 1_048_575


class Catalog:
    """Stage tables as Parquet folders. A table without a finished write is empty."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        os.makedirs(root, exist_ok=True) if "://" not in root else None

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def exists(self, table: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(table)}/_SUCCESS")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def read(self, table: str) -> DataFrame:
        if self.exists(table):
            df = self.spark.read.parquet(self.path(table))
            return migrate(df, table) if table in TABLES else df
        return self.spark.createDataFrame([], schema(table))

    def write(self, table: str, df: DataFrame, mode: str = "overwrite") -> DataFrame:
        df.write.mode(mode).parquet(self.path(table))
        return self.spark.read.parquet(self.path(table))

    def append_absent(self, table: str, new: DataFrame) -> DataFrame:
        """Add the rows whose key is not there yet; writing the same rows twice changes nothing."""
        from turnloom.operators.state import insert_if_absent

        insert_if_absent(migrate(new, table), self.read(table), table).write.mode("append").parquet(self.path(table))
        return self.read(table)


def numbered_final(final: DataFrame) -> DataFrame:
    """Windows in export order with ``window_id`` 1, 2, 3 and so on.

    Rows are sorted by ranges and written once; ids are their place in a partition after the sizes of the partitions
    before it, so only those sizes, one number a partition, meet in one task.
    """
    ordered = final.orderBy("broadcast_date", "channel_name", "broadcast_time", "program_title", "stitched_dialogue")
    at = F.monotonically_increasing_id()
    placed = cut(ordered.withColumns({"__part": F.shiftright(at, 33), "__at": at.bitwiseAND(F.lit((1 << 33) - 1))}))
    sizes = placed.groupBy("__part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__part", before.alias("__start"))
    numbered = placed.join(F.broadcast(starts), "__part")  # one row a partition
    return numbered.select((F.col("__start") + F.col("__at") + 1).alias("window_id"), *final.columns)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def sheets_can_be_written() -> bool:
    return any(importlib.util.find_spec(x) for x in ("openpyxl", "xlsxwriter"))


def write_sheet(df: DataFrame, path: str) -> None:
    """An Excel sheet through pandas, where an engine for it is installed; a larger table than a sheet is refused."""
    head = df.limit(SHEET_ROWS + 1).toPandas()  # a sheet's rows at most
    if len(head) > SHEET_ROWS:
        raise ValueError("too many rows for a sheet; write CSV or Parquet")
    head.to_excel(path, index=False)


def write_report(blocks: DataFrame, path: str) -> None:
    """Text blocks (``block``), each followed by a blank line."""
    blocks.select(F.concat("block", F.lit("\n")).alias("value")).write.mode("overwrite").text(path)
