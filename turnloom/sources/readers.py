"""Readers of raw exports, schedules and prompts."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.schemas import RAW_COLUMNS, require_columns


def read_export(spark: SparkSession, path: str, null_words: tuple[str, ...] = ()) -> DataFrame:
    """A raw export with header: the required columns as text, snake-case names, and ``ord``, the ingest order: the
    file's path, then the record's place in the file (a file with line breaks in its fields is read by one task).

    Missing columns raise ``ValueError`` by name; further columns are dropped. Words in ``null_words`` become null.
    """
    raw = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE").csv(path)
    require_columns(raw)
    cols = [F.when(~F.col(f"`{c}`").isin(*null_words), F.col(f"`{c}`")).alias(c.lower().replace(" ", "_")) if null_words else F.col(f"`{c}`").alias(c.lower().replace(" ", "_")) for c in RAW_COLUMNS]
    return raw.select(*cols, F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("n")).alias("ord"))


def read_schedule(spark: SparkSession, path: str) -> DataFrame:
    """Schedule file ``day, channel, start, end`` in file order as ``sched_ord``."""
    s = spark.read.option("header", True).schema("day string, channel string, start string, end string").csv(path)
    return s.select((F.monotonically_increasing_id() + 1).alias("sched_ord"), F.col("day").alias("day_name"), F.col("channel").alias("channel_name"), F.col("start").alias("start_time"), F.col("end").alias("end_time"))


def read_prompt(path: str) -> dict:
    """A prompt template: YAML where the library is there, else ``key: |`` blocks and plain ``key: value`` lines."""
    text = Path(path).read_text(encoding="utf-8")
    try:
        import yaml

        return yaml.safe_load(text) or {}
    except ImportError:
        out: dict[str, str] = {}
        key = None
        for line in text.splitlines():
            if line and not line[0].isspace() and ":" in line and not line.startswith("#"):
                key, _, value = line.partition(":")
                out[key] = "" if value.strip() in ("|", ">", "") else value.strip()
            elif key is not None:
                out[key] = (out[key] + "\n" + line[2:]).strip("\n") if line.strip() else out[key] + "\n"
        return out
