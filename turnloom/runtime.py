"""Session building, table reading and lineage cutting shared by all operators."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str | None = None, app: str = "turnloom", **conf: str) -> SparkSession:
    """A session with the settings the operators expect; ``conf`` wins over the defaults.

    Keyword names are written with ``__`` for dots, e.g. ``spark__sql__shuffle__partitions="8"``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for k, v in {**defaults, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers where they could not import it by themselves.

    Workers see the driver's ``PYTHONPATH`` and, on one machine, its working directory; anywhere else the package
    travels as a zip that Spark's own file server hands out.
    """
    package = Path(__file__).resolve().parent
    seen = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    sc = spark.sparkContext
    if str(package.parent) in seen or sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    made = shutil.make_archive(os.path.join(tempfile.mkdtemp(), package.name), "zip", package.parent, package.name)
    sc.addPyFile(made)


_SHIPPED: set[str] = set()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One Parquet table of a data folder."""
    ship(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet"))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints.

    The cluster names it in ``spark.checkpoint.dir``; only a session without that setting (a local
    test) gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    have = sc.getCheckpointDir()
    if have:
        return have
    want = sc.getConf().get("spark.checkpoint.dir")
    if not want:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor shares")
        want = tempfile.mkdtemp(prefix="turnloom-checkpoint-")
    sc.setCheckpointDir(want)
    return sc.getCheckpointDir() or want


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and drop its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def hold(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a barrier that the optimiser doesn't inline or push filters through.

    One-element generators keep long parse expressions from being copied into everything that reads them.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


MOST_VALUES = 100_000  # distinct values that are worked out once and broadcast; more are worked out row by row


def by_value(df: DataFrame, columns: list[str], add: Callable[[DataFrame], DataFrame], most: int = MOST_VALUES) -> DataFrame:
    """``add(df)``, where what ``add`` adds depends on ``columns`` alone: worked out once for each distinct value.

    Values are broadcast only after they are known to be at most ``most``; beyond that ``add`` runs on every row.
    """
    values = cut(add(df.select(*columns).distinct()))
    if values.limit(most + 1).count() > most:
        return add(df)
    other = values.select(*[F.col(c).alias(f"__v_{c}") for c in columns], *[c for c in values.columns if c not in columns])
    met = None
    for c in columns:
        same = df[c].eqNullSafe(other[f"__v_{c}"])
        met = same if met is None else met & same
    return df.join(F.broadcast(other), met).drop(*[f"__v_{c}" for c in columns])


def parallelism(spark: SparkSession, least: int = 8) -> int:
    """Partitions for CPU-bound Python stages: a multiple of the cores, never below ``least``."""
    return max(least, 2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame, times: int = 2) -> DataFrame:
    """Deal rows out evenly where a scan has fewer partitions than ``times`` the cluster's cores.

    Text work is bound by the CPU, and one compressed file split may hold hundreds of megabytes of text. Large
    inputs already have more splits than that and pass through unchanged.
    """
    sc = df.sparkSession.sparkContext
    if df.rdd.getNumPartitions() >= times * sc.defaultParallelism:
        return df
    return df.repartition(parallelism(df.sparkSession))
