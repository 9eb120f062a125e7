"""Queries of the general data problems (1, 3 and 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.operators.rowcheck import clean_rows, row_errors
from turnloom.operators.sessions import sessions
from turnloom.operators.timestamps import clip_moments
from turnloom.runtime import read, spread

SESSION_GAP_S = 300


def _moments(spark: SparkSession, sf: str) -> DataFrame:
    clips = read(spark, sf, "clips").select("clip_id", "broadcast_date", "broadcast_time", "channel_name")
    return clip_moments(spread(clips), read(spark, sf, "channels"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return _moments(spark, sf).filter("n_moments = 1").select("clip_id", F.col("utc").alias("utc_s"))


def p3_report(spark: SparkSession, sf: str) -> DataFrame:
    """Every clip with its chosen moment or the reason why it has none."""
    m = _moments(spark, sf)
    return m.select("clip_id", F.col("utc").alias("utc_s"), "n_moments", "format", "no_moment")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    m = _moments(spark, sf).filter("n_moments = 1").select("channel_id", "utc")
    s = sessions(m, "channel_id", "utc", SESSION_GAP_S)
    return s.select("channel_id", F.col("start").alias("start_s"), F.col("end").alias("end_s"), F.col("n_events").alias("n_clips"))


def p1_durations(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions of the events table by user, with their durations (thirty-minute gap)."""
    ev = read(spark, sf, "events").select("user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("t"))
    s = sessions(ev, "user_id", "t", 1800)
    return s.select("user_id", F.col("start").alias("start_s"), F.col("end").alias("end_s"), F.col("duration").alias("duration_s"), F.col("n_events").alias("n_moments"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return row_errors(spread(read(spark, sf, "raw_export")), read(spark, sf, "channels"))


def p5_loaded(spark: SparkSession, sf: str) -> DataFrame:
    return clean_rows(spread(read(spark, sf, "raw_export")), read(spark, sf, "channels"))


QUERIES = {f.__name__: f for f in (p1_found, p1_durations, p3_found, p3_report, p5_found, p5_loaded)}

#: Twins in SQL, where one is quick enough on whole tables.
SQL: dict[str, str] = {
    "p1_durations": """WITH m AS (SELECT DISTINCT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
a AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t) <= 1800 THEN 0 ELSE 1 END AS nw FROM m),
b AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY t) AS s FROM a)
SELECT user_id, min(t) AS start_s, max(t) AS end_s, max(t) - min(t) AS duration_s, count(*) AS n_moments FROM b GROUP BY user_id, s""",
}
