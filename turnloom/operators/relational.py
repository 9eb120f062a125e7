"""Small relational operators of the pipeline: look-ups, exports, ordered reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def texts_of(groups: DataFrame, ids: DataFrame) -> DataFrame:
    return groups.join(ids.select("group_id").distinct(), "group_id", "left_semi").select("group_id", "plain_text")


def segments_of(segments: DataFrame, ids: DataFrame) -> DataFrame:
    """Segments of the given groups in order."""
    return segments.join(ids.select("group_id").distinct(), "group_id", "left_semi").orderBy("group_id", "order_index", "segment_id")


def segment_lists(segments: DataFrame) -> DataFrame:
    """Each group's segments as one ordered array, and as the block of lines a prompt shows."""
    rows = F.array_sort(F.collect_list(F.struct("order_index", "segment_id", "broadcast_time", F.trim(F.coalesce("text", F.lit(""))).alias("text"))))
    g = segments.groupBy("group_id").agg(rows.alias("s"))
    prefix = lambda x: F.when(F.coalesce(x["broadcast_time"], F.lit("")) != "", F.concat(F.lit("["), x["broadcast_time"], F.lit("] "))).otherwise("")
    return g.select("group_id", F.size("s").alias("n_segments"), F.array_join(F.transform("s", lambda x: F.concat(prefix(x), x["text"])), "\n").alias("block"))


def dialogue_export(dialogues: DataFrame, groups: DataFrame) -> DataFrame:
    """Dialogues with their group's programme under the export's column names; the dialogue's own block flag wins.

    In order of date, time and place; channels interleave."""
    g = groups.select("group_id", "broadcast_date", "program_title", "channel_name", F.col("block_status").alias("__gb"))
    j = dialogues.join(g, "group_id")
    return j.select(
        F.col("broadcast_date").alias("Broadcast Date"), F.col("broadcast_time").alias("Broadcast Time"), F.col("program_title").alias("Program Title"),
        F.col("channel_name").alias("Channel Name"), F.col("dialogue").alias("Dialogue"), F.col("speaker").alias("Speaker"), F.col("role").alias("Role"),
        F.col("confidence_score").alias("Confidence Score"), F.coalesce("block_status", "__gb").alias("Block Status"), F.col("order_index").alias("Order Index"),
    ).orderBy("Broadcast Date", "Broadcast Time", "Order Index")


def failed_left(failed: DataFrame, resolved: DataFrame, blocked: DataFrame, key: str = "group_id") -> DataFrame:
    """Keys that failed and were neither resolved nor blocked since."""
    return failed.join(resolved.select(key).unionByName(blocked.select(key)), key, "left_anti")


def continuous_order(turns: DataFrame) -> DataFrame:
    """Turns of several chunks as one sequence: ``order_index`` from 0 within each group."""
    from pyspark.sql import Window

    w = Window.partitionBy("group_id").orderBy("chunk", "turn")
    return turns.withColumn("order_index", (F.row_number().over(w) - 1).cast("int"))
