"""Turns that straddle the boundary of neighbouring groups, merged in closed form."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnloom.functions.text import ws_ltrim, ws_rtrim, ws_trim


def boundary_rows(dialogues: DataFrame) -> DataFrame:
    """First and last turn of each group by ``order_index`` (nulls first, then by id)."""
    key = F.struct(F.coalesce("order_index", F.lit(-1)), "dialogue_id")
    row = F.struct("dialogue_id", "speaker", "dialogue")
    return dialogues.groupBy("group_id").agg(F.min_by(row, key).alias("first"), F.max_by(row, key).alias("last"), F.count("*").alias("n_turns"))


def merges(groups: DataFrame, dialogues: DataFrame) -> DataFrame:
    """``target, source, text`` of each merge.

    Neighbours within date and channel match if the last speaker of one and the first of the next are the same but
    for case and outer space, neither blank nor unknown. A group of one turn that was merged away breaks the chain, so
    along chains of one-turn groups every second match merges. Groups without turns stand between others.
    """
    ends = groups.select("group_id", "broadcast_date", "channel_name", "broadcast_time").join(boundary_rows(dialogues), "group_id", "left")
    w = Window.partitionBy("broadcast_date", "channel_name").orderBy("broadcast_time", "group_id")
    name = lambda c: F.lower(ws_trim(F.coalesce(F.col(c)["speaker"], F.lit(""))))
    seq = ends.withColumns({"a": name("last"), "b": F.lead(name("first")).over(w), "next": F.lead("first").over(w)})
    seq = seq.withColumn("match", F.coalesce((F.col("a") == F.col("b")) & ~F.col("a").isin("", "unknown"), F.lit(False)))
    seq = seq.withColumn("chained", F.col("match") & F.coalesce(F.col("n_turns") == 1, F.lit(False)) & F.coalesce(F.lag("match").over(w), F.lit(False)))
    seq = seq.withColumn("run", F.sum((~F.col("chained")).cast("int")).over(w))
    r = Window.partitionBy("broadcast_date", "channel_name", "run").orderBy("broadcast_time", "group_id")
    done = seq.withColumn("place", F.row_number().over(r)).filter(F.col("match") & (F.col("place") % 2 == 1))
    text = F.concat(ws_rtrim(F.col("last")["dialogue"]), F.lit(" "), ws_ltrim(F.col("next")["dialogue"]))
    return done.select(F.col("last")["dialogue_id"].alias("target"), F.col("next")["dialogue_id"].alias("source"), text.alias("text"))


def stitch(groups: DataFrame, dialogues: DataFrame) -> DataFrame:
    """Dialogues after merging: targets carry the joined text, sources are gone."""
    m = merges(groups, dialogues)
    gone = F.struct(F.col("source").alias("dialogue_id"), F.lit(None).cast("string").alias("__t"), F.lit(True).alias("__gone"))
    grown = F.struct(F.col("target").alias("dialogue_id"), F.col("text").alias("__t"), F.lit(False).alias("__gone"))
    both = m.select(F.inline(F.array(gone, grown)))  # a turn is merged away or grows, never both
    done = dialogues.join(both, "dialogue_id", "left").filter(~F.coalesce("__gone", F.lit(False)))
    return done.withColumn("dialogue", F.coalesce("__t", "dialogue")).select(*dialogues.columns)
