"""Broadcast windows: groups close in time assembled into one row with ordered text and speakers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.functions.text import ws_trim
from turnloom.operators.ingest import seconds_24h
from turnloom.runtime import hold

GAP_S = 300


def latest(dialogues: DataFrame) -> DataFrame:
    """One row per dialogue: the latest delivery; of several at one moment the greatest by its columns."""
    rest = [c for c in dialogues.columns if c not in ("dialogue_id", "loaded_at")]
    return dialogues.groupBy("dialogue_id").agg(F.max(F.struct("loaded_at", *rest)).alias("v")).select("dialogue_id", "v.*").select(*dialogues.columns)


def groups_with_dialogues(groups: DataFrame, dialogues: DataFrame) -> DataFrame:
    return groups.join(dialogues.select("group_id").distinct(), "group_id", "left_semi")


def gap_windows(groups: DataFrame, gap_s: int = GAP_S) -> DataFrame:
    """Add ``win``: number of the window within date and channel; a new one opens when starts lie more than
    ``gap_s`` apart. Adds ``sod`` and ``pos`` (place within date and channel)."""
    timed = groups.withColumn("sod", seconds_24h(F.col("broadcast_time")))
    w = Window.partitionBy("broadcast_date", "channel_name").orderBy("broadcast_time", "group_id")
    new = F.coalesce((F.col("sod") - F.lag("sod").over(w) > gap_s).cast("int"), F.lit(1))
    return timed.withColumns({"new": new, "pos": F.row_number().over(w)}).withColumn("win", F.sum("new").over(w)).drop("new")


KEY = ["broadcast_date", "channel_name", "win"]


def window_bounds(windowed: DataFrame) -> DataFrame:
    g = windowed.groupBy(*KEY).agg(
        F.min_by("broadcast_time", "pos").alias("start_time"), F.max_by("broadcast_time", "pos").alias("end_time"),
        F.min_by("sod", "pos").alias("a"), F.max_by("sod", "pos").alias("b"), F.count("*").alias("n_groups"),
    )
    return g.select(*KEY, "start_time", "end_time", ((F.col("b") - F.col("a")) / 60.0).alias("duration_min"), "n_groups")


def title_mode(windowed: DataFrame) -> DataFrame:
    """Commonest title of each window; of equals the one met first."""
    counts = windowed.groupBy(*KEY, "program_title").agg(F.count("*").alias("n"), F.min("pos").alias("p"))
    return counts.groupBy(*KEY).agg(F.max_by("program_title", F.struct(F.col("n"), -F.col("p"))).alias("program_title"))


def turns_by_group(dialogues: DataFrame) -> DataFrame:
    """``group_id, t``: each group's turns in order (``order_index``, nulls first, then id)."""
    row = F.struct(F.coalesce("order_index", F.lit(-1)).alias("oi"), "dialogue_id", "dialogue", "speaker")
    return dialogues.groupBy("group_id").agg(F.array_sort(F.collect_list(row)).alias("t"))


def listed(windowed: DataFrame) -> DataFrame:
    """One row per window with its groups in order as ``g``; needs ``t``, the turns of each group."""
    row = F.struct("pos", "broadcast_time", "sod", "program_title", "t")
    return windowed.groupBy(*KEY).agg(F.array_sort(F.collect_list(row), lambda x, y: x["pos"] - y["pos"]).alias("g"))


def all_turns(g: Column) -> Column:
    return F.flatten(F.transform(g, lambda x: x["t"]))


def starts(rows: Column, same) -> Column:
    """Places (from 1) at which ``same(row, row before)`` doesn't hold; the first place always."""
    return F.filter(F.sequence(F.lit(1), F.size(rows)), lambda i: (i == 1) | ~same(F.element_at(rows, i), F.element_at(rows, F.greatest(i - 1, F.lit(1)))))


def stretches(rows: Column, at: Column, build) -> Column:
    """``build(rows from one start up to the next)`` for each start, in time linear in the rows."""
    return F.transform(at, lambda s, k: build(F.slice(rows, s, F.coalesce(F.get(at, k + 1), F.size(rows) + 1) - s)))


def title_of(g: Column) -> Column:
    """Commonest title of a window; of equals the one met first."""
    titles = F.array_sort(F.transform(g, lambda x: F.struct(x["program_title"].alias("title"), x["pos"].alias("pos"))))
    counted = stretches(titles, starts(titles, lambda a, b: a["title"].eqNullSafe(b["title"])), lambda r: F.struct(F.size(r).alias("n"), (-F.element_at(r, 1)["pos"]).alias("p"), F.element_at(r, 1)["title"].alias("title")))
    return F.array_max(counted)["title"]


def said(turns: Column) -> Column:
    """The texts of turns joined by blanks; null and empty ones are left out."""
    return F.array_join(F.filter(F.transform(turns, lambda x: x["dialogue"]), lambda d: d != ""), " ")


def speakers_of(turns: Column) -> Column:
    named = F.transform(turns, lambda x: ws_trim(F.coalesce(x["speaker"], F.lit(""))))
    return F.array_join(F.array_distinct(F.filter(named, lambda s: s != "")), ", ")


def stitched_of(g: Column) -> Column:
    """``[time] texts`` for each group, groups parted by a blank line."""
    return F.array_join(F.transform(g, lambda x: F.concat(F.lit("["), x["broadcast_time"], F.lit("] "), said(x["t"]))), "\n\n")


def heading(speaker: Column) -> Column:
    return F.concat(F.lit("**Speaker ( "), F.coalesce(speaker, F.lit("None")), F.lit(" )** : "))


def diarized_of(turns: Column) -> Column:
    """Runs of one (raw, null-safe) speaker over a window's turns, across groups: heading and joined texts."""
    runs = stretches(turns, starts(turns, lambda a, b: a["speaker"].eqNullSafe(b["speaker"])), lambda r: F.concat(heading(F.element_at(r, 1)["speaker"]), said(r)))
    return F.array_join(runs, "\n\n")


def final_windows(groups: DataFrame, dialogues: DataFrame, gap_s: int = GAP_S) -> DataFrame:
    """The window table: bounds, commonest title, speakers, stitched and diarized text.

    Each table is read once: turns are gathered by group, groups numbered into windows and gathered by window, and all
    columns come from the ordered arrays. A window's row holds its whole text, which bounds what a task gathers.
    """
    g = groups.select("group_id", "broadcast_date", "channel_name", "broadcast_time", "program_title").join(turns_by_group(dialogues), "group_id")
    rows = hold(listed(gap_windows(g, gap_s)), turns=all_turns(F.col("g")))
    first, last = F.element_at("g", 1), F.element_at("g", -1)
    return rows.select(
        title_of(F.col("g")).alias("program_title"), "channel_name", "broadcast_date",
        F.concat_ws(" - ", first["broadcast_time"], last["broadcast_time"]).alias("broadcast_time"), ((last["sod"] - first["sod"]) / 60.0).alias("duration_min"),
        F.size("turns").cast("bigint").alias("n_segments"), speakers_of(F.col("turns")).alias("speakers"),
        stitched_of(F.col("g")).alias("stitched_dialogue"), diarized_of(F.col("turns")).alias("diarized_dialogue"),
    )
