"""Raw clip rows to clean, scheduled, ordered clips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.functions.text import ws_trim

DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd")
MOST_WINDOWS = 100_000  # a schedule larger than this is joined by shuffle, not broadcast
_CLOCK12 = r"(\d{1,2}:\d{2}\s(?:AM|PM))"


def small(df: DataFrame, most: int = MOST_WINDOWS) -> DataFrame:
    """Broadcast a dimension only after its size is known to be within ``most`` rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def dedup_keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row by ``order`` of each raw key; nulls are a key like any other.

    A grouped minimum, so copies are combined before the shuffle however many a key has.
    """
    others = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.col(order)).alias("__v"))
    return best.select(*keys, "__v.*").select(*df.columns)


def trim_strings(df: DataFrame) -> DataFrame:
    return df.select(*[ws_trim(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def parse_date(text: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    return F.coalesce(*[F.when(F.length(text) == len(f), F.try_to_date(text, f)) for f in formats])


def clock12(text: Column) -> Column:
    """The first ``h:mm AM``/``PM`` in a text, null if there is none."""
    m = F.regexp_extract(text, _CLOCK12, 1)
    return F.when(m != "", m)


def seconds_12h(text: Column) -> Column:
    """Second of the day of a 12-hour clock text; an hour outside 1 to 12 or a minute above 59 is null."""
    t = clock12(text)
    h, m = F.regexp_extract(t, r"^(\d+):", 1).try_cast("int"), F.regexp_extract(t, r":(\d+)", 1).try_cast("int")
    return F.when(h.between(1, 12) & (m <= 59), (h % 12 + F.when(t.endswith("PM"), 12).otherwise(0)) * 3600 + m * 60)


def seconds_24h(text: Column) -> Column:
    """Second of the day of ``HH:MM:SS``."""
    part = lambda i: F.split(text, ":").getItem(i).try_cast("int")
    return F.when(text.rlike(r"^\d{2}:\d{2}:\d{2}$"), part(0) * 3600 + part(1) * 60 + part(2))


def clock_text(seconds: Column) -> Column:
    pad = lambda c: F.lpad(F.floor(c).cast("string"), 2, "0")
    return F.concat_ws(":", pad(seconds / 3600), pad((seconds % 3600) / 60), pad(seconds % 60))


def day_name(date: Column) -> Column:
    """English day name whatever the session's locale."""
    names = F.array(*[F.lit(x) for x in ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")])
    return F.when(date.isNotNull(), F.try_element_at(names, F.dayofweek(date)))


def schedule(df: DataFrame) -> DataFrame:
    """Schedule rows with bounds as seconds of the day: ``sched_ord, day_name, channel_name, start_s, end_s``."""
    return df.select("sched_ord", "day_name", "channel_name", "start_time", "end_time", seconds_24h(F.col("start_time")).alias("start_s"), seconds_24h(F.col("end_time")).alias("end_s"))


def schedule_filter(clips: DataFrame, sched: DataFrame) -> DataFrame:
    """Keep clips within any window of their day and channel (bounds included), of unknown day or time, or of a day
    and channel without schedule. Needs ``bdate`` and ``sod``."""
    s = schedule(sched).groupBy("day_name", "channel_name").agg(F.collect_list(F.struct("start_s", "end_s")).alias("windows"))
    keyed = clips.withColumns({"day_name": day_name(F.col("bdate"))}).join(small(s), ["day_name", "channel_name"], "left")
    inside = F.exists("windows", lambda w: F.col("sod").between(w["start_s"], w["end_s"]))
    keep = F.col("bdate").isNull() | F.col("sod").isNull() | F.col("windows").isNull() | inside
    return keyed.filter(keep).select(*clips.columns)


def first_window(groups: DataFrame, sched: DataFrame) -> DataFrame:
    """Add ``start_time, end_time`` of the first schedule window (file order) that holds a group's start, else null."""
    s = schedule(sched).groupBy("day_name", "channel_name").agg(F.array_sort(F.collect_list(F.struct("sched_ord", "start_s", "end_s", "start_time", "end_time"))).alias("windows"))
    keyed = groups.withColumn("day_name", day_name(F.col("bdate"))).join(small(s), ["day_name", "channel_name"], "left")
    hit = F.try_element_at(F.filter("windows", lambda w: F.col("sod").between(w["start_s"], w["end_s"])), F.lit(1))
    return keyed.withColumns({"start_time": hit["start_time"], "end_time": hit["end_time"]}).select(*groups.columns, "start_time", "end_time")


def sort_order() -> list[Column]:
    return [F.col("channel_name").asc_nulls_last(), F.col("bdate").asc_nulls_last(), F.col("sod").asc_nulls_last(), F.col("ord")]


def top_n_sorted(clips: DataFrame, limit: int = 0) -> DataFrame:
    """Channel, date, time order; the first ``limit`` rows, all of them for 0."""
    out = clips.orderBy(*sort_order())
    return out.limit(limit) if limit else out


def ingest(raw: DataFrame, sched: DataFrame, limit: int = 0, seconds=seconds_12h) -> DataFrame:
    """``ord, bdate, sod, program_title, channel_name, plain_text``: dedup on raw keys, trim, parse, schedule, sort."""
    once = dedup_keep_first(raw, ["broadcast_date", "broadcast_time", "channel_name"], "ord")
    clean = trim_strings(once).withColumns({"bdate": parse_date(F.col("broadcast_date")), "sod": seconds(F.col("broadcast_time"))})
    return top_n_sorted(schedule_filter(clean, sched).select("ord", "bdate", "sod", "program_title", "channel_name", "plain_text"), limit)


def capped_groups(clips: DataFrame, gap_s: int = 60, cap: int = 5) -> DataFrame:
    """Clips of one channel and date at most ``gap_s`` apart, at most ``cap`` rows to a group: adds ``island, part``.

    Chunks of gap islands: equal to extending a group clip by clip, as a clip is compared with the one before it even
    after a split. A channel day bounds the window's partition. Clips without date, channel or time are left out.
    """
    rows = clips.filter("bdate is not null and channel_name is not null and sod is not null")
    w = Window.partitionBy("channel_name", "bdate").orderBy("sod", "ord")
    new = F.coalesce((F.col("sod") - F.lag("sod").over(w) > gap_s).cast("int"), F.lit(1))
    islands = rows.withColumn("new", new).withColumn("island", F.sum("new").over(w)).drop("new")
    i = Window.partitionBy("channel_name", "bdate", "island").orderBy("sod", "ord")
    return islands.withColumn("part", F.floor((F.row_number().over(i) - 1) / cap).cast("int"))


def merged_groups(clips: DataFrame, gap_s: int = 60, cap: int = 5) -> DataFrame:
    """One row per capped group: first time and title, texts joined by spaces in order, null texts skipped."""
    g = capped_groups(clips, gap_s, cap).groupBy("channel_name", "bdate", "island", "part")
    pos = F.struct("sod", "ord")
    texts = F.array_sort(F.collect_list(F.when(F.col("plain_text").isNotNull(), F.struct("sod", "ord", "plain_text"))))
    return g.agg(
        F.min("sod").alias("sod"), F.min_by("program_title", pos).alias("program_title"), F.count("*").alias("n_clips"),
        F.array_join(F.transform(texts, lambda x: x["plain_text"]), " ").alias("plain_text"),
    ).drop("island", "part")
