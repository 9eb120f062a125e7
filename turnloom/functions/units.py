"""Text kernels of segmentation and attribution, as higher-order expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnloom.functions.text import ws_trim

MARK = " >> "


def sentence_units(text: Column) -> Column:
    """Sentence-level units in order: parts at speaker marks (the mark kept before all but the first), then cut after
    ``.!?`` and white space; never empty."""
    parts = F.transform(F.split(text, MARK, -1), lambda p, i: F.struct(i.alias("i"), ws_trim(p).alias("p")))
    marked = F.transform(
        F.filter(parts, lambda x: x["p"] != ""),
        lambda x: F.when((x["i"] > 0) & ~x["p"].startswith(">>"), F.concat(F.lit(">> "), x["p"])).otherwise(x["p"]),
    )
    cut = F.flatten(F.transform(marked, lambda p: F.split(p, r"(?<=[.!?])(?U)\s+", -1)))
    units = F.filter(F.transform(cut, ws_trim), lambda u: u != "")
    return F.when(F.size(units) > 0, units).otherwise(F.array(ws_trim(text)))


def numbered_block(units: Column) -> Column:
    return F.array_join(F.transform(units, lambda u, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), u)), "\n")


def repair_ranges(ranges: Column, n: Column) -> Column:
    """Make ``array<struct<s, e>>`` tile 1..n: clamp, swap, sort, drop the covered, close gaps, extend the last.

    Ranges with a null end are dropped; null if none is left.
    """
    one = F.lit(1)
    clamp = lambda x: F.greatest(one, F.least(x, n))
    good = F.filter(ranges, lambda r: r["s"].isNotNull() & r["e"].isNotNull())
    fixed = F.array_sort(F.transform(good, lambda r: F.struct(clamp(F.least(r["s"], r["e"])).alias("s"), clamp(F.greatest(r["s"], r["e"])).alias("e"))))
    empty = F.array().cast("array<struct<s:int,e:int>>")
    state = F.struct(one.alias("cursor"), empty.alias("out"))

    def step(acc: Column, r: Column) -> Column:
        grown = F.struct((r["e"] + 1).alias("cursor"), F.concat(acc["out"], F.array(F.struct(acc["cursor"].alias("s"), r["e"].alias("e")))).alias("out"))
        return F.when(r["e"] < acc["cursor"], acc).otherwise(grown)

    tiled = F.aggregate(fixed, state, step, lambda acc: acc["out"])
    last = F.size(tiled) - 1
    ended = F.transform(tiled, lambda r, i: F.struct(r["s"].alias("s"), F.when(i == last, n).otherwise(r["e"]).alias("e")))
    return F.when(F.size(fixed) > 0, ended)


def repair_owned(ranges: Column, n: Column) -> Column:
    """:func:`repair_ranges` for ``array<struct<s, e, speaker, confidence>>``: a kept range keeps its owner."""
    one = F.lit(1)
    clamp = lambda x: F.greatest(one, F.least(x, n))
    good = F.filter(ranges, lambda r: r["s"].isNotNull() & r["e"].isNotNull())
    fixed = F.transform(good, lambda r, i: F.struct(clamp(F.least(r["s"], r["e"])).alias("s"), clamp(F.greatest(r["s"], r["e"])).alias("e"), i.alias("i"), r["speaker"].alias("speaker"), r["confidence"].alias("confidence")))
    sorted_ = F.array_sort(fixed)
    # A range is covered if one before it reaches as far; what it keeps begins after the furthest end before it.
    reach = lambda i: F.coalesce(F.array_max(F.transform(F.slice(sorted_, one, i), lambda x: x["e"])), F.lit(0))
    laid = F.transform(sorted_, lambda r, i: F.struct((reach(i) + 1).alias("s"), r["e"].alias("e"), r["speaker"].alias("speaker"), r["confidence"].alias("confidence")))
    kept = F.filter(laid, lambda r: r["e"] >= r["s"])
    last = F.size(kept) - 1
    ended = F.transform(kept, lambda r, i: F.struct(r["s"].alias("s"), F.when(i == last, n).otherwise(r["e"]).alias("e"), r["speaker"].alias("speaker"), r["confidence"].alias("confidence")))
    return F.when(F.size(fixed) > 0, ended)


def segment_texts(units: Column, ranges: Column) -> Column:
    """Each range's units joined, without the opening mark; blank texts dropped."""
    joined = F.transform(ranges, lambda r: ws_trim(F.regexp_replace(F.array_join(F.slice(units, r["s"], r["e"] - r["s"] + 1), " "), r"^>>(?U)\s*", "")))
    return F.filter(joined, lambda t: t != "")


def pack_chunks(text: Column, most: int = 8000) -> Column:
    """Greedy packing of the parts between speaker marks into chunks of at most ``most`` characters (4 per part for
    the mark); a longer part is a chunk of its own."""
    state = F.struct(F.array().cast("array<string>").alias("done"), F.array().cast("array<string>").alias("cur"), F.lit(0).alias("len"))

    def step(a: Column, p: Column) -> Column:
        size = F.length(p) + 4
        full = (F.size(a["cur"]) > 0) & (a["len"] + size > most)
        flushed = F.struct(F.concat(a["done"], F.array(F.array_join(a["cur"], MARK))).alias("done"), F.array(p).alias("cur"), size.alias("len"))
        grown = F.struct(a["done"].alias("done"), F.concat(a["cur"], F.array(p)).alias("cur"), (a["len"] + size).alias("len"))
        return F.when(full, flushed).otherwise(grown)

    return F.aggregate(F.split(text, MARK, -1), state, step, lambda a: F.concat(a["done"], F.array(F.array_join(a["cur"], MARK))))


def only_vocative(speaker: Column, text: Column) -> Column:
    """The speaker's name occurs in the text, each time only to address someone.

    An occurrence addresses if a comma stands on one side and a comma, a sentence mark or nothing on the other.
    """
    name = F.regexp_replace(ws_trim(speaker), r"([\\.\[\]{}()*+?^$|\-])", r"\\$1")
    pieces = F.split(text, F.concat(F.lit(r"(?iU)\b"), name, F.lit(r"\b")), -1)
    edge_l, edge_r = F.substring(ws_trim(speaker), -1, 1), F.substring(ws_trim(speaker), 1, 1)
    n = F.size(pieces)

    def before(i: Column) -> Column:
        p = ws_trim(F.element_at(pieces, i + 1))
        return F.when(p != "", F.substring(p, -1, 1)).when(i > 0, edge_l).otherwise("")

    def after(i: Column) -> Column:
        p = ws_trim(F.element_at(pieces, i + 2))
        return F.when(p != "", F.substring(p, 1, 1)).when(i + 2 < n, edge_r).otherwise("")

    ends, sides = ("", ".", "!", "?", ","), ("", ".", "!", "?")
    called = lambda i: ((before(i) == ",") & after(i).isin(*ends)) | (before(i).isin(*sides) & (after(i) == ","))
    hit = (n > 1) & F.forall(F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0))), lambda i: F.when(n > 1, called(i)).otherwise(False))
    return F.coalesce(F.when(ws_trim(speaker) != "", hit), F.lit(False))


def cap_vocative(score: Column, speaker: Column, text: Column) -> Column:
    return F.when((score > 0.5) & only_vocative(speaker, text), F.lit(0.5)).otherwise(score)


def entry_block(index: Column, text: Column) -> Column:
    return F.concat(F.lit("["), index.cast("string"), F.lit("] TEXT:\n"), ws_trim(F.coalesce(text, F.lit(""))))


def review_block(index: Column, speaker: Column, dialogue: Column) -> Column:
    shown = F.when(F.coalesce(speaker, F.lit("")) == "", F.lit("(none)")).otherwise(speaker)
    return F.concat(F.lit("["), index.cast("string"), F.lit("] CURRENTLY ASSIGNED SPEAKER: "), shown, F.lit("\nDIALOGUE: "), ws_trim(F.coalesce(dialogue, F.lit(""))))


def fence_strip(text: Column) -> Column:
    """JSON without the code fence around it."""
    t = ws_trim(text)
    return ws_trim(F.regexp_replace(F.regexp_replace(t, r"^```(?:json)?\s*", ""), r"\s*```$", ""))


def strip_clip(speaker: Column) -> Column:
    return ws_trim(F.regexp_replace(speaker, r"(?i)\s*\(Clip\)\s*$", ""))
