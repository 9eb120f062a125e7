"""Repeated consecutive events collapsed into runs (problem 6): optimal segmentation by pruned dynamic programming.

A run costs a fixed boundary penalty plus the dissimilarity of its members to the run's best member; the cheapest
segmentation of each entity's sequence is found by dynamic programming. Where two neighbours are too far apart for
any run to hold both, the sequence falls into stretches that are solved alone, and starts that no run can reach are
pruned. Cells of a bounded range of positions are read by themselves, so no task sees a whole hot entity: stretches
within a cell are solved there; those at its edges carry their items (equal neighbours are one item), are linked with
the next cell's by pointer doubling, and solved as a whole. Where cells end makes no difference to the result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.operators.sessions import double_pointers
from turnloom.runtime import cut, parallelism

BOUNDARY = 1.0
SLIP = 0.01  # a member one slip of the keyboard away from the run's best member
CELL = 1024  # positions per cell

# Speakers that name nobody.
NOBODY = ("", "unknown", "unknownspeaker", "unidentified", "unidentifiedspeaker", "none", "null", "na", "nan", "tbc", "tbd", "anonymous")

_NOTES = r"\([^()]*\)|\[[^\[\]]*\]|\{[^{}]*\}|<[^<>]*>|♪+|>>+"
_BEFORE = r"(?U)^\s*\p{L}[\p{L} ]{1,20}?(?:\s+[-–—|]|\s*/)\s+(?=\S)"


def speaker_key(speaker: Column) -> Column:
    """Letters and digits of a typed speaker in lower case, without notes around the name; null if nobody."""
    s = F.regexp_replace(speaker, _NOTES, " ")
    s = F.regexp_replace(s, _BEFORE, "")
    s = F.lower(F.regexp_replace(s, r"(?U)[^\p{L}\p{M}\p{N}]+", ""))
    return F.when(~s.isin(*NOBODY), s)


def one_slip(a: str, b: str) -> bool:
    """Equal, or one letter left out, added, changed, or two neighbours swapped."""
    if a == b:
        return True
    la, lb = len(a), len(b)
    if abs(la - lb) > 1:
        return False
    i = 0
    while i < la and i < lb and a[i] == b[i]:
        i += 1
    if la == lb:
        return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])
    if la > lb:
        return a[i + 1 :] == b[i:]
    return a[i:] == b[i + 1 :]


def _distance(a: str, b: str) -> float:
    if a == b:
        return 0.0
    return SLIP if min(len(a), len(b)) > 3 and one_slip(a, b) else float("inf")


def stretches(keys: list[str | None]) -> list[list[list]]:
    """Items ``[key, start, end exclusive]`` of equal neighbours, in stretches that no run can span. Null keys are in none."""
    out: list[list[list]] = []
    before = None
    for p, k in enumerate(keys):
        if k is not None:
            if before is None or not _together(before, k):
                out.append([[k, p, p + 1]])
            elif before == k:
                out[-1][-1][2] = p + 1
            else:
                out[-1].append([k, p, p + 1])
        before = k
    return out


def _together(a: str, b: str) -> bool:
    """Whether neighbours could stand in one run: both within one slip of some spelling."""
    return a == b or _distance(a, b) < float("inf") or _near(a, b)


def solve(items: list[tuple[str, int]]) -> list[tuple[int, int, str]]:
    """Cheapest runs ``(first item, last item exclusive, best member)`` of a stretch of ``(key, how many)``.

    Ties go to the longer run that starts earlier.
    """
    n = len(items)
    best = [0.0] * (n + 1)
    back: list = [None] * (n + 1)
    for j in range(1, n + 1):
        best[j] = float("inf")
        counts: dict[str, int] = {}
        for i in range(j - 1, -1, -1):
            k, many = items[i]
            if k not in counts and any(_distance(k, c) > 2 and not _near(k, c) for c in counts):
                break  # members of a run are one slip from its best member, so two from each other
            counts[k] = counts.get(k, 0) + many
            within, rep = min((sum(_distance(c, r) * w for c, w in counts.items()), -counts[r], r) for r in counts)[::2]
            if within == float("inf"):
                continue  # a member further back may be near them all
            if best[i] + BOUNDARY + within <= best[j]:
                best[j], back[j] = best[i] + BOUNDARY + within, (i, rep)
    cuts, j = [], n
    while j:
        i, rep = back[j]
        cuts.append((i, j, rep))
        j = i
    return cuts[::-1]


def segment(keys: list[str | None]) -> list[tuple[int, int, str]]:
    """Cheapest runs ``(start, end exclusive, best member)`` of a sequence; null keys are in no run."""
    return [(x[a][1], x[b - 1][2], rep) for x in stretches(keys) for a, b, rep in solve([(k, e - s) for k, s, e in x])]


def _near(a: str, b: str) -> bool:
    """Within two slips, so a third spelling could hold both."""
    if abs(len(a) - len(b)) > 2:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    for x, y in ((a[i + 1 :], b[i:]), (a[i:], b[i + 1 :]), (a[i + 1 :], b[i + 1 :]), (a[i + 2 :], b[i + 2 :])):
        if one_slip(x, y):
            return True
    return False


_RUN = ["first_pos", "last_pos", "n", "first_s", "last_s", "rep"]
_ITEM = "struct<key:string,first_pos:bigint,last_pos:bigint,n:bigint,first_s:bigint,last_s:bigint>"
_RUNS = "first_pos bigint, last_pos bigint, n bigint, first_s bigint, last_s bigint, rep string"
_PARTS = f"entity string, cell bigint, at bigint, {_RUNS}, opens boolean, closes boolean, items array<{_ITEM}>"


def _runs_of(items: list[dict]) -> list[tuple]:
    """The runs of one stretch as rows of ``_RUN``."""
    out = []
    for a, b, rep in solve([(x["key"], x["n"]) for x in items]):
        out.append((items[a]["first_pos"], items[b - 1]["last_pos"], sum(x["n"] for x in items[a:b]), items[a]["first_s"], items[b - 1]["last_s"], rep))
    return out


def _cell(rows: list[tuple]) -> list[tuple]:
    """Runs of one cell's ``(pos, key, second)``; those of a stretch at its edge carry the stretch's items once."""
    out = []
    for x in stretches([r[1] for r in rows]):
        opens, closes, at = x[0][1] == 0, x[-1][2] == len(rows), x[0][1]
        items = [{"key": k, "first_pos": rows[s][0], "last_pos": rows[e - 1][0], "n": e - s, "first_s": rows[s][2], "last_s": rows[e - 1][2]} for k, s, e in x]
        for i, r in enumerate(_runs_of(items)):
            out.append((at, *r, opens, closes, items if i == 0 and (opens or closes) else None))
    return out or [(0, None, None, 0, None, None, None, False, False, None)]  # nobody speaks here, which parts the cells around


def _grouped(rows: DataFrame, keys: list[str], values: list[str], make, schema: str) -> DataFrame:
    """``make(list of values)`` for each run of equal ``keys`` in sorted partitions: ``keys`` and the rows it gives."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, held = None, []
        names = [c.split()[0] for c in schema.split(", ")]

        def close() -> list[tuple]:
            return [(*here, *r) for r in make(held)] if held else []

        for batch in batches:
            done: list[tuple] = []
            for k, v in zip(zip(*(batch[c].tolist() for c in keys)), zip(*(_plain(batch[c]) for c in values))):
                if k != here:
                    done += close()
                    here, held = k, []
                held.append(v)
            yield _frame(done, names)
        yield _frame(close(), names)

    return rows.select(*keys, *values).mapInPandas(run, schema)


def _plain(c: pd.Series) -> list:
    return [None if isinstance(x, float) and x != x else int(x) if isinstance(x, float) else x for x in c.tolist()]


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    return out.astype({c: "Int64" for c in ("first_pos", "last_pos", "first_s", "last_s")}) if rows else out


def _joined(held: list[tuple]) -> list[tuple]:
    """Runs of the linked stretches of several cells, in order: equal neighbours at a seam are one item."""
    items: list[dict] = []
    for (part,) in held:
        for x in part:
            x = dict(x.asDict() if hasattr(x, "asDict") else x)
            for c in ("first_s", "last_s"):
                x[c] = None if x[c] is None or x[c] != x[c] else int(x[c])
            if items and items[-1]["key"] == x["key"]:
                items[-1] |= {"last_pos": x["last_pos"], "n": items[-1]["n"] + x["n"], "last_s": x["last_s"]}
            else:
                items.append(x)
    out, start = [], 0
    for i in range(1, len(items) + 1):
        if i == len(items) or not _together(items[i - 1]["key"], items[i]["key"]):
            out += _runs_of(items[start:i])
            start = i
    return out


def collapse_runs(events: DataFrame, cell: int = CELL) -> DataFrame:
    """Runs of ``(entity, pos, key, second)``: ``entity, first_pos, last_pos, n, first_s, last_s, rep``.

    ``pos`` orders an entity's events (holes allowed, rows without it left out), ``key`` is null for events that
    belong to no run and end one. Events with equal ``pos`` are ordered by key. Runs of one event are returned too.
    """
    rows = events.filter("pos is not null and entity is not null").withColumn("cell", F.floor(F.col("pos") / cell).cast("long"))
    n = parallelism(rows.sparkSession)
    laid = rows.repartition(n, "entity", "cell").sortWithinPartitions("entity", "cell", "pos", "key")
    parts = cut(_grouped(laid, ["entity", "cell"], ["pos", "key", "second"], _cell, _PARTS))
    # Cells meet where their edge stretches might run on; holes may leave cells empty, so the neighbour is the entity's cell before.
    cells = parts.select("entity", "cell").distinct()
    order = cells.withColumn("before", F.lag("cell").over(Window.partitionBy("entity").orderBy("cell"))).filter("before is not null")
    edges = parts.filter("items is not null").select("entity", "cell", "at", "opens", "closes", "items")
    left = edges.filter("closes").select("entity", F.col("cell").alias("before"), F.struct("cell", "at").alias("parent"), F.element_at("items", -1)["key"].alias("last_key"))
    right = edges.filter("opens").join(order, ["entity", "cell"]).join(left, ["entity", "before"])
    # Two slips are four letters at most; whether the keys go together is settled when the stretch is solved.
    linked = right.filter(F.levenshtein(F.element_at("items", 1)["key"], F.col("last_key")) <= 4)
    linked = cut(linked.select(F.col("entity").alias("key"), F.struct("cell", "at").alias("node"), "parent"))
    parts = parts.filter("n > 0")
    done = parts.select("entity", *_RUN)
    if linked.isEmpty():
        return done
    roots = double_pointers(linked)
    ends = roots.select("key", F.col("root").alias("node")).distinct().withColumn("root", F.col("node"))
    member = cut(roots.unionByName(ends).select(F.col("key").alias("entity"), F.col("node")["cell"].alias("cell"), F.col("node")["at"].alias("at"), F.col("root")["cell"].alias("root_cell"), F.col("root")["at"].alias("root_at")))
    apart = parts.join(member.select("entity", "cell", "at"), ["entity", "cell", "at"], "left_anti").select("entity", *_RUN)
    whole = edges.join(member, ["entity", "cell", "at"]).repartition(n, "entity", "root_cell", "root_at").sortWithinPartitions("entity", "root_cell", "root_at", "cell", "at")
    solved = _grouped(whole, ["entity", "root_cell", "root_at"], ["items"], _joined, f"entity string, root_cell bigint, root_at bigint, {_RUNS}")
    return apart.unionByName(solved.select("entity", *_RUN))


def clock_seconds(text: Column) -> Column:
    """``HH:MM[:SS]`` as the second of the day, null where it is none."""
    p = r"^\s*(\d{1,2}):(\d{2})(?::(\d{2}))?\s*$"
    part = lambda i: F.regexp_extract(text, p, i)
    return F.when(text.rlike(p), part(1).cast("int") * 3600 + part(2).cast("int") * 60 + F.when(part(3) == "", 0).otherwise(part(3).try_cast("int"))).cast("long")


def speaker_runs(dialogues: DataFrame) -> DataFrame:
    """Runs of near-identical speakers per group: ``group_id, first_order, last_order, n_turns, duration_s, speaker``.

    A dialogue delivered twice counts once, the latest ``loaded_at`` holding; rows without ``order_index`` or
    ``group_id`` are left out; blank, null and unknown speakers belong to no run and end one. Durations run across
    midnight; they are null where a clock time can't be read.
    """
    held = F.struct("group_id", "order_index", "speaker", "broadcast_time")
    latest = dialogues.groupBy("dialogue_id").agg(F.max_by(held, F.struct("loaded_at", held)).alias("v")).select("v.*")
    events = latest.select(
        F.col("group_id").alias("entity"), F.col("order_index").cast("long").alias("pos"), speaker_key(F.col("speaker")).alias("key"),
        clock_seconds(F.col("broadcast_time")).alias("second"),
    )
    runs = collapse_runs(events)
    duration = F.pmod(F.col("last_s") - F.col("first_s"), F.lit(86400))
    return runs.select(
        F.col("entity").alias("group_id"), F.col("first_pos").alias("first_order"), F.col("last_pos").alias("last_order"),
        F.col("n").alias("n_turns"), duration.alias("duration_s"), F.col("rep").alias("speaker_key"),
    )
