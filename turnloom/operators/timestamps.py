"""Mixed timestamp formats and zones: one UTC moment per record (problem 3).

Every value becomes the array of moments it can name; a Viterbi pass over each source's record order picks
one per record, charging a format switch and a backward step in time. What a source declares (its zone, its
order of day and month) narrows the arrays first, so declared knowledge is never outvoted.

Scale: a record with a single reading cuts the chain, for the best path on either side of it is independent
of the other. Records are therefore held in blocks of a bounded range of the record number; blocks without a
doubtful record never leave the JVM, the others hand a K x K cost matrix to a per-source pass over blocks
(one row per doubtful block), and are then solved inside with their ends fixed. No task sees a whole source.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions.moments import add_date_readings, add_time_reading, wall_moments, zone_offset
from turnloom.functions.text import fold_key
from turnloom.runtime import by_value, cut, hold

SWITCH_COST = 1.0
BACKWARD_COST = 2.0
BLOCK = 4096

_CAND = "array<struct<fmt:string,utc:bigint>>"


def _day_readings(df: DataFrame, date: str) -> DataFrame:
    """Add ``__days``: the days that ``date`` can name, each with the seconds its zone is east of UTC where its clocks
    keep one offset from the day before to the day after, null where they are changed about then."""
    df = add_date_readings(df, F.col(date), F.col("__order"), "__days")
    zone = F.col("__zone")

    def steady(day: Column) -> Column:
        before, after = zone_offset((day - 1) * 86400, zone), zone_offset((day + 2) * 86400, zone)
        return F.when(before == after, before)

    return hold(df.withColumnRenamed("__days", "__d"), __days=F.transform("__d", lambda d: F.struct(d["fmt"].alias("fmt"), d["day"].alias("day"), steady(d["day"]).alias("east")))).drop("__d")


def with_readings(df: DataFrame, date: str, time: str, zone: Column, order: Column, out: str = "readings") -> DataFrame:
    """Add ``out``: the distinct moments that date and time text can name, each with its format.

    Dates repeat, so each distinct one (with its zone and order) is read once, together with the offset of its day;
    only on days about a clock change are offsets looked up by the second. Takes zones whose changes lie more than
    three days apart.
    """
    df = hold(df, __zone=zone, __order=order)
    df = by_value(df, [date, "__zone", "__order"], lambda x: _day_readings(x, date))
    df = add_time_reading(df, F.col(time), F.col("__zone"), "__clock")
    clock = F.col("__clock")
    stamp = F.array(F.struct(F.lit("stamp").alias("fmt"), clock["stamp_day"].alias("day"), F.lit(None).cast("bigint").alias("east")))
    dated = F.when(clock["stamp_day"].isNotNull(), stamp).otherwise(F.col("__days"))
    walls = F.transform(dated, lambda d: F.struct(F.concat_ws("+", d["fmt"], clock["fmt"]).alias("fmt"), (d["day"] * 86400 + clock["sod"]).alias("wall"), d["east"].alias("east")))
    df = hold(df, __walls=F.when(clock["sod"].isNotNull() & clock["fmt"].isNotNull(), walls))

    def moments(r: Column) -> Column:
        return F.when(clock["off"].isNotNull(), F.array(r["wall"] - clock["off"] * 60)).when(r["east"].isNotNull(), F.array(r["wall"] - r["east"])).otherwise(wall_moments(r["wall"], F.col("__zone")))

    found = F.when(clock["epoch"].isNotNull(), F.array(F.struct(F.lit("epoch").alias("fmt"), clock["epoch"].alias("utc")))).otherwise(
        F.flatten(F.transform("__walls", lambda r: F.transform(moments(r), lambda u: F.struct(r["fmt"].alias("fmt"), u.alias("utc")))))
    )
    df = hold(df, **{out: F.coalesce(F.filter(found, lambda r: r["utc"].isNotNull()), F.array().cast(_CAND))})
    reason = (
        F.when(F.size(out) > 0, F.lit(None).cast("string"))
        .when(clock["fmt"].isNull(), F.lit("no_time"))
        .when((F.size("__days") == 0) & clock["stamp_day"].isNull(), F.lit("no_date"))
        .otherwise(F.lit("skipped_by_clock_change"))
    )
    return df.withColumn("no_moment", reason).drop("__zone", "__order", "__days", "__clock", "__walls")


def _step(a: list, b: list) -> np.ndarray:
    fa, ua = np.array([x["fmt"] for x in a], dtype=object), np.array([x["utc"] for x in a], dtype=np.int64)
    fb, ub = np.array([x["fmt"] for x in b], dtype=object), np.array([x["utc"] for x in b], dtype=np.int64)
    return SWITCH_COST * (fa[:, None] != fb[None, :]) + BACKWARD_COST * (ub[None, :] < ua[:, None])


def _path(chain: list[list], first: int | None = None, last: int | None = None) -> list[int]:
    """Indices of the cheapest path; ties go to the earlier reading. Single readings cut the work."""
    cost = np.zeros(len(chain[0]))
    if first is not None:
        cost = np.where(np.arange(len(cost)) == first, 0.0, np.inf)
    back = []
    for a, b in zip(chain, chain[1:]):
        if len(a) == 1 and len(b) == 1:
            back.append(None)
            continue
        total = cost[:, None] + _step(a, b)
        back.append(total.argmin(axis=0))
        cost = total.min(axis=0)
        if len(b) == 1:
            cost = np.zeros(1)
    k = int(cost.argmin()) if last is None else last
    picks = [k]
    for bp in reversed(back):
        k = 0 if bp is None else int(bp[k])
        picks.append(k)
    return picks[::-1]


def _matrix(chain: list[list]) -> np.ndarray:
    """Cheapest cost from each reading of the first record to each of the last."""
    m = np.where(np.eye(len(chain[0])) > 0, 0.0, np.inf)
    for a, b in zip(chain, chain[1:]):
        m = (m[:, :, None] + _step(a, b)[None, :, :]).min(axis=1)
    return m


def _chain(pdf: pd.DataFrame, col: str) -> list[list]:
    return [list(x) for x in pdf[col]]


def viterbi_choice(df: DataFrame, source: str, position: str, readings: str = "readings", block: int = BLOCK) -> DataFrame:
    """Add ``utc`` (null without a reading), ``format`` and ``n_moments`` (distinct moments among the readings).

    ``position`` is a unique whole number giving the record order within ``source``; a block holds at most
    ``block`` numbers, so tasks stay bounded whatever share of the rows a source has. Null sources form one
    source of their own. Records without a reading are passed over.
    """
    n = F.size(F.array_distinct(F.transform(readings, lambda r: r["utc"])))
    key = F.coalesce(F.col(source).cast("string"), F.lit(""))
    base = cut(hold(df, n_moments=n.cast("bigint"), __src=key, __blk=F.floor(F.col(position) / block).cast("long")))
    rows = base.select("__src", "__blk", F.col(position).alias("__pos"), F.col(readings).alias("__c")).filter(F.size("__c") > 0)
    blocks = rows.groupBy("__src", "__blk").agg(
        F.min_by("__c", "__pos").alias("head"), F.max_by("__c", "__pos").alias("tail"), F.max(F.size("__c")).alias("widest")
    )
    blocks = cut(blocks)
    doubtful = blocks.filter("widest > 1").select("__src", "__blk")
    if doubtful.isEmpty():
        picks = None
    else:
        inside = rows.join(doubtful, ["__src", "__blk"], "left_semi")

        def matrices(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("__pos", kind="stable")
            m = _matrix(_chain(pdf, "__c"))
            return pd.DataFrame({"__src": [pdf["__src"].iloc[0]], "__blk": [pdf["__blk"].iloc[0]], "cost": [m.ravel().tolist()]})

        costs = inside.groupBy("__src", "__blk").applyInPandas(matrices, "__src string, __blk bigint, cost array<double>")
        line = blocks.filter("widest > 1 or size(head) > 1 or size(tail) > 1").join(costs, ["__src", "__blk"], "left")
        # Neighbouring blocks with single readings only enter as one fixed record on either side.
        from pyspark.sql import Window

        w = Window.partitionBy("__src").orderBy("__blk")
        near = blocks.withColumns({"before": F.lag("tail").over(w), "after": F.lead("head").over(w), "prev_wide": F.lag("widest").over(w), "next_wide": F.lead("widest").over(w)})
        line = near.join(line.select("__src", "__blk", "cost"), ["__src", "__blk"])

        def ends(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("__blk", kind="stable")
            out, run = [], []

            def flush() -> None:
                if not run:
                    return
                # A path over block ends: [before] head0 tail0 head1 tail1 ... [after]
                k0, first = len(run[0].head), run[0]
                cost = np.zeros(k0)
                if first.before is not None and len(first.before) == 1:
                    cost = _step(list(first.before), list(first.head))[0]
                backs = []
                for i, r in enumerate(run):
                    m = np.array(r.cost).reshape(len(r.head), len(r.tail))
                    t = cost[:, None] + m
                    backs.append(t.argmin(axis=0))
                    cost = t.min(axis=0)
                    if i + 1 < len(run):
                        t = cost[:, None] + _step(list(r.tail), list(run[i + 1].head))
                        backs.append(t.argmin(axis=0))
                        cost = t.min(axis=0)
                end = run[-1]
                if end.after is not None and len(end.after) == 1:
                    cost = cost + _step(list(end.tail), list(end.after))[:, 0]
                k = int(cost.argmin())
                got = [k]
                for b in reversed(backs):
                    k = int(b[k])
                    got.append(k)
                got = got[::-1]
                out.extend((r.src, r.blk, got[2 * i], got[2 * i + 1]) for i, r in enumerate(run))
                run.clear()

            pdf = pdf.rename(columns={"__src": "src", "__blk": "blk"})
            for r in pdf.itertuples(index=False):
                if run and not (r.prev_wide is not None and r.prev_wide > 1):
                    flush()
                run.append(r)
            flush()
            return pd.DataFrame(out, columns=["__src", "__blk", "first", "last"])

        fixed = line.groupBy("__src").applyInPandas(ends, "__src string, __blk bigint, first int, last int")

        def solve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if left.empty or right.empty:
                return pd.DataFrame({"__src": [], "__blk": [], "__pos": [], "pick": []})
            left = left.sort_values("__pos", kind="stable")
            p = _path(_chain(left, "__c"), int(right["first"].iloc[0]), int(right["last"].iloc[0]))
            keep = [len(c) > 1 for c in left["__c"]]
            return left.assign(pick=p)[["__src", "__blk", "__pos", "pick"]][keep]

        picks = inside.groupBy("__src", "__blk").cogroup(fixed.groupBy("__src", "__blk")).applyInPandas(solve, "__src string, __blk bigint, __pos bigint, pick int")
        picks = picks.select("__src", F.col("__pos").alias("__p"), "pick")
    if picks is not None:
        base = base.join(picks, (base["__src"] == picks["__src"]) & (base[position] == picks["__p"]), "left").drop(picks["__src"], "__p")
    else:
        base = base.withColumn("pick", F.lit(None).cast("int"))
    best = F.try_element_at(F.col(readings), F.coalesce(F.col("pick"), F.lit(0)) + 1)
    return base.withColumns({"utc": best["utc"], "format": best["fmt"]}).drop("__src", "__blk", "pick")


def clip_moments(clips: DataFrame, channels: DataFrame) -> DataFrame:
    """Clips with ``channel_id``, ``utc`` (chosen moment), ``format``, ``n_moments`` and ``no_moment`` (reason).

    Channel names are matched without regard to case and white space. A clip of an unknown channel keeps both
    readings of an all-number date and takes UTC as its home zone. ``n_moments`` is 1 where date and time name
    exactly one moment, 2 or more where the choice is Viterbi's, 0 where they name none.
    """
    dim = channels.select(F.col("channel_id"), "home_zone", "date_order", fold_key(F.col("channel_name")).alias("__ch"))
    kept = [c for c in clips.columns if c not in ("channel_id", "home_zone", "date_order", "utc", "format", "n_moments", "no_moment", "readings")]
    joined = clips.select(*kept, fold_key(F.col("channel_name")).alias("__ch")).join(dim, "__ch", "left")
    read = with_readings(joined, "broadcast_date", "broadcast_time", F.coalesce("home_zone", F.lit("UTC")), F.col("date_order"))
    return viterbi_choice(read.drop("home_zone", "date_order"), "__ch", "clip_id").drop("__ch", "readings")
