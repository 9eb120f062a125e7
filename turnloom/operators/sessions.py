"""Splitting events into sessions by inactivity gap (problem 1): pointer doubling over events.

Moments that lie in one span no longer than the gap belong together whatever else there is, so they enter as one
node. Every node points to its predecessor, the node of the span before, if that one ends within the gap; pointers
are squared by self-join until every chain has found its root, and nodes are summed by root. No task sees more of a
hot key than its share of the spans, and neither a window nor a loop over a key's events is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.runtime import cut


def nodes(events: DataFrame, key: str, moment: str, gap: int) -> DataFrame:
    """``key, span, start, end, n`` of the distinct moments in each span of ``gap + 1`` seconds.

    Dealt out by key and span once, which serves the distinct moments and their sums alike.
    """
    t = F.col(moment)
    rows = events.select(F.col(key).alias("key"), F.floor(t / (gap + 1)).cast("long").alias("span"), t.alias("t")).filter("t is not null and key is not null")
    once = rows.repartition("key", "span").distinct()
    return once.groupBy("key", "span").agg(F.min("t").alias("start"), F.max("t").alias("end"), F.count("*").alias("n"))


def double_pointers(pointers: DataFrame) -> DataFrame:
    """Roots of ``(key, node, parent)`` chains as ``(key, node, root)``; a node without parent, or its own, is a root.

    Each round replaces a pointer by its target's pointer, so a chain of length n settles in log2(n) rounds; nodes
    whose target is a root are settled and only looked up from then on.
    """
    given = cut(pointers.select("key", "node", F.col("parent").alias("root")))
    own, active = given.filter("node = root"), given.filter("node <> root")
    settled: DataFrame | None = None
    while True:
        every = active if settled is None else settled.unionByName(active)
        up = every.select("key", F.col("node").alias("root"), F.col("root").alias("higher"))
        step = cut(active.join(up, ["key", "root"], "left").select("key", "node", F.coalesce("higher", "root").alias("root"), F.col("higher").isNotNull().alias("moved")))
        still = step.filter("not moved").drop("moved")
        settled = still if settled is None else settled.unionByName(still)
        active = step.filter("moved").drop("moved")
        if active.isEmpty():
            return settled.unionByName(own)


def sessions(events: DataFrame, key: str, moment: str, gap: int = 300) -> DataFrame:
    """One row per session: ``key, start, end, duration, n_events``.

    Two neighbouring moments (whole seconds) of a key belong together if at most ``gap`` apart; equal moments
    count once; rows without key or moment are left out; an empty input gives no rows.
    """
    parts = cut(nodes(events, key, moment, gap))
    before = parts.select("key", (F.col("span") + 1).alias("span"), F.col("end").alias("before"))
    linked = parts.join(before, ["key", "span"]).filter(F.col("start") - F.col("before") <= gap)
    roots = double_pointers(linked.select("key", F.col("span").alias("node"), (F.col("span") - 1).alias("parent")))
    rooted = parts.join(roots.withColumnRenamed("node", "span"), ["key", "span"], "left").withColumn("root", F.coalesce("root", "span"))
    out = rooted.groupBy("key", "root").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n_events"))
    return out.select(F.col("key").alias(key), "start", "end", (F.col("end") - F.col("start")).alias("duration"), "n_events")
