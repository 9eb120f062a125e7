"""Mixing sources to target weights (problem 9) along a time-varying curriculum.

Tokens available are counted over all documents. Demand is poured onto the sources by target share; a source that
would need more repeats than its cap gives its surplus to the others. Every source has a weight schedule over
training time; its integral is the cumulative demand, and a document's place in its source's token stream is turned
into a training position by inverting that integral. Documents are then range-sorted by position. Prefix sums run
over hash buckets first and inside buckets second, so a source with a third of all rows is never in one task.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.runtime import cut

BUCKETS = 4096
MOST_SOURCES = 10_000  # the table of targets is held by the driver and broadcast; larger ones are refused


@lru_cache(maxsize=2)
def _encoding(path: str):
    import public_tokenizers as P
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def default_vocabulary() -> str:
    import public_tokenizers as P

    return str(P.path("byte_bpe_50k.tiktoken"))


def token_counts(docs: DataFrame, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``doc_id, source, n_tokens``; null texts have 0 tokens. ``vocabulary`` is a file of byte-pair ranks."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = _encoding(path)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b["t"]]
            yield b[["doc_id", "source"]].assign(n_tokens=n)

    return docs.select("doc_id", "source", F.col(text).alias("t")).mapInPandas(run, "doc_id bigint, source string, n_tokens bigint")


def pour(sources: list[dict], total: float) -> dict[str, float]:
    """Tokens asked of each source: target shares of ``total``, at most ``tokens * max_repeats`` each; what a capped
    source can't give is shared among the rest by target until nothing is left to give or to ask."""
    demand = {s["source"]: 0.0 for s in sources}
    open_ = [s for s in sources if s["target_share"] > 0 and s["tokens"] * s["max_repeats"] > 0]
    left = total
    while open_ and left > 1e-6:
        weight = sum(s["target_share"] for s in open_)
        full = [s for s in open_ if left * s["target_share"] / weight > s["tokens"] * s["max_repeats"] * (1 + 1e-9)]
        if not full:
            for s in open_:
                demand[s["source"]] = left * s["target_share"] / weight
            break
        for s in full:
            demand[s["source"]] = float(s["tokens"] * s["max_repeats"])
            left -= demand[s["source"]]
        open_ = [s for s in open_ if s not in full]
    return demand


def largest_exact(sources: list[dict]) -> float:
    """The largest total at which no source with documents needs more than its capped repeats. Shares of sources
    without documents fall to the others by target."""
    able = [s for s in sources if s["target_share"] > 0 and s["tokens"] * s["max_repeats"] > 0]
    weight = sum(s["target_share"] for s in able)
    return min((s["tokens"] * s["max_repeats"] * weight / s["target_share"] for s in able), default=0.0)


def tilts(demand: dict[str, float], slope: float = 0.5) -> dict[str, float]:
    """Slopes of the weight schedules ``share * (1 + k (2t - 1))``: small sources grow over training, large ones
    give way, so that the weights sum to one at every moment (the share-weighted mean of the slopes is 0)."""
    total = sum(demand.values()) or 1.0
    share = {s: d / total for s, d in demand.items()}
    raw = {s: 1.0 - p for s, p in share.items()}
    mean = sum(raw[s] * share[s] for s in share)
    off = {s: raw[s] - mean for s in raw}
    widest = max((abs(v) for v in off.values()), default=0.0) or 1.0
    return {s: slope * v / widest for s, v in off.items()}


def invert(c: Column, k: Column) -> Column:
    """Time at which the integral ``(1 - k) t + k t^2`` of a schedule reaches the part ``c`` of its demand."""
    b = 1 - k
    return F.when(F.abs(k) < 1e-9, c).otherwise((F.sqrt(b * b + 4 * k * c) - b) / (2 * k))


def plan(tokens: DataFrame, targets: DataFrame, total: float | None = None, slope: float = 0.5) -> DataFrame:
    """``source, target_share, max_repeats, tokens, demand, repeats, k``: one row per target. ``total`` is the size
    wished for in tokens; by default the largest at which every source that has documents supplies its share."""
    have = tokens.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    rows = targets.filter("source is not null").join(have, "source", "left").select("source", "target_share", "max_repeats", F.coalesce("tokens", F.lit(0)).alias("tokens")).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} targets")
    sources = sorted((r.asDict() for r in rows), key=lambda r: r["source"])
    wish = total if total is not None else largest_exact(sources)
    demand = pour(sources, wish)
    k = tilts(demand, slope)
    data = [
        (s["source"], float(s["target_share"]), int(s["max_repeats"]), int(s["tokens"]), demand[s["source"]], min(float(s["max_repeats"]), demand[s["source"]] / s["tokens"]) if s["tokens"] else 0.0, k[s["source"]])
        for s in sources
    ]
    return tokens.sparkSession.createDataFrame(data, "source string, target_share double, max_repeats int, tokens bigint, demand double, repeats double, k double")


def placed(tokens: DataFrame, mix: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``position, doc_id, copy, source, n_tokens``: every copy with its training position in [0, 1], unsorted.

    Documents without tokens or target are left out. Order within a source is by hash of the document number. A
    source's whole repeats go to all its documents, the last part of one to those first in its order.
    """
    p = mix.filter("demand > 0").select("source", F.col("tokens").alias("have"), "repeats", "max_repeats", "demand", "k")
    docs = tokens.filter("n_tokens > 0").join(F.broadcast(p), "source")  # at most MOST_SOURCES rows
    h = F.xxhash64("doc_id")
    docs = docs.withColumns({"h": h, "bucket": F.pmod(F.shiftrightunsigned(h, 20), F.lit(buckets)).cast("int")})
    sums = docs.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("in_bucket"))
    before = F.coalesce(F.sum("in_bucket").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = sums.select("source", "bucket", before.alias("base"))
    inner = Window.partitionBy("source", "bucket").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    laid = docs.withColumn("within", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0))).join(base, ["source", "bucket"])
    start = F.col("base") + F.col("within")
    whole = F.floor("repeats")
    extra = F.when((start + F.col("n_tokens") / 2 < (F.col("repeats") - whole) * F.col("have")) & (whole < F.col("max_repeats")), 1).otherwise(0)
    copies = (whole + extra).cast("int")
    out = laid.withColumns({"start": start, "copies": copies}).filter("copies > 0")
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    middle = F.least(F.lit(1.0), ((F.col("copy") - 1) * F.col("have") + F.col("start") + F.col("n_tokens") / 2) / F.col("demand"))
    return out.select(invert(middle, F.col("k")).alias("position"), "doc_id", F.col("copy").cast("bigint").alias("copy"), "source", "n_tokens")


def mixture(docs: DataFrame, targets: DataFrame, total: float | None = None, slope: float = 0.5) -> DataFrame:
    """Documents in training order (range-sorted by position)."""
    tokens = cut(token_counts(docs))
    return placed(tokens, plan(tokens, targets, total, slope)).orderBy("position", "doc_id", "copy")


def reached(docs: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """The report: one row per target and per source without one, with the shares reached."""
    tokens = cut(token_counts(docs))
    mix = plan(tokens, targets, total)
    got = placed(tokens, mix).groupBy("source").agg(F.sum("n_tokens").alias("mixed_tokens"), F.countDistinct("doc_id").alias("n_documents"), F.max("copy").alias("most_copies"))
    have = tokens.groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"))
    every = have.join(mix.select("source", "target_share", "max_repeats"), have["source"].eqNullSafe(mix["source"]), "full").select(F.coalesce(have["source"], mix["source"]).alias("source"), "available_tokens", "target_share", "max_repeats")
    rows = every.join(got, "source", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    all_mixed = got.agg(F.sum("mixed_tokens")).first()[0] or 0
    share = F.coalesce(F.col("mixed_tokens"), F.lit(0)) / F.lit(float(max(all_mixed, 1)))
    return rows.select("source", "target_share", "max_repeats", zero("available_tokens"), zero("mixed_tokens"), zero("n_documents"), zero("most_copies"), share.alias("actual_share"))
