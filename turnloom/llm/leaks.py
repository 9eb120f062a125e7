"""Evaluation texts leaking into training text (problem 8): an FM-index per training shard.

Each partition of the corpus is cut into shards of a bounded number of words. A shard's words are numbered by the
vocabulary of the test items (runs of other words become one number), an FM-index is built over them, and two-word
phrases of every item are sought backwards through wavelet-tree ranks; rows are located by sampled suffix
positions. Places where enough of an item's phrases gather are then aligned with it word by word, and the matching
spans are merged. The corpus is read once per block of items.

No case is lost on the way: counted are stretches of two words or more, so a case of w words holds w / 2 of the item's
two-word phrases; half of those may be among its commonest, which are not sought, so the rest are found.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm.fmindex import FMIndex
from turnloom.runtime import cut

PHRASE = 2  # words, as many as the shortest stretch that counts
SHARE = 0.4  # of an item's words, in order and in one place
LEAST = 5  # words in order that any case has
SEVERAL = 3  # items that share a stock instruction and go on differently
PART = 1 / 3  # of the items that share it, a stock instruction is no more
COMMON = 20  # items that open with one sentence, which then is stock however large a part it is
GAP = 24  # words between two matching stretches of one place
SHARD_WORDS = 400_000
PAIRS = 2_000_000  # places of phrases in items and documents that are matched at a time
ITEM_BLOCK = 20_000  # items sought per pass over the corpus: about what a task, and the driver, hold of them

_TAG = re.compile(r"<!--.*?-->|<[^<>]{0,300}>|&[a-z]{2,8};", re.S | re.I)
_WORD = re.compile(r"[^\W_]+")
_STOP = re.compile(r"[.!?…:;。！？：；\n]")
_SCHEMA = "item_id bigint, doc_id bigint, words bigint, of_words bigint, start_pos bigint, end_pos bigint"


def words_of(text: str) -> list[str]:
    return _WORD.findall(_TAG.sub(" ", text).lower())


def sentence_ends(text: str) -> set[int]:
    """After how many words of :func:`words_of` a sentence, a line or what a colon introduces begins."""
    t = _TAG.sub(" ", text).lower()
    spans = [m.span() for m in _WORD.finditer(t)]
    return {n for n in range(1, len(spans)) if _STOP.search(t, spans[n - 1][1], spans[n][0])}


def read_items(items: DataFrame) -> DataFrame:
    """``item_id, words, stops, prefixes``: the words, after how many of them something new begins, and a hash of the
    first n words for each n. Null items are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, t in zip(b["item_id"], b["text"]):
                words, digest, prefixes = words_of(t), b"", []
                for w in words:
                    digest = blake2b(digest + w.encode(), digest_size=8).digest()
                    prefixes.append(int.from_bytes(digest, "big", signed=True))
                rows.append((i, words, sorted(sentence_ends(t)), prefixes))
            yield pd.DataFrame(rows, columns=["item_id", "words", "stops", "prefixes"])

    good = items.filter("text is not null and item_id is not null").select("item_id", "text")
    return good.mapInPandas(run, "item_id bigint, words array<string>, stops array<int>, prefixes array<bigint>")


def with_stock(read: DataFrame, least: int = 5) -> DataFrame:
    """Add ``stock``: how many opening words of each item are a stock instruction, 0 if none.

    Stock is an opening of ``least`` words or more that ``SEVERAL`` different items share and go on from in as many
    ways, if it is at most ``PART`` of them, or ends a sentence and opens ``COMMON`` items. The longest that ends a
    sentence counts, else the longest. A passage under a few questions, an edited copy and an equal item are no stock.
    Openings are counted by way before they are counted alone, so one that all items share is no hot key.
    """
    whole = F.try_element_at("prefixes", F.lit(-1))
    own = read.filter(F.size("words") >= least).select("item_id", whole.alias("whole"), "stops", "prefixes")
    opening = F.posexplode(F.slice("prefixes", least, F.size("prefixes"))).alias("k", "p")
    distinct = own.groupBy("whole").agg(F.first("prefixes").alias("prefixes"))
    at = distinct.select("prefixes", F.size("prefixes").alias("size"), opening)
    ways = at.groupBy("p", "k", F.get("prefixes", F.col("k") + least).alias("next")).agg(F.count("*").alias("c"), F.sum("size").alias("s"))
    shared = ways.groupBy("p", "k").agg(F.count("*").alias("ways"), F.sum("c").alias("c"), F.sum("s").alias("s")).filter(F.col("ways") >= SEVERAL)
    small = F.col("k") + least <= F.lit(PART) * F.col("s") / F.col("c")
    met = own.select("item_id", "whole", "stops", opening).join(shared, ["p", "k"])
    n = F.col("k") + least
    ends = F.array_contains("stops", n) & (small | (F.col("c") >= COMMON))
    longest = met.groupBy("item_id", "whole").agg(F.max(F.when(ends, n)).alias("at_end"), F.max(F.when(small, n)).alias("anywhere"))
    joined = read.withColumn("whole", F.coalesce(whole, F.lit(0))).join(longest, ["item_id", "whole"], "left")
    return joined.select("item_id", "words", F.coalesce("at_end", "anywhere", F.lit(0)).alias("stock"))


def aligned(item: np.ndarray, doc: np.ndarray) -> tuple[int, int, int]:
    """``(words, first, last)``: most words of ``item`` found in ``doc`` in order and in one place.

    Counted are stretches of two or more neighbouring words; between two stretches at most ``GAP`` other words.
    """
    same = item[:, None] == doc[None, :]
    runs = []
    m, n = same.shape
    padded = np.zeros((m + 2, n + 2), dtype=bool)
    padded[1:-1, 1:-1] = same
    starts = np.argwhere(padded[1:-1, 1:-1] & ~padded[:-2, :-2] & padded[2:, 2:])
    for i, j in starts:
        k = 0
        while i + k < m and j + k < n and same[i + k, j + k]:
            k += 1
        runs.append((int(j), int(i), k))
    runs.sort()
    longest = max((k for _, _, k in runs), default=0)
    best: list[tuple[int, int]] = []
    top = (0, 0, 0)
    for a, (j, i, k) in enumerate(runs):
        score, first = k, j
        for b in range(a - 1, -1, -1):
            pj, pi, pk = runs[b]
            if pj + longest + GAP < j:
                break  # nothing before reaches here
            cut = max(0, pj + pk - j, pi + pk - i)
            if k - cut >= 1 and pi < i and pj < j and j - (pj + pk) <= GAP and best[b][0] + k - cut >= score:
                score, first = best[b][0] + k - cut, best[b][1]
        best.append((score, first))
        if score > top[0]:
            top = (score, first, j + k - 1)
    return top


def _positions(text: str) -> list[tuple[int, int]]:
    blank = _TAG.sub(lambda m: " " * len(m[0]), text)
    return [m.span() for m in _WORD.finditer(blank)]


class _Items:
    """The items of one block as arrays: vocabulary, numbered words, distinct phrases and where they come from."""

    def __init__(self, rows: list[tuple[int, list[str], int]]):
        self.ids = [r[0] for r in rows]
        core = [w[s:] for _, w, s in rows]
        vocab: dict[str, int] = {}
        for w in core:
            for x in w:
                vocab.setdefault(x, len(vocab) + 2)  # 0 ends the text, 1 is any other word
        self.vocab = vocab
        self.words = [np.array([vocab[x] for x in w], dtype=np.int64) for w in core]
        self.need = np.array([max(LEAST, int(np.ceil(SHARE * len(w) - 1e-9))) for w in self.words], dtype=np.int64)
        # A case holds half of ``need`` in phrases; as many of the commonest phrases as half of that are not sought.
        held = -(-self.need // 2)
        left_out = held // 2
        self.seeds = held - left_out
        grams: dict[tuple, list[tuple[int, int]]] = {}
        places = [[tuple(w[p : p + PHRASE].tolist()) for p in range(len(w) - PHRASE + 1)] if len(w) >= LEAST else [] for w in self.words]
        seen: dict[tuple, int] = {}
        for x in places:
            for g in x:
                seen[g] = seen.get(g, 0) + 1
        for q, x in enumerate(places):
            common = sorted(range(len(x)), key=lambda p: (-seen[x[p]], p))[: left_out[q]]  # noqa: B023
            skipped = set(common)
            for p, g in enumerate(x):
                if p not in skipped:
                    grams.setdefault(g, []).append((q, p))
        self.patterns = np.array(list(grams) or np.zeros((0, PHRASE)), dtype=np.int64).reshape(-1, PHRASE)
        flat = [x for v in grams.values() for x in v]
        self.ptr = np.concatenate(([0], np.cumsum([len(v) for v in grams.values()], dtype=np.int64))).astype(np.int64)
        self.item_of, self.place_of = (np.array([x[k] for x in flat], dtype=np.int64) for k in (0, 1))


def _gathered(it: _Items, which: np.ndarray, doc: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(document, item, places in the document, places in the item)`` of the pairs with enough phrases in common.

    ``which, doc, at`` are phrases found and where, in order of documents. Pairs are laid out for so many documents at
    a time that about ``PAIRS`` are held, however many items share a phrase.
    """
    fan = it.ptr[which + 1] - it.ptr[which]
    total = np.cumsum(fan)
    lo = 0
    while lo < len(which):
        base = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, base + PAIRS, side="right")))
        hi = int(np.searchsorted(doc, doc[hi - 1], side="right"))  # whole documents
        part = fan[lo:hi]
        rows = np.repeat(np.arange(lo, hi), part)
        source = np.repeat(it.ptr[which[lo:hi]], part) + np.arange(len(rows)) - np.repeat(np.cumsum(part) - part, part)
        q, place = it.item_of[source], it.place_of[source]
        order = np.lexsort((place, q, doc[rows]))
        d, q, place, where = doc[rows][order], q[order], place[order], at[rows][order]
        pair = np.concatenate(([True], (d[1:] != d[:-1]) | (q[1:] != q[:-1])))
        fresh = pair | np.concatenate(([True], place[1:] != place[:-1]))
        starts = np.flatnonzero(pair)
        distinct = np.add.reduceat(fresh.astype(np.int64), starts)
        ends = np.append(starts[1:], len(d))
        for k in np.flatnonzero(distinct >= it.seeds[q[starts]]):
            a, b = starts[k], ends[k]
            yield int(d[a]), int(q[a]), where[a:b], place[a:b]
        lo = hi


def _search_shard(docs: list[tuple[int, str]], coded: list[np.ndarray], it: _Items) -> list[tuple]:
    """Leaks among ``docs`` (id, text) whose numbered words are ``coded``."""
    if not docs or not len(it.patterns):
        return []
    pieces, starts, origin, at = [], [], [], 0
    for c in coded:
        keep = np.ones(len(c), dtype=bool)
        keep[1:] = (c[1:] != 1) | (c[:-1] != 1)
        c2 = np.concatenate((c[keep], [1]))
        pieces.append(c2)
        origin.append(np.flatnonzero(keep))
        starts.append(at)
        at += len(c2)
    text = np.concatenate([*pieces, [0]])
    index = FMIndex(text, len(it.vocab) + 2)
    lo, hi = index.search(it.patterns)
    size = hi - lo
    which = np.flatnonzero(size)
    if not len(which):
        return []
    rep = np.repeat(which, size[which])
    rows = np.repeat(lo[which], size[which]) + np.arange(len(rep)) - np.repeat(np.cumsum(size[which]) - size[which], size[which])
    where = index.locate(rows)
    begin = np.array(starts)
    order = np.argsort(where, kind="stable")
    rep, where = rep[order], where[order]
    doc_no = np.searchsorted(begin, where, side="right") - 1
    out = []
    for d, q, spots, places in _gathered(it, rep, doc_no, where - begin[doc_no]):
        item, need, seeds = it.words[q], int(it.need[q]), int(it.seeds[q])
        spots = origin[d][spots]
        # A case spans no more than the item's words and the gaps between its stretches, so it lies whole in one of
        # these windows, each twice as long, that begin one such span after the other.
        span = len(item) + GAP * (len(item) // 2)
        best = (0, 0, 0)
        for w in np.unique(np.concatenate((spots // span, np.maximum(spots // span - 1, 0)))):
            a, b = int(w) * span, (int(w) + 2) * span
            if len(np.unique(places[(spots >= a) & (spots < b)])) < seeds:
                continue
            n, first, last = aligned(item, coded[d][a : b + 1])
            if n > best[0]:
                best = (n, a + first, a + last)
        if best[0] >= need:
            pos = _positions(docs[d][1])
            out.append((it.ids[q], docs[d][0], best[0], len(item), pos[best[1]][0], pos[best[2]][1]))
    return out


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``item_id, doc_id, words, of_words, start_pos, end_pos`` of each document that holds a passage of an item.

    A case holds ``SHARE`` of the item's words beyond its stock instruction, in order and in one place, whatever the
    letter case, punctuation, tags or table layout. Null, empty and very short items or texts give no case.
    """
    spark = documents.sparkSession
    known = cut(with_stock(cut(read_items(items))))
    blocks = -(-known.count() // ITEM_BLOCK)
    docs = documents.filter("text is not null").select("doc_id", "text")
    found = None
    for k in range(blocks):
        # One block at a time passes through the driver; blocks are of about ITEM_BLOCK items however many there are.
        part = known.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).select("item_id", "words", "stock").collect()
        held = spark.sparkContext.broadcast(sorted((r[0], list(r[1]), r[2] if r[2] < len(r[1]) else 0) for r in part))

        def run(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            it = _Items(held.value)
            get = it.vocab.get
            shard: list[tuple[int, str]] = []
            coded: list[np.ndarray] = []
            total = 0
            for b in batches:
                for d, t in zip(b["doc_id"], b["text"]):
                    c = np.array([get(w, 1) for w in words_of(t)], dtype=np.int64)
                    if not (c > 1).any():
                        continue
                    shard.append((d, t))
                    coded.append(c)
                    total += len(c)
                    if total >= SHARD_WORDS:
                        yield pd.DataFrame(_search_shard(shard, coded, it), columns=_COLUMNS)
                        shard, coded, total = [], [], 0
            yield pd.DataFrame(_search_shard(shard, coded, it), columns=_COLUMNS)

        of_block = docs.mapInPandas(run, _SCHEMA)
        found = of_block if found is None else found.unionByName(of_block)
    return found if found is not None else spark.createDataFrame([], _SCHEMA)


_COLUMNS = [c.split()[0] for c in _SCHEMA.split(", ")]


def removal_spans(found: DataFrame) -> DataFrame:
    """Overlapping leaks of a document merged: ``doc_id, start_pos, end_pos, n_items``. Positions are code points."""
    from pyspark.sql import Window

    w = Window.partitionBy("doc_id").orderBy("start_pos", "end_pos").rowsBetween(Window.unboundedPreceding, -1)
    new = F.coalesce((F.col("start_pos") > F.max("end_pos").over(w)).cast("int"), F.lit(0))
    o = Window.partitionBy("doc_id").orderBy("start_pos", "end_pos")
    marked = found.withColumn("new", new).withColumn("span", F.sum("new").over(o))
    return marked.groupBy("doc_id", "span").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), F.count("*").alias("n_items")).drop("span")
