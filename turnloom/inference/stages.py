"""Inference stages: rows in, rows out. Calls run in ``mapInPandas``; answers are parsed outside, in the JVM.

Persist a stage's answers before using them: computing them again would call the provider again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions import ids, jsonio, units
from turnloom.functions.text import clamp01, is_blank, ws_trim
from turnloom.inference.control import CALL_TIMEOUT_S, CALLS_PER_MINUTE, Limiter, call
from turnloom.inference.provider import Outcome, Provider, Request, punctuate
from turnloom.logs import get_logger
from turnloom.operators import state, verdicts

log = get_logger(__name__)

ANSWERS = "key string, response string, outcome string, tokens_in bigint, cached bigint, tokens_out bigint"


# The place of a stage's data in its prompt template.
SLOTS = {
    "relevance": "entries", "punctuation": "raw_transcript", "segmentation": "full_text", "segmentation_indexed": "numbered_transcript",
    "attribution": "segments", "verification": "dialogues", "who_why": "entries", "diarization": "full_text", "diarization_indexed": "numbered_transcript",
}


def filled(template: str, values: dict[str, Column]) -> Column:
    """A template with ``{name}`` places taken by columns; other braces stay, and nothing within a value is replaced."""
    parts = re.split("(" + "|".join(re.escape(f"{{{k}}}") for k in values) + ")", template)
    return F.concat(*[F.coalesce(values[x[1:-1]].cast("string"), F.lit("")) if i % 2 else F.lit(x) for i, x in enumerate(parts)])


def ask(
    prompts: DataFrame, provider: Provider, stage: str, tasks: int | None = None, per_minute: float = CALLS_PER_MINUTE,
    templates: dict[str, dict] | None = None, caches: dict[str, str] | None = None, timeout: float | None = CALL_TIMEOUT_S, context: dict[str, Column] | None = None,
) -> DataFrame:
    """Answers to ``key, prompt``: ``key, response, outcome, tokens_in, cached, tokens_out``.

    The budget of calls per minute is divided by the tasks, whose number (the cluster's cores by default) bounds the
    calls in flight. ``templates`` holds a stage's ``system_prompt`` and ``user_prompt``; the bare data takes the place
    named in ``SLOTS``, ``context`` further places. ``caches`` holds handles of instructions that the service keeps.
    """
    tasks = tasks or prompts.sparkSession.sparkContext.defaultParallelism
    t = (templates or {}).get(stage) or {}
    instructions, handle = t.get("system_prompt"), (caches or {}).get(stage)
    body = F.col("prompt")
    sent = filled(t["user_prompt"], {**(context or {}), SLOTS[stage]: body}) if t.get("user_prompt") else body

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limiter = Limiter(per_minute / tasks)
        for b in batches:
            rows = []
            for k, p, whole in zip(b["key"], b["prompt"], b["sent"]):
                r = call(provider, Request(stage, p, whole, instructions, handle), limiter, timeout=timeout)
                rows.append((k, r.text, r.outcome.value, r.tokens_in, r.cached, r.tokens_out))
            yield pd.DataFrame(rows, columns=["key", "response", "outcome", "tokens_in", "cached", "tokens_out"])

    return prompts.select("key", "prompt", sent.alias("sent")).repartition(tasks, "key").mapInPandas(run, ANSWERS)


@contextmanager
def instructions_cached(provider: Provider, templates: dict[str, dict] | None, stages: tuple[str, ...]) -> Iterator[dict[str, str]]:
    """Handles of the stages' fixed instructions, opened once and closed whatever happens; a stage whose instructions
    can't be kept sends them with every call."""
    held: dict[str, str] = {}
    try:
        for s in stages:
            fixed = ((templates or {}).get(s) or {}).get("system_prompt")
            try:
                got = provider.open_cache(s, fixed) if fixed else None
            except Exception as e:  # noqa: BLE001 - a cache is never needed
                log.info("%s: instructions can't be kept, sent with every call (%s)", s, e)
                got = None
            if got:
                held[s] = got
        yield held
    finally:
        for s, h in held.items():
            try:
                provider.close_cache(h)
            except Exception as e:  # noqa: BLE001
                log.warning("%s: cache %s was not closed (%s)", s, h, e)


def relevance(groups: DataFrame, provider: Provider, **how) -> DataFrame:
    """``group_id, is_relevant, confidence, outcome, status``. Ten groups to a call; the groups of a blocked batch are
    asked again one by one, and one that is blocked alone goes forward flagged."""
    texts = groups.select("group_id", "plain_text")
    b = verdicts.numbered_batches(texts, ["group_id"], verdicts.RELEVANCE_BATCH).withColumn("key", F.concat_ws("-", "bucket", "batch"))

    def prompts(df: DataFrame) -> DataFrame:
        e = df.withColumn("entry", units.entry_block(F.col("idx"), F.col("plain_text")))
        rows = F.array_sort(F.collect_list(F.struct("idx", "entry")))
        return e.groupBy("key").agg(F.array_join(F.transform(rows, lambda x: x["entry"]), "\n\n").alias("prompt"))

    first = ask(prompts(b), provider, "relevance", **how)
    alone = b.join(first.filter(F.col("outcome") == Outcome.BLOCKED.value).select("key"), "key", "left_semi")
    alone = alone.withColumns({"key": F.col("group_id"), "idx": F.lit(1)})
    again = ask(prompts(alone), provider, "relevance", **how)
    asked = b.join(first.filter(F.col("outcome") != Outcome.BLOCKED.value), "key").unionByName(alone.join(again, "key"))
    v = F.try_element_at(F.filter(jsonio.last_by_index(jsonio.relevance(F.col("response"))), lambda r: r["index"] == F.col("idx")), F.lit(1))
    j = asked.withColumn("v", v)
    outcome = (
        F.when(F.col("outcome") == Outcome.BLOCKED.value, "blocked")
        .when((F.col("outcome") != Outcome.OK.value) | F.col("v").isNull() | F.col("v")["is_relevant"].isNull(), "failed")
        .otherwise(verdicts.relevance_outcome(F.col("v")["is_relevant"], F.col("v")["confidence"]))
    )
    out = j.select("group_id", F.col("v")["is_relevant"].alias("is_relevant"), F.col("v")["confidence"].alias("confidence"), outcome.alias("outcome"))
    return out.withColumn("status", verdicts.relevance_status(F.col("outcome")))


def punctuation(groups: DataFrame, provider: Provider, most: int = 8000, restore=None, **how) -> DataFrame:
    """``group_id, text, source, outcome``. Long texts go in chunks; a blocked chunk is restored locally by ``restore``
    (see :func:`local_punctuation`); a result that lost too much fails; blank texts are left out."""
    g = state.drop_blank(groups.select("group_id", "plain_text"), "plain_text")
    c = g.select("group_id", F.col("plain_text").alias("whole"), F.posexplode(units.pack_chunks(F.col("plain_text"), most)).alias("chunk", "prompt"))
    c = c.withColumn("key", F.concat_ws("#", "group_id", "chunk"))
    a = c.join(ask(c, provider, "punctuation", **how), "key")
    local = local_punctuation(a.filter(F.col("outcome") == Outcome.BLOCKED.value).select("key", "prompt"), restore)
    m = a.join(local, "key", "left").withColumn("piece", F.coalesce("restored", F.trim("response")))
    rows = F.array_sort(F.collect_list(F.struct("chunk", "piece")))
    done = m.groupBy("group_id").agg(
        F.first("whole").alias("whole"), F.array_join(F.transform(rows, lambda x: x["piece"]), units.MARK).alias("text"),
        F.max(F.col("restored").isNotNull()).alias("fell_back"), F.max(F.col("piece").isNull()).alias("lost"),
    )
    error = F.when(F.col("lost"), "failed").otherwise(state.length_guard(F.col("whole"), F.col("text")))
    return done.select("group_id", "text", F.when(F.col("fell_back"), "local").otherwise("llm").alias("source"), F.coalesce(error, F.lit("ok")).alias("outcome"))


def marked(text: str, restore) -> str:
    """``restore`` applied to each part between speaker marks, all at once; the marks stay where they are."""
    parts = text.split(units.MARK)
    live = [i for i, p in enumerate(parts) if p.strip()]
    for i, done in zip(live, restore([parts[i].strip() for i in live])):
        parts[i] = done
    return units.MARK.join(p.strip() for p in parts)


def local_punctuation(df: DataFrame, restore=None) -> DataFrame:
    """``key, restored``: punctuation without the provider, for texts it refuses; speaker marks are kept.

    ``restore`` is a picklable ``texts -> texts``; a model is loaded in its first call of a worker. By default the rules
    of the offline provider serve.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"key": b["key"], "restored": [punctuate(t) if restore is None else marked(t, restore) for t in b["prompt"]]})

    return df.select("key", "prompt").mapInPandas(run, "key string, restored string")


def token_counts(groups: DataFrame, provider: Provider) -> DataFrame:
    """``group_id, tokens, size_label``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"group_id": b["group_id"], "tokens": [provider.count_tokens(t) for t in b["plain_text"]]})

    n = groups.filter("plain_text is not null").select("group_id", "plain_text").mapInPandas(run, "group_id string, tokens bigint")
    return n.withColumn("size_label", verdicts.size_label(F.col("tokens")))


def segmentation(groups: DataFrame, provider: Provider, **how) -> DataFrame:
    """``group_id, texts, outcome``: small groups echo their spans, large ones answer ranges of numbered units that are
    repaired to tile the group and turned back into text."""
    g = groups.select("group_id", "plain_text", "size_label").filter(~is_blank(F.col("plain_text")))
    small = verdicts.under(g).select(F.col("group_id").alias("key"), F.col("plain_text").alias("prompt"))
    a = ask(small, provider, "segmentation", **how).select(F.col("key").alias("group_id"), "outcome", jsonio.segment_texts(F.col("response")).alias("texts"))
    big = verdicts.over(g).withColumn("units", units.sentence_units(F.col("plain_text")))
    numbered = big.select(F.col("group_id").alias("key"), units.numbered_block(F.col("units")).alias("prompt"), F.size("units").alias("n"))
    r = ask(numbered, provider, "segmentation_indexed", context={"unit_count": F.col("n")}, **how)
    b = big.join(r.withColumnRenamed("key", "group_id"), "group_id")
    tiles = units.repair_ranges(jsonio.ranges(F.col("response")), F.size("units"))
    b = b.select("group_id", "outcome", units.segment_texts(F.col("units"), tiles).alias("texts"))
    out = a.unionByName(b)
    kind = F.when(F.col("outcome") == Outcome.BLOCKED.value, "blocked").when((F.col("outcome") != Outcome.OK.value) | F.col("texts").isNull() | (F.size("texts") == 0), "failed").otherwise("ok")
    return out.select("group_id", "texts", kind.alias("outcome"))


def segment_rows(done: DataFrame, groups: DataFrame) -> DataFrame:
    g = groups.select("group_id", "program_id", "broadcast_time")
    s = done.filter("outcome = 'ok'").select("group_id", F.posexplode("texts").alias("order_index", "text")).join(g, "group_id")
    return s.select(ids.child_id(F.col("group_id"), F.col("order_index")).alias("segment_id"), "group_id", "program_id", "broadcast_time", "order_index", "text")


def attribution(segments: DataFrame, provider: Provider, chunk: int = verdicts.ATTRIBUTION_CHUNK, **how) -> DataFrame:
    """Turns of segmented groups, ready for the dialogue table plus ``outcome``. Segments go in chunks, orders run on
    across chunks. A blocked group yields one placeholder turn that no later stage picks up."""
    c = verdicts.chunked(segments, "group_id", ["order_index", "segment_id"], chunk)
    line = F.concat(F.when(F.coalesce("broadcast_time", F.lit("")) != "", F.concat(F.lit("["), "broadcast_time", F.lit("] "))).otherwise(""), ws_trim(F.coalesce("text", F.lit(""))))
    rows = F.array_sort(F.collect_list(F.struct("idx", line.alias("line"))))
    p = c.groupBy("group_id", "chunk").agg(F.array_join(F.transform(rows, lambda x: x["line"]), "\n").alias("prompt")).withColumn("key", F.concat_ws("#", "group_id", "chunk"))
    a = p.join(ask(p, provider, "attribution", **how), "key").withColumn("turns", jsonio.turns(F.col("response")))
    per = a.groupBy("group_id").agg(F.max(F.col("outcome") == Outcome.BLOCKED.value).alias("blocked"), F.max((F.col("outcome") == Outcome.OK.value) & F.col("turns").isNotNull()).alias("some"), F.max(F.col("turns").isNull()).alias("bad"))
    info = segments.groupBy("group_id").agg(F.min("program_id").alias("program_id"), F.min("broadcast_time").alias("broadcast_time"))
    from turnloom.operators.relational import continuous_order

    good = per.filter("not blocked and not bad").select("group_id")
    t = continuous_order(a.join(good, "group_id", "left_semi").select("group_id", "chunk", F.posexplode("turns").alias("turn", "x"))).join(info, "group_id")
    turns = t.select(
        ids.child_id(F.col("group_id"), F.col("order_index")).alias("dialogue_id"), "group_id", "program_id", "broadcast_time", F.col("x")["text"].alias("dialogue"), F.col("x")["speaker"].alias("speaker"),
        F.col("x")["role"].alias("role"), units.cap_vocative(F.col("x")["confidence"], F.coalesce(F.col("x")["speaker"], F.lit("")), F.col("x")["text"]).alias("confidence_score"), F.lit(None).cast("double").alias("verification_score"),
        F.lit(None).cast("string").alias("block_status"), "order_index", F.col("x")["speaker_type"].alias("speaker_type"), F.col("x")["note"].alias("note"), F.lit("ok").alias("outcome"),
    )
    text = segments.groupBy("group_id").agg(F.array_sort(F.collect_list(F.struct("order_index", "text"))).alias("s"))
    blocked = per.filter("blocked").join(info, "group_id").join(text, "group_id").select(
        ids.blocked_id(F.col("group_id")).alias("dialogue_id"), "group_id", "program_id", "broadcast_time", F.array_join(F.transform("s", lambda x: x["text"]), " ").alias("dialogue"), F.lit("UNKNOWN").alias("speaker"),
        F.lit(None).cast("string").alias("role"), F.lit(0.0).alias("confidence_score"), F.lit(None).cast("double").alias("verification_score"), F.lit("BLOCKED_ATTRIBUTION").alias("block_status"), F.lit(0).alias("order_index"),
        F.lit(None).cast("string").alias("speaker_type"), F.lit(None).cast("string").alias("note"), F.lit("blocked").alias("outcome"),
    )
    return turns.unionByName(blocked)


def verification(dialogues: DataFrame, groups: DataFrame, provider: Provider, **how) -> DataFrame:
    """Verdicts ``dialogue_id, v_speaker, v_role, v_score, v_prior, v_reason``: all unsure turns of a group in one call."""
    c = verdicts.chunked(verdicts.verification_candidates(dialogues, groups), "group_id", ["order_index", "dialogue_id"], 1_000_000)
    e = c.withColumn("entry", units.review_block(F.col("idx"), F.col("speaker"), F.col("dialogue")))
    rows = F.array_sort(F.collect_list(F.struct("idx", "entry")))
    p = e.groupBy(F.col("group_id").alias("key")).agg(F.array_join(F.transform(rows, lambda x: x["entry"]), "\n\n").alias("prompt"), F.first("plain_text").alias("whole"))
    a = ask(p, provider, "verification", context={"full_text": F.col("whole")}, **how)
    v = a.select(F.col("key").alias("group_id"), F.explode(jsonio.last_by_index(jsonio.verifications(F.col("response")))).alias("v"))
    return c.select("group_id", "idx", "dialogue_id").join(v.withColumn("idx", F.col("v")["index"]), ["group_id", "idx"]).select("dialogue_id", F.col("v")["speaker"].alias("v_speaker"), F.col("v")["role"].alias("v_role"), F.col("v")["score"].alias("v_score"), F.col("v")["prior"].alias("v_prior"), F.col("v")["reasoning"].alias("v_reason"))


def name_roles(names: DataFrame, provider: Provider, **how) -> DataFrame:
    """Role and context of found names (``group_id, person``), twenty to a call."""
    from turnloom.operators.people import join_roles

    b = verdicts.numbered_batches(names, ["group_id", "person"], verdicts.NAME_BATCH).withColumn("key", F.concat_ws("-", "bucket", "batch"))
    line = F.concat(F.lit("["), F.col("idx").cast("string"), F.lit("] "), "group_id", F.lit(" | "), "person")
    rows = F.array_sort(F.collect_list(F.struct("idx", line.alias("line"))))
    a = ask(b.groupBy("key").agg(F.array_join(F.transform(rows, lambda x: x["line"]), "\n").alias("prompt")), provider, "who_why", **how)
    f = lambda v, k: F.try_variant_get(v, f"$['{k}']", "string")
    got = a.select(F.posexplode(jsonio.items(F.col("response"), "results")).alias("seq", "v"))
    return join_roles(names, got.select(f(F.col("v"), "Group ID").alias("group_id"), f(F.col("v"), "Person").alias("person"), f(F.col("v"), "Role").alias("role"), f(F.col("v"), "Context_of_mention").alias("context"), "seq"))


def diarization(groups: DataFrame, provider: Provider, indexed: bool = False, **how) -> DataFrame:
    """Whole-group diarization: ``group_id, order_index, speaker, text, confidence``.

    The indexed form answers ranges of numbered units, which are repaired to tile the group: a gap goes to the range
    after it, an overlap to the one before, the rest to the last.
    """
    g = groups.select("group_id", "plain_text").filter(~is_blank(F.col("plain_text"))).withColumn("units", units.sentence_units(F.col("plain_text")))
    prompt = units.numbered_block(F.col("units")) if indexed else F.col("plain_text")
    p = g.select(F.col("group_id").alias("key"), prompt.alias("prompt"), F.size("units").alias("n"))
    a = g.join(ask(p, provider, "diarization_indexed" if indexed else "diarization", context={"unit_count": F.col("n")}, **how).withColumnRenamed("key", "group_id"), "group_id")
    s = lambda v, k: F.try_variant_get(v, f"$.{k}", "string")
    said = jsonio.items(F.col("response"), "segments")
    if indexed:
        whole = lambda v, k: F.try_variant_get(v, f"$.{k}", "int")
        made = F.transform(said, lambda v: F.struct(whole(v, "start").alias("s"), whole(v, "end").alias("e"), s(v, "speaker").alias("speaker"), s(v, "confidence").alias("confidence")))
        tiles = units.repair_owned(made, F.size("units"))
        text = F.array_join(F.slice("units", F.col("x")["s"], F.col("x")["e"] - F.col("x")["s"] + 1), " ")
        seg = a.select("group_id", "units", F.posexplode(tiles).alias("order_index", "x")).select("group_id", "order_index", F.col("x")["speaker"].alias("speaker"), text.alias("text"), F.col("x")["confidence"].alias("confidence"))
    else:
        seg = a.select("group_id", F.posexplode(said).alias("order_index", "v")).select("group_id", "order_index", s(F.col("v"), "speaker").alias("speaker"), F.coalesce(s(F.col("v"), "text"), F.lit("")).alias("text"), s(F.col("v"), "confidence").alias("confidence"))
    out = seg.select("group_id", "order_index", "speaker", ws_trim(F.regexp_replace("text", r"^>>\s*", "")).alias("text"), clamp01(F.col("confidence")).alias("confidence"))
    return out.filter("text <> ''").withColumn("confidence", units.cap_vocative(F.col("confidence"), F.coalesce("speaker", F.lit("")), F.col("text")))


def token_labels(df: DataFrame, tagger, tasks: int | None = None) -> DataFrame:
    """``key, tokens, labels`` from ``key, text`` by a pluggable tagger ``texts -> [(tokens, labels)]``, batches of 32."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i in range(0, len(b), 32):
                part = b.iloc[i : i + 32]
                out += [(k, t, lab) for k, (t, lab) in zip(part["key"], tagger(list(part["text"])))]
            yield pd.DataFrame(out, columns=["key", "tokens", "labels"])

    laid = df.select("key", "text").repartition(tasks or df.sparkSession.sparkContext.defaultParallelism, "key")
    return laid.mapInPandas(run, "key string, tokens array<string>, labels array<string>")


WINDOW, OVERLAP = 512, 64  # tokens a tagger sees at once, and that neighbouring windows share


def joined_labels(tokens: list[str], label) -> list[str]:
    """Labels of a text of any length by ``label`` (tokens -> labels) over overlapping windows of ``WINDOW`` tokens.

    From the middle of an overlap on the later window counts; a name begun before that place stays with the earlier one.
    """
    out: list[str] = label(tokens[:WINDOW])
    at = WINDOW - OVERLAP
    while at + OVERLAP < len(tokens):
        more = label(tokens[at : at + WINDOW])
        seam = OVERLAP // 2
        while seam < OVERLAP and (out[at + seam].startswith("I-") or more[seam].startswith("I-")):
            seam += 1
        out = out[: at + seam] + more[seam:]
        at += WINDOW - OVERLAP
    return out


def capital_tagger(texts: list[str]) -> list[tuple[list[str], list[str]]]:
    """A rule tagger for tests: two capitalised words in a row are a person."""
    import re

    def label(tokens: list[str]) -> list[str]:
        cap = [x[:1].isupper() and x[1:].islower() for x in tokens]
        labels = ["O"] * len(tokens)
        for i in range(len(tokens)):
            if cap[i] and i + 1 < len(tokens) and cap[i + 1] and labels[i] == "O":
                labels[i], labels[i + 1] = "B-PER", "I-PER"
        return labels

    found = [re.findall(r"\w+|[^\w\s]", t or "") for t in texts]
    return [(tokens, joined_labels(tokens, label)) for tokens in found]
