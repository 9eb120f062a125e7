"""Queries of the training-data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.llm.leaks import leaks, removal_spans
from turnloom.llm.mixing import mixture, reached
from turnloom.llm.names import entities, entity_pairs
from turnloom.llm.residue import residue
from turnloom.llm.runs import NOBODY, speaker_runs
from turnloom.llm.sentences import split_sentences
from turnloom.llm.turns import clean_dialogues, transcript_turns
from turnloom.runtime import read, spread


def _p7(spark: SparkSession, sf: str) -> DataFrame:
    raw = spread(read(spark, sf, "grouped").filter("punctuation_source is null").select("group_id", "plain_text"))
    a = transcript_turns(raw, "group_id", "plain_text").withColumn("src_table", F.lit("grouped"))
    d = read(spark, sf, "dialogues").select("dialogue_id", "dialogue", "speaker", "loaded_at")
    b = clean_dialogues(d, "dialogue_id", "dialogue", "speaker", "loaded_at").withColumn("src_table", F.lit("dialogues"))
    return a.unionByName(b)


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return _p7(spark, sf).select("src_table", "row_key", "turn_no", "speaker", "n_words")


def p7_utterances(spark: SparkSession, sf: str) -> DataFrame:
    return _p7(spark, sf).select("src_table", "row_key", "turn_no", "speaker", "utterance")


def _p2(spark: SparkSession, sf: str) -> DataFrame:
    g = spread(read(spark, sf, "grouped").filter("punctuation_source is not null").select("group_id", "plain_text"))
    s = spread(read(spark, sf, "segments").select("segment_id", "text"))
    a = split_sentences(g, "group_id", "plain_text").withColumn("src_table", F.lit("grouped"))
    return a.unionByName(split_sentences(s, "segment_id", "text").withColumn("src_table", F.lit("segments")))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return _p2(spark, sf).select("src_table", "row_key", "start_pos", "n_chars")


def p2_sentences(spark: SparkSession, sf: str) -> DataFrame:
    return _p2(spark, sf).select("src_table", "row_key", "start_pos", "sentence")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    cols = ("dialogue_id", "group_id", "order_index", "speaker", "broadcast_time", "loaded_at")
    runs = speaker_runs(read(spark, sf, "dialogues").select(*cols))
    return runs.filter("n_turns >= 2").drop("speaker_key")


def p6_turns(spark: SparkSession, sf: str) -> DataFrame:
    """Every run with the spelling that stands for it, single dialogues included."""
    cols = ("dialogue_id", "group_id", "order_index", "speaker", "broadcast_time", "loaded_at")
    return speaker_runs(read(spark, sf, "dialogues").select(*cols))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    # Scanned several times with little work: dealt out only where there are fewer splits than cores.
    docs = spread(read(spark, sf, "documents").select("doc_id", "text", "source", "page_id", "page_title"), 1)
    return residue(docs).select("doc_id")


def p10_kept(spark: SparkSession, sf: str) -> DataFrame:
    """The documents left after exclusion, by source."""
    docs = read(spark, sf, "documents")
    out = residue(spread(docs.select("doc_id", "text", "source", "page_id", "page_title"), 1))
    return docs.join(out, "doc_id", "left_anti").groupBy("source").agg(F.count("*").alias("n_documents"), F.sum("n_chars").alias("n_chars"))


def _p8(spark: SparkSession, sf: str) -> DataFrame:
    return leaks(spread(read(spark, sf, "documents").select("doc_id", "text")), read(spark, sf, "eval_items"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return _p8(spark, sf).select("item_id", "doc_id")


def p8_spans(spark: SparkSession, sf: str) -> DataFrame:
    return removal_spans(_p8(spark, sf))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return entity_pairs(entities(read(spark, sf, "name_forms")))


def p4_entities(spark: SparkSession, sf: str) -> DataFrame:
    """One row per form: its entity (named by its smallest form) and the number of forms it is linked to."""
    e = entities(read(spark, sf, "name_forms"))
    g = e.groupBy("entity").agg(F.min("name_id").alias("entity_id"), (F.count("*") - 1).alias("n_links"))
    return e.join(g, "entity").select("name_id", "entity_id", "n_links")


def p9_mixture(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(read(spark, sf, "documents").select("doc_id", "source", "text"))
    return mixture(docs, read(spark, sf, "mix_targets"))


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(read(spark, sf, "documents").select("doc_id", "source", "text"))
    return reached(docs, read(spark, sf, "mix_targets"))


QUERIES = {f.__name__: f for f in (p2_found, p2_sentences, p4_found, p4_entities, p6_found, p6_turns, p7_found, p7_utterances, p8_found, p8_spans, p9_mixture, p9_shares, p10_found, p10_kept)}

# Twins in SQL. Runs are chains of neighbours within one slip there, which is what the optimum comes to wherever the
# spellings of a run lie within one slip of its commonest; the tests compare the optimum itself with every segmentation.
_KEY = (
    r"lower(regexp_replace(regexp_replace(regexp_replace(speaker, '\([^()]*\)|\[[^\[\]]*\]|\{[^{}]*\}|<[^<>]*>|♪+|>>+', ' ', 'g'), "
    r"'^[\s\x{A0}]*\p{L}[\p{L} ]{1,20}?(?:[\s\x{A0}]+[-–—|]|[\s\x{A0}]*/)[\s\x{A0}]+([^\s\x{A0}])', '\1'), '[^\p{L}\p{M}\p{N}]+', '', 'g'))"
)
_NOBODY = ", ".join(f"'{x}'" for x in NOBODY)
_CLOCK = r"CASE WHEN regexp_full_match(broadcast_time, '\s*\d{1,2}:\d{2}(:\d{2})?\s*') THEN CAST(split_part(trim(broadcast_time), ':', 1) AS BIGINT)*3600 + CAST(split_part(trim(broadcast_time), ':', 2) AS BIGINT)*60 + CAST(coalesce(nullif(split_part(trim(broadcast_time), ':', 3), ''), '0') AS BIGINT) END"
_P6 = f"""WITH l AS (SELECT *, row_number() OVER (PARTITION BY dialogue_id ORDER BY loaded_at DESC) AS v FROM dialogues),
e AS (SELECT group_id, CAST(order_index AS BIGINT) AS pos, CASE WHEN {_KEY} NOT IN ({_NOBODY}) THEN {_KEY} END AS key, {_CLOCK} AS s FROM l WHERE v = 1 AND order_index IS NOT NULL AND group_id IS NOT NULL),
p AS (SELECT *, lag(key) OVER w AS before FROM e WINDOW w AS (PARTITION BY group_id ORDER BY pos, key NULLS FIRST)),
n AS (SELECT *, CASE WHEN key = before OR (least(length(key), length(before)) > 3 AND damerau_levenshtein(key, before) <= 1) THEN 0 ELSE 1 END AS new FROM p),
r AS (SELECT *, sum(new) OVER (PARTITION BY group_id ORDER BY pos, key NULLS FIRST ROWS UNBOUNDED PRECEDING) AS run, row_number() OVER (PARTITION BY group_id ORDER BY pos, key NULLS FIRST) AS place FROM n),
k AS (SELECT group_id, run, key, count(*) AS c FROM r WHERE key IS NOT NULL GROUP BY 1, 2, 3), b AS (SELECT group_id, run, first(key ORDER BY c DESC, key) AS speaker_key FROM k GROUP BY 1, 2),
g AS (SELECT group_id, run, min(pos) AS first_order, max(pos) AS last_order, count(*) AS n_turns, last(s ORDER BY place) - first(s ORDER BY place) AS d FROM r WHERE key IS NOT NULL GROUP BY 1, 2)
SELECT g.group_id, first_order, last_order, n_turns, (d % 86400 + 86400) % 86400 AS duration_s, speaker_key FROM g JOIN b USING (group_id, run)"""

SQL: dict[str, str] = {"p6_turns": _P6, "p6_found": f"SELECT * EXCLUDE (speaker_key) FROM ({_P6}) WHERE n_turns >= 2"}
