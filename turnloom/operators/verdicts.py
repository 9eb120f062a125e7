"""Decisions on model verdicts: relevance, size, confidence, verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.functions.text import two_places, ws_trim
from turnloom.functions.units import cap_vocative

# Thresholds of the stages.
IRRELEVANT_AT = 0.8
UNCERTAIN_BELOW = 0.9
OVER_TOKENS = 1000
PUNCTUATED_LEAST = 0.4
RELEVANCE_BATCH = 10
ATTRIBUTION_CHUNK = 40
NAME_BATCH = 20


def relevance_outcome(is_relevant: Column, confidence: Column) -> Column:
    """Kept if relevant, dropped if surely not, kept as uncertain otherwise (also without confidence)."""
    return F.when(is_relevant, "kept").when(confidence >= IRRELEVANT_AT, "dropped").otherwise("uncertain")


def relevance_status(outcome: Column) -> Column:
    return F.when(outcome == "dropped", "NOT RELEVANT").when(outcome == "failed", "FAILED RELEVANCE").otherwise("RELEVANT")


def numbered_batches(df: DataFrame, order: list[str], size: int, rows_per_bucket: int = 10_000) -> DataFrame:
    """Add ``bucket``, ``batch`` and 1-based ``idx``: rows in order within hash buckets, ``size`` to a batch.

    A batch is ``(bucket, batch)``. Buckets, as many as the rows ask for, keep the numbering distributed; only the
    columns of ``order``, which name a row, go through the window, and the rest is joined to them.
    """
    buckets = max(1, -(-df.count() // rows_per_bucket))
    b = df.select(*order).withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    n = F.row_number().over(Window.partitionBy("bucket").orderBy(*order)) - 1
    numbered = b.withColumn("n", n).select(*order, "bucket", F.floor(F.col("n") / size).cast("int").alias("batch"), (F.col("n") % size + 1).cast("int").alias("idx"))
    return df.join(numbered, order)


def chunked(df: DataFrame, key: str, order: list[str], size: int) -> DataFrame:
    """Add 0-based ``chunk`` and 1-based ``idx`` of ``size`` rows within each key."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1
    return df.withColumn("n", n).withColumns({"chunk": F.floor(F.col("n") / size).cast("int"), "idx": (F.col("n") % size + 1).cast("int")}).drop("n")


def join_verdicts(entries: DataFrame, verdicts: DataFrame, on: list[str]) -> DataFrame:
    """Entries with their verdict by batch and index; of several verdicts the last holds, none means failed."""
    last = verdicts.groupBy(*on).agg(F.max_by(F.struct(*[c for c in verdicts.columns if c not in on]), "seq").alias("v"))
    return entries.join(last, on, "left")


def size_label(tokens: Column) -> Column:
    return F.when(tokens > OVER_TOKENS, "OVER").otherwise("UNDER")


def over(df: DataFrame) -> DataFrame:
    return df.filter(F.col("size_label").eqNullSafe("OVER"))


def under(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("size_label").eqNullSafe("OVER"))


def low_confidence(dialogues: DataFrame) -> DataFrame:
    """Turns to verify: unsure or without confidence, not verified, not blocked."""
    unsure = F.col("confidence_score").isNull() | (F.col("confidence_score") < UNCERTAIN_BELOW)
    return dialogues.filter(unsure & F.col("verification_score").isNull() & F.col("block_status").isNull())


def verification_candidates(dialogues: DataFrame, groups: DataFrame) -> DataFrame:
    g = groups.select("group_id", F.col("plain_text"), "channel_name", "program_title")
    d = low_confidence(dialogues).select("dialogue_id", "group_id", "dialogue", "speaker", "role", "confidence_score", "order_index")
    return d.join(g, "group_id")


def apply_verification(dialogues: DataFrame, verdicts: DataFrame) -> DataFrame:
    """``dialogue_id, speaker, role, verification_score`` after verdicts ``dialogue_id, v_speaker, v_role, v_score``.

    A blank verified speaker keeps the present one; the role changes only with the speaker; a score above 0.5 of a
    speaker the turn only addresses is cut to 0.5; turns without verdict stay as they are.
    """
    j = dialogues.join(verdicts.withColumn("__has", F.lit(True)), "dialogue_id", "left")
    chosen = F.when(F.col("__has") & (ws_trim(F.coalesce("v_speaker", F.lit(""))) != ""), ws_trim(F.col("v_speaker"))).otherwise(F.col("speaker"))
    changed = F.col("__has").isNotNull() & ~chosen.eqNullSafe(F.col("speaker"))
    score = F.when(F.col("__has"), cap_vocative(F.col("v_score"), chosen, F.col("dialogue"))).otherwise(F.col("verification_score"))
    return j.select("dialogue_id", chosen.alias("speaker"), F.when(changed, F.col("v_role")).otherwise(F.col("role")).alias("role"), score.alias("verification_score"), changed.alias("corrected"))


def verdict_label(has: Column, before: Column, after: Column) -> Column:
    return F.when(~has, "NO VERDICT").when(~after.eqNullSafe(before), "CORRECTED").otherwise("confirmed")


# The labels and rules of the verification report.
REPORT_RULE = "=" * 80


def report_block(index: Column, dialogue_id: Column, dialogue: Column, before: Column, after: Column, role: Column, prior: Column, score: Column, has: Column, reasoning: Column) -> Column:
    """One dialogue of the verification report."""
    outcome = verdict_label(has, before, after)
    num = lambda c: F.when(c.isNotNull(), two_places(c)).otherwise("n/a")
    none = lambda c: F.coalesce(c, F.lit("None"))
    shown = F.coalesce(F.when(role != "", role), F.lit("n/a"))
    note = F.when(outcome == "CORRECTED", shown).otherwise(F.concat(shown, F.lit(" (not written; speaker unchanged)")))
    return F.concat(
        F.lit("["), index.cast("string"), F.lit("] dialogue_id="), none(dialogue_id),
        F.lit("\n    DIALOGUE:          "), none(dialogue), F.lit("\n    CURRENT SPEAKER:   "), none(before),
        F.lit("\n    VERIFIED SPEAKER:  "), none(after), F.lit("   ("), outcome, F.lit(")\n    VERIFIED ROLE:     "), note,
        F.lit("\n    PRIOR CONFIDENCE:  "), num(prior), F.lit("\n    VERIFICATION:      "), num(score),
        F.lit("\n    REASONING:         "), F.coalesce(F.when(reasoning != "", reasoning), F.lit("(none provided)")),
    )


def report(dialogues: DataFrame, verdicts: DataFrame) -> DataFrame:
    """``group_id, report``: for each group with unsure turns its heading and one block a turn, in order.

    ``verdicts`` has ``dialogue_id, v_speaker, v_role, v_score, v_prior, v_reason``; a turn without one is shown so.
    Numbers run from 1 within a group, as they were asked.
    """
    asked = low_confidence(dialogues).select("dialogue_id", "group_id", "dialogue", "speaker", "confidence_score", "order_index")
    n = F.row_number().over(Window.partitionBy("group_id").orderBy("order_index", "dialogue_id"))
    cols = ["v_speaker", "v_role", "v_score", "v_prior", "v_reason"]
    j = asked.withColumn("n", n).join(verdicts.select("dialogue_id", *cols, F.lit(True).alias("has")), "dialogue_id", "left")
    has = F.coalesce("has", F.lit(False))
    after = F.when(has & (ws_trim(F.coalesce("v_speaker", F.lit(""))) != ""), ws_trim(F.col("v_speaker"))).otherwise(F.col("speaker"))
    prior = F.when(has, F.col("v_prior")).otherwise(F.col("confidence_score"))
    score = F.when(has, cap_vocative(F.col("v_score"), F.coalesce(after, F.lit("")), F.col("dialogue")))
    block = report_block(F.col("n"), F.col("dialogue_id"), F.col("dialogue"), F.col("speaker"), after, F.coalesce("v_role", F.lit("")), prior, score, has, F.coalesce("v_reason", F.lit("")))
    listed = F.array_sort(F.collect_list(F.struct("n", block.alias("block"))))
    head = F.concat(F.lit(f"{REPORT_RULE}\nGROUP: "), "group_id", F.lit(f"\n{REPORT_RULE}\n\n"))
    return j.groupBy("group_id").agg(listed.alias("b")).select("group_id", F.concat(head, F.array_join(F.transform("b", lambda x: x["block"]), "\n\n"), F.lit("\n")).alias("report"))
