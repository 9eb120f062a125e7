"""Row states without updates: append-only outcomes, idempotent inserts, usage and outcome roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions.text import is_blank
from turnloom.schemas import BLOCK_STATUSES, KEYS, REQUIRED, STATUSES

# Prices per million tokens and the share of the input price a cached token costs.
INPUT_PRICE, OUTPUT_PRICE, CACHED_SHARE = 0.25, 1.50, 0.25


def by_status(table: DataFrame, status: str) -> DataFrame:
    return table.filter(F.col("status") == status)


def uncounted(groups: DataFrame) -> DataFrame:
    return groups.filter((F.col("status") == "PUNCTUATED") & F.col("size_label").isNull())


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    return df.filter(~is_blank(F.col(column)))


def insert_if_absent(new: DataFrame, existing: DataFrame, table: str) -> DataFrame:
    """Rows of ``new`` to append: required fields set, key not there yet, one row (the least) per key."""
    key = KEYS[table]
    good = new
    for c in REQUIRED.get(table, (key,)):
        if c in new.columns:
            good = good.filter(F.col(c).isNotNull())
    rest = [c for c in good.columns if c != key]
    once = good.groupBy(key).agg(F.min(F.struct(*rest)).alias("v")).select(key, "v.*").select(*good.columns)
    return once.join(existing.select(key), key, "left_anti").select(*good.columns)


def set_status(table: DataFrame, outcomes: DataFrame, key: str = "group_id") -> DataFrame:
    """The table with the status of each key's latest outcome (``key, attempt, status``); unknown states are refused."""
    latest = outcomes.filter(F.col("status").isin(*STATUSES)).groupBy(key).agg(F.max_by("status", "attempt").alias("__s"))
    return table.join(latest, key, "left").withColumn("status", F.coalesce("__s", "status")).select(*table.columns)


def set_block(table: DataFrame, blocked: DataFrame, key: str = "group_id") -> DataFrame:
    """Set ``block_status`` of the keys in ``blocked`` (``key, block``); the dialogues of a group share its key."""
    ok = blocked.filter(F.col("block").isin(*BLOCK_STATUSES)).groupBy(key).agg(F.max("block").alias("__b"))
    return table.join(ok, key, "left").withColumn("block_status", F.coalesce("__b", "block_status")).select(*table.columns)


def set_text(groups: DataFrame, punctuated: DataFrame) -> DataFrame:
    """New text and its source for the groups of ``punctuated`` (``group_id, text, source``); the raw text is kept."""
    p = punctuated.select("group_id", F.col("text").alias("__t"), F.col("source").alias("__src"))
    had = F.col("punctuation_source") if "punctuation_source" in groups.columns else F.lit(None).cast("string")
    j = groups.withColumns({"raw_text": F.col("plain_text"), "punctuation_source": had}).join(p, "group_id", "left")
    return j.withColumns({"plain_text": F.coalesce("__t", "plain_text"), "punctuation_source": F.coalesce("__src", "punctuation_source")}).drop("__t", "__src")


def set_size(groups: DataFrame, counts: DataFrame) -> DataFrame:
    c = counts.select("group_id", F.col("size_label").alias("__c"))
    return groups.join(c, "group_id", "left").withColumn("size_label", F.coalesce("__c", "size_label")).select(*groups.columns)


def length_guard(before: Column, after: Column, least: float = 0.4) -> Column:
    """Error of a punctuated text that lost more than it may, else null."""
    return F.when(F.length(after) < least * F.length(before), "too_short")


def cost(tokens_in: Column, cached: Column, tokens_out: Column) -> Column:
    """Price of a call; cached input tokens cost a share of the input price."""
    full = F.greatest(F.lit(0), tokens_in - cached)
    return (full * INPUT_PRICE + cached * INPUT_PRICE * CACHED_SHARE + tokens_out * OUTPUT_PRICE) / 1_000_000


def cost_rollup(usage: DataFrame) -> DataFrame:
    """Per stage: calls, tokens and cost, summed over all passes."""
    return usage.groupBy("stage").agg(
        F.count("*").alias("calls"), F.sum("tokens_in").alias("tokens_in"), F.sum("cached").alias("cached"), F.sum("tokens_out").alias("tokens_out"),
        F.sum(cost(F.col("tokens_in"), F.col("cached"), F.col("tokens_out"))).alias("cost"),
    )


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("stage", "outcome").count()
