"""Model responses (JSON text) to typed arrays; malformed text is told apart from empty answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnloom.functions.text import clamp01, null_if_empty, ws_trim
from turnloom.functions.units import fence_strip


def response(text: Column) -> Column:
    """The response as VARIANT, null where it is no JSON object."""
    v = F.try_parse_json(fence_strip(text))
    return F.when(F.schema_of_variant(v).startswith("OBJECT"), v)


def bad_json(text: Column) -> Column:
    return response(text).isNull()


def items(text: Column, name: str) -> Column:
    """Array under ``name`` as ``array<variant>``; empty if missing or null, null for malformed text."""
    got = F.try_variant_get(response(text), f"$.{name}", "array<variant>")
    return F.when(~bad_json(text), F.coalesce(got, F.array().cast("array<variant>")))


def _s(v: Column, f: str) -> Column:
    return F.try_variant_get(v, f"$.{f}", "string")


def _i(v: Column, f: str) -> Column:
    return F.try_variant_get(v, f"$.{f}", "int")


def truth(v: Column, f: str) -> Column:
    """Booleans, and the words true and false in any case; anything else is null."""
    return F.lower(ws_trim(_s(v, f))).try_cast("boolean")


def relevance(text: Column) -> Column:
    """``array<struct<index, is_relevant, confidence>>``; entries without a whole-number index are dropped."""
    out = F.transform(items(text, "results"), lambda v: F.struct(_i(v, "index").alias("index"), truth(v, "is_relevant").alias("is_relevant"), clamp01(_s(v, "confidence")).alias("confidence")))
    return F.filter(out, lambda r: r["index"].isNotNull())


def segment_texts(text: Column) -> Column:
    return F.filter(F.transform(items(text, "segments"), lambda v: ws_trim(F.coalesce(_s(v, "text"), F.lit("")))), lambda t: t != "")


def ranges(text: Column) -> Column:
    """``array<struct<s, e>>`` of index ranges, null ends where they are no numbers."""
    return F.transform(items(text, "segments"), lambda v: F.struct(_i(v, "start").alias("s"), _i(v, "end").alias("e")))


def turns(text: Column) -> Column:
    out = F.transform(
        items(text, "turns"),
        lambda v: F.struct(
            null_if_empty(_s(v, "speaker")).alias("speaker"), null_if_empty(_s(v, "role")).alias("role"), null_if_empty(_s(v, "speaker_type")).alias("speaker_type"),
            ws_trim(F.coalesce(_s(v, "text"), F.lit(""))).alias("text"), clamp01(_s(v, "confidence")).alias("confidence"), null_if_empty(_s(v, "note")).alias("note"),
        ),
    )
    return F.filter(out, lambda t: t["text"] != "")


def verifications(text: Column) -> Column:
    out = F.transform(
        items(text, "verifications"),
        lambda v: F.struct(
            _i(v, "index").alias("index"), _s(v, "verified_speaker").alias("speaker"), _s(v, "verified_role").alias("role"),
            clamp01(_s(v, "verification_score")).alias("score"), clamp01(_s(v, "prior_confidence")).alias("prior"), _s(v, "reasoning").alias("reasoning"),
        ),
    )
    return F.filter(out, lambda r: r["index"].isNotNull())


def last_by_index(entries: Column) -> Column:
    """Of entries with one index the last holds."""
    n = F.size(entries)
    numbered = F.transform(entries, lambda e, i: F.struct(i.alias("i"), e.alias("e")))
    return F.when(n >= 0, F.transform(F.filter(numbered, lambda x: ~F.exists(numbered, lambda y: (y["i"] > x["i"]) & (y["e"]["index"] == x["e"]["index"]))), lambda x: x["e"]))
