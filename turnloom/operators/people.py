"""Person mentions: roles by name, candidate lists, names found by token labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions.text import ws_trim
from turnloom.functions.units import strip_clip

# Roles of the fallback labels.
FALLBACK_ROLES = {"news anchor": "Anchor", "interviewee": "Interviewee", "guest": "Guest", "reporter": "Reporter"}


def resolve_roles(dialogues: DataFrame, people: DataFrame) -> DataFrame:
    """``dialogue_id, speaker, resolved_role``: role of the group's person of that name (case and a closing ``(Clip)``
    aside; the first by ``row_id``), else of a fallback label, else null."""
    p = people.filter(F.col("person").isNotNull()).select("group_id", F.lower(ws_trim(F.col("person"))).alias("k"), "row_id", "role").filter("k <> ''")
    best = p.groupBy("group_id", "k").agg(F.min_by(F.struct(ws_trim(F.coalesce("role", F.lit(""))).alias("r")), "row_id").alias("b"))
    d = dialogues.select("dialogue_id", "group_id", "speaker", F.lower(strip_clip(F.col("speaker"))).alias("k"))
    fallback = F.create_map(*[F.lit(x) for kv in FALLBACK_ROLES.items() for x in kv])
    role = F.when(F.col("b").isNotNull(), F.when(F.col("b")["r"] != "", F.col("b")["r"])).otherwise(F.try_element_at(fallback, F.coalesce("k", F.lit(""))))
    return d.join(best, ["group_id", "k"], "left").select("dialogue_id", "speaker", role.alias("resolved_role"))


def people_lists(people: DataFrame) -> DataFrame:
    """Candidate speakers of each group as lines of text, in ``row_id`` order."""
    # The labels of a line.
    known = lambda c: ws_trim(F.coalesce(F.col(c), F.lit("Unknown")))
    line = F.concat(F.lit("- Person: "), ws_trim(F.coalesce("person", F.lit(""))), F.lit(" | Role: "), known("role"), F.lit(" | Context: "), known("context_of_mention"))
    rows = F.array_sort(F.collect_list(F.struct("row_id", line.alias("line"))))
    return people.groupBy("group_id").agg(F.array_join(F.transform(rows, lambda x: x["line"]), "\n").alias("people"))


def join_roles(entries: DataFrame, answers: DataFrame) -> DataFrame:
    """Names with the role and context answered for them, by group and name without regard to case."""
    a = answers.select("group_id", F.lower(ws_trim(F.col("person"))).alias("k"), "role", "context", "seq")
    last = a.groupBy("group_id", "k").agg(F.max_by(F.struct("role", "context"), "seq").alias("v"))
    e = entries.withColumn("k", F.lower(ws_trim(F.col("person"))))
    return e.join(last, ["group_id", "k"], "left").select(*entries.columns, F.col("v")["role"].alias("role"), F.col("v")["context"].alias("context"))


def distinct_names(people: DataFrame) -> DataFrame:
    """Distinct names of each group by first appearance."""
    rows = F.array_sort(F.collect_list(F.when(ws_trim(F.coalesce("person", F.lit(""))) != "", F.struct("row_id", ws_trim(F.col("person")).alias("p")))))
    return people.groupBy("group_id").agg(F.array_join(F.array_distinct(F.transform(rows, lambda x: x["p"])), ", ").alias("names"))


def name_spans(tokens: Column, labels: Column) -> Column:
    """Person names from word pieces and their labels (``B-PER``, ``I-PER``, ``O``).

    Pieces opening with ``##`` belong to the word before; a ``B`` right after a name's word goes on with that name.
    Names are distinct, in order; labels past the shorter of both arrays are ignored.
    """
    empty = F.array().cast("array<string>")
    state = F.struct(empty.alias("out"), F.lit(None).cast("string").alias("cur"), F.lit(False).alias("per"))

    def push(a: Column) -> Column:
        return F.when(a["cur"].isNotNull(), F.concat(a["out"], F.array(a["cur"]))).otherwise(a["out"])

    def mk(out: Column, cur: Column, per: Column) -> Column:
        return F.struct(out.alias("out"), cur.alias("cur"), per.alias("per"))

    def step(a: Column, x: Column) -> Column:
        t, lab, yes, no = x["t"], x["l"], F.lit(True), F.lit(False)
        begin, inside = lab.startswith("B-PER"), lab.startswith("I-PER")
        grow = mk(a["out"], F.concat_ws(" ", a["cur"], t), yes)
        return (
            F.when(t.startswith("##"), mk(a["out"], F.when(a["cur"].isNotNull(), F.concat(a["cur"], F.substring(t, 3, 1000))), a["per"]))
            .when(begin & a["cur"].isNotNull() & a["per"], grow)
            .when(begin, mk(push(a), t, yes))
            .when(inside & a["cur"].isNotNull(), grow)
            .otherwise(mk(push(a), F.lit(None).cast("string"), no))
        )

    pairs = F.filter(F.arrays_zip(tokens.alias("t"), labels.alias("l")), lambda x: x["t"].isNotNull() & x["l"].isNotNull())
    return F.array_distinct(F.aggregate(pairs, state, step, push))
