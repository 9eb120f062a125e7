"""Rows that fail to parse (problem 5): set apart with a reason while the rest is loaded.

A line is cut at its quote marks: pieces alternate between outside and inside of quotes, which settles whether
the quoting is sound and where the separators are, without a parser written by hand or a recursive pattern.
Cells are exploded to (row, column, value), met with a table of rules, and errors are gathered per row; clean
rows are those left by an anti-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions.moments import add_date_readings, add_time_reading
from turnloom.functions.text import fold_key, is_blank, ws_trim
from turnloom.runtime import by_value, hold

COLUMNS = ("broadcast_date", "broadcast_time", "program_title", "channel_name", "plain_text")

#: Rules by column position: a column without a rule takes anything.
RULES = ((0, "calendar_day", "value"), (1, "time_of_day", "value"), (4, "has_text", "value"))

#: Signs that may stand for a separating comma: the first that a line doesn't hold itself is taken.
_SEPARATORS = ("\x1f", "\x1e", "\ue000")


def _separator(line: Column) -> Column:
    """A text that doesn't occur in ``line``, nor where it meets a piece of it: one of the signs, else a run of the last
    one longer than the line with another sign after it."""
    out = None
    for c in _SEPARATORS:
        free = ~line.contains(c)
        out = F.when(free, F.lit(c)) if out is None else out.when(free, F.lit(c))
    return out.otherwise(F.concat(F.repeat(F.lit(_SEPARATORS[-1]), F.length(line) + 1), F.lit(_SEPARATORS[0])))



def add_csv_cells(df: DataFrame, line: Column) -> DataFrame:
    """Add ``sound`` and ``cells`` of one logical CSV record.

    Sound: a quoted field is quoted wholly, quotes inside it are doubled, quotes occur nowhere else. White space
    around the line, a byte-order mark and a closing carriage return are dropped first; white space around a
    quoted field is no fault. ``cells`` is only meaningful where ``sound``.
    """
    df = hold(df, __line=ws_trim(F.coalesce(line, F.lit(""))))
    df = hold(df, __pieces=F.split("__line", '"', -1), __sep=_separator(F.col("__line")))
    df = hold(df, __n=F.size("__pieces"))
    n, at = F.col("__n"), lambda i: F.element_at("__pieces", i + 1)
    pos = F.sequence(F.lit(0), n - 1)
    fine = F.forall(
        pos,
        lambda i: F.when((i % 2 == 1) | (n == 1), True)
        .when(i == 0, at(i).rlike(r"(^|,)\s*$"))
        .when(i == n - 1, at(i).rlike(r"^\s*(,|$)"))
        .otherwise((at(i) == "") | at(i).rlike(r"^\s*,([\s\S]*,)?\s*$")),
    )
    # An empty piece between two quoted ones is a doubled quote.
    marked = F.array_join(
        F.transform(
            pos,
            lambda i: F.when(i % 2 == 1, at(i))
            .when((at(i) == "") & (i > 0) & (i < n - 1), F.lit('"'))
            .otherwise(F.replace(at(i), F.lit(","), F.col("__sep"))),
        ),
        "",
    )
    cells = F.split(marked, F.concat(F.lit("\\Q"), F.col("__sep"), F.lit("\\E")), -1)
    return hold(df, sound=(n % 2 == 1) & fine, cells=cells).drop("__line", "__pieces", "__sep", "__n")


def parsed(raw: DataFrame) -> DataFrame:
    """``raw_id, sound, cells`` of the lines that are not headers (line 1 of a file)."""
    lines = raw.filter(~F.col("line_no").eqNullSafe(1)).select("raw_id", "raw_line")
    return add_csv_cells(lines, F.col("raw_line")).drop("raw_line")


def rule_table(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(list(RULES), "col int, rule string, reason string")


def row_errors(raw: DataFrame, channels: DataFrame) -> DataFrame:
    """``raw_id, reason`` of each failing line: ``quoting``, else ``column_count``, else ``value``.

    A null or empty line counts one column. All-number dates are read in the order of the line's channel, either
    way if the channel is unknown. Headers are never reported; empty input gives no rows.
    """
    lines = parsed(raw)
    structure = F.when(~F.col("sound"), "quoting").when(F.size("cells") != len(COLUMNS), "column_count")
    dim = channels.select(fold_key(F.col("channel_name")).alias("__ch"), "date_order").dropDuplicates(["__ch"])
    lines = hold(lines, structure=structure, __ch=fold_key(F.try_element_at("cells", F.lit(4)))).join(dim, "__ch", "left")
    # A line of broken structure has no cells to speak of: it goes through as one, with its reason.
    cells = lines.select("raw_id", "date_order", "structure", F.posexplode(F.when(F.col("structure").isNull(), F.col("cells")).otherwise(F.array(F.lit("")))).alias("col", "value"))
    rules = F.broadcast(rule_table(raw))  # as long as RULES
    v, rule = F.col("value"), F.col("rule")
    met = cells.join(rules, "col", "left").filter("structure is not null or rule is not null")
    whole = F.col("structure").isNull()
    met = hold(met, __date=F.when(whole & (rule == "calendar_day"), v), __time=F.when(whole & (rule == "time_of_day"), v))
    met = by_value(met, ["__date", "date_order"], lambda x: add_date_readings(x, F.col("__date"), F.col("date_order"), "days"))
    met = add_time_reading(met, F.col("__time"), F.lit("UTC"), "clock")
    ok = (
        F.when(rule == "calendar_day", F.size("days") > 0)
        .when(rule == "time_of_day", F.col("clock")["fmt"].isNotNull())
        .when(rule == "has_text", ~is_blank(v))
    )
    wrong = met.filter(~whole | ~F.coalesce(ok, F.lit(False))).select("raw_id", F.coalesce("structure", "reason").alias("reason"))
    return wrong.groupBy("raw_id").agg(F.min("reason").alias("reason"))


def clean_rows(raw: DataFrame, channels: DataFrame) -> DataFrame:
    """The lines that load, as ``raw_id`` and the five named text columns."""
    good = parsed(raw).join(row_errors(raw, channels), "raw_id", "left_anti")
    return good.select("raw_id", *[ws_trim(F.try_element_at("cells", F.lit(i + 1))).alias(c) for i, c in enumerate(COLUMNS)])
