"""Text expressions that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode knows it (Spark's own trim takes U+0020 only), and signs of no width at the ends of a text.
SPACE = "\t\n\x0b\x0c\r \x85\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
EDGE = SPACE + "\u200b\ufeff"


def ws_trim(c: Column) -> Column:
    """Strip Unicode white space (with no-break space and byte-order mark) from both ends."""
    return F.trim(c, F.lit(EDGE))


def ws_rtrim(c: Column) -> Column:
    return F.rtrim(c, F.lit(SPACE))


def ws_ltrim(c: Column) -> Column:
    return F.ltrim(c, F.lit(SPACE))


def squeeze(c: Column) -> Column:
    """Runs of white space become one space; the ends are stripped."""
    return ws_trim(one_space(F.translate(c, SPACE, " " * len(SPACE))))


def one_space(c: Column) -> Column:
    """Runs of U+0020 become one; most texts have none and pass a plain search only."""
    return F.when(c.contains("  "), F.regexp_replace(c, " {2,}", " ")).otherwise(c)


def fold_key(c: Column) -> Column:
    """Case and white space insensitive key of a hand-typed label."""
    return F.lower(squeeze(c))


def is_blank(c: Column) -> Column:
    """Null or nothing but white space."""
    return c.isNull() | (ws_trim(c) == "")


def null_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def clamp01(c: Column) -> Column:
    """A text or number as a double within [0, 1]; what is no number is null."""
    d = c.try_cast("double")
    return F.when(d.isNotNull() & ~F.isnan(d), F.greatest(F.lit(0.0), F.least(F.lit(1.0), d)))


def two_places(c: Column) -> Column:
    """A number as text with two digits after the point, rounded by its exact binary value, ties to even.

    The product with 100 is split into its rounded value and what rounding took away, which settles ties.
    """
    x = F.abs(c)
    p = x * 100
    high = x * 134217729 - (x * 134217729 - x)
    lost = (high * 100 - p) + (x - high) * 100
    down = F.floor(p)
    over = (p - (down + 0.5)) + lost
    n = (down + F.when(over > 0, 1).when(over < 0, 0).otherwise(down % 2)).cast("bigint")
    sign = F.when(c < 0, "-").otherwise("")
    return F.concat(sign, F.floor(n / 100).cast("string"), F.lit("."), F.lpad((n % 100).cast("string"), 2, "0"))
