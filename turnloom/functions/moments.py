"""Reading dates and times typed in many ways, as JVM expressions.

``add_date_readings`` gives every calendar day a text can name; ``add_time_reading`` gives the clock time, the
zone or offset written beside it and the absolute moment if the text is a full stamp.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions.text import SPACE, one_space, ws_trim
from turnloom.runtime import hold

# Month names and short forms by number (English, German, French; accents removed).
MONTHS = {
    1: "january jan januar janner janvier janv",
    2: "february feb februar fevrier fevr fev",
    3: "march mar marz mrz mars",
    4: "april apr avril avr",
    5: "may mai",
    6: "june jun juni juin",
    7: "july jul juli juillet juil",
    8: "august aug aout",
    9: "september sep sept septembre",
    10: "october oct oktober okt octobre",
    11: "november nov novembre",
    12: "december dec dezember dez decembre",
}

# Minutes east of UTC of zone abbreviations, and where another meaning is usual.
ABBREVIATIONS = {
    "z": 0, "utc": 0, "gmt": 0, "ut": 0, "wet": 0, "west": 60, "bst": 60, "cet": 60, "cest": 120, "mez": 60,
    "mesz": 120, "eet": 120, "eest": 180, "msk": 180, "ist": 330, "pkt": 300, "sgt": 480, "hkt": 480, "jst": 540,
    "kst": 540, "awst": 480, "acst": 570, "acdt": 630, "aest": 600, "aedt": 660, "nzst": 720, "nzdt": 780,
    "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420,
    "akst": -540, "akdt": -480, "hst": -600, "ast": -240, "adt": -180, "nst": -210, "ndt": -150, "brt": -180,
    "sast": 120, "cat": 120, "eat": 180, "wat": 60,
}
HOME_MEANINGS = {
    "ist|Europe/Dublin": 60, "ist|Asia/Jerusalem": 120, "cst|Asia/Shanghai": 480, "cst|Asia/Taipei": 480,
    "cst|America/Havana": -300, "bst|Asia/Dhaka": 360, "ast|Asia/Riyadh": 180, "est|Australia/Sydney": 600,
    "est|Australia/Melbourne": 600, "gst|Asia/Dubai": 240,
}
#: Zones named in general only: the wall clock of the home zone.
GENERAL = ("et", "ct", "mt", "pt", "at", "local", "local time", "uk", "uk time")

_ACCENTED, _PLAIN = "áàâäãéèêëíìîïóòôöúùûüç", "aaaaaeeeeiiiioooouuuuc"


def _map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


_MONTH_OF = {name: n for n, names in MONTHS.items() for name in names.split()}


def plain(c: Column) -> Column:
    """Lower case, one space between words, no accents: what the patterns below read."""
    return ws_trim(one_space(F.translate(F.lower(c), _ACCENTED + SPACE, _PLAIN + " " * len(SPACE))))


def valid_day(y: Column, m: Column, d: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    length = F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)
    return (y >= 1) & m.between(1, 12) & (d >= 1) & (d <= length)


def epoch_day(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970-01-01, null where there is no such day."""
    return F.when(valid_day(y, m, d), F.unix_date(F.make_date(y, m, d)).cast("long"))


def _full_year(y: Column) -> Column:
    return F.when(y < 100, y + 2000).otherwise(y)


_NUM = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d{2})$"
_YMD = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})$"
_DAY_FIRST = r"^(?:[a-z]+[.,]{0,2} ?)?(\d{1,2})(?:st|nd|rd|th|er)?[.]?[- /]?([a-z]{3,})[.,]?[- /,](\d{4}|\d{2})$"
_MONTH_FIRST = r"^(?:[a-z]+[.,]{0,2} )?([a-z]{3,})[.]? (\d{1,2})(?:st|nd|rd|th)?,? (\d{4})$"
_DATES = (("ymd", _YMD), ("num", _NUM), ("compact", _COMPACT), ("day_name", _DAY_FIRST), ("month_name", _MONTH_FIRST))


def _parts(t: Column, patterns: tuple, groups: int) -> Column:
    """The name of the first pattern that matches and its groups, as one array of texts."""
    out = None
    for name, p in patterns:
        refs = "|".join(f"${i + 1}" for i in range(groups))
        value = F.split(F.regexp_replace(t, p, f"{name}|{refs}"), r"\|", -1)
        out = F.when(t.rlike(p), value) if out is None else out.when(t.rlike(p), value)
    return out


def add_date_readings(df: DataFrame, text: Column, date_order: Column, out: str) -> DataFrame:
    """Add ``out``: ``array<struct<fmt, day>>``, each real calendar day (epoch day) that ``text`` can name.

    All-number dates that do not open with the year are read in ``date_order`` (``dmy``/``mdy``) where it is
    known and both ways where it is null. Null, blank and impossible texts give an empty array.
    """
    df = hold(df, __t=plain(text), __o=date_order)
    df = hold(df, __p=_parts(F.col("__t"), _DATES, 3))
    g = lambda i: F.try_element_at("__p", F.lit(i + 1))
    n = lambda i: g(i).try_cast("int")
    fmt, month, o = g(0), _map(_MONTH_OF), F.col("__o")
    named = lambda i: F.try_element_at(month, g(i))
    parts = (
        F.when(fmt.isin("ymd", "compact"), F.array(F.struct(fmt.alias("fmt"), n(1).alias("y"), n(2).alias("m"), n(3).alias("d"))))
        .when(
            fmt == "num",
            F.filter(
                F.array(
                    F.struct(F.lit("dmy").alias("fmt"), _full_year(n(3)).alias("y"), n(2).alias("m"), n(1).alias("d")),
                    F.struct(F.lit("mdy").alias("fmt"), _full_year(n(3)).alias("y"), n(1).alias("m"), n(2).alias("d")),
                ),
                lambda r: o.isNull() | (r["fmt"] == o),
            ),
        )
        .when(fmt == "day_name", F.array(F.struct(fmt.alias("fmt"), _full_year(n(3)).alias("y"), named(2).alias("m"), n(1).alias("d"))))
        .when(fmt == "month_name", F.array(F.struct(fmt.alias("fmt"), n(3).alias("y"), named(1).alias("m"), n(2).alias("d"))))
    )
    days = F.filter(F.transform(parts, lambda r: F.struct(r["fmt"].alias("fmt"), epoch_day(r["y"], r["m"], r["d"]).alias("day"))), lambda r: r["day"].isNotNull())
    return hold(df, **{out: F.coalesce(days, F.array().cast("array<struct<fmt:string,day:bigint>>"))}).drop("__t", "__o", "__p")


_CLOCKS = (
    ("epoch", r"^(\d{10}|\d{13}|\d{16})()()()()()$"),
    ("stamp", r"^(\d{4}-\d{2}-\d{2})[t ](\d{2}):(\d{2})(?::(\d{2})(?:[.,]\d+)?)? ?(z|utc|gmt|[+-]\d{2}:?\d{2})?()$"),
    ("military", r"^()(\d{2}):?(\d{2}) ?(?:h|hrs)()()()$"),
    (
        "clock",
        r"^()(\d{1,2})[:.](\d{2})(?::(\d{2})(?:[.,]\d+)?)? ?"
        r"\(?([a-z]{1,5}|local time|uk time|(?:utc|gmt)?[+-]\d{1,2}:?\d{2})?\)?()$",
    ),
    (
        "clock",
        r"^()(\d{1,2})[:.](\d{2})(?::(\d{2})(?:[.,]\d+)?)? ?(?=[ap]\.?m)"
        r"(?:[ap]\.?m\.?) ?\(?([a-z]{1,5}|local time|uk time|(?:utc|gmt)?[+-]\d{1,2}:?\d{2})?\)?()$",
    ),
)


def add_time_reading(df: DataFrame, text: Column, home_zone: Column, out: str) -> DataFrame:
    """Add ``out``: ``struct<fmt, epoch, stamp_day, sod, off>`` of a clock text.

    ``epoch`` is set for numbers of seconds, milliseconds or microseconds; ``stamp_day`` for texts that carry
    their own date; ``sod`` is the second of the day; ``off`` the minutes east of UTC of a written zone or
    offset, null where the wall clock of the home zone is meant. ``fmt`` is null where no time of day can be
    read (null, blank, words, an hour above 12 or 0 beside a 12-hour mark, an unknown zone).
    """
    zone_map, home_map = _map(ABBREVIATIONS), _map(HOME_MEANINGS)
    df = hold(df, __t=plain(text), __h=home_zone)
    # The 12-hour mark is taken out first so that one pattern serves clocks with and without it.
    df = hold(df, __m=F.regexp_extract("__t", r"^\d{1,2}[:.]\d{2}(?::\d{2}(?:[.,]\d+)?)? ?([ap])\.?m\b", 1))
    df = hold(df, __p=_parts(F.col("__t"), (*_CLOCKS[:3], _CLOCKS[4], _CLOCKS[3]), 6))
    g = lambda i: F.try_element_at("__p", F.lit(i + 1))
    n = lambda i: F.when(g(i) == "", 0).otherwise(g(i).try_cast("int"))
    kind, z = g(0), g(5)
    digits = F.lpad(F.regexp_replace(z, r"[^0-9]", ""), 4, "0")
    minutes = F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")
    signed = z.rlike(r"[+-]\d")
    off = (
        F.when(z.isin("", *GENERAL), F.lit(None).cast("int"))
        .when(signed, F.when(z.contains("-"), -minutes).otherwise(minutes))
        .otherwise(F.coalesce(F.try_element_at(home_map, F.concat_ws("|", z, F.col("__h"))), F.try_element_at(zone_map, z)))
    )
    sd, mark, h = g(1), F.col("__m"), n(2)
    hour = F.when((kind != "clock") | (mark == ""), h).when(h.between(1, 12), h % 12 + F.when(mark == "p", 12).otherwise(0))
    df = hold(df, __off=off, __z=z, __hour=hour)
    hour, off, z = F.col("__hour"), F.col("__off"), F.col("__z")
    sod = F.when(hour.between(0, 23) & n(3).between(0, 59) & n(4).between(0, 59) & (off.isNotNull() | z.isin("", *GENERAL)), hour * 3600 + n(3) * 60 + n(4))
    day = epoch_day(F.substring(sd, 1, 4).try_cast("int"), F.substring(sd, 6, 2).try_cast("int"), F.substring(sd, 9, 2).try_cast("int"))
    scale = F.when(F.length(sd) == 10, F.lit(1)).when(F.length(sd) == 13, F.lit(1000)).otherwise(F.lit(1000000))
    df = hold(
        df,
        __sod=F.when(kind != "epoch", sod),
        __day=F.when(kind == "stamp", day),
        __ep=F.when(kind == "epoch", F.floor(sd.try_cast("long") / scale).cast("long")),
    )
    good = F.col("__ep").isNotNull() | (F.col("__sod").isNotNull() & ((kind != "stamp") | F.col("__day").isNotNull()))
    name = F.when(kind == "clock", F.when(mark == "", F.lit("h24")).otherwise(F.lit("h12"))).otherwise(kind)
    reading = F.struct(
        F.when(good, name).alias("fmt"), F.col("__ep").alias("epoch"), F.col("__day").alias("stamp_day"), F.col("__sod").alias("sod"), off.alias("off")
    )
    return hold(df, **{out: reading}).drop("__t", "__h", "__m", "__p", "__off", "__z", "__hour", "__sod", "__day", "__ep")


def zone_offset(utc: Column, zone: Column) -> Column:
    """Seconds east of UTC of ``zone`` at the moment ``utc`` (epoch seconds)."""
    return F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(utc), zone)) - utc


def wall_moments(wall: Column, zone: Column) -> Column:
    """Every moment at which clocks in ``zone`` show ``wall`` (seconds as if UTC): none in a spring gap, two in
    an autumn overlap. Takes zones whose changes lie more than two days apart."""
    before, after = zone_offset(wall - 86400, zone), zone_offset(wall + 86400, zone)
    both = F.array_distinct(F.array(wall - before, wall - after))
    return F.when(before == after, F.array(wall - before)).otherwise(F.filter(both, lambda u: u + zone_offset(u, zone) == wall))
