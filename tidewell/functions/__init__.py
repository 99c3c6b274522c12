"""Column-level helpers: all built-in Spark expressions (codegen friendly)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import BOOLEAN_TEXT, DAY_BUCKET_TAIL, DAY_BUCKETS, NA_TOKENS


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------- text
# The Unicode White_Space characters, i.e. exactly what the regex
# class \p{IsWhite_Space} matches (U+0009-U+000D, U+0020, U+0085, U+00A0, U+1680,
# U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000).
WHITESPACE_CHARS = (["\t", "\n", "\x0b", "\x0c", "\r", " ", "\x85", "\xa0", "\u1680"]
                    + [chr(cp) for cp in range(0x2000, 0x200B)]
                    + ["\u2028", "\u2029", "\u202f", "\u205f", "\u3000"])


def _ws(ch: Column) -> Column:
    return ch.isin(WHITESPACE_CHARS)


def edge_ws(c: str | Column) -> Column:
    """First or last character is whitespace (= the value differs from its strip)."""
    c = col_(c)
    return _ws(F.substring(c, 1, 1)) | _ws(F.substring(c, -1, 1))


def is_blank(c: str | Column) -> Column:
    """Null, or no non-whitespace character (tabs and Unicode blanks included).

    A non-empty value whose first character is not whitespace is decided
    without the regex (the common case)."""
    c = col_(c)
    return (c.isNull() | (c.cast("string") == "")
            | (_ws(F.substring(c, 1, 1)) & ~c.rlike(r"\P{IsWhite_Space}")))


def na_to_null(c: str | Column) -> Column:
    """CSV missing-value tokens become null (done once, at the scan)."""
    c = col_(c)
    return F.when(c.isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def strip(c: str | Column) -> Column:
    """Trim leading/trailing whitespace of any kind (not only spaces).

    The regex only runs for values with whitespace at an edge."""
    c = col_(c)
    return F.when(edge_ws(c), F.regexp_replace(c, r"^\p{IsWhite_Space}+|\p{IsWhite_Space}+$", "")
                  ).otherwise(c)


# --------------------------------------------------------------------------- casts
#: Characters of a time of day without a zone.
PLAIN_TIME_CHARS = "0123456789:. T"


def to_ts(c: str | Column) -> Column:
    """Tolerant text -> TIMESTAMP_NTZ in UTC; unparseable -> null (never raises).

    Supported are the ISO forms that Spark casts. A text with an offset, 'Z' or a
    zone name is an instant (the session time zone is UTC) taken as UTC wall time:
    a direct cast to TIMESTAMP_NTZ would drop the offset without notice.
    """
    c = col_(c)
    return F.when(has_zone(c), c.try_cast("timestamp").cast("timestamp_ntz")).otherwise(
        c.try_cast("timestamp_ntz"))


def has_zone(c: Column) -> Column:
    """Anything but digits, separators and T behind the date part: an offset or zone."""
    return F.translate(F.substring(c.cast("string"), 11, 64), PLAIN_TIME_CHARS, "") != ""


def to_date(c: str | Column) -> Column:
    c = col_(c)
    return F.when(has_zone(c), to_ts(c).cast("date")).otherwise(
        F.coalesce(c.try_cast("date"), to_ts(c).cast("date")))


def to_number(c: str | Column) -> Column:
    """Tolerant text -> double; NaN, infinities and Java's type suffixes (10d, 10f)
    count as unparseable. No other number holds one of those letters."""
    c = col_(c)
    d = F.when(F.translate(c.cast("string"), "dDfF", "") == c.cast("string"), c.try_cast("double"))
    return F.when(F.isnan(d) | (F.abs(d) == float("inf")), F.lit(None)).otherwise(d)


def to_bool(c: str | Column) -> Column:
    t = F.lower(strip(col_(c)))
    expr = None
    for k, v in BOOLEAN_TEXT.items():
        expr = (F.when(t == k, F.lit(v)) if expr is None else expr.when(t == k, F.lit(v)))
    return expr.otherwise(F.lit(None).cast("boolean"))


# --------------------------------------------------------------------------- money
def round_half_even_2(c: Column) -> Column:
    """2-dp rounding the way NumPy rounds floats: rint(x*100)/100."""
    return F.rint(c * 100) / 100


# --------------------------------------------------------------------------- dates
def date_key(c: str | Column) -> Column:
    """timestamp/date -> int yyyymmdd."""
    return F.date_format(col_(c), "yyyyMMdd").cast("int")


def iso_day(c: str | Column) -> Column:
    return F.date_format(col_(c), "yyyy-MM-dd")


def whole_days(start: Column, end: Column) -> Column:
    """Whole 24-hour days from start to end, truncated (Trino date_diff('day'))."""
    return F.timestamp_diff("DAY", start, end).cast("bigint")


def ts_lit(d: _dt.date | _dt.datetime) -> Column:
    if not isinstance(d, _dt.datetime):
        d = _dt.datetime(d.year, d.month, d.day)
    return F.lit(d).cast("timestamp_ntz")


def day_bucket(c: str | Column) -> Column:
    c = col_(c)
    expr = None
    for bound, label in DAY_BUCKETS:
        expr = F.when(c <= bound, label) if expr is None else expr.when(c <= bound, label)
    return expr.otherwise(DAY_BUCKET_TAIL)


# --------------------------------------------------------------------------- exact rounding
def with_half_up(df, out: str, num: Column, den: Column, scale: int, num_scale: int = 0):
    """``out = round(num / 10^num_scale / den, scale)``, exactly, half away from zero.

    ``num`` must be integer-valued (e.g. cents as DECIMAL(38,0)). Integer
    division (``div``) avoids the binary-double tie problem: 2432517.07 / 2 is
    1216258.535 exactly and rounds to .54 in every engine.
    """
    from pyspark.sql import functions as _F

    k = 10 ** scale
    d = 10 ** num_scale
    df = df.withColumn("_hn", num.cast("decimal(38,0)")).withColumn("_hd", den.cast("decimal(38,0)"))
    q = _F.expr(f"(2 * abs(_hn) * {k} + _hd * {d}) div (2 * _hd * {d})")
    sign = _F.when(_F.col("_hn") < 0, -1).otherwise(1)
    val = (sign * q).cast("double") / float(k)
    return df.withColumn(out, _F.when(_F.col("_hd") == 0, _F.lit(None)).otherwise(val)).drop("_hn", "_hd")


def cents(c: str | Column) -> Column:
    """2-dp decimal money -> integer cents (exact)."""
    return (col_(c).cast("decimal(38,2)") * 100).cast("decimal(38,0)")
