"""Column-level building blocks. All are built-in expressions and safe under ANSI mode."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_ts_lenient(value: ColumnOrName) -> Column:
    """Timestamp, or null where the text cannot be read as one (session zone: UTC)."""
    return as_column(value).try_cast("timestamp")


def event_day(ts: ColumnOrName) -> Column:
    """Calendar day of a timestamp."""
    return F.to_date(as_column(ts))


def floor_hour(ts: ColumnOrName) -> Column:
    """Start of the hour a timestamp falls in."""
    return F.date_trunc("hour", as_column(ts))


def week_label(ts: ColumnOrName) -> Column:
    """Monday-to-Sunday week printed as ``start/end``."""
    monday = F.to_date(F.date_trunc("week", as_column(ts)))
    return F.concat_ws("/", monday.cast("string"), F.date_add(monday, 6).cast("string"))


def clip(value: ColumnOrName, lo: float, hi: float) -> Column:
    """Limit to ``[lo, hi]``; null stays null (``least``/``greatest`` alone would skip it)."""
    col = as_column(value)
    return F.when(col.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), col)))


def fill_clip_int(value: ColumnOrName, default: int, lo: int, hi: int) -> Column:
    """Null becomes ``default``; then limit to ``[lo, hi]`` and drop the fraction."""
    return clip(F.coalesce(as_column(value), F.lit(default)), lo, hi).cast("int")


def in_set(value: ColumnOrName, members: Iterable[str]) -> Column:
    """Membership where null counts as "not a member"."""
    return F.coalesce(as_column(value).isin(list(members)), F.lit(False))


def flag_any(value: ColumnOrName) -> Column:
    """1 where a count is positive, else 0."""
    return F.coalesce(as_column(value) > 0, F.lit(False)).cast("int")


def safe_ratio(num: ColumnOrName, den: ColumnOrName, scale: float = 1.0) -> Column:
    """``num * scale / den`` as double; 0.0 where the denominator is zero or a side is null."""
    top = as_column(num).cast("double") * F.lit(float(scale))
    return F.coalesce(F.try_divide(top, as_column(den).cast("double")), F.lit(0.0))


def bin_column(value: ColumnOrName, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed interval holding the value, ``nan`` outside all of them."""
    if len(edges) != len(labels) + 1:
        raise ValueError("bin_column needs one more edge than labels")
    col = as_column(value)
    binned = F.when(col.isNull() | (col <= F.lit(edges[0])), F.lit("nan"))
    for edge, label in zip(edges[1:], labels, strict=True):
        binned = binned.when(col <= F.lit(edge), F.lit(label))
    return binned.otherwise(F.lit("nan"))


def normalize_bounds(value: ColumnOrName, lo: ColumnOrName, hi: ColumnOrName) -> Column:
    """Min-max scale after limiting to ``[lo, hi]``; 0 where the bounds are not increasing."""
    low, high = as_column(lo), as_column(hi)
    x = F.coalesce(as_column(value).cast("double"), F.lit(0.0))
    limited = F.greatest(low, F.least(high, x))
    return F.when(high > low, F.try_divide(limited - low, high - low)).otherwise(F.lit(0.0))


def null_if_nan(value: ColumnOrName) -> Column:
    col = as_column(value)
    return F.when(~F.isnan(col), col)


def python_text(value: ColumnOrName, dtype: str) -> Column:
    """Print a value the way ``str()`` does in Python, with ``nan`` / ``NaT`` for null.

    Spark switches doubles to exponent form outside [1e-3, 1e7), Python outside
    [1e-4, 1e16), so the digits between those limits are moved by hand.
    """
    col = as_column(value)
    if dtype in ("timestamp", "timestamp_ntz"):
        offset = "+00:00" if dtype == "timestamp" else ""
        micros = F.date_format(col, "SSSSSS")
        fraction = F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(F.lit(""))
        text = F.concat(F.date_format(col, "yyyy-MM-dd HH:mm:ss"), fraction, F.lit(offset))
        return F.coalesce(text, F.lit("NaT"))
    if dtype == "boolean":
        return F.coalesce(F.initcap(col.cast("string")), F.lit("nan"))
    if dtype in ("double", "float"):
        return F.coalesce(_python_double(col.cast("double")), F.lit("nan"))
    return F.coalesce(col.cast("string"), F.lit("nan"))


def _python_double(col: Column) -> Column:
    size = F.abs(col)
    raw = size.cast("string")
    mantissa = F.split_part(raw, F.lit("E"), F.lit(1))
    exponent = F.split_part(raw, F.lit("E"), F.lit(2)).try_cast("int")
    trimmed = F.regexp_replace(mantissa, r"\.0$", "")
    digits = F.replace(mantissa, F.lit("."), F.lit(""))
    bare = F.replace(trimmed, F.lit("."), F.lit(""))
    whole = F.rpad(F.substring(digits, F.lit(1), exponent + 1), exponent + 1, F.lit("0"))
    rest = F.substring(digits, exponent + 2, F.length(digits))
    rest = F.when(F.length(rest) == 0, F.lit("0")).otherwise(rest)
    magnitude = (
        F.when(size.isin(float("inf")), F.lit("inf"))
        .when((size == 0) | ((size >= 1e-3) & (size < 1e7)), raw)
        .when((size >= 1e7) & (size < 1e16), F.concat(whole, F.lit("."), rest))
        .when((size >= 1e-4) & (size < 1e-3), F.concat(F.lit("0.000"), bare))
        .otherwise(
            F.concat(
                trimmed,
                F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
                F.lpad(F.abs(exponent).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exponent).cast("string"))), F.lit("0")),
            )
        )
    )
    negative = (col < 0) | (col.cast("string") == "-0.0")
    return F.when(~F.isnan(col), F.concat(F.when(negative, F.lit("-")).otherwise(F.lit("")), magnitude))
