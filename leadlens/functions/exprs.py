"""Scalar column expressions.

Every helper returns a ``Column`` built from built-in functions only, so it
stays inside whole-stage codegen.  Null handling follows the pandas
semantics of the original feature code: NaN/NaT/None are one "missing",
comparisons against missing are false, and ``!=`` against missing is true.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: characters Python's str.strip() removes in the ASCII range.
WHITESPACE = " \t\n\r\x0b\x0c"

MICROS_PER_HOUR = 3.6e9
MICROS_PER_MINUTE = 6e7


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_date(d: _dt.date | str) -> Column:
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


# F1 ---------------------------------------------------------------------------
def days_since(ts: str | Column, ref_date: _dt.date | str) -> Column:
    """Whole days from midnight of ``ts`` to ``ref_date`` (negative if later)."""
    return F.datediff(lit_date(ref_date), F.to_date(col(ts)))


# F2 ---------------------------------------------------------------------------
def hours_between(a: str | Column, b: str | Column) -> Column:
    """Fractional hours from ``a`` to ``b``; null if either side is null."""
    return F.timestamp_diff("MICROSECOND", col(a), col(b)) / F.lit(MICROS_PER_HOUR)


def minutes_between(a: str | Column, b: str | Column) -> Column:
    return F.timestamp_diff("MICROSECOND", col(a), col(b)) / F.lit(MICROS_PER_MINUTE)


# F3 ---------------------------------------------------------------------------
def strip_ws(c: str | Column) -> Column:
    return F.btrim(col(c).cast("string"), F.lit(WHITESPACE))


def non_blank(c: str | Column) -> Column:
    """Boolean: value present and not only whitespace."""
    c = col(c)
    return c.isNotNull() & (strip_ws(c) != F.lit(""))


def flag(c: str | Column) -> Column:
    """0/1 int version of :func:`non_blank`; never null."""
    return F.when(non_blank(c), 1).otherwise(0).cast("int")


def bool_flag(cond: Column) -> Column:
    """0/1 int from a predicate; a null predicate counts as 0."""
    return F.when(cond, 1).otherwise(0).cast("int")


# F4 ---------------------------------------------------------------------------
def fill(c: str | Column, default) -> Column:
    return F.coalesce(col(c), F.lit(default))


# F5 ---------------------------------------------------------------------------
def hour_of_day(ts: str | Column) -> Column:
    return F.hour(col(ts))


def day_of_week(ts: str | Column) -> Column:
    """Monday = 0 … Sunday = 6."""
    return F.weekday(col(ts))


def is_weekend(ts: str | Column) -> Column:
    return bool_flag(F.weekday(col(ts)).isin(5, 6))


def is_business_hours(ts: str | Column, start: int = 9, end: int = 18) -> Column:
    return bool_flag(F.hour(col(ts)).between(start, end))


# F6 ---------------------------------------------------------------------------
def changed(prev: str | Column, cur: str | Column) -> Column:
    """prev present and different from cur, where "different from null" is true."""
    prev, cur = col(prev), col(cur)
    return bool_flag(prev.isNotNull() & ~prev.eqNullSafe(cur))


# F7 ---------------------------------------------------------------------------
def contains_any(c: str | Column, keywords: Iterable[str]) -> Column:
    """Case-insensitive substring match of any keyword (a missing text is '').

    Keywords are plain substrings; no wildcard characters are interpreted.
    """
    text = F.lower(F.coalesce(col(c).cast("string"), F.lit("")))
    cond = F.lit(False)
    for kw in keywords:
        cond = cond | text.contains(kw.lower())
    return cond


# F8 ---------------------------------------------------------------------------
def json_number(c: str | Column, path: str) -> Column:
    """Tolerant JSON path read cast to an integral number; bad JSON → null."""
    return F.get_json_object(col(c), path).try_cast("decimal(38,0)")


# F9 ---------------------------------------------------------------------------
def guarded_ratio(num: str | Column, den: str | Column, scale: int = 3) -> Column:
    """``num/den`` when ``den > 0`` else 0, rounded half-even."""
    num, den = col(num), col(den)
    return F.bround(F.when(den > 0, num / den).otherwise(F.lit(0.0)), scale)


# F10 --------------------------------------------------------------------------
def avg_interval_hours(first: str | Column, last: str | Column,
                       count: str | Column) -> Column:
    n = F.coalesce(col(count), F.lit(0))
    return F.when(n > 1, hours_between(first, last) / F.greatest(n - 1, F.lit(1)))


# F11 / F12 --------------------------------------------------------------------
def weighted_engagement(call: Column, whatsapp: Column, email: Column,
                        sms: Column) -> Column:
    return call * 3 + whatsapp * 2 + email + sms


def multi_channel(*counts: Column, at_least: int = 2) -> Column:
    positives = sum((F.when(c > 0, 1).otherwise(0) for c in counts), F.lit(0))
    return bool_flag(positives >= at_least)


# F13 --------------------------------------------------------------------------
def real_email(c: str | Column, placeholder: str = "default@") -> Column:
    """Present and not a placeholder address; an empty string counts as real."""
    c = col(c)
    return bool_flag(c.isNotNull() & ~c.cast("string").contains(placeholder))


# F15 --------------------------------------------------------------------------
def clip(c: str | Column, lo=None, hi=None) -> Column:
    """Clamp to [lo, hi]; null stays null (bare greatest/least skip nulls)."""
    c = col(c)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(c.isNull(), F.lit(None)).otherwise(out)


# F16 --------------------------------------------------------------------------
def exp_decay(days: str | Column, half: float = 30.0, scale: float = 100.0,
              digits: int = 2) -> Column:
    return F.bround(F.lit(scale) * F.exp(-col(days) / F.lit(half)), digits)


# F17 --------------------------------------------------------------------------
def normalise_category(c: str | Column, missing: str = "missing") -> Column:
    v = F.lower(strip_ws(F.coalesce(col(c).cast("string"), F.lit(missing))))
    return F.when(v.isin("", "nan", "none"), F.lit(missing)).otherwise(v)


# F18 --------------------------------------------------------------------------
def to_number(c: str | Column, dtype: str = "double") -> Column:
    """Numeric coercion; unparsable text becomes null.  NaN becomes null too."""
    v = col(c).try_cast(dtype)
    if dtype in ("double", "float"):
        v = F.nanvl(v, F.lit(None).cast(dtype))
    return v


def to_timestamp_lenient(c: str | Column) -> Column:
    """String → timestamp, malformed → null (pandas ``errors='coerce'``)."""
    return F.try_to_timestamp(col(c).cast("string"))


# F19 --------------------------------------------------------------------------
def user_active(status: Column | None, deleted_at: Column | None) -> Column:
    """Active = not soft-deleted and status == 1; fallbacks when columns lack."""
    if status is None:
        return F.lit(0).cast("int")
    cond = status == 1
    if deleted_at is not None:
        cond = deleted_at.isNull() & cond
    return bool_flag(cond)


def ts_literal(value: _dt.datetime | _dt.date) -> Column:
    """A wall-clock timestamp literal (``timestamp_ntz``) independent of the
    Python process and session time zones."""
    if not isinstance(value, _dt.datetime):
        value = _dt.datetime(value.year, value.month, value.day)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
