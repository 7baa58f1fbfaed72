"""Column-expression helpers shared by all operators.

Everything here returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage code generation; nothing is evaluated in Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400.0


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _second_of_day(ts: Column) -> Column:
    """With its fraction, as a decimal."""
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts)


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Seconds from ``start`` to ``end``, to the microsecond (wall-clock, time-zone free).

    Built from calendar parts (day difference and second of day) because
    ``timestamp_diff`` on ``timestamp_ntz`` values resolves wall-clock times
    that fall into a daylight-saving gap of the *session* time zone, which
    shifts such durations by an hour depending on a session setting.
    """
    s, e = col(start), col(end)
    days = F.datediff(F.to_date(e), F.to_date(s)).cast("long")
    return days * 86400 + (_second_of_day(e) - _second_of_day(s))


def days_between(start: str | Column, end: str | Column) -> Column:
    """(end - start) in fractional days; NULL if either side is NULL."""
    return seconds_between(start, end).cast("double") / F.lit(SECONDS_PER_DAY)


def _micros(days: str | Column) -> Column:
    return F.round(col(days) * F.lit(SECONDS_PER_DAY * 1e6)).cast("long")


def seconds_of(days: str | Column) -> Column:
    """The whole seconds of fractional days, for exact sums."""
    return F.floor(_micros(days) / F.lit(1e6))


def spare_micros(days: str | Column) -> Column:
    """The microseconds beyond ``seconds_of``: two long sums hold what one of
    microseconds would overflow with."""
    return F.pmod(_micros(days), F.lit(1_000_000))


def days_of(seconds: Column, micros: Column, n: Column) -> Column:
    """The mean in days of ``n`` durations from the sums of their two parts."""
    return F.try_divide(seconds + micros / F.lit(1e6), n * F.lit(SECONDS_PER_DAY))


def avg_days(days: str | Column) -> Column:
    """Mean of a duration column from exact sums of its microseconds.

    A double sum depends on the order rows are added, i.e. on partitioning, so
    a mean that is exactly halfway between two rounded values could round
    either way from run to run. Integer sums are exact and the few final
    operations are the same everywhere, so the result is reproducible.
    """
    return days_of(F.sum(seconds_of(days)), F.sum(spare_micros(days)), F.count(col(days)))


def avg_exact(c: str | Column) -> Column:
    """Mean of a double column from the exact sum of its decimal values (18
    places, more than a double of a coordinate's size holds): not rounded, and
    independent of the order of rows."""
    return F.try_divide(F.sum(col(c).cast("decimal(38,18)")).cast("double"), F.count(col(c)))


def avg_fixed(c: str | Column, digits: int = 2) -> Column:
    """Exact mean of values that carry ``digits`` decimals (e.g. rates already
    rounded to 2 places): summed as integers in units of 10^-digits."""
    scale = float(10 ** digits)
    units = F.round(col(c) * F.lit(scale)).cast("long")
    return F.try_divide(F.sum(units), F.count(col(c)) * F.lit(scale))


def weighted_avg_fixed(c: str | Column, w: str | Column, digits: int = 2) -> Column:
    """Exact ``sum(c * w) / sum(w)`` for ``digits``-decimal values and integer weights."""
    scale = float(10 ** digits)
    units = F.round(col(c) * F.lit(scale)).cast("long") * col(w)
    return F.try_divide(F.sum(units), F.sum(col(w)) * F.lit(scale))


def clip_lower(c: str | Column, lo: float = 0.0) -> Column:
    """pandas ``clip(lower=lo)``: keeps NULL (``greatest`` would not)."""
    c = col(c)
    return F.when(c < F.lit(lo), F.lit(lo)).otherwise(c)


def clip(c: str | Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Two- or one-sided clip that keeps NULL."""
    c = col(c)
    out = c
    if lo is not None:
        out = F.when(c < F.lit(lo), F.lit(float(lo))).otherwise(out)
    if hi is not None:
        out = F.when(c > F.lit(hi), F.lit(float(hi))).otherwise(out)
    return out


def rnd(c: str | Column, digits: int = 2, rounding: str = "half_up") -> Column:
    """Round for display; ``half_even`` reproduces banker's rounding."""
    c = col(c)
    return F.bround(c, digits) if rounding == "half_even" else F.round(c, digits)


def pct(cond: Column, total: Column | None = None) -> Column:
    """``count_if(cond) * 100.0 / count(*)`` as double (multiply first)."""
    total = F.count(F.lit(1)) if total is None else total
    return F.count_if(cond) * F.lit(100.0) / total


def pct_div_first(cond: Column, total: Column | None = None) -> Column:
    """``count_if(cond) / count(*) * 100`` as double (divide first)."""
    total = F.count(F.lit(1)) if total is None else total
    return F.count_if(cond) / total * F.lit(100.0)


def yyyymm(ts: str | Column) -> Column:
    ts = col(ts)
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def month_start(ts: str | Column) -> Column:
    return F.trunc(col(ts), "MM")


def iso_weekday(ts: str | Column) -> Column:
    """Monday = 1 .. Sunday = 7."""
    return (F.weekday(col(ts)) + 1).cast("int")


# Weekday names as the reference's dashboards print them
# (Monday first).
WEEKDAY_NAMES = ["Senin", "Selasa", "Rabu", "Kamis", "Jumat", "Sabtu", "Minggu"]


def weekday_name(ts: str | Column) -> Column:
    d = iso_weekday(ts)
    out = F.lit(None).cast("string")
    for i, name in reversed(list(enumerate(WEEKDAY_NAMES, start=1))):
        out = F.when(d == i, F.lit(name)).otherwise(out)
    return out


def bucket(c: str | Column, edges: Sequence[float], labels: Sequence[str],
           right_closed: bool = True, below: str | None = None) -> Column:
    """Label by the first edge the value does not exceed (``c <= edge``).

    ``labels`` has one more entry than ``edges``: the last label takes every
    value above the last edge *and* NULL, like a SQL ``CASE ... ELSE``.
    With ``right_closed=False`` the test is ``c < edge``.
    """
    c = col(c)
    assert len(labels) == len(edges) + 1
    out = F.lit(labels[-1])
    for edge, label in reversed(list(zip(edges, labels[:-1]))):
        test = (c <= F.lit(edge)) if right_closed else (c < F.lit(edge))
        out = F.when(test, F.lit(label)).otherwise(out)
    if below is not None:
        out = F.when(c.isNull(), F.lit(below)).otherwise(out)
    return out


def interval_bucket(c: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """pandas ``cut``: right-closed intervals (edges[i], edges[i+1]]; outside or NULL -> NULL."""
    c = col(c)
    assert len(labels) == len(edges) - 1
    out = F.lit(None).cast("string")
    for lo, hi, label in reversed(list(zip(edges[:-1], edges[1:], labels))):
        out = F.when((c > F.lit(lo)) & (c <= F.lit(hi)), F.lit(label)).otherwise(out)
    return out


# The dashboard's hour-of-day bands (inclusive hour ranges).
DAYPARTS = [
    (0, 5, "1. 00:00 - 05:59 (Dini Hari)"),
    (6, 11, "2. 06:00 - 11:59 (Pagi)"),
    (12, 17, "3. 12:00 - 17:59 (Siang)"),
    (18, 23, "4. 18:00 - 23:59 (Malam)"),
]


def daypart(ts: str | Column) -> Column:
    h = F.hour(col(ts))
    out = F.lit(DAYPARTS[-1][2])
    for lo, hi, label in reversed(DAYPARTS[:-1]):
        out = F.when(h.between(lo, hi), F.lit(label)).otherwise(out)
    return out
