"""Time arithmetic on timestamp / timestamp_ntz columns.

All differences go through ``timestampdiff(MICROSECOND, ...)`` which works for
both timestamp flavours and is exact; ``unix_timestamp`` drops sub-second
precision and ``cast(... as int)`` truncates negatives toward zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

US_PER_HOUR = 3_600_000_000
US_PER_SECOND = 1_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def diff_us(start, end) -> Column:
    """Exact microseconds from ``start`` to ``end`` (bigint)."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def floor_div(num: Column, d: int) -> Column:
    """Integer floor division that rounds toward -inf for negatives."""
    return ((num - F.pmod(num, F.lit(d))) / F.lit(d)).cast("bigint")


def floor_hours(start, end) -> Column:
    """floor((end - start) / 1 hour) — the hour index of ``end`` in a stay."""
    return floor_div(diff_us(start, end), US_PER_HOUR)


def hours_in(start, end, clamp_zero: bool = True) -> Column:
    """Hour of stay; measurements before entry are clamped into hour 0."""
    h = floor_hours(start, end)
    return F.greatest(F.lit(0).cast("bigint"), h) if clamp_zero else h


def ceil_hours(start, end) -> Column:
    """ceil(seconds / 3600)."""
    us = diff_us(start, end)
    return (-floor_div(-us, US_PER_HOUR)).cast("bigint")


def duration_hours(start, end) -> Column:
    """Fractional hours between two timestamps."""
    return diff_us(start, end) / F.lit(float(US_PER_HOUR))


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970 for either timestamp flavour."""
    return floor_div(F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), _c(ts).cast("timestamp_ntz")),
                     US_PER_SECOND)


def epoch_us(ts) -> Column:
    """Microseconds since 1970 for either timestamp flavour."""
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"),
                            _c(ts).cast("timestamp_ntz"))


def time_bucket(ts, seconds: int) -> Column:
    """Time bucket id of width ``seconds``; equal timestamps share a bucket."""
    return floor_div(epoch_us(ts), int(seconds) * US_PER_SECOND)


def add_hours(ts, hours) -> Column:
    """``ts + hours`` for a literal or column number of hours."""
    h = F.lit(hours) if isinstance(hours, (int, float)) else _c(hours)
    return _c(ts) + F.make_dt_interval(hours=h.cast("int"))


def add_seconds(ts, secs) -> Column:
    s = F.lit(secs) if isinstance(secs, (int, float)) else _c(secs)
    return _c(ts) + F.make_dt_interval(secs=s.cast("decimal(18,6)"))


def interval_day_part(start, end) -> Column:
    """DATE_PART('day', end - start): whole days of the interval."""
    return F.expr("0") + F.extract(F.lit("DAY"), _c(end) - _c(start))


def interval_hour_part(start, end) -> Column:
    """DATE_PART('hour', end - start): the 0..23 hour component, not total hours."""
    return F.extract(F.lit("HOUR"), _c(end) - _c(start))


def calendar_age(birth, at) -> Column:
    """Whole calendar years from ``birth`` to ``at`` (F08, like AGE's year part)."""
    b, a = _c(birth), _c(at)
    years = F.year(a) - F.year(b)
    earlier = (F.month(a) < F.month(b)) | ((F.month(a) == F.month(b)) & (F.dayofmonth(a) < F.dayofmonth(b)))
    return (years - F.when(earlier, 1).otherwise(0)).cast("int")


def hour_of_day(ts) -> Column:
    return F.hour(_c(ts))


def absolute_hour(ts, offset) -> Column:
    """(hour(intime) + hours_in) mod 24."""
    return F.pmod(F.hour(_c(ts)) + _c(offset), F.lit(24))
