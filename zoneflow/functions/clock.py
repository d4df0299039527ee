"""Time expressions. Stored time is UTC; calendar features use local time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

EASTERN = "US/Eastern"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local(time: Column | str, tz: str = EASTERN) -> Column:
    """Wall-clock time in `tz`, DST aware; read it with hour(), month() and so on."""
    return F.from_utc_timestamp(col(time), tz)


def to_utc(wall_time: Column | str, tz: str = EASTERN) -> Column:
    return F.to_utc_timestamp(col(wall_time), tz)


def plus_hours(time: Column | str, hours: Column | int) -> Column:
    hours = F.lit(hours) if isinstance(hours, int) else hours
    return col(time) + F.make_dt_interval(F.lit(0), hours.cast("int"))


def minus_days(time: Column | str, days: int) -> Column:
    return col(time) - F.make_dt_interval(F.lit(days))


def minus_months(time: Column | str, months: int) -> Column:
    """Calendar months back, clipped to the end of a shorter month."""
    return col(time) - F.make_ym_interval(F.lit(0), F.lit(months))


def hour_start(time: Column | str) -> Column:
    return F.date_trunc("hour", col(time))


def hour_ending(time: Column | str) -> Column:
    """Label of the hour a reading belongs to: 14:00-14:59 -> 15:00."""
    return plus_hours(hour_start(time), 1)


def from_epoch(seconds: Column | str) -> Column:
    return F.timestamp_seconds(col(seconds))


def iso(time: Column | str) -> Column:
    """ISO-8601 text with a numeric offset; the fraction only when there is one."""
    t = col(time)
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.when(F.unix_micros(t) % 1_000_000 != 0, F.date_format(t, ".SSSSSS")).otherwise("")
    return F.concat(whole, fraction, F.date_format(t, "xxx"))


def parse_mixed_offsets(text: Column | str) -> Column:
    """Timestamps written with different UTC offsets, as one UTC instant; bad text is NULL."""
    return F.try_to_timestamp(col(text))


def parse_us_date(text: Column | str) -> Column:
    return F.to_date(F.try_to_timestamp(col(text), F.lit("M/d/yyyy")))


def hours_between(start: Column | str, end: Column | str, step_hours: int = 1) -> Column:
    """Array of the instants from `start` up to but not including `end`; empty when none."""
    step = F.make_dt_interval(F.lit(0), F.lit(step_hours))
    last = F.greatest(col(start), col(end))
    return F.filter(F.sequence(col(start), last, step), lambda t: t < col(end))


def age_hours(time: Column | str, as_of: Column) -> Column:
    return (F.unix_micros(as_of) - F.unix_micros(col(time))) / F.lit(3_600_000_000.0)


def utc_literal(value: dt.datetime | dt.date | str | Column) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("timestamp")
