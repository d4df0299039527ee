"""Calendar and degree-hour features, all plain column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.clock import EASTERN, col, local

BASE_C = 18.33
BASE_F = 65.0
PEAK_HOURS = (14, 18)
MARKET_HOURS = (7, 22)


def above(value: Column | str, base: float) -> Column:
    """max(value - base, 0), and NULL for NULL: greatest() alone would turn NULL into 0."""
    v = col(value)
    return F.when(v.isNotNull(), F.greatest(v - F.lit(base), F.lit(0.0)))


def below(value: Column | str, base: float) -> Column:
    v = col(value)
    return F.when(v.isNotNull(), F.greatest(F.lit(base) - v, F.lit(0.0)))


def weekend_flag(df: DataFrame, time_col: str = "time", tz: str = EASTERN) -> DataFrame:
    return df.withColumn("is_weekend", F.weekday(local(time_col, tz)) >= 5)


def degree_day_features(df: DataFrame, temp_col: str = "temperature") -> DataFrame:
    return df.withColumns({"hdd": below(temp_col, BASE_C), "cdd": above(temp_col, BASE_C)})


def degree_hours_f(df: DataFrame, temp_f_col: str = "temp_f") -> DataFrame:
    """Cooling and heating degree hours on a Fahrenheit column."""
    return df.withColumns({"cdh": above(temp_f_col, BASE_F), "hdh": below(temp_f_col, BASE_F)})


def peak_hour_flag(df: DataFrame, time_col: str = "time", tz: str = EASTERN) -> DataFrame:
    return df.withColumn("is_peak_hour", F.hour(local(time_col, tz)).between(*PEAK_HOURS))


def cyclical_features(df: DataFrame, time_col: str = "time", tz: str = EASTERN) -> DataFrame:
    at = local(time_col, tz)
    hour_angle = F.hour(at) * F.lit(2 * math.pi) / F.lit(24.0)
    month_angle = (F.month(at) - 1) * F.lit(2 * math.pi) / F.lit(12.0)
    return df.withColumns(
        {
            "hour_sin": F.sin(hour_angle),
            "hour_cos": F.cos(hour_angle),
            "month_sin": F.sin(month_angle),
            "month_cos": F.cos(month_angle),
            "year": F.year(at),
        }
    )


def features(
    df: DataFrame, time_col: str = "time", tz: str = EASTERN, drop_time_col: bool = True
) -> DataFrame:
    """All calendar and degree features. Row order is left alone: none of them needs it."""
    out = (
        df.transform(weekend_flag, time_col, tz)
        .transform(degree_day_features)
        .transform(peak_hour_flag, time_col, tz)
        .transform(cyclical_features, time_col, tz)
    )
    return drop_time(out, time_col) if drop_time_col else out


def drop_time(df: DataFrame, time_col: str = "time") -> DataFrame:
    return df.drop(time_col)


def build_features(df: DataFrame) -> DataFrame:
    """Features with time kept. Zone stays text; the model's indexer makes it categorical."""
    return features(df, drop_time_col=False)


def _nth_monday(year: Column, month: int, nth: int) -> Column:
    first = F.make_date(year, F.lit(month), F.lit(1))
    return F.date_add(F.next_day(F.date_sub(first, 1), "Mon"), 7 * (nth - 1))


def holiday_name(date: Column) -> Column:
    """The six market holidays by calendar rule; a fixed-date holiday that falls on a
    weekend is also observed on the nearest weekday."""
    year = F.year(date)
    fixed = [("New Year's Day", 1, 1), ("Independence Day", 7, 4), ("Christmas Day", 12, 25)]
    memorial = F.date_sub(F.next_day(F.make_date(year, F.lit(5), F.lit(31)), "Mon"), 7)
    thanksgiving = F.date_add(F.next_day(F.date_sub(F.make_date(year, F.lit(11), F.lit(1)), 1), "Thu"), 21)
    out = (
        F.when(date == memorial, "Memorial Day")
        .when(date == _nth_monday(year, 9, 1), "Labor Day")
        .when(date == thanksgiving, "Thanksgiving Day")
    )
    for name, month, day in fixed:
        # a Saturday holiday is observed on the Friday before, a Sunday one on the Monday
        # after; 1 January can be observed in the previous year
        observed = [
            (F.month(d) == month) & (F.dayofmonth(d) == day) & cond
            for d, cond in (
                (date, F.lit(True)),
                (F.date_add(date, 1), F.weekday(date) == 4),
                (F.date_sub(date, 1), F.weekday(date) == 0),
            )
        ]
        out = out.when(observed[0] | observed[1] | observed[2], name)
    return out


def holiday_flag(df: DataFrame, time_col: str = "time", tz: str = EASTERN) -> DataFrame:
    return df.withColumn("is_holiday", holiday_name(F.to_date(local(time_col, tz))).isNotNull())


def market_on_peak_flag(df: DataFrame, time_col: str = "time", tz: str = EASTERN) -> DataFrame:
    """Market on-peak: hour beginning 07-22 local, Monday to Friday, no holiday."""
    at = local(time_col, tz)
    return df.withColumn(
        "is_market_on_peak",
        F.hour(at).between(*MARKET_HOURS)
        & (F.weekday(at) < 5)
        & holiday_name(F.to_date(at)).isNull(),
    )
