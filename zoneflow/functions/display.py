"""Unit conversion, condition labels and display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zoneflow.functions.clock import EASTERN, col, local

# Condition thresholds (mm, percent) and their labels.
RAIN_FLOOR_MM = 0.1
CLOUDY_PCT = 85
PARTLY_CLOUDY_PCT = 40
CONDITION_LABELS = {
    "clear": "Clear",
    "partly_cloudy": "Partly cloudy",
    "cloudy": "Cloudy",
    "rain": "Rain",
    "snow": "Snow",
}


def c_to_f(c: Column | str) -> Column:
    return col(c) * 9 / 5 + 32


def kmh_to_mph(c: Column | str) -> Column:
    return col(c) * F.lit(0.621371)


def weather_condition(temp_c: Column | str, precip_mm: Column | str, cloud_pct: Column | str) -> Column:
    wet = F.when(col(temp_c) <= 0, "snow").otherwise("rain")
    return (
        F.when(col(precip_mm) > RAIN_FLOOR_MM, wet)
        .when(col(cloud_pct) >= CLOUDY_PCT, "cloudy")
        .when(col(cloud_pct) >= PARTLY_CLOUDY_PCT, "partly_cloudy")
        .otherwise("clear")
    )


def condition_label(condition: Column | str) -> Column:
    pairs = [F.lit(x) for item in CONDITION_LABELS.items() for x in item]
    return F.create_map(*pairs)[col(condition)]


def fmt_mw(c: Column | str) -> Column:
    """Three decimals with a thousands comma."""
    return F.format_number(col(c), 3)


def fmt_mw_conditional(c: Column | str) -> Column:
    """Three decimals; the comma only above 9999."""
    return F.when(F.abs(col(c)) > 9999, fmt_mw(c)).otherwise(F.regexp_replace(fmt_mw(c), ",", ""))


def eastern_label(time: Column | str) -> Column:
    """`01-31 9:05AM` in Eastern time."""
    return F.date_format(local(time, EASTERN), "MM-dd h:mma")


def scale_unit(value: Column, low: Column, high: Column) -> Column:
    """Min-max scaled and clamped to [0, 1]; 0 when the range is empty."""
    spread = F.when(high > low, high - low)
    return F.coalesce(F.least(F.greatest((value - low) / spread, F.lit(0.0)), F.lit(1.0)), F.lit(0.0))


def horizon_hours(text: Column | str) -> Column:
    """`y_24h` or `24h` -> 24."""
    return F.regexp_extract(col(text), r"(\d+)h$", 1).cast("int")
