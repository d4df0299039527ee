"""Read queries over the feature table. An empty result is an empty frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.functions.calendar import build_features
from zoneflow.functions.clock import age_hours, minus_days, plus_hours
from zoneflow.functions.display import (
    c_to_f,
    condition_label,
    kmh_to_mph,
    scale_unit,
    weather_condition,
)
from zoneflow.operators import metrics
from zoneflow.plans.staging import last_per_key
from zoneflow.schemas import HORIZONS, SYSTEM_ZONE, WEATHER_COLS
from zoneflow.sources import tables
from zoneflow.sources.tables import DATE, since

Predictor = Callable[[DataFrame], DataFrame]

LIVE_HOURS = 96
TOP_ZONES = 5
DRILLDOWN_HOURS = 48
ACCURACY_HOURS = 72
LABELS = [f"y_{h}h" for h in HORIZONS]


def baseline_predictor(features: DataFrame) -> DataFrame:
    """Persistence forecast from the lags: needs no model, and plain SQL can repeat it."""
    return features.withColumns(
        {
            "y_1h": F.col("demand_lag_72h"),
            "y_24h": F.round("demand_roll_24h"),
            "y_72h": F.col("demand_lag_168h"),
        }
    )


def for_zone(df: DataFrame, zone: str | None) -> DataFrame:
    return df if zone is None else df.filter(F.col("zone") == zone)


def latest_features(features: DataFrame, zone: str | None = None) -> DataFrame:
    """Most recent row per zone: one row per zone and input partition is shuffled."""
    return last_per_key(for_zone(features, zone), ["zone"], "time")


def latest_stored(spark: SparkSession, path: str, schema: T.StructType, zone: str | None = None) -> DataFrame:
    """Most recent row per zone of a written table: only the dates that hold them are read."""
    rows = tables.read_newest(spark, path, schema, None if zone is None else [zone])
    return latest_features(rows.drop(DATE), zone)


def features_window(
    features: DataFrame, as_of: Column, hours: int = DRILLDOWN_HOURS, zone: str | None = None
) -> DataFrame:
    """Trailing rows. On a written table the date partitions before the window are pruned."""
    return since(for_zone(features, zone), plus_hours(as_of, -hours)).drop(DATE)


def ordered(df: DataFrame) -> DataFrame:
    """Output order of a series; not used inside other queries."""
    return df.orderBy("zone", "time")


def recent_peak(features: DataFrame, as_of: Column, days: int = 30, zone: str | None = None) -> DataFrame:
    recent = since(for_zone(features, zone), minus_days(as_of, days))
    return recent.groupBy("zone").agg(F.max("demand_mw").alias("peak_mw"))


def freshness(features: DataFrame, as_of: Column) -> DataFrame:
    """Newest hour, its age, and whether the feed keeps pace; NULLs on an empty table."""
    last = features.agg(F.max("time").alias("latest_load_time"))
    age = age_hours("latest_load_time", as_of)
    return last.select("latest_load_time", age.alias("age_hours"), (age <= LIVE_HOURS).alias("is_live"))


def freshness_stored(spark: SparkSession, path: str, as_of: Column) -> DataFrame:
    """As `freshness`, of a written table: its index knows the newest hour, so no row is read."""
    micros = tables.newest_micros(spark, path)
    return freshness(spark.range(1).select(F.timestamp_micros(F.lit(micros).cast("long")).alias("time")), as_of)


def peak_stored(spark: SparkSession, path: str, schema: T.StructType, as_of: Column, days: int = 30) -> DataFrame:
    """As `recent_peak`, of a written table: kept maxima of whole dates, rows of the date that the window cuts."""
    at = spark.range(1).select(F.unix_micros(minus_days(as_of, days))).first()[0]
    return tables.read_peaks(spark, path, schema, at).withColumnRenamed("peak", "peak_mw")


def predict(features: DataFrame, predictor: Predictor) -> DataFrame:
    """(time, zone, one column per horizon), plus the weather of the row it came from."""
    scored = predictor(build_features(features))
    return scored.select("time", "zone", *LABELS, *WEATHER_COLS)


def attach_weather(predictions: DataFrame, weather: DataFrame) -> DataFrame:
    """Weather from another table, for stored predictions."""
    return predictions.join(weather.select("time", "zone", *WEATHER_COLS), ["time", "zone"], "left")


def predictions(features: DataFrame, predictor: Predictor, zone: str | None = None) -> DataFrame:
    """Forecast of the latest row per zone. The row is unique per zone, so its weather is
    carried along rather than joined back."""
    return predict(latest_features(features, zone), predictor)


def by_horizon(preds: DataFrame) -> DataFrame:
    """One row per prediction and horizon, at the hour it is for."""
    values = [F.struct(F.lit(h).alias("horizon_h"), F.col(f"y_{h}h").alias("predicted_mw")) for h in HORIZONS]
    long = preds.select("time", "zone", F.inline(F.array(*values)))
    return long.withColumn("time", plus_hours("time", F.col("horizon_h")))


def history(
    features: DataFrame,
    predictor: Predictor,
    as_of: Column,
    hours: int = DRILLDOWN_HOURS,
    zone: str | None = None,
) -> DataFrame:
    """Every prediction of the window next to what was measured at its hour, if it was.
    All horizons are aligned by one join."""
    window = features_window(features, as_of, hours, zone)
    actual = window.select("time", "zone", F.col("demand_mw").alias("actual_mw"))
    aligned = by_horizon(predict(window, predictor)).join(actual, ["time", "zone"], "left")
    return aligned.select("time", "zone", "horizon_h", "actual_mw", "predicted_mw")


def system_history(features: DataFrame, predictor: Predictor, as_of: Column) -> DataFrame:
    """History long enough that the longest horizon has actuals across the accuracy window."""
    return history(features, predictor, as_of, ACCURACY_HOURS + max(HORIZONS))


def zone_table(preds: DataFrame, horizon: int) -> DataFrame:
    """Zones by predicted load, highest first."""
    picked = preds.select("zone", F.col(f"y_{horizon}h").alias("predicted_mw"))
    return picked.orderBy(F.desc_nulls_last("predicted_mw"), "zone")


def top_zones(preds: DataFrame, horizon: int, n: int = TOP_ZONES) -> DataFrame:
    return zone_table(preds, horizon).limit(n)


def top_zone_series(hist: DataFrame, preds: DataFrame, horizon: int, n: int = TOP_ZONES) -> DataFrame:
    """History of one horizon for the top zones; the list is n rows."""
    top = top_zones(preds, horizon, n).select("zone")
    return hist.filter(F.col("horizon_h") == horizon).join(F.broadcast(top), "zone", "left_semi")


def accuracy(hist: DataFrame) -> DataFrame:
    return metrics.accuracy_stats(hist)


def drilldown(
    hist: DataFrame, as_of: Column, horizon: int, zone: str = SYSTEM_ZONE
) -> DataFrame:
    """Series of a zone, or the sum of all zones; the look-back covers the horizon."""
    cutoff = plus_hours(as_of, -(DRILLDOWN_HOURS + horizon))
    recent = hist.filter((F.col("time") >= cutoff) & (F.col("horizon_h") == horizon))
    if zone == SYSTEM_ZONE:
        recent = metrics.system_totals(recent)
    else:
        recent = for_zone(recent, zone)
    return recent.select("time", "zone", "horizon_h", "actual_mw", "predicted_mw")


def weather_summary(preds: DataFrame, zone: str = SYSTEM_ZONE) -> DataFrame:
    """Current weather with display units; no row while any reading is missing."""
    if zone == SYSTEM_ZONE:
        readings = preds.agg(*[F.avg(c).alias(c) for c in WEATHER_COLS])
    else:
        readings = for_zone(preds, zone).select(*WEATHER_COLS)
    condition = weather_condition("temperature", "precipitation", "cloud_cover")
    return readings.na.drop("any", subset=WEATHER_COLS).select(
        F.lit(zone).alias("zone"),
        *WEATHER_COLS,
        condition.alias("condition"),
        condition_label(condition).alias("condition_label"),
        c_to_f("temperature").alias("temp_f"),
        kmh_to_mph("wind_speed").alias("wind_mph"),
    )


def load_ratio(preds: DataFrame, peaks: DataFrame, zones: DataFrame, horizon: int) -> DataFrame:
    """Predicted load over the zone's own recent peak, scaled over the zones shown.

    All three inputs are one row per zone.
    """
    picked = preds.select("zone", F.col(f"y_{horizon}h").alias("predicted_mw"))
    rows = zones.select(F.col("zone_id").alias("zone")).distinct().join(picked, "zone").join(peaks, "zone")
    rows = rows.withColumn("load_ratio", F.col("predicted_mw") / F.when(F.col("peak_mw") != 0, F.col("peak_mw")))
    spread = rows.agg(F.struct(F.min("load_ratio").alias("lo"), F.max("load_ratio").alias("hi"))).scalar()
    rows = rows.withColumn("_spread", spread)
    heat = scale_unit(F.col("load_ratio"), F.col("_spread.lo"), F.col("_spread.hi"))
    return rows.withColumn("heat", heat).drop("_spread")
