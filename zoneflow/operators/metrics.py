"""Forecast error metrics. Each is one pass with map-side partial aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.numbers import pct_error
from zoneflow.schemas import SYSTEM_ZONE


def _error_terms(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    kept = df.filter(F.col(actual).isNotNull())
    return kept.withColumn("_e", F.col(predicted) - F.col(actual))


def r2(actual: Column, error: Column) -> Column:
    """1 - SSres / SStot. The total is a central moment, which does not cancel the way a
    difference of raw sums does."""
    ss_res = F.sum(error * error)
    ss_tot = F.var_pop(actual) * F.count(actual)
    fit = F.when(ss_tot > 0, 1 - ss_res / F.when(ss_tot > 0, ss_tot))
    flat = F.when(ss_res == 0, 1.0).otherwise(0.0)
    return F.when(F.count(actual) >= 2, F.coalesce(fit, flat))


def evaluate(df: DataFrame, actual: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    """RMSE, MAE and R2; rows without an actual drop."""
    scored = _error_terms(df, actual, predicted)
    e = F.col("_e")
    return scored.groupBy(*(by or [])).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), r2(F.col(actual), e).alias("r2")
    )


def error_rates(df: DataFrame, actual: str, predicted: str, *by: str) -> DataFrame:
    """MAE and MAPE (percent) per group."""
    scored = _error_terms(df, actual, predicted)
    e = F.col("_e")
    return scored.groupBy(*by).agg(
        F.avg(F.abs(e)).alias("mae"), (F.avg(pct_error(e, F.col(actual))) * 100).alias("mape")
    )


def zone_metrics(df: DataFrame, actual: str, predicted: str, *by: str) -> DataFrame:
    return error_rates(df, actual, predicted, *by, "zone")


def accuracy_stats(history: DataFrame) -> DataFrame:
    return error_rates(history, "actual_mw", "predicted_mw", "horizon_h")


def system_totals(history: DataFrame) -> DataFrame:
    """All zones per hour and horizon. The actual stays NULL while every zone's is missing;
    the prediction sums to 0 then."""
    return (
        history.groupBy("time", "horizon_h")
        .agg(
            F.sum("actual_mw").alias("actual_mw"),
            F.coalesce(F.sum("predicted_mw"), F.lit(0.0)).alias("predicted_mw"),
        )
        .withColumn("zone", F.lit(SYSTEM_ZONE))
    )
