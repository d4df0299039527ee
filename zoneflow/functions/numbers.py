"""Guards that keep NaN, division and error terms the same everywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.clock import col


def nan_to_null(c: Column | str) -> Column:
    return F.when(~F.isnan(col(c)), col(c))


def nans_to_null(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every floating column: Spark aggregates skip NULL but spread NaN."""
    floats = [n for n, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({n: nan_to_null(n) for n in floats})


def pct_error(error: Column, actual: Column) -> Column:
    """abs(error / actual); infinity for a miss on a zero actual, NULL for 0/0."""
    return F.when(actual != 0, F.abs(error / F.when(actual != 0, actual))).when(
        error != 0, F.lit(float("inf"))
    )
