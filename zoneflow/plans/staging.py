"""Staging models: projections with the zone rule and the look-back of each source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.schemas import LMP, LOAD, WEATHER


def _since(df: DataFrame, since: Column | None) -> DataFrame:
    return df if since is None else df.filter(F.col("time") >= since)


def stg_load(load: DataFrame, since: Column | None = None) -> DataFrame:
    """All zones: the system total of the second source must survive staging."""
    return _since(load.select(*LOAD.fieldNames()), since)


def stg_lmp(lmp: DataFrame, zones: list[str], since: Column | None = None) -> DataFrame:
    kept = _since(lmp.filter(F.col("zone").isin(zones)), since)
    return kept.select(*LMP.fieldNames()).withColumnRenamed("lmp", "lmp_total")


def stg_weather(weather: DataFrame, zones: list[str], since: Column | None = None) -> DataFrame:
    return _since(weather.filter(F.col("zone").isin(zones)), since).select(*WEATHER.fieldNames())


FIXED_WIDTH = ("double", "float", "bigint", "int", "boolean", "timestamp", "timestamp_ntz", "date")


def _extreme_per_key(df: DataFrame, keys: list[str], order_col: str, top, by) -> DataFrame:
    """The row of each key with the extreme `order_col`, reduced before the shuffle: a key
    with very many rows sends one row per input partition.

    Rows of fixed-width columns are kept column by column, which aggregates by hash; text
    columns need the row as one struct, which aggregates by sort.
    """
    types = dict(df.dtypes)
    rest = [c for c in df.columns if c not in [*keys, order_col]]
    bound = top(order_col).alias(order_col)
    if all(types[c] in FIXED_WIDTH for c in rest):
        picked = df.groupBy(*keys).agg(bound, *[by(c, order_col).alias(c) for c in rest])
    else:
        row = by(F.struct(*rest), F.col(order_col)).alias("_row")
        picked = df.groupBy(*keys).agg(bound, row).select(*keys, order_col, "_row.*")
    return picked.select(*df.columns)


def last_per_key(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """The last row of each key, whole: nulls of a later row win too."""
    return _extreme_per_key(df, keys, order_col, F.max, F.max_by)


def first_per_key(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """Deduplicate by key, keeping the first row in `order_col`."""
    return _extreme_per_key(df, keys, order_col, F.min, F.min_by)
