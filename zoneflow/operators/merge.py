"""Keyed merges as lazy frames. A writer in `sources.tables` applies them to a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.plans.staging import last_per_key


def incremental_merge(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Delete the target rows whose key is in `new`, then insert `new`. Keys absent from
    `new` stay; several rows of one key inside `new` all stay.

    The keys are reduced before they are shuffled for the join.
    """
    return target.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def keyed_upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str],
    order_col: str | None = None,
    update_cols: list[str] | None = None,
) -> DataFrame:
    """Insert or replace by key; within the batch the row with the highest `order_col` wins.

    With `update_cols` an existing row keeps its other columns. The replacement is whole:
    a NULL in the batch overwrites a value.
    """
    columns = target.columns
    if order_col:
        batch = last_per_key(batch, keys, order_col)
    batch = batch.select(*columns)
    if update_cols is None:
        return incremental_merge(target, batch, keys)
    values = [c for c in columns if c not in keys]
    old = target.select(*keys, F.struct(*values).alias("_old"))
    new = batch.select(*keys, F.struct(*values).alias("_new"))

    def pick(c: str):
        fresh = F.col("_new").isNotNull() if c in update_cols else F.col("_old").isNull()
        return F.when(fresh, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c)

    joined = old.join(new, keys, "full_outer")
    return joined.select(*[c if c in keys else pick(c) for c in columns])


def replace_zones(target: DataFrame, new: DataFrame, zones: list[str]) -> DataFrame:
    """Delete every row of the listed zones, insert `new`: a filter and a union, no join."""
    kept = target.filter(F.col("zone").isNull() | ~F.col("zone").isin(zones))
    return kept.unionByName(new.select(*target.columns))


def absent_hours(target: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidate rows whose (zone, hour) the target does not hold yet.

    The target is not updated in between: two candidates of one absent hour both stay.
    """
    hours = target.select("zone", F.date_trunc("hour", "time").alias("_hour")).distinct()
    return (
        candidates.withColumn("_hour", F.date_trunc("hour", "time"))
        .join(hours, ["zone", "_hour"], "left_anti")
        .drop("_hour")
    )


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def fill_from(
    df: DataFrame, first: DataFrame, second: DataFrame, key: str, value: str
) -> DataFrame:
    """Attach `value` from `first`, where missing from `second`; drop rows found in neither."""
    a = first.select(key, F.col(value).alias("_first"))
    b = second.select(key, F.col(value).alias("_second"))
    joined = df.join(a, key, "left").join(b, key, "left")
    filled = joined.withColumn(value, F.coalesce("_first", "_second")).drop("_first", "_second")
    return filled.filter(F.col(value).isNotNull())
