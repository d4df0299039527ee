"""Profiles of a table: counts, value frequencies, correlation, mutual information."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def source_profile(load: DataFrame) -> DataFrame:
    return load.groupBy("source").agg(
        F.count("*").alias("n_rows"), F.count_distinct("zone").alias("n_zones")
    )


def run_profile(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("zone").alias("n_zones"),
        F.min("time").alias("first_time"),
        F.max("time").alias("last_time"),
        F.count_if(~F.col("is_verified")).alias("n_unverified"),
    )


def value_counts(df: DataFrame, column: str, keep_null: bool = True) -> DataFrame:
    kept = df if keep_null else df.filter(F.col(column).isNotNull())
    return kept.groupBy(column).agg(F.count("*").alias("n"))


def distinct_zones(df: DataFrame, column: str = "zone") -> DataFrame:
    return df.select(column).distinct()


def correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every column pair over the rows where both are known.

    All pairs are moments of one aggregate, merged from partial results: one pass, one row
    per partition shuffled.
    """
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = [
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"c{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
    ]
    return wide.select(F.inline(F.array(*rows)))


def binned_mi(
    df: DataFrame, target: str, numeric: list[str], discrete: list[str] | None = None, bins: int = 8
) -> DataFrame:
    """Mutual information (nats) of each feature with the target, over equal-width bins.

    The ranges are one scalar subquery. The joint counts are reduced before the shuffle to
    at most features x bins x bins rows per partition; all else runs on that small table.
    """
    discrete = discrete or []
    ranged = [target, *numeric]
    bounds = [F.min(c).alias(f"lo_{c}") for c in ranged] + [F.max(c).alias(f"hi_{c}") for c in ranged]
    # one column, so that the plan holds the subquery once and not per use
    bounded = df.withColumn("_b", df.agg(F.struct(*bounds)).scalar())

    def binned(c: str):
        low, high = F.col(f"_b.lo_{c}"), F.col(f"_b.hi_{c}")
        share = (F.col(c) - low) / F.when(high > low, high - low)
        code = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * bins), F.lit(bins - 1))
        return F.when(F.col(c).isNotNull(), code.cast("string")).alias(c)

    coded = bounded.select(
        *[binned(c) for c in ranged], *[F.col(c).cast("string").alias(c) for c in discrete]
    )
    long = coded.unpivot([target], [*numeric, *discrete], "feature", "bin").na.drop("any")
    joint = long.groupBy("feature", "bin", target).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("feature"))
    by_bin = F.sum("n").over(Window.partitionBy("feature", "bin"))
    by_target = F.sum("n").over(Window.partitionBy("feature", target))
    terms = joint.select(
        "feature", ((F.col("n") / total) * F.ln(F.col("n") * total / (by_bin * by_target))).alias("term")
    )
    return terms.groupBy("feature").agg(F.sum("term").alias("mi"))


def information_ranking(mi: DataFrame) -> DataFrame:
    """Features by what they say about the target, most first; equal ones by name."""
    return mi.orderBy(F.desc("mi"), "feature")
