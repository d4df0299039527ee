"""Data-quality checks as frames of (check, column, failures)."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.clock import age_hours
from zoneflow.operators.merge import union_all

EXPECTED_POLLS = 3
# Hours of age at which a source is stale (warn, error).
FRESHNESS_SLA = {"load": (6, 24), "lmp": (6, 24), "weather": (2, 6)}


def row_checks(
    df: DataFrame, not_null: Iterable[str] = (), accepted: dict[str, list[str]] | None = None
) -> DataFrame:
    """Every check that looks at one row at a time, in one pass over the table. NULL is not
    a value outside an accepted list."""
    checks = [("not_null", c, F.col(c).isNull()) for c in not_null]
    checks += [("accepted_values", c, ~F.col(c).isin(v)) for c, v in (accepted or {}).items()]
    counts = df.agg(*[F.count_if(bad).alias(f"n{i}") for i, (_, _, bad) in enumerate(checks)])
    rows = [
        F.struct(F.lit(k).alias("check_name"), F.lit(c).alias("column_name"), F.col(f"n{i}").alias("failures"))
        for i, (k, c, _) in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def null_audit(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """NULLs per column."""
    return row_checks(df, columns or df.columns)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def _count_as(df: DataFrame, check: str, column: str) -> DataFrame:
    return df.agg(F.count("*").alias("failures")).select(
        F.lit(check).alias("check_name"), F.lit(column).alias("column_name"), "failures"
    )


def unique_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return _count_as(duplicate_keys(df, keys), "unique", ",".join(keys))


def outside_values(df: DataFrame, column: str, accepted: list[str]) -> DataFrame:
    """Distinct values outside the accepted list, with their row counts; NULL is not a value."""
    return df.filter(~F.col(column).isin(accepted)).groupBy(column).agg(F.count("*").alias("n"))


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Values without a parent, with their row counts. Rows are counted per value before the
    join, so a value that most rows share is one row by then."""
    used = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return used.join(parent.select(F.col(parent_column).alias(column)).distinct(), column, "left_anti")


def relationship(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    lost = orphans(df, column, parent, parent_column).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))
    return lost.select(F.lit("relationship").alias("check_name"), F.lit(column).alias("column_name"), "failures")


def key_mismatch(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys held by one side only."""
    a = left.select(key).distinct().withColumn("in_left", F.lit(True))
    b = right.select(key).distinct().withColumn("in_right", F.lit(True))
    both = a.join(b, key, "full_outer")
    held = {c: F.coalesce(F.col(c), F.lit(False)) for c in ("in_left", "in_right")}
    return both.withColumns(held).filter(~(F.col("in_left") & F.col("in_right")))


def freshness(df: DataFrame, source: str, as_of: Column, sla: tuple[float, float] | None = None) -> DataFrame:
    """Age of the newest row against the source's SLA; an empty source is an error."""
    warn, error = sla or FRESHNESS_SLA[source]
    last = df.agg(F.max("time").alias("latest_time")).withColumn("age_hours", age_hours("latest_time", as_of))
    age = F.col("age_hours")
    status = F.when(age <= warn, "pass").when(age <= error, "warn").otherwise("error")
    return last.select(F.lit(source).alias("source"), "latest_time", "age_hours", status.alias("status"))


def sparse_hours(weather_features: DataFrame, expected: int = EXPECTED_POLLS) -> DataFrame:
    return weather_features.filter(F.col("observation_count") < expected)


def report(checks: list[DataFrame]) -> DataFrame:
    return union_all(*checks)


@dataclass(frozen=True)
class TableTests:
    """What has to hold for one table. `parents`: column to (table, column) that has all its values."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: dict[str, list[str]] = field(default_factory=dict)
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)


def contract_report(tables: dict[str, DataFrame], contract: dict[str, TableTests]) -> DataFrame:
    """(table_name, check_name, column_name, failures) of every declared test. All checks on single
    rows are one pass over a table; a key and a parent are one more each."""
    out = []
    for name, tests in contract.items():
        df = tables[name]
        checks = [row_checks(df, tests.not_null, tests.accepted)] if tests.not_null or tests.accepted else []
        if tests.unique:
            checks.append(unique_keys(df, list(tests.unique)))
        checks += [relationship(df, c, tables[t], p) for c, (t, p) in tests.parents.items()]
        out += [c.select(F.lit(name).alias("table_name"), "*") for c in checks]
    return report(out)
