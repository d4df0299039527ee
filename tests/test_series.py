"""Bucketed windows against plain windows, on series with gaps, dense days and hot keys."""

import random

import pytest
from conftest import values
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from zoneflow.operators.series import HOUR_US, series_window
from zoneflow.plans import features as feats


def _series(spark, seed):
    rng = random.Random(seed)
    rows = []
    for zone, keep in (("dense", 1.0), ("gappy", 0.4), ("rare", 0.02)):
        for h in range(24 * 200):
            if rng.random() < keep:
                rows.append((zone, h * 3600, float(rng.randrange(1000))))
    # a burst of many rows within hours, and a long hole before it
    rows += [("burst", 7000 * 3600 + i * 7, float(i % 13)) for i in range(3000)]
    rows += [("burst", i * 3600, 1.0) for i in range(20)]
    df = spark.createDataFrame(rows, "zone string, s long, demand_mw double")
    return df.select("zone", F.timestamp_seconds("s").alias("time"), "demand_mw")


@pytest.mark.parametrize("per_bucket", [1, 50, 700, 100_000])
def test_bucketed_equals_plain(spark, per_bucket):
    df = _series(spark, per_bucket)

    def frames(w):
        return {
            "lag": w.lag("demand_mw", 168),
            "lag3": w.lag("demand_mw", 3),
            "lead": w.lead("demand_mw", 72),
            "roll": w.avg_between("demand_mw", 96, 72),
        }

    got = series_window(df, frames, rows_back=168, rows_ahead=72, hours_back=96, rows_per_bucket=per_bucket)
    w = Window.partitionBy("zone").orderBy(F.unix_micros("time"))
    want = df.select(
        "*",
        F.lag("demand_mw", 168).over(w).alias("lag"),
        F.lag("demand_mw", 3).over(w).alias("lag3"),
        F.lead("demand_mw", 72).over(w).alias("lead"),
        F.avg("demand_mw").over(w.rangeBetween(-96 * HOUR_US, -72 * HOUR_US)).alias("roll"),
    )
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_one_window_node_for_all_frames(spark):
    df = _series(spark, 1)
    stg = df.withColumns({"source": F.lit("pjm")})
    plan = feats.load_features(stg, ["dense"])._jdf.queryExecution().sparkPlan().toString()
    bucketed = [line for line in plan.splitlines() if "Window" in line and "_bucket" in line]
    assert len(bucketed) == 1


def test_range_ends_are_inclusive(spark):
    df = spark.range(200).select(
        F.lit("A").alias("zone"), F.timestamp_seconds(F.col("id") * 3600).alias("time"),
        F.lit(1.0).alias("demand_mw"),
    )
    w = Window.partitionBy("zone").orderBy(F.unix_micros("time"))
    n = df.select(
        F.count("*").over(w.rangeBetween(-78 * HOUR_US, -72 * HOUR_US)).alias("six"),
        F.count("*").over(w.rangeBetween(-96 * HOUR_US, -72 * HOUR_US)).alias("day"),
    ).agg(F.max("six"), F.max("day"))
    assert tuple(n.first()) == (7, 25)


def test_labels_shift_within_zone(frame):
    rows = [(z, f"2026-01-01 0{i}:00:00", b * (i + 1)) for z, b in (("A", 10.0), ("B", 100.0)) for i in range(3)]
    got = values(feats.build_labels(frame(rows, "zone string, time timestamp, demand_mw double")))
    assert [r[3] for r in got] == [20.0, 30.0, None, 200.0, 300.0, None]
    assert all(r[4] is None and r[5] is None for r in got)


def test_row_lag_and_time_lag_differ_on_gaps(spark):
    hours = [h for h in range(200) if h != 100]
    rows = [("A", h * 3600, float(h), "pjm") for h in hours]
    df = spark.createDataFrame(rows, "zone string, s long, demand_mw double, source string").withColumn(
        "time", F.timestamp_seconds("s")
    )
    at = {}
    for mode in ("row", "time"):
        out = feats.load_features(df, ["A"], lag_mode=mode)
        at[mode] = {int(r.demand_mw): r.demand_lag_72h for r in out.collect()}
    assert at["row"][150] == 77.0 and at["time"][150] == 78.0
    assert at["row"][172] == 99.0 and at["time"][172] is None
    assert at["row"][199] == at["time"][199] == 127.0
