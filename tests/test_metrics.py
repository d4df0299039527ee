import math

import pytest
from conftest import values
from pyspark.sql import functions as F

from zoneflow.operators import metrics, profile, quality
from zoneflow.plans import model, serve


def test_evaluate_drops_null_labels(spark):
    df = spark.createDataFrame([(100.0, 110.0), (200.0, 190.0), (None, 1.0), (300.0, 310.0)], "y double, p double")
    r = metrics.evaluate(df, "y", "p").first()
    assert (r.rmse, r.mae) == (10.0, 10.0)
    assert r.r2 == pytest.approx(1 - 300 / 20000)


def test_r2_edges(spark):
    def r2(rows):
        return metrics.evaluate(spark.createDataFrame(rows, "y double, p double"), "y", "p").first().r2

    assert r2([(1.0, 1.0), (1.0, 1.0)]) == 1.0
    assert r2([(1.0, 2.0), (1.0, 1.0)]) == 0.0
    assert r2([(1.0, 2.0)]) is None


def test_zone_metrics(spark):
    df = spark.createDataFrame(
        [("A", 100.0, 110.0), ("A", 200.0, 190.0), ("B", 50.0, 60.0), ("B", 150.0, 140.0)],
        "zone string, y double, p double",
    )
    got = {r.zone: (r.mae, r.mape) for r in metrics.zone_metrics(df, "y", "p").collect()}
    assert got["A"] == pytest.approx((10.0, (10 + 5) / 2))
    assert got["B"] == pytest.approx((10.0, (20 + 100 / 15) / 2))


def test_mape_of_zero_actual(spark):
    df = spark.createDataFrame([("A", 0.0, 1.0), ("B", 0.0, 0.0), ("B", 1.0, 2.0)], "zone string, y double, p double")
    got = {r.zone: r.mape for r in metrics.zone_metrics(df, "y", "p").collect()}
    assert math.isinf(got["A"]) and got["B"] == 100.0


def test_system_totals_keep_missing(frame):
    rows = [("2026-01-01 00:00:00", 1, "A", None, 1.0), ("2026-01-01 00:00:00", 1, "B", None, 2.0),
            ("2026-01-01 01:00:00", 1, "A", 5.0, None), ("2026-01-01 01:00:00", 1, "B", None, None)]
    df = frame(rows, "time timestamp, horizon_h int, zone string, actual_mw double, predicted_mw double")
    assert values(metrics.system_totals(df), "actual_mw", "predicted_mw") == [(5.0, 0.0), (None, 3.0)]


def test_split_bounds(frame):
    df = frame([(f"2026-0{m}-01 00:00:00",) for m in (1, 2, 3, 4)], "time timestamp")
    feb, apr = F.lit("2026-02-01").cast("timestamp"), F.lit("2026-04-01").cast("timestamp")
    assert [r[0][:7] for r in values(model.split_by_date(df, feb, apr))] == ["2026-02", "2026-03"]
    assert model.split_by_date(df, None, feb).count() == 1
    assert model.split_by_date(df, apr, None).count() == 1
    assert model.split_by_date(df, None, None).count() == 4
    assert model.split_by_days(df, "2026-02-01", "2026-03-01").count() == 2


@pytest.mark.parametrize(
    ("champion", "challenger", "expected"),
    [
        (None, 100.0, {2: "Production"}),
        (150.0, 100.0, {1: "Archived", 2: "Production"}),
        (50.0, 100.0, {1: "Production", 2: "Staging"}),
        (100.0, 100.0, {1: "Production", 2: "Staging"}),
    ],
)
def test_promotion(spark, champion, challenger, expected):
    schema = "name string, version int, stage string, rmse double"
    rows = [] if champion is None else [("m", 1, "Production", champion)]
    after = model.promote(
        spark.createDataFrame(rows, schema), spark.createDataFrame([("m", 2, "Staging", challenger)], schema)
    )
    assert {r.version: r.stage for r in after.collect()} == expected


def _offsets(df):
    return df.withColumns({f"y_{h}h": F.lit(100.0 + h) for h in (1, 24, 72)})


FEATURES = (
    "time timestamp, zone string, demand_mw double, temperature double, precipitation double, wind_speed double, "
    "cloud_cover double"
)


def test_predictions_null_weather(frame):
    df = frame([("2026-01-01 00:00:00", "AEP", 1.0, 10.0, None, 5.0, 80.0)], FEATURES)
    got = values(serve.predictions(df, _offsets))
    assert got == [("2026-01-01 00:00:00", "AEP", 101.0, 124.0, 172.0, 10.0, None, 5.0, 80.0)]
    assert serve.predictions(df, _offsets, "NOPE").count() == 0


def test_history_alignment(frame):
    rows = [(f"2026-01-01 0{i}:00:00", "AEP", 500.0 + 100 * i, 0.0, 0.0, 0.0, 0.0) for i in range(2)]
    at = F.lit("2026-01-01 02:00:00").cast("timestamp")
    hist = serve.history(frame(rows, FEATURES), _offsets, at, 48, "AEP")
    assert hist.count() == 6
    one = {r[0]: r[1:] for r in values(hist.filter("horizon_h = 1"), "time", "actual_mw", "predicted_mw")}
    assert one == {"2026-01-01 01:00:00": (600.0, 101.0), "2026-01-01 02:00:00": (None, 101.0)}


def test_latest_keeps_nulls_of_the_latest_row(frame):
    rows = [("2026-01-01 00:00:00", "A", 1.0, 9.0, 9.0, 9.0, 9.0), ("2026-01-01 01:00:00", "A", 2.0, None, 1.0, 1.0, 1.0)]
    got = values(serve.latest_features(frame(rows, FEATURES)))
    assert got == [("2026-01-01 01:00:00", "A", 2.0, None, 1.0, 1.0, 1.0)]


def test_freshness(frame):
    df = frame([("2026-01-01 00:00:00", "A", 1.0, 9.0, 9.0, 9.0, 9.0)], FEATURES)
    at = F.lit("2026-01-05 00:00:00").cast("timestamp")
    assert values(serve.freshness(df, at)) == [("2026-01-01 00:00:00", 96.0, True)]
    assert values(serve.freshness(df.filter("false"), at)) == [(None, None, None)]


def test_weather_summary_needs_every_reading(frame):
    df = frame([("2026-01-01 00:00:00", "A", 1.0, 10.0, None, 5.0, 80.0)], FEATURES)
    assert serve.weather_summary(serve.predictions(df, _offsets), "A").count() == 0


def test_freshness_sla(frame):
    df = frame([("2026-01-01 00:00:00",)], "time timestamp")
    status = {}
    for h in (2, 6, 7):
        at = F.lit(f"2026-01-01 0{h}:00:00").cast("timestamp")
        status[h] = quality.freshness(df, "weather", at).first().status
    assert status == {2: "pass", 6: "warn", 7: "error"}
    assert quality.freshness(df.filter("false"), "load", F.lit("2026-01-01").cast("timestamp")).first().status == "error"


def test_mutual_information(spark):
    df = spark.range(4000).select(
        (F.col("id") % 8).cast("double").alias("y"),
        ((F.col("id") % 8) * 2).cast("double").alias("same"),
        (F.floor(F.col("id") / 8) % 5).cast("double").alias("free"),
    )
    got = {r.feature: r.mi for r in profile.binned_mi(df, "y", ["same", "free"]).collect()}
    assert got["same"] == pytest.approx(math.log(8)) and abs(got["free"]) < 1e-9
