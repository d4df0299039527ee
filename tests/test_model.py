import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import functions as F

from zoneflow.operators import stations
from zoneflow.plans import features as feats
from zoneflow.plans import model, serve


@pytest.fixture(scope="module")
def table(spark):
    """Forty days of two zones whose demand follows the hour and the temperature."""
    h = F.col("id")
    base = spark.range(24 * 40).select(
        F.explode(F.array(F.lit("A"), F.lit("B"))).alias("zone"), F.timestamp_seconds(h * 3600 + 1_767_225_600).alias("time"),
        (F.sin(h / 24 * 6.2832) * 100 + 500 + (h * 7919 % 13)).alias("demand_mw"),
        (F.cos(h / 24 * 6.2832) * 10 + 10).alias("temperature"),
    )
    out = feats.load_features(base.withColumn("source", F.lit("pjm")), ["A", "B"])
    out = out.join(base.select("zone", "time", "temperature"), ["zone", "time"])
    rest = ["lmp_total_lag_48h", "congestion_price_lag_48h", "marginal_loss_price_lag_48h", "precipitation", "wind_speed", "cloud_cover"]
    return out.withColumns({c: F.hour("time").cast("double") for c in rest} | {"observation_count": F.lit(3).cast("long")}).cache()


def test_model_inputs(table):
    cols = model.feature_columns(model.training_frame(table).columns)
    assert len(cols) == 21 and not {"time", "demand_mw", "observation_count", "y_1h"} & set(cols)


def test_a_shortened_model_is_the_one_fitted_that_far(spark):
    rows = [(Vectors.dense(float(i % 7), float(i * 13 % 11)), float(i % 7 * 3 + i * 13 % 11 + i % 3)) for i in range(200)]
    df = spark.createDataFrame(rows, ["x", "y"])
    fit = lambda rounds: GBTRegressor(featuresCol="x", labelCol="y", predictionCol="p", maxIter=rounds, maxDepth=3, seed=7).fit(df)
    short, again = model.shortened(fit(9), 4), fit(4)
    splits = lambda m: [t.toDebugString.split("\n", 1)[1] for t in m.trees]
    assert splits(short) == splits(again) and short.treeWeights == again.treeWeights
    assert [r.p for r in short.transform(df).collect()] == [r.p for r in again.transform(df).collect()]


def test_a_shortened_model_can_be_stored(spark, tmp_path):
    df = spark.createDataFrame([(Vectors.dense(float(i)), float(i * i)) for i in range(50)], ["x", "y"])
    short = model.shortened(GBTRegressor(featuresCol="x", labelCol="y", maxIter=5, seed=7).fit(df), 2)
    PipelineModel([short]).write().overwrite().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    assert [r.prediction for r in back.transform(df).collect()] == [r.prediction for r in short.transform(df).collect()]


def test_train_register_promote_predict(spark, table, tmp_path):
    frame = model.with_split(model.training_frame(table), test_days=7, val_days=7).cache()
    models, report = model.train_all(frame, max_iter=5, max_depth=3)
    assert model.declared_inputs(models[1])[0] == "_zone" and len(model.declared_inputs(models[1])) == 21
    rows = {(r.horizon_h, r.split): r for r in report.collect()}
    assert set(rows) == {(h, s) for h in (1, 24, 72) for s in model.SPLITS}
    assert rows[1, "test"].r2 > 0.8

    registry = model.Registry(spark, str(tmp_path))
    rmse = {h: rows[h, "test"].rmse for h in models}
    at = dt.datetime(2026, 3, 1)
    registry.challenge(models, rmse, at)
    after = registry.challenge(models, {1: rmse[1] / 2, 24: rmse[24], 72: rmse[72] * 2}, at)
    stages = {(r.name, r.version): r.stage for r in after.collect()}
    assert stages["demand-gbt-1h", 1] == "Archived" and stages["demand-gbt-1h", 2] == "Production"
    assert stages["demand-gbt-24h", 1] == "Production" and stages["demand-gbt-24h", 2] == "Staging"
    assert stages["demand-gbt-72h", 1] == "Production"

    loaded = registry.load_models()
    preds = serve.predictions(table, model.model_predictor(loaded))
    assert preds.columns == ["time", "zone", "y_1h", "y_24h", "y_72h", "temperature", "precipitation", "wind_speed", "cloud_cover"]
    assert all(300 < r.y_1h < 700 for r in preds.collect()) and preds.count() == 2


def _two_regressions(rows):
    """Partial R2 from Spark's own fits, with and without the degree hours."""
    rows = rows.withColumns({"hour": F.hour("time").cast("string"), "dow": F.weekday("time").cast("string")})
    coded = [StringIndexer(inputCol=c, outputCol=f"{c}_i") for c in ("hour", "dow")]
    hot = OneHotEncoder(inputCols=["hour_i", "dow_i"], outputCols=["hour_v", "dow_v"])
    fits = []
    for inputs in (["hour_v", "dow_v"], ["hour_v", "dow_v", "c", "h"]):
        stages = [*coded, hot, VectorAssembler(inputCols=inputs, outputCol="x"), LinearRegression(featuresCol="x", labelCol="y", solver="normal", standardization=False)]
        fits.append(Pipeline(stages=stages).fit(rows).stages[-1].summary.r2)
    return (fits[1] - fits[0]) / (1 - fits[0])


def test_subset_scores_equal_row_level_regression(spark):
    rng = np.random.default_rng(3)
    hours = pd.date_range("2026-01-01", periods=24 * 30, freq="h")
    temps = pd.concat(
        pd.DataFrame({"zone": "A", "city": c, "time": hours, "temperature": 15 + 12 * rng.standard_normal(len(hours))})
        for c in ("x", "y", "z")
    )
    temps = temps[rng.random(len(temps)) > 0.1]
    load = pd.DataFrame({"zone": "A", "time": hours, "demand_mw": 1000 + 50 * rng.standard_normal(len(hours)) + np.arange(len(hours)) % 24})
    t = spark.createDataFrame(temps)
    l = spark.createDataFrame(load)
    dim = t.select("zone", "city").distinct()
    scores = {r.stations: r for r in stations.score_subsets(t, l, dim).collect()}
    assert len(scores) == 7 and scores["x + z"].n == 2
    rows = stations.subset_observations(t, l, dim).cache()
    for name in scores:
        assert scores[name].partial_r2 == pytest.approx(_two_regressions(rows.filter(F.col("stations") == name)), abs=1e-6), name
    best = stations.best_subsets(stations.score_subsets(t, l, dim)).first()
    single = max((r for r in scores.values() if r.n == 1), key=lambda r: r.partial_r2)
    assert best.best_single == single.stations and best.gain == pytest.approx(best.composite_r2 - best.single_r2)


def test_a_zone_with_many_stations_is_refused(spark):
    many = spark.range(stations.MOST_STATIONS + 1).select(F.lit("A").alias("zone"), F.col("id").cast("string").alias("city"))
    assert stations.station_subsets(many.limit(stations.MOST_STATIONS)).count() == 2**stations.MOST_STATIONS - 1
    with pytest.raises(Exception, match="zone A has over"):
        stations.station_subsets(many).collect()


def test_stop_round():
    assert model.stop_round([5, 4, 3, 3.5, 3.4, 2], 2) == 3
    assert model.stop_round([5, 4, 3, 3.5, 3.4, 2], 3) == 6
    assert model.stop_round([1], 5) == 1


def test_training_run_with_a_dead_price_feed(spark, table, tmp_path):
    """One operation from features to the registry; a column that is wholly NULL, and gaps in another."""
    gaps = table.withColumns({"lmp_total_lag_48h": F.lit(None).cast("double"), "temperature": F.when(F.hour("time") != 5, F.col("temperature"))})
    out = model.training_run(spark, gaps, str(tmp_path), dt.datetime(2026, 3, 1), options={"max_iter": 4, "max_depth": 3}, test_days=7, val_days=7)
    run = out["runs"].first()
    frame = model.with_split(model.training_frame(gaps), test_days=7, val_days=7)
    sizes = {r.split: r.n for r in frame.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert (run.train_rows, run.val_rows, run.test_rows) == tuple(sizes[s] for s in model.SPLITS) and run.row_count == sum(sizes.values())
    assert {(r.horizon_h, r.split) for r in out["run_metrics"].collect()} == {(h, s) for h in (1, 24, 72) for s in model.SPLITS}
    assert {(r.horizon_h, r.zone) for r in out["run_zones"].collect()} == {(h, z) for h in (1, 24, 72) for z in "AB"}
    assert {r.stage for r in out["registry"].collect()} == {"Production"} and out["registry"].count() == 3
    again = model.training_run(spark, gaps, str(tmp_path), dt.datetime(2026, 3, 2), options={"max_iter": 4, "max_depth": 3}, test_days=7, val_days=7)
    assert again["registry"].count() == 6
    loaded = model.Registry(spark, str(tmp_path)).load_models()
    preds = serve.predictions(gaps, model.model_predictor(loaded))
    assert preds.count() == 2 and preds.where("y_1h is null or y_24h is null or y_72h is null").count() == 0


def test_no_rows_to_train_on(spark, table):
    frame = model.with_split(model.training_frame(table), test_days=700, val_days=7)
    models, report = model.train_all(frame)
    assert models == {} and report.where("rmse is not null").count() == 0
    preds = serve.predictions(table, model.model_predictor(models))
    assert preds.count() == 2 and preds.where("y_1h is null").count() == 2
