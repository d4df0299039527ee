"""Training, evaluation, promotion and scoring of one model per horizon."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.functions.calendar import build_features
from zoneflow.functions.clock import minus_days, minus_months
from zoneflow.operators import metrics
from zoneflow.plans.features import build_labels
from zoneflow.schemas import HORIZONS, REGISTRY
from zoneflow.session import materialize
from zoneflow.sources.tables import read_or_empty

TEST_MONTHS = 7
VAL_MONTHS = 12
# columns of the feature table that no model gets
NON_FEATURES = ["time", "demand_mw", "observation_count"]
SPLITS = ["train", "val", "test"]
STAGING, PRODUCTION, ARCHIVED = "Staging", "Production", "Archived"


def feature_columns(columns: list[str]) -> list[str]:
    labels = [f"y_{h}h" for h in HORIZONS]
    return [c for c in columns if c not in [*NON_FEATURES, *labels, "split"]]


def training_frame(features: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Labels first, on the raw series; then features; then rows that have their longest lag."""
    return with_longest_lag(build_features(build_labels(features, index)))


def with_longest_lag(df: DataFrame) -> DataFrame:
    return df.filter(F.col("demand_lag_168h").isNotNull())


def newest_time(features: DataFrame) -> Column:
    """Newest time of the rows that can be used for training, as a scalar subquery. Labels
    drop no rows, so it is read from the table and not from the labelled frame."""
    return with_longest_lag(features).agg(F.max("time")).scalar()


def split_by_date(df: DataFrame, start: Column | None, end: Column | None) -> DataFrame:
    """Rows in [start, end); either end can be open."""
    if start is not None:
        df = df.filter(F.col("time") >= start)
    return df if end is None else df.filter(F.col("time") < end)


def split_by_days(df: DataFrame, first: str, last: str) -> DataFrame:
    """Rows whose calendar day lies in the closed range."""
    return df.filter(F.to_date("time").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def with_split(
    df: DataFrame,
    test_months: int = TEST_MONTHS,
    val_months: int = VAL_MONTHS,
    test_days: int | None = None,
    val_days: int | None = None,
    newest: Column | None = None,
) -> DataFrame:
    """Chronological split counted back from the newest row, as a column in one pass.

    The newest time is a scalar subquery; pass it when `df` is costly to derive. Day lengths
    replace the month lengths when given.
    """
    newest = df.agg(F.max("time")).scalar() if newest is None else newest
    if test_days is not None and val_days is not None:
        test_start = minus_days(newest, test_days)
        val_start = minus_days(newest, test_days + val_days)
    else:
        test_start = minus_months(newest, test_months)
        val_start = minus_months(test_start, val_months)
    t = F.col("time")
    return df.withColumn("split", F.when(t >= test_start, "test").when(t >= val_start, "val").otherwise("train"))


MISSING = "_missing"


def _inputs(df: DataFrame, fit_on: DataFrame) -> tuple[list, list[str]]:
    """Stages that make every input a number, and the vector's columns.

    Trees here take no NULL: a missing value becomes the column's mean over the rows to fit on,
    or 0 where there is none (a feed that is down), and a second column says that it was missing.
    """
    types = dict(df.dtypes)
    numbers = [c for c in feature_columns(df.columns) if c != "zone"]
    doubles = [c for c in numbers if types[c] == "double"]
    means = fit_on.agg(*[F.avg(F.nanvl(F.col(c), F.lit(None).cast("double"))).alias(c) for c in doubles]).first()
    filled = [f"coalesce(nanvl({c}, cast(null as double)), {float(means[c] or 0.0)!r}D) as _{c}" for c in doubles]
    marks = [f"cast({c} is null or isnan({c}) as double) as _{c}{MISSING}" for c in doubles]
    casts = [f"cast({c} as double) as _{c}" for c in numbers if c not in doubles]
    columns = ["_zone", *[f"_{c}" for c in numbers], *[f"_{c}{MISSING}" for c in doubles]]
    return [
        SQLTransformer(statement=f"select *, {', '.join([*filled, *marks, *casts])} from __THIS__"),
        StringIndexer(inputCol="zone", outputCol="_zone", handleInvalid="keep"),
        VectorAssembler(inputCols=columns, outputCol="_inputs"),
    ], columns


def stop_round(errors: list[float], patience: int) -> int:
    """Rounds to keep: up to the best one before `patience` rounds in a row brought no better."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def shortened(fitted: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The model as it was after so many rounds: boosting never changes the trees before."""
    java, gateway = fitted._java_obj, SparkSession.getActiveSession().sparkContext._gateway
    kinds = gateway.jvm.org.apache.spark.ml.regression
    trees = gateway.new_array(kinds.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = java.trees()[i], java.treeWeights()[i]
    short = kinds.GBTRegressionModel(java.uid(), trees, weights)
    short.setFeaturesCol(fitted.getFeaturesCol()).setPredictionCol(fitted.getPredictionCol())
    return GBTRegressionModel(short)


def train_horizon(
    df: DataFrame, horizon: int, max_iter: int = 100, max_depth: int = 5, patience: int = 50
) -> PipelineModel:
    """Gradient-boosted trees on train rows, stopped early on val rows.

    `df` has the `split` column. Fitting ends with the best round before `patience` rounds without
    a lower validation error; the trees of later rounds are left out. Missing inputs are filled and marked; the zone is categorical.
    """
    label = f"y_{horizon}h"
    fit_on = df.filter(F.col(label).isNotNull() & (F.col("split") == "train"))
    val = df.filter(F.col(label).isNotNull() & (F.col("split") == "val"))
    if fit_on.isEmpty():
        raise ValueError(f"no rows to train the {horizon} h model on")
    stages, _ = _inputs(df, fit_on)
    prepared = Pipeline(stages=stages).fit(fit_on)

    names = {"featuresCol": "_inputs", "labelCol": label, "predictionCol": f"pred_{horizon}h"}
    trees = GBTRegressor(**names, maxIter=max_iter, maxDepth=max_depth, maxBins=64, seed=7)
    fitted = trees.fit(prepared.transform(fit_on).select("_inputs", label))
    if not val.isEmpty():
        errors = fitted.evaluateEachIteration(prepared.transform(val).select("_inputs", label), "squared")
        rounds = stop_round(errors, patience)
        if rounds < max_iter:
            fitted = shortened(fitted, rounds)
    return PipelineModel([*prepared.stages, fitted])


def declared_inputs(model: PipelineModel) -> list[str]:
    """The assembled inputs of a trained model, in its order, without the marks of missing ones."""
    names = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    return [n for n in names if not n.endswith(MISSING)]


def score(df: DataFrame, models: dict[int, PipelineModel]) -> DataFrame:
    """One prediction column per horizon, NULL where it has no model; helper columns are dropped."""
    keep = list(df.columns)
    for h in sorted(set(HORIZONS) | set(models)):
        model = models.get(h)
        if model is None:
            df = df.withColumn(f"pred_{h}h", F.lit(None).cast("double"))
            keep.append(f"pred_{h}h")
            continue
        scored = model.transform(df)
        df = scored.select(*keep, f"pred_{h}h")
        keep.append(f"pred_{h}h")
    return df


def model_predictor(models: dict[int, PipelineModel]):
    """Predictor for the read queries: y_{h}h is the forecast."""

    def predict(features: DataFrame) -> DataFrame:
        return score(features, models).withColumnsRenamed({f"pred_{h}h": f"y_{h}h" for h in HORIZONS})

    return predict


def split_metrics(scored: DataFrame, horizon: int) -> DataFrame:
    """RMSE, MAE and R2 of each split."""
    out = metrics.evaluate(scored, f"y_{horizon}h", f"pred_{horizon}h", ["split"])
    return out.select(F.lit(horizon).alias("horizon_h"), "split", "rmse", "mae", "r2")


def zone_report(scored: DataFrame, horizon: int) -> DataFrame:
    """MAE and MAPE of each zone over the test rows."""
    test = scored.filter(F.col("split") == "test")
    out = metrics.zone_metrics(test, f"y_{horizon}h", f"pred_{horizon}h")
    return out.select(F.lit(horizon).alias("horizon_h"), "zone", "mae", "mape")


def run_record(df: DataFrame, featureset: str, source: str, run_at: Column) -> DataFrame:
    """One row that describes the training data of a run: size and date range per split."""
    ranges = []
    for s in SPLITS:
        mine = F.col("split") == s
        day = F.when(mine, F.to_date("time"))
        ranges += [F.min(day).alias(f"{s}_first"), F.max(day).alias(f"{s}_last"), F.count_if(mine).alias(f"{s}_rows")]
    described = df.agg(F.count("*").alias("row_count"), *ranges)
    return described.select(
        F.lit(featureset).alias("featureset"), F.lit(source).alias("source_table"), run_at.alias("run_at"), "*"
    )


def champions(registry: DataFrame) -> DataFrame:
    """The model in production per name: the highest version there."""
    live = registry.filter(F.col("stage") == PRODUCTION)
    return live.groupBy("name").agg(F.max_by("rmse", "version").alias("champion_rmse"))


def promote(registry: DataFrame, candidates: DataFrame) -> DataFrame:
    """The registry after `candidates` challenge it, one candidate per name.

    A candidate goes to production when the name has no model there or its RMSE is strictly
    lower; the ones it replaces are archived. Otherwise it stays in staging.
    """
    judged = candidates.join(champions(registry), "name", "left")
    wins = F.col("champion_rmse").isNull() | (F.col("rmse") < F.col("champion_rmse"))
    judged = judged.withColumn("stage", F.when(wins, PRODUCTION).otherwise(STAGING)).drop("champion_rmse")
    won = judged.filter(F.col("stage") == PRODUCTION).select("name", F.lit(True).alias("_replaced"))
    kept = registry.join(won, "name", "left").withColumn(
        "stage",
        F.when((F.col("stage") == PRODUCTION) & F.col("_replaced"), ARCHIVED).otherwise(F.col("stage")),
    )
    return kept.drop("_replaced").unionByName(judged.select(*registry.columns))


class Registry:
    """Model registry as a small append-only folder of versions of one table."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def read(self) -> DataFrame:
        """The table of the newest state; empty before the first model."""
        versioned = T.StructType([*REGISTRY.fields, T.StructField("state", T.IntegerType())])
        states = read_or_empty(self.spark, f"{self.root}/registry", versioned)
        newest = states.agg(F.max("state")).first()[0]
        if newest is None:
            return self.spark.createDataFrame([], REGISTRY)
        return states.filter(F.col("state") == newest).drop("state")

    def challenge(self, models: dict[int, PipelineModel], rmse: dict[int, float], at: dt.datetime) -> DataFrame:
        """Save the models, register a version of each, promote the better ones."""
        current = self.read()
        versions = {r["name"]: r["v"] for r in current.groupBy("name").agg(F.max("version").alias("v")).collect()}
        rows = []
        for h, model in models.items():
            name = model_name(h)
            version = versions.get(name, 0) + 1
            path = f"{self.root}/models/{name}/{version}"
            model.write().overwrite().save(path)
            rows.append((name, version, STAGING, float(rmse[h]), path, at))
        candidates = self.spark.createDataFrame(rows, REGISTRY)
        state = sum(versions.values()) + len(rows)
        after = promote(current, candidates).coalesce(1)
        after.write.mode("overwrite").parquet(f"{self.root}/registry/state={state}")
        return self.read()

    def load_models(self, stage: str = PRODUCTION) -> dict[int, PipelineModel]:
        """The newest model of each horizon in the stage."""
        at_stage = self.read().filter(F.col("stage") == stage)
        newest = at_stage.groupBy("name").agg(F.max_by("model_path", "version").alias("path")).collect()
        paths = {r["name"]: r["path"] for r in newest}
        return {h: PipelineModel.load(paths[model_name(h)]) for h in HORIZONS if model_name(h) in paths}


def model_name(horizon: int) -> str:
    return f"demand-gbt-{horizon}h"


def train_all(
    frame: DataFrame, horizons: tuple[int, ...] = HORIZONS, **options
) -> tuple[dict[int, PipelineModel], DataFrame]:
    """Train every horizon that has rows, on a split frame; returns the models and their split metrics.

    `frame` is read once per boosting round, so pass a written table.
    """
    sizes = frame.filter("split = 'train'").agg(*[F.count(f"y_{h}h").alias(f"n{h}") for h in horizons]).first()
    models = {h: train_horizon(frame, h, **options) for h in horizons if sizes[f"n{h}"]}
    scored = score(frame, models)
    return models, reduce(DataFrame.unionByName, [split_metrics(scored, h) for h in horizons])


def training_run(
    spark: SparkSession, features: DataFrame, root: str, at: dt.datetime, featureset: str = "v1",
    source: str = "features", options: dict | None = None, **lengths,
) -> dict[str, DataFrame]:
    """Labels, features, split, fits, metrics, registration and promotion in one go.

    Writes under `root`: the registry with its models, and for this run its row of `runs` (sizes
    and dates of the splits), `run_metrics` (a row for each horizon and split) and `run_zones`
    (a row for each horizon and zone). Returns these three frames and the registry.
    """
    table = materialize(features, "features")
    frame = materialize(with_split(training_frame(table), newest=newest_time(table), **lengths), "training")
    models, by_split = train_all(frame, **(options or {}))
    scored = materialize(score(frame, models), "scored")
    stamp = F.lit(at.isoformat()).cast("timestamp")
    run = at.strftime("%Y%m%dT%H%M%S")
    out = {
        "runs": run_record(frame, featureset, source, stamp),
        "run_metrics": by_split,
        "run_zones": reduce(DataFrame.unionByName, [zone_report(scored, h) for h in HORIZONS]),
    }
    for name, df in out.items():
        path = f"{root}/{name}/run={run}"
        df.write.mode("overwrite").parquet(path)
        out[name] = spark.read.schema(df.schema).parquet(path)
    tests = {r.horizon_h: r.rmse for r in out["run_metrics"].filter("split = 'test' and rmse is not null").collect()}
    able = {h: m for h, m in models.items() if h in tests}
    return out | {"registry": Registry(spark, root).challenge(able, tests, at)}
