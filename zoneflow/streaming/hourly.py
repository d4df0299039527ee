"""Streaming twin of the hourly weather model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.functions.clock import plus_hours
from zoneflow.schemas import WEATHER_COLS
from zoneflow.sources import tables
from zoneflow.streaming import ingest


def hourly_weather(readings: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Tumbling hours labelled by their end. State is one row per open (zone, hour); the
    watermark closes an hour `lateness` after it ended, and drops it from the state."""
    return (
        readings.withWatermark("time", lateness)
        .groupBy(F.window("time", "1 hour").alias("w"), "zone")
        .agg(*[F.avg(c).alias(c) for c in WEATHER_COLS], F.count("*").alias("observation_count"))
        .select(F.col("w.end").alias("time"), "zone", *WEATHER_COLS, "observation_count")
    )


def append_closed_hours(hourly: DataFrame, path: str, checkpoint: str) -> None:
    """Write each hour once, when it closes. The file sink's own log makes that exact."""
    query = (
        hourly.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


#: Sums and counts of an hour, in the table that open hours are kept in.
_KEY = ["time", "zone"]
_SUMS = [f"{c}_{kind}" for c in WEATHER_COLS for kind in ("sum", "n")]
SUMS = T.StructType(
    [T.StructField("time", T.TimestampType()), T.StructField("zone", T.StringType())]
    + [T.StructField(c, T.LongType() if c.endswith("_n") else T.DoubleType()) for c in _SUMS]
    + [T.StructField("observation_count", T.LongType()), T.StructField("runs", T.MapType(T.StringType(), T.LongType()))]
)


def upsert_open_hours(readings: DataFrame, path: str, checkpoint: str) -> None:
    """Every hour, closed or not: each micro-batch adds its sums to those of its hours.

    An hour remembers the last batch of a run that it took, so a batch that is taken again
    adds nothing.
    """
    spark = readings.sparkSession
    run = ingest.run_id(spark, checkpoint)

    def each(batch: DataFrame, batch_id: int) -> None:
        hour = plus_hours(F.date_trunc("hour", "time"), 1)
        sums = [f(c).alias(f"{c}_{kind}") for c in WEATHER_COLS for kind, f in (("sum", F.sum), ("n", F.count))]
        marks = F.create_map(F.lit(run), F.lit(batch_id).cast("long"))
        new = batch.groupBy(hour.alias("time"), "zone").agg(*sums, F.count("*").alias("observation_count"))
        tables.rewrite_dates(batch.sparkSession, path, SUMS, new.withColumn("runs", marks), _added)

    def _added(old: DataFrame, new: DataFrame) -> DataFrame:
        a, b = (df.select(*_KEY, F.struct(*SUMS.fieldNames()[2:]).alias(n)) for df, n in ((old, "_old"), (new, "_new")))
        both = a.join(b, _KEY, "full_outer")
        seen = F.coalesce(F.col("_old.runs")[run] >= F.col("_new.runs")[run], F.lit(False))
        take = F.when(~seen, F.col("_new"))
        total = lambda c: F.when(F.col(f"_old.{c}").isNotNull() | take[c].isNotNull(), F.coalesce(F.col(f"_old.{c}"), F.lit(0)) + F.coalesce(take[c], F.lit(0)))
        kept = F.map_filter(F.coalesce(F.col("_old.runs"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))), lambda k, v: k != run)
        marks = F.when(F.col("_new").isNull() | seen, F.col("_old.runs")).otherwise(F.map_concat(kept, F.col("_new.runs")))
        return both.select(*_KEY, *[total(c).alias(c) for c in [*_SUMS, "observation_count"]], marks.alias("runs"))

    query = readings.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def read_hours(spark: SparkSession, path: str) -> DataFrame:
    """The hourly model's rows from the table of sums."""
    rows = tables.read_table(spark, path, SUMS)
    means = [(F.col(f"{c}_sum") / F.col(f"{c}_n")).alias(c) for c in WEATHER_COLS]
    return rows.select(*_KEY, *means, "observation_count")
