"""Domain views over the driver's tables: event types play zones, users play sub-areas.

Measures are scaled to whole numbers so that averages do not depend on summation order.
Every view is a lazy transform of one table, so its work grows with that table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.functions.clock import hour_ending, hour_start
from zoneflow.functions.codec import encode_messages
from zoneflow.plans import staging
from zoneflow.schemas import LMP, LOAD, MESSAGE, WEATHER
from zoneflow.streaming import shaping

ZONES = ["click", "purchase", "signup", "view"]
OUT_OF_SCOPE = "error"
AS_OF = "2024-01-31 00:00:00"


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


_schemas: dict[str, T.StructType] = {}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as stored. Its footer is read for the schema once, not per use."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with its naive timestamps taken as UTC."""
    df = raw(spark, sf_dir, name)
    naive = [n for n, t in df.dtypes if t == "timestamp_ntz"]
    return df.withColumns({n: F.col(n).cast("timestamp") for n in naive}) if naive else df


def naive(df: DataFrame) -> DataFrame:
    """UTC timestamps back to naive ones, the type the oracle returns."""
    stamps = [n for n, t in df.dtypes if t == "timestamp"]
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in stamps}) if stamps else df


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def load_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metered load per sub-area, under the column names of the metered feed."""
    return events(spark, sf_dir).select(
        hour_ending("ts").alias("Interval End"),
        F.col("event_type").alias("Zone"),
        (F.col("user_id") % 4).alias("Load Area"),
        F.round(F.col("value") * 100).alias("MW"),
        (F.col("event_id") % 7 != 0).alias("Is Verified"),
    )


def eia_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """System load per hour, under the column names of the grid monitor feed."""
    hourly = load_areas(spark, sf_dir).groupBy("Interval End").agg(F.sum("MW").alias("Load"))
    return hourly.select(
        "Interval End",
        "Load",
        (F.col("Load") + 1000).alias("Load Forecast"),
        (F.col("Load") - 1000).alias("Net Generation"),
        F.lit(-500.0).alias("Total Interchange"),
    )


def load_pjm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.pjm_load(load_areas(spark, sf_dir), ZONES + [OUT_OF_SCOPE])


def load_eia(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.eia_load(eia_raw(spark, sf_dir))


def load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_pjm(spark, sf_dir).unionByName(load_eia(spark, sf_dir))


def lmp_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price rows in offset order, several per (time, pnode_id)."""
    return events(spark, sf_dir).select(
        F.col("event_id").alias("offset"),
        hour_ending("ts").alias("time"),
        F.concat_ws("-", "event_type", (F.col("user_id") % 4).cast("string")).alias("pnode_id"),
        F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("node "), "event_type")).alias("pnode_name"),
        F.col("event_type").alias("zone"),
        F.round(F.col("value") * 100).alias("lmp"),
        (F.col("user_id") % 40).cast("double").alias("congestion_price"),
        (F.col("event_id") % 10).cast("double").alias("marginal_loss_price"),
    )


def lmp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.last_per_key(lmp_messages(spark, sf_dir), ["time", "pnode_id"], "offset")


def lmp_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices under the column names of the price feed, located by short name."""
    return lmp_messages(spark, sf_dir).select(
        F.col("time").alias("Interval End"),
        F.col("offset").alias("Location Id"),
        F.concat(F.lit("node "), "pnode_id").alias("Location Name"),
        F.upper(F.substring("zone", 1, 3)).alias("Location Short Name"),
        F.col("lmp").alias("LMP"),
        F.col("congestion_price").alias("Congestion"),
        F.col("marginal_loss_price").alias("Loss"),
    )


# Zone -> short name in lmp_raw; the out-of-scope zone has none.
ZONE_LOCATION = {"click": "CLI", "purchase": "PUR", "signup": "SIG", "view": "VIE"}


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    return events(spark, sf_dir).select(
        F.col("ts").alias("time"),
        F.col("event_type").alias("zone"),
        (k - 20).cast("double").alias("temperature"),
        (F.col("event_id") % 10).cast("double").alias("precipitation"),
        (F.col("user_id") % 40).cast("double").alias("wind_speed"),
        k.cast("double").alias("cloud_cover"),
    )


def station_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station readings, one poll per 20 minutes."""
    minute = F.minute("ts")
    return events(spark, sf_dir).select(
        (hour_start("ts") + F.make_dt_interval(F.lit(0), F.lit(0), minute - minute % 20)).alias("poll"),
        F.col("event_type").alias("zone"),
        (F.col("user_id") % 3).alias("station"),
        F.unix_seconds("ts").alias("epoch"),
        F.round(F.col("value") * 100).alias("temperature"),
        (F.col("event_id") % 10).cast("double").alias("precipitation"),
        (F.col("user_id") % 40).cast("double").alias("wind_speed"),
        (F.col("event_id") % 100).cast("double").alias("cloud_cover"),
    )


def candidate_temps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly temperature of up to four candidate stations per zone, hour beginning."""
    return (
        station_readings(spark, sf_dir)
        .groupBy(
            hour_start("poll").alias("time"),
            F.col("zone").alias("zone_id"),
            F.concat(F.lit("s"), F.col("station").cast("string")).alias("city"),
        )
        .agg(F.avg(F.col("temperature") % 40).alias("temperature"))
    )


def zone_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station seed: one row per (zone, station), zones in scope only."""
    return (
        events(spark, sf_dir)
        .filter(F.col("event_type") != OUT_OF_SCOPE)
        .select(
            F.col("event_type").alias("zone_id"),
            F.concat(F.lit("s"), (F.col("user_id") % 3).cast("string")).alias("city"),
        )
        .distinct()
    )


def facility_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("facility_id"),
        F.date_trunc("month", "o_orderdate").alias("synced_at"),
        F.col("o_orderkey").alias("row_id"),
        F.col("o_orderstatus").alias("status"),
    )


# Message `offset` is faulty in the first way whose modulus m gives
# offset % m = m - 1.
#   11 truncated                 13 key missing           17 null in a required column
#   19 not a number              23 null, nullable column 29 extra key
#   31 number as text            37 not a timestamp       41 trailing text
#   43 not an object


def load_stream_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load row per event, many of them revisions of the same zone-hour."""
    return events(spark, sf_dir).select(
        F.col("event_id").alias("offset"),
        hour_ending("ts").alias("time"),
        F.col("event_type").alias("zone"),
        F.lit("pjm").alias("source"),
        F.round(F.col("value") * 100).alias("demand_mw"),
        F.when(F.col("event_id") % 2 == 0, F.col("user_id").cast("double")).alias("demand_forecast_mw"),
        F.lit(None).cast("double").alias("net_generation_mw"),
        F.lit(None).cast("double").alias("total_interchange_mw"),
        (F.col("event_id") % 7 != 0).alias("is_verified"),
    )


def load_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load rows as keyed JSON messages with faults injected."""
    rows = load_stream_rows(spark, sf_dir)
    good = encode_messages(rows, "zone", LOAD.fieldNames(), carry=["offset"])
    v = F.col("value")

    def mw(text: str) -> Column:
        return F.regexp_replace(v, r'"demand_mw":[0-9.E]+', f'"demand_mw":{text}')

    faults = {
        11: F.expr("substring(value, 1, length(value) - 1)"),
        13: F.replace(v, F.lit(',"net_generation_mw":null'), F.lit("")),
        17: mw("null"),
        19: mw('"12x"'),
        23: F.regexp_replace(v, r'"is_verified":(true|false)', '"is_verified":null'),
        29: F.regexp_replace(v, r"}$", ',"note":"extra"}'),
        31: mw('"12.5"'),
        37: F.regexp_replace(v, r'"time":"[^"]*"', '"time":"soon"'),
        41: F.concat(v, F.lit(" }")),
        43: F.concat(F.lit("["), v, F.lit("]")),
    }
    broken = F
    for m, value in faults.items():
        broken = broken.when(F.col("offset") % m == m - 1, value)
    broken = broken.otherwise(v)
    return good.select(*[broken.alias(n) if n == "value" else n for n in MESSAGE.fieldNames()])


def price_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_messages(lmp_messages(spark, sf_dir), "zone", LMP.fieldNames(), carry=["offset"])


def weather_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = weather(spark, sf_dir).withColumn("offset", F.unix_micros("time"))
    return encode_messages(rows, "zone", WEATHER.fieldNames(), carry=["offset"])


def order_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One instant per order over several years, so that DST and holidays occur."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))).alias("time"),
        F.round(F.col("o_totalprice") % 60 - 20).alias("temperature"),
        F.col("o_orderstatus").alias("zone"),
        F.round("o_totalprice").alias("demand_mw"),
    )


def territories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as utilities: a diamond each, on a plane that grows with their number."""
    key = F.col("s_suppkey")
    cx, cy = (key * 37) % 211 + F.floor(key / 1000) * 250, (key * 53) % 199
    r = F.lit(3) + key % 11
    corners = [(cx - r, cy), (cx, cy + r), (cx + r, cy), (cx, cy - r)]
    ring = F.array(*[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in corners])
    return table(spark, sf_dir, "supplier").select(
        key.alias("entity"), F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("name"), ring.alias("ring")
    )


def territory_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Utility name -> zone; every third nation has no zone of its own."""
    return (
        table(spark, sf_dir, "nation")
        .filter(F.col("n_nationkey") % 3 != 0)
        .select(
            F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("name"),
            F.concat(F.lit("Z"), F.col("n_regionkey").cast("string")).alias("zone_id"),
        )
    )


def facility_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("facility_id"),
        ((key * 41) % 260 + 0.25).alias("x"),
        ((key * 29) % 210 + 0.75).alias("y"),
    )
