"""Raw feed frames -> table rows. The same functions serve batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.clock import from_epoch
from zoneflow.schemas import LMP, LOAD, TOTAL_ZONE, WEATHER, WEATHER_COLS


def _project(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def all_true(flag: Column) -> Column:
    """True unless some value is false; unknown values do not count, an empty group is true."""
    return F.coalesce(F.every(flag), F.lit(True))


def pjm_load(raw: DataFrame, zone_ids: list[str]) -> DataFrame:
    """Sum the sub-areas of a zone-hour; verified only when every sub-area is.

    The sum of no values is 0, not NULL, as in the feed's own reduction.
    """
    rolled = (
        raw.filter(F.col("Zone").isin(zone_ids))
        .groupBy(F.col("Interval End").alias("time"), F.col("Zone").alias("zone"))
        .agg(
            F.coalesce(F.sum("MW"), F.lit(0.0)).alias("demand_mw"),
            all_true(F.col("Is Verified")).alias("is_verified"),
        )
    )
    unknown = ["demand_forecast_mw", "net_generation_mw", "total_interchange_mw"]
    return _project(
        rolled.withColumns({"source": F.lit("pjm")} | {c: F.lit(None) for c in unknown}), LOAD
    )


def eia_load(raw: DataFrame) -> DataFrame:
    renamed = raw.withColumnsRenamed(
        {
            "Interval End": "time",
            "Load": "demand_mw",
            "Load Forecast": "demand_forecast_mw",
            "Net Generation": "net_generation_mw",
            "Total Interchange": "total_interchange_mw",
        }
    )
    fixed = {"zone": F.lit(TOTAL_ZONE), "source": F.lit("eia"), "is_verified": F.lit(None)}
    return _project(renamed.withColumns(fixed), LOAD)


def lmp(raw: DataFrame, zone_to_location: dict[str, str]) -> DataFrame:
    """Keep locations that map to a zone. The map is a fixed list of zones, so it is carried
    as a literal map in the projection: no join at all."""
    lookup = F.create_map(*[F.lit(x) for z, loc in zone_to_location.items() for x in (loc, z)])
    mapped = raw.filter(F.col("Location Short Name").isin(list(zone_to_location.values())))
    mapped = mapped.withColumn("zone", lookup[F.col("Location Short Name")])
    renamed = mapped.withColumnsRenamed(
        {
            "Interval End": "time",
            "Location Id": "pnode_id",
            "Location Name": "pnode_name",
            "LMP": "lmp",
            "Congestion": "congestion_price",
            "Loss": "marginal_loss_price",
        }
    )
    return _project(renamed, LMP)


def lmp_by_lookup(raw: DataFrame, locations: DataFrame) -> DataFrame:
    """The same with the map as a table (location, zone), for maps kept outside the code.
    The join has no hint: Spark broadcasts the table when its size allows it."""
    located = raw.join(
        locations.select(F.col("location").alias("Location Short Name"), "zone"), "Location Short Name"
    )
    return _project(
        located.select(
            F.col("Interval End").alias("time"),
            F.col("Location Id").alias("pnode_id"),
            F.col("Location Name").alias("pnode_name"),
            "zone",
            F.col("LMP").alias("lmp"),
            F.col("Congestion").alias("congestion_price"),
            F.col("Loss").alias("marginal_loss_price"),
        ),
        LMP,
    )


def station_composite(readings: DataFrame, poll_cols: list[str]) -> DataFrame:
    """Average the stations of a zone's poll; the poll time is the earliest reading."""
    merged = readings.groupBy(*poll_cols, "zone").agg(
        from_epoch(F.min("epoch")).alias("time"), *[F.avg(c).alias(c) for c in WEATHER_COLS]
    )
    return merged.select(*poll_cols, *WEATHER.fieldNames())


def composite_by_time(readings: DataFrame) -> DataFrame:
    """Average the stations that report the same instant of a zone; incomplete rows drop."""
    complete = readings.na.drop("any")
    return complete.groupBy("time", "zone").agg(*[F.avg(c).alias(c) for c in WEATHER_COLS])
