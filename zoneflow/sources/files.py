"""File sources and sinks with declared schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.functions.clock import parse_mixed_offsets, parse_us_date
from zoneflow.functions.numbers import nans_to_null
from zoneflow.schemas import FACILITY_COORDS, FACILITY_DATES, FACILITY_TEXT, STATION_SEED


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """Station seed, one row per station."""
    return spark.read.schema(STATION_SEED).csv(path, header=True)


def read_facilities(spark: SparkSession, path: str, columns_in_file: list[str]) -> DataFrame:
    """Facility sheet: free text stays text (a zip keeps its leading zero), coordinates are
    numbers, dates are m/d/yyyy and become NULL when they are not."""
    as_text = T.StructType([T.StructField(c, T.StringType()) for c in columns_in_file])
    sheet = spark.read.schema(as_text).csv(path, header=True, multiLine=True, escape='"')
    return nans_to_null(
        sheet.select(
            *FACILITY_TEXT,
            *[F.col(c).try_cast("double").alias(c) for c in FACILITY_COORDS],
            *[parse_us_date(c).alias(c) for c in FACILITY_DATES],
        )
    )


METERED_CSV = T.StructType(
    [
        T.StructField("Interval End", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("Load Area", T.StringType()),
        T.StructField("MW", T.DoubleType()),
        T.StructField("Is Verified", T.BooleanType()),
    ]
)


def read_metered_load(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Metered load files; each row carries its own UTC offset. Several paths are one scan."""
    raw = spark.read.schema(METERED_CSV).csv(path, header=True)
    return raw.withColumn("Interval End", parse_mixed_offsets("Interval End"))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_sorted_csv(df: DataFrame, path: str, by: list[Column | str]) -> None:
    """Globally sorted: part files are in order, and so are the rows in them."""
    df.orderBy(*by).write.mode("overwrite").csv(path, header=True)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
