import math

import pytest
from conftest import values
from pyspark.sql import functions as F

from zoneflow.functions import calendar, clock, display, numbers


def test_weekend_is_local(frame):
    df = frame([("2026-08-15 12:00:00",), ("2026-08-17 12:00:00",), ("2026-08-17 02:00:00",)], "time timestamp")
    got = dict(values(calendar.weekend_flag(df)))
    # 02:00 UTC on Monday is still Sunday evening in the east
    assert got == {"2026-08-15 12:00:00": True, "2026-08-17 12:00:00": False, "2026-08-17 02:00:00": True}


def test_degree_days_keep_null(spark):
    df = spark.createDataFrame([(0.0,), (18.33,), (30.0,), (None,)], "temperature double")
    got = {r.temperature: (r.hdd, r.cdd) for r in calendar.degree_day_features(df).collect()}
    assert got == {0.0: (18.33, 0.0), 18.33: (0.0, 0.0), 30.0: (0.0, 30 - 18.33), None: (None, None)}


def test_peak_hour_is_local_and_inclusive(frame):
    rows = ["2026-08-17 18:00:00", "2026-08-17 22:00:00", "2026-08-18 02:00:00", "2026-08-17 17:59:59"]
    got = dict(values(calendar.peak_hour_flag(frame([(r,) for r in rows], "time timestamp"))))
    assert [got[r] for r in rows] == [True, True, False, False]


def test_cyclical_follows_dst(frame):
    df = calendar.cyclical_features(frame([("2026-01-01 05:00:00",), ("2026-04-01 16:00:00",)], "time timestamp"))
    winter, spring = df.orderBy("time").collect()
    assert (winter.hour_sin, winter.hour_cos) == pytest.approx((0, 1), abs=1e-12)
    assert (spring.hour_sin, spring.hour_cos) == pytest.approx((0, -1), abs=1e-12)
    assert (winter.month_sin, winter.month_cos) == pytest.approx((0, 1), abs=1e-12)
    assert (spring.month_sin, spring.month_cos) == pytest.approx((1, 0), abs=1e-12)
    assert {winter.year, spring.year} == {2026}


def test_features_adds_all_and_drops_time(frame):
    df = frame([("2026-01-01 05:00:00", 1.0)], "time timestamp, temperature double")
    added = ["is_weekend", "hdd", "cdd", "is_peak_hour", "hour_sin", "hour_cos", "month_sin", "month_cos", "year"]
    assert calendar.features(df).columns == ["temperature", *added]
    assert "time" in calendar.build_features(df).columns


@pytest.mark.parametrize(
    ("day", "name"),
    [
        ("2026-05-25", "Memorial Day"),
        ("2026-09-07", "Labor Day"),
        ("2026-11-26", "Thanksgiving Day"),
        ("2026-07-04", "Independence Day"),
        ("2026-07-03", "Independence Day"),
        ("2021-12-31", "New Year's Day"),
        ("2022-12-26", "Christmas Day"),
        ("2026-07-06", None),
        ("2026-11-27", None),
    ],
)
def test_holidays(spark, day, name):
    assert spark.range(1).select(calendar.holiday_name(F.lit(day).cast("date"))).first()[0] == name


def test_clock(spark):
    t = F.lit("2024-03-31 10:20:30").cast("timestamp")
    row = spark.range(1).select(
        clock.minus_months(t, 1).cast("string").alias("feb"),
        clock.hour_ending(t).cast("string").alias("he"),
        clock.iso(t).alias("iso"),
        clock.iso(F.lit("2024-03-31 10:20:30.5").cast("timestamp")).alias("iso_fraction"),
        clock.parse_us_date(F.lit("2/30/2024")).alias("bad"),
        clock.parse_us_date(F.lit("2/3/2024")).cast("string").alias("good"),
        clock.parse_mixed_offsets(F.lit("2024-07-01 00:00:00-04:00")).cast("string").alias("east"),
    ).first()
    assert row.asDict() == {
        "feb": "2024-02-29 10:20:30",
        "he": "2024-03-31 11:00:00",
        "iso": "2024-03-31T10:20:30+00:00",
        "iso_fraction": "2024-03-31T10:20:30.500000+00:00",
        "bad": None,
        "good": "2024-02-03",
        "east": "2024-07-01 04:00:00",
    }


def test_hours_between(spark):
    df = spark.sql("select timestamp'2026-01-01 00:00:00' a, timestamp'2026-01-01 05:00:00' b")
    n = df.select(F.size(clock.hours_between("a", "b")), F.size(clock.hours_between("a", "b", 2)), F.size(clock.hours_between("b", "a")), F.size(clock.hours_between("a", "a")))
    assert tuple(n.first()) == (5, 3, 0, 0)


def test_horizon_text(spark):
    df = spark.createDataFrame([("24h",), ("y_72h",)], "t string")
    assert [r[0] for r in df.select(display.horizon_hours("t")).collect()] == [24, 72]


def test_conditions(spark):
    rows = [(5.0, 0.2, 0.0), (0.0, 0.2, 0.0), (5.0, 0.1, 85.0), (5.0, 0.0, 40.0), (5.0, 0.0, 39.9)]
    df = spark.createDataFrame(rows, "t double, p double, c double")
    got = [r[0] for r in df.select(display.weather_condition("t", "p", "c")).collect()]
    assert got == ["rain", "snow", "cloudy", "partly_cloudy", "clear"]


def test_display(spark):
    df = spark.createDataFrame([(9999.0,), (10000.5,), (-12345.6789,)], "v double")
    got = df.select(display.fmt_mw("v"), display.fmt_mw_conditional("v")).collect()
    assert [tuple(r) for r in got] == [
        ("9,999.000", "9999.000"), ("10,000.500", "10,000.500"), ("-12,345.679", "-12,345.679")
    ]


def test_guards(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "v double")
    assert [r.v for r in numbers.nans_to_null(df).collect()] == [None, 1.0, None]
    e = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (0.0, 0.0)], "e double, y double")
    got = [r[0] for r in e.select(numbers.pct_error(F.col("e"), F.col("y"))).collect()]
    assert got[0] == 0.5 and math.isinf(got[1]) and got[2] is None


def test_scale_unit(spark):
    one = F.lit(1.0)
    row = spark.range(1).select(
        display.scale_unit(F.lit(5.0), F.lit(0.0), F.lit(10.0)),
        display.scale_unit(F.lit(50.0), F.lit(0.0), F.lit(10.0)),
        display.scale_unit(one, one, one),
    ).first()
    assert tuple(row) == (0.5, 1.0, 0.0)
