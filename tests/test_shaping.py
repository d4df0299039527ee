from conftest import values
from pyspark.sql import functions as F

from zoneflow.operators import stations
from zoneflow.plans import features as feats
from zoneflow.plans import staging
from zoneflow.schemas import STATION_SEED, ZONE_LOCATION, ZONES
from zoneflow.sources import files
from zoneflow.streaming import shaping


def _areas(frame, rows):
    df = frame(rows, "t timestamp, Zone string, MW double, v boolean")
    return df.withColumnsRenamed({"t": "Interval End", "v": "Is Verified"})


def test_area_rollup(frame):
    h = "2026-01-01 01:00:00"
    raw = _areas(frame, [(h, "AEP", 100.0, True), (h, "AEP", 50.0, True), (h, "COMED", 200.0, False)])
    got = values(shaping.pjm_load(raw, ["AEP", "COMED"]), "zone", "demand_mw", "is_verified", "source", "net_generation_mw")
    assert got == [("AEP", 150.0, True, "pjm", None), ("COMED", 200.0, False, "pjm", None)]


def test_area_rollup_filters_zones_and_unknowns(frame):
    h = "2026-01-01 01:00:00"
    raw = _areas(frame, [(h, "AEP", None, None), (h, "DOM", 2.0, True)])
    assert values(shaping.pjm_load(raw, ["AEP"]), "zone", "demand_mw", "is_verified") == [("AEP", 0.0, True)]


def test_eia_shape(frame):
    raw = frame(
        [("2026-01-01 01:00:00", 50000.0, 51000.0, 49000.0, -500.0)],
        "a timestamp, Load double, c double, d double, e double",
    ).withColumnsRenamed(
        {"a": "Interval End", "c": "Load Forecast", "d": "Net Generation", "e": "Total Interchange"}
    )
    got = values(shaping.eia_load(raw))
    assert got == [("2026-01-01 01:00:00", "RTO", "eia", 50000.0, 51000.0, 49000.0, -500.0, None)]


def test_station_composite(spark):
    df = spark.createDataFrame(
        [
            (1, "AEP", 1000, 10.0, 0.0, 5.0, 20.0),
            (1, "AEP", 2000, 20.0, 1.0, 7.0, 30.0),
            (1, "COMED", 1500, 15.0, 0.5, 6.0, 25.0),
        ],
        "poll int, zone string, epoch long, temperature double, precipitation double, wind_speed double, "
        "cloud_cover double",
    )
    got = values(shaping.station_composite(df, ["poll"]).drop("poll"))
    assert got == [
        ("1970-01-01 00:16:40", "AEP", 15.0, 0.5, 6.0, 25.0),
        ("1970-01-01 00:25:00", "COMED", 15.0, 0.5, 6.0, 25.0),
    ]


def test_lmp_map_and_table_agree(spark, frame):
    raw = frame(
        [("2026-01-01 01:00:00", 7, "n", loc, 1.0, 2.0, 3.0) for loc in ("COMED", "AECO", "OVEC", "PJM-RTO")],
        "t timestamp, id int, name string, loc string, LMP double, c double, l double",
    ).withColumnsRenamed(
        {"t": "Interval End", "id": "Location Id", "name": "Location Name", "loc": "Location Short Name",
         "c": "Congestion", "l": "Loss"}
    )
    by_map = shaping.lmp(raw, ZONE_LOCATION)
    table = spark.createDataFrame(list(ZONE_LOCATION.items()), "zone string, location string")
    assert values(by_map, "zone", "pnode_id") == [("AE", "7"), ("CE", "7")]
    assert values(by_map) == values(shaping.lmp_by_lookup(raw, table))
    assert set(ZONES) == set(ZONE_LOCATION) and len(ZONES) == 20


def test_price_is_joined_by_time_not_by_row(frame):
    load = frame([("2026-01-03 00:00:00", "A", 1.0), ("2026-01-03 05:00:00", "A", 2.0)], "time timestamp, zone string, demand_mw double")
    for c in feats.LAGS_H:
        load = load.withColumn(f"demand_lag_{c}h", F.lit(0.0))
    load = load.withColumns({c: F.lit(0.0) for c in feats.ROLLS_H})
    lmp = frame([("2026-01-01 00:00:00", "A", 10.0, 1.0, 1.0)], "time timestamp, zone string, lmp_total double, congestion_price double, marginal_loss_price double")
    weather = frame([("2026-01-03 05:00:00", "A", 5.0, 0.0, 0.0, 0.0, 3)], "time timestamp, zone string, temperature double, precipitation double, wind_speed double, cloud_cover double, observation_count long")
    got = values(feats.features(load, lmp, weather), "time", "lmp_total_lag_48h", "temperature")
    assert got == [("2026-01-03 00:00:00", 10.0, None), ("2026-01-03 05:00:00", None, 5.0)]


def test_staging_keeps_total_zone(frame):
    load = frame(
        [("2026-01-01 00:00:00", z, "eia", 1.0, None, None, None, None) for z in ("RTO", "AEP")],
        "time timestamp, zone string, source string, demand_mw double, demand_forecast_mw double, "
        "net_generation_mw double, total_interchange_mw double, is_verified boolean",
    )
    assert staging.stg_load(load).count() == 2
    assert feats.modelled_load(staging.stg_load(load), ["AEP"]).count() == 0


def test_files(spark, tmp_path):
    seed = tmp_path / "seed.csv"
    seed.write_text("zone_id,zone_name,city,lat,lon\nAEP,A,Columbus,39.9,-83.0\n")
    df = files.read_stations(spark, str(seed))
    assert df.schema == STATION_SEED and df.count() == 1

    columns = [*files.FACILITY_TEXT, "extra", *files.FACILITY_COORDS, *files.FACILITY_DATES]
    row = ["x"] * len(files.FACILITY_TEXT) + ["ignored", "39.5", "", "3/4/2025", "soon"]
    row[columns.index("zip")], row[columns.index("mw")] = "08037", "100-200"
    sheet = tmp_path / "sheet.csv"
    sheet.write_text(",".join(columns) + "\n" + ",".join(row) + "\n")
    got = files.read_facilities(spark, str(sheet), columns).first()
    assert (got.zip, got.mw, got.lat, got.long) == ("08037", "100-200", 39.5, None)
    assert str(got.date_created) == "2025-03-04" and got.date_updated is None

    metered = tmp_path / "load.csv"
    metered.write_text(
        "Interval End,Zone,Load Area,MW,Is Verified\n"
        "2024-03-10 01:00:00-05:00,AEP,a,1.5,True\n2024-03-10 03:00:00-04:00,AEP,b,2.5,False\n"
    )
    back = files.read_metered_load(spark, str(metered))
    assert [r[0] for r in values(back)] == ["2024-03-10 06:00:00", "2024-03-10 07:00:00"]

    out = str(tmp_path / "sorted")
    files.write_sorted_csv(back.repartition(4), out, [F.desc("MW")])
    assert [r.MW for r in spark.read.schema(files.METERED_CSV).csv(out, header=True).collect()] == [2.5, 1.5]
    files.write_json(back, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2


def test_pivot_means(frame):
    df = frame(
        [("2026-01-01 00:00:00", "A", "x", 1.0), ("2026-01-01 00:00:00", "A", "x", 3.0), ("2026-01-01 00:00:00", "A", "y", 5.0)],
        "time timestamp, zone string, city string, temperature double",
    )
    assert values(stations.station_pivot(df, df), "x", "y") == [(2.0, 5.0)]


def test_load_side_is_shuffled_once(spark, tmp_path):
    """Both joins of the feature table share its partitioning, so three sides, three shuffles."""
    from zoneflow.plans.build import SCHEMAS
    from zoneflow.sources.tables import read_or_empty

    sides = []
    for name in ("load_features", "lmp_features", "weather_features"):
        spark.createDataFrame([], SCHEMAS[name]).write.parquet(str(tmp_path / name))
        sides.append(read_or_empty(spark, str(tmp_path / name), SCHEMAS[name]))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = feats.features(*sides)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning") == 3
