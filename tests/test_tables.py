import random

import pytest
from conftest import FULL, values
from pyspark.sql import functions as F

from zoneflow import fixtures as fx
from zoneflow import session
from zoneflow.operators import merge
from zoneflow.plans import serve
from zoneflow.plans.build import SCHEMAS, Lookback, Warehouse
from zoneflow.schemas import LOAD, WEATHER
from zoneflow.sources import tables

LOAD_DDL = (
    "time timestamp, zone string, source string, demand_mw double, demand_forecast_mw double, "
    "net_generation_mw double, total_interchange_mw double, is_verified boolean"
)
WEATHER_DDL = (
    "time timestamp, zone string, temperature double, precipitation double, wind_speed double, cloud_cover double"
)


def _load(frame, *rows):
    return frame([(t, z, "pjm", mw, fc, None, None, None) for t, z, mw, fc in rows], LOAD_DDL)


def test_upsert_replaces_whole_rows(spark, frame, tmp_path):
    path, keys = str(tmp_path / "load"), ["time", "zone", "source"]
    first = _load(frame, ("2026-01-01 00:00:00", "A", 1.0, 5.0), ("2026-01-02 00:00:00", "A", 2.0, 5.0))
    tables.upsert_table(spark, path, LOAD, first, keys)
    tables.upsert_table(spark, path, LOAD, _load(frame, ("2026-01-01 00:00:00", "A", 9.0, None)), keys)
    got = values(tables.read_table(spark, path, LOAD), "time", "demand_mw", "demand_forecast_mw")
    assert got == [("2026-01-01 00:00:00", 9.0, None), ("2026-01-02 00:00:00", 2.0, 5.0)]


def test_partial_upsert_keeps_other_columns(spark, frame, tmp_path):
    path, keys = str(tmp_path / "load"), ["time", "zone", "source"]
    tables.upsert_table(spark, path, LOAD, _load(frame, ("2026-01-01 00:00:00", "A", 1.0, 5.0)), keys)
    batch = _load(frame, ("2026-01-01 00:00:00", "A", 9.0, None), ("2026-01-01 00:00:00", "B", 3.0, 4.0))
    tables.upsert_table(spark, path, LOAD, batch, keys, update_cols=["demand_mw", "is_verified"])
    got = values(tables.read_table(spark, path, LOAD), "zone", "demand_mw", "demand_forecast_mw")
    assert got == [("A", 9.0, 5.0), ("B", 3.0, 4.0)]


def test_batches_equal_one_upsert_at_a_time(spark, tmp_path):
    """Random messages in three batches against a dictionary written message by message."""
    rng, path = random.Random(11), str(tmp_path / "load")
    keys, held, offset = ["time", "zone", "source"], {}, 0
    for _ in range(3):
        rows = []
        for _ in range(300):
            hour, zone = rng.randrange(72), rng.choice("AB")
            mw, forecast = float(rng.randrange(1000)), rng.choice([None, 1.0, 2.0])
            rows.append((hour * 3600, zone, "pjm", mw, forecast, offset))
            held[hour, zone] = (mw, forecast)
            offset += 1
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "s long, zone string, source string, demand_mw double, demand_forecast_mw double, offset long")
        df = df.withColumns({"time": F.timestamp_seconds("s"), "net_generation_mw": F.lit(None).cast("double"), "total_interchange_mw": F.lit(None).cast("double"), "is_verified": F.lit(True)})
        tables.upsert_table(spark, path, LOAD, df.repartition(5).select(*LOAD.fieldNames(), "offset"), keys, "offset")
    got = tables.read_table(spark, path, LOAD).select(F.unix_seconds("time").alias("s"), "zone", "demand_mw", "demand_forecast_mw")
    assert {(r.s // 3600, r.zone): (r.demand_mw, r.demand_forecast_mw) for r in got.collect()} == held
    assert got.count() == len(held)


def test_merge_keeps_absent_keys_and_batch_repeats(frame):
    target = _load(frame, ("2026-01-01 00:00:00", "A", 1.0, None), ("2026-01-01 01:00:00", "A", 2.0, None))
    new = _load(frame, ("2026-01-01 01:00:00", "A", 7.0, None), ("2026-01-01 01:00:00", "A", 8.0, None))
    got = values(merge.incremental_merge(target, new, ["time", "zone"]), "demand_mw")
    assert got == [(1.0,), (7.0,), (8.0,)]


KEYS = ["time", "zone", "source"]
ONE = ("2026-01-01 00:00:00", "A", 1.0, None)


def _writers(spark, frame, path):
    """Each writer of a load table by name, with the demand values the table `[1.0]` holds after it."""
    new = _load(frame, ("2026-01-01 00:00:00", "A", 7.0, None))
    later = _load(frame, ("2026-01-03 00:00:00", "B", 8.0, None))
    return {
        "upsert": (lambda: tables.upsert_table(spark, path, LOAD, new, KEYS), [7.0]),
        "merge": (lambda: tables.merge_table(spark, path, LOAD, later, KEYS), [1.0, 8.0]),
        "refresh": (lambda: tables.write_table(later, path), [8.0]),
        "append": (lambda: tables.append_batch(later, path, "x"), [1.0, 8.0]),
        "replace": (lambda: tables.replace_zones_table(spark, path, LOAD, later, ["A"], "y"), [8.0]),
        "absent": (lambda: tables.append_absent_hours(spark, path, LOAD, later, "z"), [1.0, 8.0]),
    }


@pytest.mark.parametrize("step", ["_put", "_commit", "_forget", "write_small"])
@pytest.mark.parametrize("dead", ["upsert", "replace", "append"])
def test_a_dead_writer_leaves_nothing(spark, frame, tmp_path, monkeypatch, dead, step):
    """A writer stopped at any step, then a reader and each other writer."""
    for after in ("upsert", "merge", "refresh", "append", "replace", "absent"):
        path = str(tmp_path / after)
        tables.upsert_table(spark, path, LOAD, _load(frame, ONE), KEYS)
        died, done = _writers(spark, frame, path)[dead], step == "_forget"
        with monkeypatch.context() as m:
            m.setattr(tables, step, lambda *a, **k: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                died[0]()
        held = values(tables.read_table(spark, path, LOAD), "demand_mw")
        assert held == [(v,) for v in (died[1] if done else [1.0])]
        if not done:
            write, want = _writers(spark, frame, path)[after]
            write()
            assert values(tables.read_table(spark, path, LOAD), "demand_mw") == [(v,) for v in want], after


def test_a_late_rerun_is_not_applied_over_a_refresh(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "load")
    tables.write_table(_load(frame, ONE), path)
    with monkeypatch.context() as m:
        m.setattr(tables, "_commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            tables.upsert_table(spark, path, LOAD, _load(frame, ("2026-01-01 00:00:00", "A", -5.0, None)), KEYS)
    tables.write_table(_load(frame, ("2026-01-01 00:00:00", "A", 100.0, None)), path)
    tables.upsert_table(spark, path, LOAD, _load(frame, ("2026-01-02 00:00:00", "A", 3.0, None)), KEYS)
    assert sorted(values(tables.read_table(spark, path, LOAD), "demand_mw")) == [(3.0,), (100.0,)]


def test_two_rows_of_a_key_need_an_order(spark, frame, tmp_path):
    twice = _load(frame, ONE, ("2026-01-01 00:00:00", "A", 2.0, None))
    for cols in (None, ["demand_mw"]):
        with pytest.raises(ValueError, match="holds a key 2 times"):
            tables.upsert_table(spark, str(tmp_path / "load"), LOAD, twice, KEYS, update_cols=cols)


def test_batches_keep_their_names(spark, frame, tmp_path):
    """After a replacement, a replay of an earlier batch still adds nothing."""
    path = str(tmp_path / "weather")
    row = (1.0, 0.0, 0.0, 0.0)
    for n in (0, 1):
        tables.append_batch(frame([(f"2026-01-0{n + 1} 00:10:00", z, *row) for z in "AB"], WEATHER_DDL), path, f"run-{n}")
    tables.replace_zones_table(spark, path, WEATHER, frame([("2026-01-05 00:00:00", "A", *row)], WEATHER_DDL), ["A"], "again")
    for n in (0, 1):
        tables.append_batch(frame([(f"2026-01-0{n + 1} 00:10:00", z, *row) for z in "AB"], WEATHER_DDL), path, f"run-{n}")
    assert tables.read_appended(spark, path, WEATHER).count() == 3
    stored = tables._read(spark, path, tables.with_batch(WEATHER), tables.state(spark, path).parts)
    assert {(r.zone, r.batch_id) for r in stored.collect()} == {("B", "run-0"), ("B", "run-1"), ("A", "again")}


def test_a_lost_folder_is_an_error(spark, frame, tmp_path):
    import shutil

    path = str(tmp_path / "load")
    assert tables.read_table(spark, path, LOAD).count() == 0
    tables.write_table(_load(frame, ONE), path)
    (folder,) = (tmp_path / "load").glob("v=*")
    shutil.move(folder, f"{tmp_path}/elsewhere")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_table(spark, path, LOAD)


def test_only_a_local_master_may_lack_a_shared_folder():
    class Fake:
        def __init__(self, master, named=None):
            self.conf = type("C", (), {"get": lambda s, k, d: named})()
            self.sparkContext = type("S", (), {"master": master, "getCheckpointDir": lambda s: None, "setCheckpointDir": lambda s, d: None})()

    assert session.shared_dir(Fake("local[4]")).startswith("/")
    assert session.shared_dir(Fake("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    for master in ("yarn", "local-cluster[3,2,1000]", "spark://h:7077"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_dir(Fake(master))


def test_untouched_dates_are_not_rewritten(spark, frame, tmp_path):
    path, keys = str(tmp_path / "load"), ["time", "zone", "source"]
    tables.upsert_table(spark, path, LOAD, _load(frame, ("2026-01-01 00:00:00", "A", 1.0, None), ("2026-01-02 00:00:00", "A", 2.0, None)), keys)
    before = {f for f in tables.read_table(spark, path, LOAD).inputFiles() if "2026-01-01" in f}
    tables.upsert_table(spark, path, LOAD, _load(frame, ("2026-01-02 00:00:00", "A", 3.0, None)), keys)
    assert before < set(tables.read_table(spark, path, LOAD).inputFiles()) and before


def test_replace_zones_and_backfill(spark, frame, tmp_path):
    path = str(tmp_path / "weather")
    row = (1.0, 0.0, 0.0, 0.0)
    old = frame([(f"2026-01-0{d} 00:10:00", z, *row) for d in (1, 2) for z in "AB"], WEATHER_DDL)
    tables.append_batch(old, path, "b0")
    new = frame([("2026-01-05 00:00:00", "A", *row)], WEATHER_DDL)
    tables.replace_zones_table(spark, path, WEATHER, new, ["A"], "b1")
    held = [("2026-01-01 00:10:00", "B"), ("2026-01-02 00:10:00", "B"), ("2026-01-05 00:00:00", "A")]
    assert values(tables.read_appended(spark, path, WEATHER).select("time", "zone")) == held

    wanted = frame([("2026-01-01 00:00:00", "B", *row), ("2026-01-01 01:00:00", "B", *row), ("2026-01-01 01:00:00", "B", *row)], WEATHER_DDL)
    for _ in range(2):
        tables.append_absent_hours(spark, path, WEATHER, wanted, "b2")
    got = values(tables.read_appended(spark, path, WEATHER).select("time", "zone"))
    assert got == sorted([*held, ("2026-01-01 01:00:00", "B"), ("2026-01-01 01:00:00", "B")])


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "facilities")
    for day, names in (("2026-01-01", "ab"), ("2026-01-02", "bc"), ("2026-01-02", "bc")):
        df = spark.createDataFrame([(n,) for n in names], "facility_name string")
        tables.append_snapshot(df, path, F.lit(day).cast("timestamp"))
    df = spark.read.parquet(path)
    assert df.count() == 4
    assert values(tables.latest_snapshot(df).select("facility_name")) == [("b",), ("c",)]
    stored = tables.read_latest_snapshot(spark, path, df.drop("synced_at").schema)
    assert values(stored.select("facility_name")) == [("b",), ("c",)]
    assert "PartitionFilters: [isnotnull(synced_at" in stored._jdf.queryExecution().executedPlan().toString()


def test_high_water_prunes(spark, frame, tmp_path):
    path = str(tmp_path / "load")
    assert tables.high_water(spark, path) is None
    tables.write_table(_load(frame, ("2026-01-01 00:00:00", "A", 1.0, None), ("2026-01-09 03:00:00", "A", 1.0, None)), path)
    table = tables.read_table(spark, path, LOAD)
    mark = tables.high_water(spark, path)
    assert spark.range(1).select(mark.cast("string")).first()[0] == "2026-01-09 03:00:00"
    plan = tables.since(table, mark)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "PushedFilters: [IsNotNull(time)" in plan


def test_trailing_reads_prune_dates(spark, frame, tmp_path):
    path = str(tmp_path / "load")
    rows = [(f"2026-01-{d:02} 05:00:00", "A", float(d), None) for d in range(1, 29)]
    tables.write_table(_load(frame, *rows), path)
    table, at = tables.read_table(spark, path, LOAD), F.lit("2026-01-28 06:00:00").cast("timestamp")
    window, peak = serve.features_window(table, at, 48), serve.recent_peak(table, at, 7)
    assert window.columns == LOAD.fieldNames() and window.count() == 2 and peak.first().peak_mw == 28.0
    for df in (window, peak):
        assert "PartitionFilters: [isnotnull(date" in df._jdf.queryExecution().executedPlan().toString()


CUT = "2024-01-26 00:00:00"


@pytest.fixture(scope="module")
def raw(spark):
    from zoneflow.session import materialize

    return [materialize(f(spark, FULL), "raw") for f in (fx.load, fx.lmp, fx.weather)]


def test_full_equals_incremental(spark, raw, tmp_path):
    """An earlier build plus incremental runs gives the tables of one full build."""
    step = Warehouse(spark, str(tmp_path / "step"), fx.ZONES)
    for until in (CUT, "2024-01-28 00:00:00", "2025-01-01 00:00:00"):
        step.build(*[df.filter(F.col("time") < F.lit(until).cast("timestamp")) for df in raw])
    whole = Warehouse(spark, str(tmp_path / "whole"), fx.ZONES)
    whole.build(*raw, full_refresh=True)
    for name in SCHEMAS:
        a, b = step.read(name), whole.read(name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_lookbacks_do_not_line_up(spark, raw, tmp_path):
    """A revision five days back reaches load_features but not features, unless aligned."""
    load, lmp, weather = raw
    at = F.lit("2024-01-26 12:00:00").cast("timestamp")
    revised = load.withColumn("demand_mw", F.when(F.col("time") == at, F.lit(-1.0)).otherwise(F.col("demand_mw")))
    seen = {}
    for label, back in (("default", Lookback(stg_load=7)), ("aligned", Lookback.consistent())):
        w = Warehouse(spark, str(tmp_path / label), fx.ZONES, back)
        w.build(load, lmp, weather)
        w.build(revised, lmp, weather)
        seen[label] = [w.read(n).filter("demand_mw = -1").count() for n in ("load_features", "features")]
    assert seen == {"default": [4, 0], "aligned": [4, 4]}
