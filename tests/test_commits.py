"""Writers that meet, the index of written folders, and tables that follow changes."""

import random
from pathlib import Path

import pytest
from conftest import values
from pyspark.sql import functions as F

from zoneflow.plans import serve
from zoneflow.plans.build import SCHEMAS, Warehouse
from zoneflow.schemas import LMP, LOAD, WEATHER
from zoneflow.sources import tables

DDL = (
    "time timestamp, zone string, source string, demand_mw double, demand_forecast_mw double, "
    "net_generation_mw double, total_interchange_mw double, is_verified boolean"
)
KEYS = ["time", "zone", "source"]


def _load(frame, *rows):
    return frame([(t, z, "pjm", mw, None, None, None, None) for t, z, mw in rows], DDL)


def _held(spark, path):
    return values(tables.read_table(spark, path, LOAD).select("time", "zone", "demand_mw"))


def _meet(monkeypatch, first):
    """The next writer is overtaken by `first` just before it commits."""
    commit, waiting = tables._commit, [first]

    def late(*a):
        if waiting:
            waiting.pop()()
        return commit(*a)

    monkeypatch.setattr(tables, "_commit", late)


def _writers(spark, frame, path):
    both = _load(frame, ("2026-01-01 00:00:00", "A", 7.0), ("2026-01-03 00:00:00", "A", 7.5))
    other = _load(frame, ("2026-01-01 00:00:00", "A", 8.0), ("2026-01-01 05:00:00", "B", 8.5), ("2026-01-04 00:00:00", "B", 8.0))
    return {
        "upsert": lambda: tables.upsert_table(spark, path, LOAD, both, KEYS),
        "merge": lambda: tables.merge_table(spark, path, LOAD, other, KEYS),
        "partial": lambda: tables.upsert_table(spark, path, LOAD, other, KEYS, update_cols=["demand_mw"]),
        "append": lambda: tables.append_batch(other, path, "x"),
        "replace": lambda: tables.replace_zones_table(spark, path, LOAD, other, ["B"], "y"),
        "absent": lambda: tables.append_absent_hours(spark, path, LOAD, other, "z"),
        "refresh": lambda: tables.write_table(other, path),
    }


ONES = [("2026-01-01 00:00:00", "A", 1.0), ("2026-01-02 00:00:00", "B", 2.0)]


@pytest.mark.parametrize("late", ["upsert", "merge", "partial", "append", "replace", "absent", "refresh"])
def test_writers_that_meet_give_the_rows_of_one_order(spark, frame, tmp_path, monkeypatch, late):
    """The overtaken writer's rows are those it has when it comes second."""
    for early in ("upsert", "replace", "append"):
        if early == late:
            continue
        paths = [str(tmp_path / f"{early}-{n}") for n in ("met", "turns")]
        for path in paths:
            tables.upsert_table(spark, path, LOAD, _load(frame, *ONES), KEYS)
        with monkeypatch.context() as m:
            _meet(m, _writers(spark, frame, paths[0])[early])
            _writers(spark, frame, paths[0])[late]()
        _writers(spark, frame, paths[1])[early]()
        _writers(spark, frame, paths[1])[late]()
        assert _held(spark, paths[0]) == _held(spark, paths[1]), early
        a, b = (tables.state(spark, path) for path in paths)
        assert (a.number, a.zones, a.batches) == (b.number, b.zones, b.batches)


def test_an_overtaken_writer_makes_only_moved_dates_again(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "load")
    tables.upsert_table(spark, path, LOAD, _load(frame, *ONES), KEYS)
    put, made = tables._put, []
    with monkeypatch.context() as m:
        m.setattr(tables, "_put", lambda *a: made.append(put(*a)) or made[-1])
        _meet(m, lambda: tables.upsert_table(spark, path, LOAD, _load(frame, ("2026-01-01 00:00:00", "A", 8.0)), KEYS))
        tables.upsert_table(spark, path, LOAD, _load(frame, ("2026-01-01 01:00:00", "A", 7.0), ("2026-01-02 01:00:00", "A", 7.0)), KEYS)
    assert [[d for d, _ in parts] for parts in made] == [["2026-01-01", "2026-01-02"], ["2026-01-01"], ["2026-01-01"]]
    assert len(_held(spark, path)) == 4


def test_a_batch_that_came_in_meanwhile_is_not_added_twice(spark, frame, tmp_path, monkeypatch):
    path, rows = str(tmp_path / "load"), _load(frame, *ONES)
    with monkeypatch.context() as m:
        _meet(m, lambda: tables.append_batch(rows, path, "run-0"))
        tables.append_batch(rows, path, "run-0")
    assert len(_held(spark, path)) == 2 and len(list(Path(path).glob("v=*"))) == 1


def test_what_dead_writers_leave_is_swept(spark, frame, tmp_path, monkeypatch):
    path = str(tmp_path / "load")
    tables.upsert_table(spark, path, LOAD, _load(frame, *ONES), KEYS)
    with monkeypatch.context() as m:
        m.setattr(tables, "_commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            tables.write_table(_load(frame, *ONES[:1]), path)
    assert len(list(Path(path).glob("v=*"))) == 2
    tables.sweep(spark, path)
    assert len(list(Path(path).glob("v=*"))) == 2  # too young
    tables.sweep(spark, path, hours=-1)
    assert len(list(Path(path).glob("v=*"))) == 1 and len(_held(spark, path)) == 2


def test_index_against_rows(spark, tmp_path):
    """Random upserts and replacements: newest dates, change log, peaks and freshness are those of the rows."""
    rng, path = random.Random(4), str(tmp_path / "load")
    held, moved = {}, {}
    for step in range(1, 7):
        hours = rng.sample(range(24 * 20), 25) if step < 6 else []
        rows = {(h, rng.choice("ABC" if step < 4 else "AB"), "pjm"): float(rng.randrange(1000)) for h in hours}
        df = spark.createDataFrame([(h * 3600, z, s, v) for (h, z, s), v in rows.items()], "s long, zone string, source string, demand_mw double")
        df = df.withColumns({"time": F.timestamp_seconds("s"), **{c: F.lit(None).cast(LOAD[c].dataType) for c in LOAD.fieldNames()[4:]}}).select(*LOAD.fieldNames())
        if step < 6:
            tables.upsert_table(spark, path, LOAD, df, KEYS)
            touched = {h // 24 for h, _, _ in rows}
            held |= rows
        else:  # a zone goes altogether
            tables.replace_zones_table(spark, path, LOAD, df, ["C"], "gone")
            touched = {h // 24 for h, z, _ in held if z == "C"}
            held = {k: v for k, v in held.items() if k[1] != "C"}
        moved |= dict.fromkeys(touched, step)
        now = tables.state(spark, path)
        assert {int(d[-2:]) - 1: n for d, n in now.moved.items()} == moved
        newest = {}
        for h, z, _ in held:
            newest[z] = max(h // 24, newest.get(z, 0))
        assert {z: int(d[-2:]) - 1 for z, d in now.zones.items()} == newest
        assert tables.newest_micros(spark, path) == max(h for h, _, _ in held) * 3_600_000_000
        at = rng.randrange(24 * 20) * 3600 + 1800
        peaks = {}
        for (h, z, _), v in held.items():
            if h * 3600 >= at:
                peaks[z] = max(v, peaks.get(z, v))
        assert {r.zone: r.peak for r in tables.read_peaks(spark, path, LOAD, at * 1_000_000).collect()} == peaks
        assert tables.changed(spark, path, step - 1)[1] == {d for d, n in now.moved.items() if n == step}


def _paths(df):
    return sorted(f.split("v=")[1] for f in df.inputFiles())


def test_newest_rows_read_only_the_dates_that_hold_them(spark, frame, tmp_path):
    path = str(tmp_path / "load")
    rows = [(f"2026-01-{d:02} {h:02}:00:00", z, float(d)) for d in range(1, 21) for h in (0, 23) for z in "AB"]
    rows += [("2026-01-03 05:00:00", "C", 3.0)]
    tables.write_table(_load(frame, *rows), path)
    df = serve.latest_stored(spark, path, LOAD)
    assert values(df, "time", "zone") == [("2026-01-03 05:00:00", "C"), ("2026-01-20 23:00:00", "A"), ("2026-01-20 23:00:00", "B")]
    assert [f.split("date=")[1][:10] for f in _paths(df)] == ["2026-01-03", "2026-01-20"]
    assert [f.split("date=")[1][:10] for f in _paths(serve.latest_stored(spark, path, LOAD, "C"))] == ["2026-01-03"]
    assert serve.latest_stored(spark, path, LOAD, "no such").count() == 0
    peaks = serve.peak_stored(spark, path, LOAD, F.lit("2026-01-20 12:00:00").cast("timestamp"), 5)
    assert values(peaks) == [("A", 20.0), ("B", 20.0)]
    assert {f.split("date=")[1][:10] for f in _paths(peaks)} == {"2026-01-15"}
    assert "parquet" not in serve.freshness_stored(spark, path, F.lit("2026-01-20 12:00:00").cast("timestamp"))._jdf.queryExecution().executedPlan().toString()


def test_a_zone_is_read_from_its_files(spark, frame, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_PER_FILE", 10)
    path = str(tmp_path / "load")
    rows = [(f"2026-01-{d:02} {h:02}:00:00", z, float(d)) for d in (1, 2) for h in range(20) for z in "ABCDE"]
    tables.write_table(_load(frame, *rows), path)
    every, one = tables.read_table(spark, path, LOAD), tables.read_table(spark, path, LOAD, ["C"])
    assert len(_paths(every)) == 20 and len(_paths(one)) == 4
    assert values(one.drop("date")) == values(every.filter("zone = 'C'").drop("date"))
    assert tables.read_table(spark, path, LOAD, ["X"]).count() == 0


def _series(spark, seed, days=60):
    """Load with random gaps, so that 168 rows span anything from a week to a month, prices and weather."""
    rng = random.Random(seed)
    load, lmp, weather = [], [], []
    for z, keep in (("A", 1.0), ("B", 0.5), ("C", 0.2)):
        for h in range(24 * days):
            if rng.random() < keep and not (z == "B" and 300 < h < 700):
                load.append((h * 3600, z, "pjm", float(rng.randrange(1000))))
                load.append((h * 3600, z, "eia", 1.0))
            if rng.random() < 0.3:
                lmp.append((h * 3600, f"{z}-1", "n", z, float(rng.randrange(100)), 1.0, 2.0))
                weather.append((h * 3600 + rng.randrange(3600), z, float(rng.randrange(30)), 0.0, 1.0, 2.0))
    stamp = lambda df: df.withColumn("time", F.timestamp_seconds("s")).drop("s")
    load = stamp(spark.createDataFrame(load, "s long, zone string, source string, demand_mw double"))
    load = load.withColumns({c: F.lit(None).cast(LOAD[c].dataType) for c in LOAD.fieldNames()[4:]}).select(*LOAD.fieldNames())
    lmp = stamp(spark.createDataFrame(lmp, "s long, pnode_id string, pnode_name string, zone string, lmp double, congestion_price double, marginal_loss_price double"))
    weather = stamp(spark.createDataFrame(weather, "s long, zone string, temperature double, precipitation double, wind_speed double, cloud_cover double"))
    return load, lmp.select(*LMP.fieldNames()), weather.select(*WEATHER.fieldNames())


def _same(a: Warehouse, b: Warehouse, names=SCHEMAS):
    for name in names:
        x, y = a.read(name), b.read(name)
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, name


def test_incremental_lags_on_series_with_gaps(spark, tmp_path):
    """Rows that 15 days do not hold are read from further back, and only those dates."""
    raw = _series(spark, 1)
    step, whole = (Warehouse(spark, str(tmp_path / n), ["A", "B", "C"]) for n in ("step", "whole"))
    for until in ("1970-02-15", "1970-02-17", "1970-03-02"):
        step.build(*[df.filter(F.col("time") < F.lit(until).cast("timestamp")) for df in raw])
    read = step._history({"1970-02-20"})
    oldest = min(f.split("date=")[1][:10] for f in read.inputFiles())
    assert "1970-01-01" < oldest < "1970-01-25"  # 168 rows of the sparse zone, a fifth of the hours
    whole.build(*raw, full_refresh=True)
    step.build(*raw)
    _same(step, whole)


@pytest.mark.parametrize("mode", ["row", "time"])
def test_tables_follow_revisions_however_old(spark, tmp_path, monkeypatch, mode):
    load, lmp, weather = _series(spark, 2)
    raw = {n: str(tmp_path / n) for n in ("load", "lmp", "weather")}
    for n, df in (("load", load), ("lmp", lmp), ("weather", weather)):
        tables.write_table(df, raw[n])
    house = Warehouse(spark, str(tmp_path / "house"), ["A", "B", "C"], lag_mode=mode)
    house.refresh(**raw)
    on = lambda day: F.to_date("time") == F.lit(day).cast("date")
    # 40 days back: values change, rows come and rows go
    some = load.filter(on("1970-01-19")).withColumn("demand_mw", F.col("demand_mw") + 5000)
    new = load.filter(on("1970-01-20") & (F.col("zone") == "A")).withColumn("zone", F.lit("C"))
    tables.merge_table(spark, raw["load"], LOAD, some.unionByName(new).dropDuplicates(KEYS), KEYS)
    tables.replace_dates(spark, raw["lmp"], lmp.filter(on("1970-02-01") & (F.hour("time") < 3)), {"1970-02-01"})
    tables.append_batch(weather.filter(on("1970-02-03")).withColumn("temperature", F.lit(99.0)), raw["weather"], "late")
    seen = []
    read = tables._read
    monkeypatch.setattr(tables, "_read", lambda s, p, sc, parts, *a: seen.append((Path(p).name, {d for d, _ in parts})) or read(s, p, sc, parts, *a))
    house.refresh(**raw)
    monkeypatch.setattr(tables, "_read", read)
    again = Warehouse(spark, str(tmp_path / "again"), ["A", "B", "C"], lag_mode=mode)
    again.refresh(**raw)
    _same(house, again)
    assert house.read("features").filter("demand_mw > 5000").count() > 0
    assert house.remade["lmp_features"] == {"1970-02-01"} and house.remade["weather_features"] == {"1970-02-03", "1970-02-04"}
    assert "1970-02-03" in house.remade["features"] and "1970-01-18" not in house.remade["features"]
    assert not [d for n, dates in seen if n in ("features", "load", "lmp", "weather") for d in dates if d in ("1970-01-05", "1970-02-20")]
    house.refresh(**raw)
    assert not any(house.remade.values())
