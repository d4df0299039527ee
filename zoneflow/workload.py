"""Registered queries: each operator over the driver's tables, whole."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow import fixtures as fx
from zoneflow import session
from zoneflow.functions import calendar, clock, codec, display, numbers
from zoneflow.operators import merge, metrics, profile, quality, stations, territory
from zoneflow.operators.series import day_index
from zoneflow.plans import features as feats
from zoneflow.plans import model, serve, staging
from zoneflow.plans.build import SCHEMAS, Warehouse
from zoneflow.schemas import CONTRACTS, FACILITY_COORDS, FACILITY_DATES, FACILITY_TEXT, HORIZONS, LMP, LOAD, MESSAGE, SOURCES, STATION_SEED, TOTAL_ZONE, WEATHER, WEATHER_COLS
from zoneflow.sources import files, tables
from zoneflow.streaming import hourly, ingest, shaping

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name; timestamps come out naive, as in the oracle."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fx.naive(fn(session.configure(spark), sf_dir))

    QUERIES[fn.__name__] = run
    return fn


_STATION = {"zone": ("stations", "zone_id")}
#: The data contract of the built tables.
TABLE_TESTS = {
    "stg_load": quality.TableTests(("time", "zone", "source", "demand_mw"), accepted={"zone": [*fx.ZONES, TOTAL_ZONE], "source": SOURCES}),
    "stg_lmp": quality.TableTests(("time", "pnode_id", "zone"), ("time", "pnode_id"), parents=_STATION),
    "stg_weather": quality.TableTests(("time", "zone"), parents=_STATION),
    "load_features": quality.TableTests(("time", "zone", "demand_mw"), ("time", "zone"), parents=_STATION),
    "lmp_features": quality.TableTests(("time", "zone"), ("time", "zone"), parents=_STATION),
    "weather_features": quality.TableTests(("time", "zone", "observation_count"), ("time", "zone"), parents=_STATION),
    "features": quality.TableTests(("time", "zone", "demand_mw"), ("time", "zone"), parents=_STATION),
}


# --- inputs the queries share ---------------------------------------------------------


def _stg_load(s: SparkSession, d: str) -> DataFrame:
    return staging.stg_load(fx.load(s, d))


def _load_features(s: SparkSession, d: str, **kw) -> DataFrame:
    """From a written base and its written day index, so that each is made once and Spark sees their sizes."""
    base = session.materialize(feats.modelled_load(_stg_load(s, d), fx.ZONES).withColumn("source", F.lit("pjm")), "base")
    return feats.load_features(base, fx.ZONES, index=session.materialize(day_index(base, "zone"), "days"), **kw)


def _stg_lmp(s: SparkSession, d: str) -> DataFrame:
    return staging.stg_lmp(fx.lmp(s, d), fx.ZONES)


def _stg_weather(s: SparkSession, d: str) -> DataFrame:
    return staging.stg_weather(fx.weather(s, d), fx.ZONES)


def _features(s: SparkSession, d: str) -> DataFrame:
    return feats.features(
        _load_features(s, d),
        feats.lmp_features(_stg_lmp(s, d)),
        feats.weather_features(_stg_weather(s, d)),
    )


def _predictions(s: SparkSession, d: str) -> DataFrame:
    """Of the newest rows, read from the dates that hold them."""
    path = _feature_path(s, d)
    return serve.predict(serve.latest_stored(s, path, SCHEMAS["features"]), serve.baseline_predictor)


def _feature_path(s: SparkSession, d: str) -> str:
    path = session.scratch(s, "features")
    tables.write_table(_features(s, d), path)
    return path


def _feature_table(s: SparkSession, d: str) -> DataFrame:
    """The feature table as its readers find it: written by date, with its `date`."""
    return tables.read_table(s, _feature_path(s, d), SCHEMAS["features"])


def _feature_rows(s: SparkSession, d: str) -> DataFrame:
    return _feature_table(s, d).drop(tables.DATE)


def _system_history(s: SparkSession, d: str) -> DataFrame:
    return serve.system_history(_feature_table(s, d), serve.baseline_predictor, fx.as_of())


def _scored(s: SparkSession, d: str) -> DataFrame:
    """Labelled rows with the persistence forecast, one row per horizon."""
    table = session.materialize(_load_features(s, d), "load-features")
    labelled = model.with_longest_lag(feats.build_labels(table))
    frame = model.with_split(labelled, test_days=7, val_days=7, newest=model.newest_time(table))
    forecast = {1: F.col("demand_lag_72h"), 24: F.round("demand_roll_24h"), 72: F.col("demand_lag_168h")}
    rows = [
        F.struct(F.lit(h).alias("horizon_h"), F.col(f"y_{h}h").alias("actual"), forecast[h].alias("pred"))
        for h in HORIZONS
    ]
    return frame.select("time", "zone", "split", F.inline(F.array(*rows)))


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Sums of fractions depend on their order in the last digits."""
    return df.withColumns({c: F.round(c, digits) + 0.0 for c in columns})


# --- staging and feature models -------------------------------------------------------


@query
def features_flagship(s: SparkSession, d: str) -> DataFrame:
    return _features(s, d)


@query
def stg_load(s: SparkSession, d: str) -> DataFrame:
    return _stg_load(s, d)


@query
def stg_lmp(s: SparkSession, d: str) -> DataFrame:
    return _stg_lmp(s, d)


@query
def stg_weather(s: SparkSession, d: str) -> DataFrame:
    return _stg_weather(s, d)


@query
def load_features(s: SparkSession, d: str) -> DataFrame:
    return _load_features(s, d)


@query
def load_features_time_lag(s: SparkSession, d: str) -> DataFrame:
    return _load_features(s, d, lag_mode="time")


@query
def lmp_features(s: SparkSession, d: str) -> DataFrame:
    return feats.lmp_features(_stg_lmp(s, d))


@query
def weather_features(s: SparkSession, d: str) -> DataFrame:
    return feats.weather_features(_stg_weather(s, d))


# --- shaping of raw feeds -------------------------------------------------------------


@query
def load_area_rollup(s: SparkSession, d: str) -> DataFrame:
    return fx.load_pjm(s, d)


@query
def eia_pjm_union(s: SparkSession, d: str) -> DataFrame:
    return fx.load(s, d)


@query
def load_totals(s: SparkSession, d: str) -> DataFrame:
    areas = fx.load_areas(s, d)
    return areas.groupBy(F.col("Interval End").alias("time"), F.col("Zone").alias("zone")).agg(
        F.sum("MW").alias("demand_mw")
    )


@query
def station_composite(s: SparkSession, d: str) -> DataFrame:
    return shaping.station_composite(fx.station_readings(s, d), ["poll"])


@query
def composite_by_time(s: SparkSession, d: str) -> DataFrame:
    readings = fx.station_readings(s, d).select(F.col("poll").alias("time"), "zone", *WEATHER_COLS)
    return shaping.composite_by_time(readings)


@query
def lmp_zone_lookup(s: SparkSession, d: str) -> DataFrame:
    return shaping.lmp(fx.lmp_raw(s, d), fx.ZONE_LOCATION)


@query
def lmp_lookup_table(s: SparkSession, d: str) -> DataFrame:
    located = fx.zone_dim(s, d).select(
        F.col("zone_id").alias("zone"), F.upper(F.substring("zone_id", 1, 3)).alias("location")
    )
    return shaping.lmp_by_lookup(fx.lmp_raw(s, d), session.materialize(located.distinct(), "locations"))


# --- keyed writes ---------------------------------------------------------------------


@query
def upsert_last_wins(s: SparkSession, d: str) -> DataFrame:
    """All messages in two batches; keys of the first come again in the second."""
    rows = fx.lmp_messages(s, d)
    first, second = rows.filter("congestion_price < 20"), rows.filter("congestion_price >= 20")
    keys = ["time", "pnode_id"]
    target = staging.last_per_key(first, keys, "offset").drop("offset")
    return merge.keyed_upsert(target, second, keys, order_col="offset")


@query
def partial_upsert(s: SparkSession, d: str) -> DataFrame:
    keys = ["time", "zone", "source"]
    target = staging.last_per_key(fx.load_stream_rows(s, d), keys, "offset").drop("offset")
    batch = fx.load(s, d)
    return merge.keyed_upsert(target, batch, keys, update_cols=["demand_mw", "is_verified"])


@query
def dedupe_first(s: SparkSession, d: str) -> DataFrame:
    return staging.first_per_key(fx.lmp_messages(s, d), ["time", "pnode_id"], "offset")


CUT = "2024-01-26 00:00:00"


@query
def delete_insert_incremental(s: SparkSession, d: str) -> DataFrame:
    """A run over the data before a cut, then an incremental run over all of it. The first
    result is a written table, and its high-water mark a constant, as in a build."""
    stg = _stg_load(s, d)
    before = feats.load_features(stg.filter(F.col("time") < clock.utc_literal(CUT)), fx.ZONES)
    old = session.materialize(before, "load-features")
    newest = tables.newest_time(old)
    new = feats.load_features(
        stg, fx.ZONES, read_since=clock.minus_days(newest, 15), write_since=clock.minus_days(newest, 8)
    )
    return merge.incremental_merge(old, new, ["time", "zone"])


@query
def weather_incremental(s: SparkSession, d: str) -> DataFrame:
    """Delete and insert on a key that repeats in the source: repeats in the slice stay."""
    weather = fx.weather(s, d).withColumn("time", clock.hour_start("time"))
    before = staging.stg_weather(weather.filter(F.col("time") < clock.utc_literal(CUT)), fx.ZONES)
    old = session.materialize(before, "stg-weather")
    newest = tables.newest_time(old)
    new = staging.stg_weather(weather, fx.ZONES, since=clock.minus_days(newest, 1))
    return merge.incremental_merge(old, new, ["time", "zone"])


RESTATIONED = ["click", "view"]


def _restationed(s: SparkSession, d: str) -> DataFrame:
    readings = fx.station_readings(s, d).select(F.col("poll").alias("time"), "zone", *WEATHER_COLS)
    return shaping.composite_by_time(readings.filter(F.col("zone").isin(RESTATIONED)))


@query
def replace_zones(s: SparkSession, d: str) -> DataFrame:
    return merge.replace_zones(fx.weather(s, d), _restationed(s, d), RESTATIONED)


def _hour_grid(s: SparkSession, d: str) -> DataFrame:
    """Every hour from the first to the last reading, for every zone of the data."""
    per_zone = fx.events(s, d).groupBy(F.col("event_type").alias("zone"))
    spans = per_zone.agg(clock.hour_start(F.min("ts")).alias("a"), clock.hour_start(F.max("ts")).alias("b"))
    return spans.select(F.explode(clock.hours_between("a", "b")).alias("time"), "zone")


@query
def backfill_absent_hours(s: SparkSession, d: str) -> DataFrame:
    values = {c: F.hour("time").cast("double") for c in WEATHER_COLS}
    return merge.absent_hours(fx.weather(s, d), _hour_grid(s, d).withColumns(values))


@query
def hour_grid_gaps(s: SparkSession, d: str) -> DataFrame:
    """Hours of the grid without a load row, per zone."""
    load = fx.load_pjm(s, d).select("time", "zone")
    grid = _hour_grid(s, d).withColumn("time", clock.plus_hours("time", 1))
    return grid.join(load, ["time", "zone"], "left_anti")


@query
def snapshot_latest(s: SparkSession, d: str) -> DataFrame:
    return tables.latest_snapshot(fx.facility_snapshots(s, d))


@query
def snapshot_history(s: SparkSession, d: str) -> DataFrame:
    """Status of each facility in its first and last snapshot."""
    order = F.struct("synced_at", "row_id")
    return fx.facility_snapshots(s, d).groupBy("facility_id").agg(
        F.min_by("status", order).alias("first_status"),
        F.max_by("status", order).alias("last_status"),
        F.count_distinct("synced_at").alias("n_snapshots"),
    )


# --- messages -------------------------------------------------------------------------


@query
def keyed_messages(s: SparkSession, d: str) -> DataFrame:
    return codec.encode_messages(fx.load(s, d), "zone", LOAD.fieldNames())


@query
def message_rows(s: SparkSession, d: str) -> DataFrame:
    decoded = codec.decode_messages(fx.load_messages(s, d), CONTRACTS["load"])
    return codec.split_valid(decoded, CONTRACTS["load"])[0]


@query
def dlq_split(s: SparkSession, d: str) -> DataFrame:
    decoded = codec.decode_messages(fx.load_messages(s, d), CONTRACTS["load"])
    return codec.split_valid(decoded, CONTRACTS["load"])[1]


#: Files that hold a stretch of a log, and that a micro-batch takes.
FILES = 4


def _in_order(rows: DataFrame, by: str, path: str, parts: int = 3) -> None:
    """A log in stretches, one after the other, as a file stream takes the older files first. A stretch is
    FILES files, each a range of the order: no task writes a stretch alone."""
    number = F.unix_micros(by) if by == "time" else F.col(by)
    rows = session.materialize(rows, "log")
    low, high = rows.agg(F.min(number), F.max(number)).first()
    share = F.least(F.floor((number - low) * parts / (high - low + 1)), F.lit(parts - 1))
    for k in range(parts):
        rows.filter(share == k).repartitionByRange(FILES, number).write.mode("append").parquet(path)


def _drained(s: SparkSession, messages: DataFrame, topic: str) -> tuple[str, ingest.IngestResult]:
    """Write messages as a topic, drain it into its table in a few batches; the folder of both, the counts."""
    root = session.scratch(s, f"stream-{topic}")
    _in_order(messages, "offset", f"{root}/topic")
    source = ingest.file_source(s, f"{root}/topic", files_per_batch=FILES)
    return root, ingest.drain(source, CONTRACTS[topic], f"{root}/table", f"{root}/dlq", f"{root}/checkpoint")


@query
def stream_upsert(s: SparkSession, d: str) -> DataFrame:
    root, _ = _drained(s, fx.load_messages(s, d), "load")
    return tables.read_table(s, f"{root}/table", LOAD).drop(tables.DATE)


@query
def stream_dead_letters(s: SparkSession, d: str) -> DataFrame:
    root, _ = _drained(s, fx.load_messages(s, d), "load")
    return tables.read_or_empty(s, f"{root}/dlq", MESSAGE).drop(tables.BATCH)


@query
def stream_lmp_upsert(s: SparkSession, d: str) -> DataFrame:
    root, _ = _drained(s, fx.price_messages(s, d), "lmp")
    return tables.read_table(s, f"{root}/table", LMP).drop(tables.DATE)


@query
def stream_weather_append(s: SparkSession, d: str) -> DataFrame:
    root, _ = _drained(s, fx.weather_messages(s, d), "weather")
    return tables.read_appended(s, f"{root}/table", WEATHER).drop(tables.DATE)


def _reading_stream(s: SparkSession, d: str, root: str) -> DataFrame:
    """Weather readings as a stream of several batches."""
    rows = fx.weather(s, d)
    _in_order(rows, "time", f"{root}/readings")
    return s.readStream.schema(rows.schema).option("maxFilesPerTrigger", FILES).parquet(f"{root}/readings")


@query
def stream_weather_hourly(s: SparkSession, d: str) -> DataFrame:
    """Every hour, the open ones too, from sums that each batch adds to."""
    root = session.scratch(s, "stream-hours")
    hourly.upsert_open_hours(_reading_stream(s, d, root), f"{root}/hours", f"{root}/checkpoint")
    return hourly.read_hours(s, f"{root}/hours")


@query
def stream_weather_closed_hours(s: SparkSession, d: str) -> DataFrame:
    """Hours closed by the watermark, which trails the newest reading by a day."""
    root = session.scratch(s, "stream-weather")
    out = hourly.hourly_weather(_reading_stream(s, d, root), "1 day")
    hourly.append_closed_hours(out, f"{root}/hours", f"{root}/checkpoint")
    return s.read.schema(out.schema).parquet(f"{root}/hours")


@query
def drain_counts(s: SparkSession, d: str) -> DataFrame:
    """What a drain of several batches says that it wrote and set aside."""
    done = _drained(s, fx.load_messages(s, d), "load")[1]
    return s.range(1).select(F.lit(done.written).cast("long").alias("written"), F.lit(done.dead_lettered).cast("long").alias("dead_lettered"))


# --- the tables themselves ------------------------------------------------------------


@query
def table_upsert(s: SparkSession, d: str) -> DataFrame:
    """All valid messages in three batches, each with revisions of the ones before."""
    path = session.scratch(s, "table")
    rows = session.materialize(codec.split_valid(codec.decode_messages(fx.load_messages(s, d), CONTRACTS["load"]), CONTRACTS["load"])[0], "rows")
    third = rows.agg(F.max("offset")).first()[0] // 3 + 1
    for k in range(3):
        batch = rows.filter(F.floor(F.col("offset") / third) == k)
        tables.upsert_table(s, path, LOAD, batch, ["time", "zone", "source"], "offset")
    return tables.read_table(s, path, LOAD).drop(tables.DATE)


@query
def table_partial_upsert(s: SparkSession, d: str) -> DataFrame:
    path, keys = session.scratch(s, "table"), ["time", "zone", "source"]
    tables.upsert_table(s, path, LOAD, fx.load_stream_rows(s, d), keys, "offset")
    tables.upsert_table(s, path, LOAD, fx.load(s, d), keys, update_cols=["demand_mw", "is_verified"])
    return tables.read_table(s, path, LOAD).drop(tables.DATE)


@query
def table_replace_zones(s: SparkSession, d: str) -> DataFrame:
    path = session.scratch(s, "table")
    tables.append_batch(fx.weather(s, d), path, "history")
    tables.replace_zones_table(s, path, WEATHER, _restationed(s, d), RESTATIONED, "restationed")
    return tables.read_appended(s, path, WEATHER).drop(tables.DATE)


@query
def table_backfill(s: SparkSession, d: str) -> DataFrame:
    path = session.scratch(s, "table")
    tables.append_batch(fx.weather(s, d), path, "history")
    wanted = _hour_grid(s, d).withColumns({c: F.hour("time").cast("double") for c in WEATHER_COLS})
    for _ in range(2):  # a second run adds nothing
        tables.append_absent_hours(s, path, WEATHER, wanted, "backfill")
    return tables.read_appended(s, path, WEATHER).drop(tables.DATE)


@query
def table_snapshots(s: SparkSession, d: str) -> DataFrame:
    """Every month's snapshot written to the log, the last one read."""
    path, rows = session.scratch(s, "table"), fx.facility_snapshots(s, d)
    tables.append_snapshot(rows, path, F.col("synced_at"))
    return tables.read_latest_snapshot(s, path, rows.drop("synced_at").schema)


def _house(s: SparkSession, d: str, *until: str) -> Warehouse:
    house = Warehouse(s, session.scratch(s, "house"), fx.ZONES)
    raw = [session.materialize(f(s, d), "raw") for f in (fx.load, fx.lmp, fx.weather)]
    for at in until:
        house.build(*[df.filter(F.col("time") < clock.utc_literal(at)) for df in raw])
    house.build(*raw)
    return house


@query
def warehouse_incremental(s: SparkSession, d: str) -> DataFrame:
    """Three builds, the later ones incremental; their features are those of one full build."""
    return _house(s, d, CUT, "2024-01-28 00:00:00").read("features")


@query
def warehouse_revision(s: SparkSession, d: str) -> DataFrame:
    """Raw tables are revised far back; the tables made from them follow, date by date."""
    root = session.scratch(s, "house")
    raw = {n: f"{root}/raw-{n}" for n in ("load", "lmp", "weather")}
    load, lmp, weather = fx.load(s, d), fx.lmp(s, d), fx.weather(s, d)
    house = Warehouse(s, root, fx.ZONES)
    for n, df in (("load", load), ("lmp", lmp), ("weather", weather)):
        tables.append_batch(df, raw[n], "history")
    house.refresh(**raw)
    on = lambda day: F.to_date("time") == F.lit(day).cast("date")
    revised = load.filter(on("2024-01-10") & (F.col("source") == "pjm")).withColumn("demand_mw", 2 * F.col("demand_mw") + 1)
    tables.upsert_table(s, raw["load"], tables.with_batch(LOAD), revised.withColumn(tables.BATCH, F.lit("revised")), ["time", "zone", "source"])
    dearer = lmp.filter(on("2024-01-12")).withColumn("lmp", F.col("lmp") + 100)
    tables.upsert_table(s, raw["lmp"], tables.with_batch(LMP), dearer.withColumn(tables.BATCH, F.lit("revised")), ["time", "pnode_id"])
    late = weather.filter(on("2024-01-14")).withColumns({"time": F.lit("2024-01-14 23:30:00").cast("timestamp"), "temperature": F.lit(5.0)})
    tables.append_batch(late, raw["weather"], "late")
    house.refresh(**raw)
    return house.read("features")


@query
def table_two_writers(s: SparkSession, d: str) -> DataFrame:
    """Two writers at once over the same dates, each with half of the zones' messages."""
    path = session.scratch(s, "table")
    rows = session.materialize(codec.split_valid(codec.decode_messages(fx.load_messages(s, d), CONTRACTS["load"]), CONTRACTS["load"])[0], "rows")
    halves = [rows.filter(F.pmod(F.length("zone"), F.lit(2)) == k) for k in (0, 1)]
    with ThreadPoolExecutor(2) as pool:
        for done in [pool.submit(tables.upsert_table, s, path, LOAD, half, ["time", "zone", "source"], "offset") for half in halves]:
            done.result()
    return tables.read_table(s, path, LOAD).drop(tables.DATE)


@query
def contract_report(s: SparkSession, d: str) -> DataFrame:
    """The declared tests over built tables."""
    house = _house(s, d)
    built = {n: house.read(n) for n in TABLE_TESTS} | {"stations": fx.zone_dim(s, d)}
    return quality.contract_report(built, TABLE_TESTS)


@query
def training_rows(s: SparkSession, d: str) -> DataFrame:
    """What the models are trained on, by zone: rows, labels, known inputs."""
    frame = model.training_frame(_feature_rows(s, d))
    named = {"n_1h": "y_1h", "n_24h": "y_24h", "n_72h": "y_72h", "n_temperature": "temperature", "n_price": "lmp_total_lag_48h"}
    return frame.groupBy("zone").agg(F.count("*").alias("n"), *[F.count(c).alias(n) for n, c in named.items()], F.sum("demand_lag_72h").alias("lag_sum"))


@query
def split_by_date(s: SparkSession, d: str) -> DataFrame:
    return model.split_by_date(fx.order_hours(s, d), clock.utc_literal("1995-03-01 00:00:00"), clock.utc_literal("1996-07-15 12:00:00"))


# --- files ----------------------------------------------------------------------------


@query
def metered_files(s: SparkSession, d: str) -> DataFrame:
    """Metered load as CSV in two folders, each row with its own UTC offset, read as one."""
    root, rows = session.scratch(s, "metered"), fx.load_areas(s, d)
    local = clock.local("Interval End")
    lag = (F.unix_seconds("Interval End") - F.unix_seconds(local)) / 3600
    text = F.concat(F.date_format(local, "yyyy-MM-dd HH:mm:ss"), F.format_string("-%02d:00", lag.cast("int")))
    rows = rows.withColumn("Interval End", text)
    for k in (0, 1):
        files.write_csv(rows.filter(F.col("Load Area") % 2 == k), f"{root}/{k}")
    back = files.read_metered_load(s, [f"{root}/0", f"{root}/1"])
    return back.select(F.col("Interval End").alias("time"), F.col("Zone").alias("zone"), F.col("MW").alias("mw"), F.col("Is Verified").alias("is_verified"))


@query
def station_seed(s: SparkSession, d: str) -> DataFrame:
    path = session.scratch(s, "seed")
    rows = fx.zone_dim(s, d)
    files.write_csv(rows.select(*[rows[c] if c in rows.columns else F.lit(None).cast("string").alias(c) for c in STATION_SEED.fieldNames()]), path)
    return files.read_stations(s, path).select("zone_id", "city")


@query
def facility_sheet(s: SparkSession, d: str) -> DataFrame:
    """A sheet with more columns than are read, quoted text, dates and coordinates that are none."""
    path, k = session.scratch(s, "facilities"), F.col("o_orderkey")
    day = lambda c: F.when(k % 7 == 0, F.lit("TBD")).otherwise(F.date_format(c, "M/d/yyyy"))
    made = {
        "facility_name": F.concat(F.lit("site "), k.cast("string")), "address": F.concat(k.cast("string"), F.lit(' "Old" Mill, Rd')),
        "zip": F.lpad((F.col("o_custkey") % 20000).cast("string"), 5, "0"), "state": F.col("o_orderstatus"), "mw": F.lit("100-200"),
        "lat": F.when(k % 5 == 0, F.lit("n/a")).otherwise((k % 90 + 0.5).cast("string")), "long": F.when(k % 9 == 0, F.lit("NaN")).otherwise((k % 180 - 179.5).cast("string")),
        "date_created": day(F.col("o_orderdate")), "date_updated": F.date_format("o_orderdate", "yyyy-MM-dd"),
    }
    columns = ["notes", *FACILITY_DATES, *FACILITY_TEXT, "contact", *FACILITY_COORDS]
    rows = fx.table(s, d, "orders").select(*[made.get(c, F.lit(None).cast("string")).alias(c) for c in columns])
    rows.write.csv(path, header=True, escape='"')
    sheet = files.read_facilities(s, path, columns)
    return sheet.select("facility_name", "address", "city", "state", "zip", "mw", "lat", "long", "date_created", "date_updated")


@query
def sorted_csv(s: SparkSession, d: str) -> DataFrame:
    path = session.scratch(s, "sorted")
    rows = fx.table(s, d, "customer").select("c_custkey", "c_acctbal")
    files.write_sorted_csv(rows, path, [F.desc("c_acctbal"), "c_custkey"])
    return s.read.schema(rows.schema).csv(path, header=True)


@query
def json_export(s: SparkSession, d: str) -> DataFrame:
    path = session.scratch(s, "json")
    rows = fx.table(s, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    files.write_json(rows, path)
    return s.read.schema(rows.schema).json(path)


@query
def nan_guard(s: SparkSession, d: str) -> DataFrame:
    """Every fifth reading NaN: guarded, it counts and adds like a missing one."""
    rows = fx.order_hours(s, d).withColumn("demand_mw", F.when(F.col("row_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("demand_mw")))
    return numbers.nans_to_null(rows).groupBy("zone").agg(F.count("*").alias("n"), F.count("demand_mw").alias("n_known"), F.sum("demand_mw").alias("total"))


@query
def eastern_to_utc(s: SparkSession, d: str) -> DataFrame:
    """Eastern wall times back to UTC. Of an hour that comes twice the first is meant."""
    rows = fx.order_hours(s, d).select("row_id", clock.local("time").alias("wall"))
    return rows.select("row_id", clock.to_utc("wall").alias("time"))


# --- scalar functions -----------------------------------------------------------------


@query
def calendar_features(s: SparkSession, d: str) -> DataFrame:
    out = calendar.features(fx.order_hours(s, d), drop_time_col=False)
    return _rounded(out, "hour_sin", "hour_cos", "month_sin", "month_cos", digits=9)


@query
def features_without_time(s: SparkSession, d: str) -> DataFrame:
    """The features of the model alone: time is dropped once its parts are taken."""
    out = calendar.features(fx.order_hours(s, d).drop("temperature", "zone", "demand_mw").withColumn("temperature", F.lit(20.0)))
    return out.select("row_id", "is_weekend", "is_peak_hour", F.lit("time" in out.columns).alias("has_time"))


@query
def horizon_labels(s: SparkSession, d: str) -> DataFrame:
    """Hours from the two ways in which horizons are written."""
    h = (F.col("row_id") % 100).cast("string")
    text = F.when(F.col("row_id") % 3 == 0, F.concat(h, F.lit("h"))).otherwise(F.concat(F.lit("y_"), h, F.lit("h")))
    return fx.order_hours(s, d).select("row_id", display.horizon_hours(text).alias("horizon_h"))


@query
def degree_days(s: SparkSession, d: str) -> DataFrame:
    temps = fx.order_hours(s, d).withColumn("temperature", F.when(F.col("row_id") % 5 != 0, F.col("temperature")))
    both = calendar.degree_hours_f(calendar.degree_day_features(temps), "temperature")
    return _rounded(both.select("row_id", "hdd", "cdd", "cdh", "hdh"), "hdd", "cdd")


@query
def horizon_series(s: SparkSession, d: str) -> DataFrame:
    """Stored predictions, one row per horizon at the hour each is for."""
    return serve.by_horizon(serve.baseline_predictor(_load_features(s, d)))


@query
def market_calendar(s: SparkSession, d: str) -> DataFrame:
    out = calendar.market_on_peak_flag(calendar.holiday_flag(fx.order_hours(s, d)))
    return out.select("row_id", "time", "is_holiday", "is_market_on_peak")


@query
def time_functions(s: SparkSession, d: str) -> DataFrame:
    t = F.col("time")
    local = clock.local("time")
    return fx.order_hours(s, d).select(
        "row_id",
        local.alias("eastern"),
        clock.hour_ending(t).alias("hour_ending"),
        clock.minus_months(t, 7).alias("months_back"),
        clock.plus_hours(t, 72).alias("later"),
        clock.from_epoch(F.unix_seconds(t)).alias("from_epoch"),
        clock.iso(t).alias("iso"),
        F.round(clock.age_hours(t, fx.as_of()), 6).alias("age_hours"),
    )


@query
def mixed_offset_parse(s: SparkSession, d: str) -> DataFrame:
    """Eastern wall times written with their changing offset, read back as UTC."""
    eastern = fx.order_hours(s, d).select("row_id", clock.local("time").alias("w"), "time")
    lag = (F.unix_seconds("time") - F.unix_seconds("w")) / 3600
    text = F.concat(
        F.date_format("w", "yyyy-MM-dd HH:mm:ss"), F.format_string("-%02d:00", lag.cast("int"))
    )
    mixed = F.when(F.col("row_id") % 2 == 0, text).otherwise(clock.iso("time"))
    mixed = F.when(F.col("row_id") % 7 == 0, F.lit("n/a")).otherwise(mixed)
    return eastern.select("row_id", clock.parse_mixed_offsets(mixed).alias("time"))


@query
def date_parse(s: SparkSession, d: str) -> DataFrame:
    day = F.date_format("time", "M/d/yyyy")
    text = F.when(F.col("row_id") % 5 == 0, F.lit("TBD")).otherwise(day)
    return fx.order_hours(s, d).select("row_id", clock.parse_us_date(text).alias("day"))


@query
def display_labels(s: SparkSession, d: str) -> DataFrame:
    mw = F.col("demand_mw") / 8
    return fx.order_hours(s, d).select(
        "row_id",
        display.fmt_mw(mw).alias("mw"),
        display.fmt_mw_conditional(mw).alias("mw_conditional"),
        display.eastern_label("time").alias("label"),
        display.c_to_f("temperature").alias("temp_f"),
        F.round(display.kmh_to_mph("temperature"), 6).alias("mph"),
    )


@query
def weather_condition(s: SparkSession, d: str) -> DataFrame:
    hours = feats.weather_features(_stg_weather(s, d))
    condition = display.weather_condition("temperature", "precipitation", "cloud_cover")
    return hours.select(
        "time", "zone", condition.alias("condition"), display.condition_label(condition).alias("condition_label")
    )


# --- labels, splits, metrics, promotion -----------------------------------------------


@query
def labels(s: SparkSession, d: str) -> DataFrame:
    return feats.build_labels(feats.modelled_load(_stg_load(s, d), fx.ZONES))


@query
def split_counts(s: SparkSession, d: str) -> DataFrame:
    table = session.materialize(_load_features(s, d), "load-features")
    frame = model.with_split(table, test_days=7, val_days=7)
    return frame.groupBy("split", "zone").agg(F.count("*").alias("n"), F.min("time").alias("first_time"))


@query
def split_months(s: SparkSession, d: str) -> DataFrame:
    frame = model.with_split(fx.order_hours(s, d))
    return frame.groupBy("split").agg(
        F.count("*").alias("n"), F.min("time").alias("first_time"), F.max("time").alias("last_time")
    )


@query
def split_by_days(s: SparkSession, d: str) -> DataFrame:
    return model.split_by_days(fx.order_hours(s, d), "1997-01-01", "1998-12-31")


@query
def eval_metrics(s: SparkSession, d: str) -> DataFrame:
    out = metrics.evaluate(_scored(s, d), "actual", "pred", ["horizon_h", "split"])
    return _rounded(out, "rmse", "mae", "r2")


@query
def zone_metrics(s: SparkSession, d: str) -> DataFrame:
    test = _scored(s, d).filter(F.col("split") == "test")
    return _rounded(metrics.zone_metrics(test, "actual", "pred", "horizon_h"), "mae", "mape")


@query
def promotion(s: SparkSession, d: str) -> DataFrame:
    """Registry: the 72 h forecast of each zone; challengers: its 24 h forecast. The zone with
    the best 72 h forecast has no champion yet."""
    rmse = metrics.evaluate(_scored(s, d), "actual", "pred", ["zone", "horizon_h"])
    rmse = session.materialize(rmse.filter(F.col("rmse").isNotNull()), "rmse")
    row = [F.col("zone").alias("name"), F.lit(1).alias("version"), F.lit(model.PRODUCTION).alias("stage")]
    long = rmse.filter("horizon_h = 72")
    registry = long.filter(F.col("rmse") > long.agg(F.min("rmse")).scalar()).select(*row, "rmse")
    row[1:] = [F.lit(2).alias("version"), F.lit(model.STAGING).alias("stage")]
    candidates = rmse.filter(F.col("horizon_h") == 24).select(*row, "rmse")
    return _rounded(model.promote(registry, candidates), "rmse")


@query
def run_record(s: SparkSession, d: str) -> DataFrame:
    table = session.materialize(_load_features(s, d), "load-features")
    frame = model.with_split(model.with_longest_lag(table), test_days=7, val_days=7)
    return model.run_record(frame, "v1", "features", fx.as_of())


# --- read queries ---------------------------------------------------------------------


@query
def latest_per_zone(s: SparkSession, d: str) -> DataFrame:
    return serve.latest_stored(s, _feature_path(s, d), SCHEMAS["features"])


@query
def latest_one_zone(s: SparkSession, d: str) -> DataFrame:
    return serve.latest_stored(s, _feature_path(s, d), SCHEMAS["features"], "view")


@query
def one_zone_rows(s: SparkSession, d: str) -> DataFrame:
    """All rows of one zone, from the files that hold it."""
    return tables.read_table(s, _feature_path(s, d), SCHEMAS["features"], ["view"]).drop(tables.DATE)


@query
def features_window(s: SparkSession, d: str) -> DataFrame:
    return serve.ordered(serve.features_window(_features(s, d), fx.as_of(), 48))


@query
def recent_peak(s: SparkSession, d: str) -> DataFrame:
    return serve.peak_stored(s, _feature_path(s, d), SCHEMAS["features"], fx.as_of(), 30)


@query
def recent_peak_week(s: SparkSession, d: str) -> DataFrame:
    """A window that begins within a date."""
    at = clock.minus_days(fx.as_of(), 0) - F.expr("interval 7 hours")
    return serve.peak_stored(s, _feature_path(s, d), SCHEMAS["features"], at, 7)


@query
def freshness(s: SparkSession, d: str) -> DataFrame:
    path = session.scratch(s, "load-features")
    tables.write_table(_load_features(s, d), path)
    return serve.freshness_stored(s, path, fx.as_of())


@query
def predictions(s: SparkSession, d: str) -> DataFrame:
    return _predictions(s, d)


@query
def predictions_weather_join(s: SparkSession, d: str) -> DataFrame:
    scored = serve.baseline_predictor(_load_features(s, d)).select("time", "zone", *serve.LABELS)
    return serve.attach_weather(scored, feats.weather_features(_stg_weather(s, d)))


@query
def history_alignment(s: SparkSession, d: str) -> DataFrame:
    return serve.history(_feature_table(s, d), serve.baseline_predictor, fx.as_of(), 144)


@query
def horizon_accuracy(s: SparkSession, d: str) -> DataFrame:
    return _rounded(serve.accuracy(_system_history(s, d)), "mae", "mape")


@query
def system_totals(s: SparkSession, d: str) -> DataFrame:
    return metrics.system_totals(_system_history(s, d))


@query
def drilldown_system(s: SparkSession, d: str) -> DataFrame:
    return serve.drilldown(_system_history(s, d), fx.as_of(), 24)


@query
def drilldown_zone(s: SparkSession, d: str) -> DataFrame:
    return serve.ordered(serve.drilldown(_system_history(s, d), fx.as_of(), 72, "click"))


@query
def weather_summary(s: SparkSession, d: str) -> DataFrame:
    preds = serve.predictions(_feature_table(s, d), serve.baseline_predictor)
    both = serve.weather_summary(preds).unionByName(serve.weather_summary(preds, "view"))
    return _rounded(both, *WEATHER_COLS, "temp_f", "wind_mph")


@query
def load_ratio(s: SparkSession, d: str) -> DataFrame:
    feature_rows = _feature_table(s, d)
    preds = serve.predictions(feature_rows, serve.baseline_predictor)
    peaks = serve.recent_peak(feature_rows, fx.as_of())
    return _rounded(serve.load_ratio(preds, peaks, fx.zone_dim(s, d), 24), "load_ratio", "heat")


@query
def zone_ranking(s: SparkSession, d: str) -> DataFrame:
    return serve.zone_table(_predictions(s, d), 24)


@query
def top_zones(s: SparkSession, d: str) -> DataFrame:
    return serve.top_zones(_predictions(s, d), 1, 3)


@query
def top_zone_series(s: SparkSession, d: str) -> DataFrame:
    table = _feature_table(s, d)
    hist = serve.system_history(table, serve.baseline_predictor, fx.as_of())
    preds = serve.predictions(table, serve.baseline_predictor)
    return serve.ordered(serve.top_zone_series(hist, preds, 24, 2))


# --- quality and profiles -------------------------------------------------------------


@query
def null_audit(s: SparkSession, d: str) -> DataFrame:
    return quality.null_audit(_features(s, d))


@query
def dq_report(s: SparkSession, d: str) -> DataFrame:
    load, lmp, weather = fx.load(s, d), _stg_lmp(s, d), fx.weather(s, d)
    stations_dim = fx.zone_dim(s, d)
    return quality.report(
        [
            quality.row_checks(
                load,
                not_null=["time", "zone", "source", "demand_mw"],
                accepted={"zone": [*fx.ZONES, TOTAL_ZONE], "source": SOURCES},
            ),
            quality.unique_keys(lmp, ["time", "pnode_id"]),
            quality.unique_keys(weather, ["time", "zone"]),
            quality.unique_keys(stations_dim, ["zone_id", "city"]),
            quality.relationship(lmp, "zone", stations_dim, "zone_id"),
            quality.relationship(weather, "zone", stations_dim, "zone_id"),
        ]
    )


@query
def dq_outside_values(s: SparkSession, d: str) -> DataFrame:
    return quality.outside_values(fx.load(s, d), "zone", [*fx.ZONES, TOTAL_ZONE])


@query
def dq_duplicates(s: SparkSession, d: str) -> DataFrame:
    return quality.duplicate_keys(fx.lmp_messages(s, d), ["time", "pnode_id"])


@query
def dq_freshness(s: SparkSession, d: str) -> DataFrame:
    at = fx.as_of()
    frames = [quality.freshness(f(s, d), n, at) for n, f in (("load", fx.load), ("lmp", fx.lmp), ("weather", fx.weather))]
    return _rounded(quality.report(frames), "age_hours")


@query
def dq_key_sync(s: SparkSession, d: str) -> DataFrame:
    observed = fx.load(s, d).select("zone")
    declared = fx.zone_dim(s, d).select(F.col("zone_id").alias("zone"))
    return quality.key_mismatch(observed, declared, "zone")


@query
def sparse_hours(s: SparkSession, d: str) -> DataFrame:
    return quality.sparse_hours(feats.weather_features(_stg_weather(s, d)))


@query
def source_profile(s: SparkSession, d: str) -> DataFrame:
    return profile.source_profile(fx.load(s, d))


@query
def run_profile(s: SparkSession, d: str) -> DataFrame:
    return profile.run_profile(fx.load_pjm(s, d))


@query
def value_counts(s: SparkSession, d: str) -> DataFrame:
    return profile.value_counts(fx.lmp_messages(s, d), "pnode_name")


@query
def value_counts_known(s: SparkSession, d: str) -> DataFrame:
    return profile.value_counts(fx.lmp_messages(s, d), "pnode_name", keep_null=False)


@query
def distinct_zones(s: SparkSession, d: str) -> DataFrame:
    return profile.distinct_zones(fx.load(s, d))


NUMERIC = ["demand_lag_72h", "demand_lag_168h", "temperature", "precipitation", "wind_speed", "cloud_cover"]


@query
def corr_matrix(s: SparkSession, d: str) -> DataFrame:
    return _rounded(profile.correlation(_features(s, d), ["demand_mw", *NUMERIC]), "corr")


@query
def binned_mi(s: SparkSession, d: str) -> DataFrame:
    return _rounded(profile.binned_mi(_feature_rows(s, d), "demand_mw", NUMERIC, ["zone"]), "mi")


@query
def information_ranking(s: SparkSession, d: str) -> DataFrame:
    mi = profile.binned_mi(_feature_rows(s, d), "demand_mw", NUMERIC, ["zone"])
    return profile.information_ranking(_rounded(mi, "mi"))


# --- stations and territories ---------------------------------------------------------


def _candidates(s: SparkSession, d: str) -> DataFrame:
    return fx.candidate_temps(s, d).withColumnRenamed("zone_id", "zone")


def _station_list(s: SparkSession, d: str) -> DataFrame:
    return session.materialize(_candidates(s, d).select("zone", "city").distinct(), "stations")


def _subset_scores(s: SparkSession, d: str) -> DataFrame:
    load = fx.load_pjm(s, d).select("time", "zone", "demand_mw")
    return stations.score_subsets(_candidates(s, d), load, _station_list(s, d))


@query
def station_pivot(s: SparkSession, d: str) -> DataFrame:
    return stations.station_pivot(_candidates(s, d), _station_list(s, d))


@query
def station_subsets(s: SparkSession, d: str) -> DataFrame:
    return stations.station_subsets(_station_list(s, d)).select("zone", "mask", "n", "stations")


@query
def subset_observations(s: SparkSession, d: str) -> DataFrame:
    load = fx.load_pjm(s, d).select("time", "zone", "demand_mw")
    return _rounded(stations.subset_observations(_candidates(s, d), load, _station_list(s, d)), "c", "h")


@query
def station_subset_scores(s: SparkSession, d: str) -> DataFrame:
    return _rounded(_subset_scores(s, d), "partial_r2")


@query
def best_station_subsets(s: SparkSession, d: str) -> DataFrame:
    return _rounded(stations.best_subsets(_subset_scores(s, d)), "single_r2", "composite_r2", "gain")


def _cells(s: SparkSession, d: str) -> DataFrame:
    return territory.rasterise(territory.edges(fx.territories(s, d)))


@query
def territory_cells(s: SparkSession, d: str) -> DataFrame:
    return _cells(s, d)


@query
def territory_area(s: SparkSession, d: str) -> DataFrame:
    return territory.entity_area(_cells(s, d))


def _land(cells: DataFrame) -> DataFrame:
    """Cells of the plane's land: all but diagonal strips of water."""
    return cells.select(*territory.CELL).distinct().filter((F.col("cell_x") + F.col("cell_y")) % 50 != 0)


def _owned(s: SparkSession, d: str) -> DataFrame:
    cells = session.materialize(_cells(s, d), "cells")
    return territory.assign_territories(
        fx.territories(s, d), cells, fx.territory_lookup(s, d), _land(cells), minor_km2=150.0
    )


@query
def territory_assign(s: SparkSession, d: str) -> DataFrame:
    return _owned(s, d)


@query
def territory_points(s: SparkSession, d: str) -> DataFrame:
    return territory.zone_of_points(fx.facility_points(s, d), _owned(s, d), "x", "y")


# --- the trained model ----------------------------------------------------------------


@query
def gbt_forecast(s: SparkSession, d: str) -> DataFrame:
    """Train one model per horizon on the feature table, then forecast the latest rows."""
    table = _feature_rows(s, d)
    frame = session.materialize(
        model.with_split(
            model.training_frame(table), test_days=7, val_days=7, newest=model.newest_time(table)
        ),
        "training",
    )
    models, _ = model.train_all(frame)
    return serve.predictions(table, model.model_predictor(models))
