"""Time-partitioned Parquet tables and the keyed writers over them.

A table is a folder of written folders, `v=<name>/date=<UTC date of time>/`, and of commits. A commit
is one small file, written last, that names the folders that make up the table; what no commit names
is not there. So a run that dies leaves nothing that any later reader or writer would see. Every key
holds `time`, so the rows a merge can touch live in the dates of the incoming batch: only those are
read and rewritten, once.

Writers may meet. Each writes folders of its own name, then tries to commit the next number; the one
that loses looks at which dates have moved meanwhile, makes its rows of those dates again from the
newer state, and tries again. Its other folders stay as they are. The result is that of one order of
the writers. Readers keep the state they began with until two commits later.

Beside each written folder lies its index: per date, file, zone and source the number of rows, the
first and last time and the largest demand. It is as long as the calendar times the zones, and read
by the driver. A commit also holds the date of each zone's newest row, the last commit that rewrote
each date, and which commits of other tables this one has taken in.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from functools import lru_cache

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.operators import merge
from zoneflow.session import materialize

DATE = "date"
BATCH = "batch_id"
VERSION = "v"
_COMMITS, _INDEX = "_commits", "_index.json"
#: Times a writer that was overtaken tries again.
ATTEMPTS = 50
#: Rows of a file. A date's rows are sorted by zone first, so its files hold runs of zones.
ROWS_PER_FILE = 1_000_000


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_small(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A file that is there whole or not at all, and never replaced: the second of two writers gets an error."""
    fs, target = _fs(spark, path)
    _, part = _fs(spark, f"{path}.{uuid.uuid4().hex}.part")
    stream = fs.create(part, True)
    stream.write(text.encode())
    stream.close()
    taken = FileExistsError(f"{path} is there already: another writer committed")
    try:
        if fs.exists(target):
            raise taken
        hadoop = spark._jvm.org.apache.hadoop.fs
        none = spark._sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        part, target = fs.makeQualified(part), fs.makeQualified(target)
        hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(part, target, none)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.toString():
            raise taken from e
        raise
    finally:
        fs.delete(part, False)


@dataclass
class State:
    """What a commit names: folders as (date, name), the batches that are in, and what is known of the rows."""

    number: int = 0
    parts: list[tuple[str, str]] = field(default_factory=list)
    batches: list[str] = field(default_factory=list)
    runs: dict[str, int] = field(default_factory=dict)
    #: Of each zone the date of its newest row.
    zones: dict[str, str] = field(default_factory=dict)
    #: Of each date that was ever rewritten the last commit that did so.
    moved: dict[str, int] = field(default_factory=dict)
    #: Of each table that this one is made from the last commit that is taken in.
    seen: dict[str, int] = field(default_factory=dict)

    def has(self, batch_id: str) -> bool:
        m = re.fullmatch(r"(.*)-(\d+)", batch_id)
        return self.runs.get(m[1], -1) >= int(m[2]) if m else batch_id in self.batches

    def add(self, batch_id: str | None) -> None:
        """Numbered batches of a run come in order, so the last number stands for all before it."""
        if batch_id is None or self.has(batch_id):
            return
        if m := re.fullmatch(r"(.*)-(\d+)", batch_id):
            self.runs[m[1]] = int(m[2])
        else:
            self.batches.append(batch_id)

    def dates(self) -> list[str]:
        return sorted({d for d, _ in self.parts})


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[:-5]) for n in _names(spark, f"{path}/{_COMMITS}") if re.fullmatch(r"\d+\.json", n))


def _state_at(spark: SparkSession, path: str, number: int) -> State:
    said = json.loads(read_small(spark, f"{path}/{_COMMITS}/{number:08d}.json"))
    return State(number, [tuple(p) for p in said.pop("parts")], **said)


def state(spark: SparkSession, path: str) -> State:
    """The newest commit; number 0 for a table that was never written."""
    numbers = _numbers(spark, path)
    return _state_at(spark, path, numbers[-1]) if numbers else State()


def _commit(spark: SparkSession, path: str, new: State) -> None:
    said = {c: getattr(new, c) for c in ("parts", "batches", "runs", "zones", "moved", "seen")}
    write_small(spark, f"{path}/{_COMMITS}/{new.number:08d}.json", json.dumps(said))


def _forget(spark: SparkSession, path: str, before: State, now: State) -> None:
    """Delete commits before the last two, and the folders that only those name. Folders of writers at work are named by none."""
    live = {v for s in (before, now) for _, v in s.parts}
    for number in _numbers(spark, path):
        if number < before.number:
            for folder in {v for _, v in _state_at(spark, path, number).parts} - live:
                _delete(spark, f"{path}/{VERSION}={folder}")
            _delete(spark, f"{path}/{_COMMITS}/{number:08d}.json")


def sweep(spark: SparkSession, path: str, hours: float = 24.0) -> None:
    """Delete folders that no commit names and that nobody has written to for so long: what dead runs left."""
    named = {v for n in _numbers(spark, path) for _, v in _state_at(spark, path, n).parts}
    fs, p = _fs(spark, path)
    for s in fs.listStatus(p) if fs.exists(p) else []:
        name = s.getPath().getName()
        if name.startswith(f"{VERSION}=") and name[2:] not in named and time.time() - s.getModificationTime() / 1000 > hours * 3600:
            _delete(spark, f"{path}/{name}")


# --- the index of a written folder ----------------------------------------------------


@dataclass(frozen=True)
class Entry:
    """Rows of one zone and source in one file of a date; times in microseconds."""

    date: str
    folder: str
    file: str
    zone: str | None
    source: str | None
    n: int
    low: int
    high: int
    top: float | None


def _describe(spark: SparkSession, path: str, folder: str, columns: dict[str, str]) -> None:
    """Write the index of a folder from its key columns. One row for each file, zone and source."""
    known = [T.StructField("time", T.TimestampType())]
    known += [T.StructField(c, t) for c, t in (("zone", T.StringType()), ("source", T.StringType()), ("demand_mw", T.DoubleType())) if c in columns]
    schema = T.StructType([*known, T.StructField(DATE, T.StringType())])
    rows = spark.read.schema(schema).option("basePath", f"{path}/{VERSION}={folder}").parquet(f"{path}/{VERSION}={folder}")
    some = lambda c: F.col(c) if c in columns else F.lit(None).cast("string").alias(c)
    top = F.max("demand_mw") if "demand_mw" in columns else F.lit(None).cast("double")
    micros = F.unix_micros("time")
    found = rows.groupBy(DATE, F.col("_metadata.file_name").alias("file"), some("zone"), some("source")).agg(F.count("*"), F.min(micros), F.max(micros), top)
    write_small(spark, f"{path}/{VERSION}={folder}/{_INDEX}", json.dumps([[str(r[0]), *r[1:]] for r in found.collect()]))


@lru_cache(maxsize=256)
def _index_of(spark: SparkSession, path: str, folder: str) -> tuple[Entry, ...]:
    """A folder is written once, so its index never changes."""
    return tuple(Entry(r[0], folder, *r[1:]) for r in json.loads(read_small(spark, f"{path}/{VERSION}={folder}/{_INDEX}")))


def entries(spark: SparkSession, path: str, parts: list[tuple[str, str]]) -> list[Entry]:
    """The index of these folders' dates, oldest first."""
    wanted = set(parts)
    found = [e for folder in sorted({f for _, f in parts}) for e in _index_of(spark, path, folder) if (e.date, folder) in wanted]
    return sorted(found, key=lambda e: e.date)


def _newest_by_zone(spark: SparkSession, path: str, before: State, parts: list[tuple[str, str]], dates: set[str]) -> dict[str, str]:
    """The date of each zone's newest row, when `dates` were rewritten. Zones whose newest date was among
    them are looked for from the newest date backwards, in ever longer steps."""
    zones = {z: d for z, d in before.zones.items() if d not in dates}
    lost = set(before.zones) - set(zones)

    def look(some: list[str]) -> None:
        wanted = set(some)
        for e in entries(spark, path, [p for p in parts if p[0] in wanted]):
            if e.zone is not None:
                zones[e.zone] = max(e.date, zones.get(e.zone, e.date))

    look(sorted(dates))
    left, step = sorted({d for d, _ in parts} - dates), 8
    while left and any(zones.get(z, "") < left[-1] for z in lost):
        look(left[-step:])
        left, step = left[:-step], 2 * step
    return zones


def _nullable(schema: T.StructType, *extra: T.StructField) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields] + list(extra))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A plain folder under a declared schema; an empty frame before the first write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
            raise
        return spark.createDataFrame([], schema)


def _read(
    spark: SparkSession, path: str, schema: T.StructType, parts: list[tuple[str, str]], wanted: Callable[[Entry], bool] | None = None
) -> DataFrame:
    """Folders that a commit names; one that is gone is an error, not an empty table. With `wanted`
    only the files that the index shows to hold such rows; other rows of those files come along."""
    full = _nullable(schema, T.StructField(DATE, T.DateType()))
    if wanted is None:
        paths = [f"{path}/{VERSION}={v}/{DATE}={d}" for d, v in parts]
    else:
        paths = sorted({f"{path}/{VERSION}={e.folder}/{DATE}={e.date}/{e.file}" for e in entries(spark, path, parts) if wanted(e)})
    if not paths:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(*paths).select(*full.names)


def read_table(spark: SparkSession, path: str, schema: T.StructType, zones: list[str] | None = None) -> DataFrame:
    """The table with its `date` column; no rows if it was never written. For `zones` only files that hold them are opened."""
    parts = state(spark, path).parts
    if zones is None:
        return _read(spark, path, schema, parts)
    return _read(spark, path, schema, parts, lambda e: e.zone in zones).filter(F.col("zone").isin(zones))


def read_dates(spark: SparkSession, path: str, schema: T.StructType, dates: set[str]) -> DataFrame:
    return _read(spark, path, schema, [p for p in state(spark, path).parts if p[0] in dates])


def read_parts(spark: SparkSession, path: str, schema: T.StructType, parts: list[tuple[str, str]], wanted: Callable[[Entry], bool]) -> DataFrame:
    """Rows of files of `parts` that the index shows to hold rows that are `wanted`."""
    return _read(spark, path, schema, parts, wanted)


def read_newest(spark: SparkSession, path: str, schema: T.StructType, zones: list[str] | None = None) -> DataFrame:
    """For each zone the rows of the date of its newest one: what the newest row of every zone is among."""
    now = state(spark, path)
    picked = {z: d for z, d in now.zones.items() if zones is None or z in zones}
    parts = [p for p in now.parts if p[0] in set(picked.values())]
    rows = _read(spark, path, schema, parts, lambda e: picked.get(e.zone) == e.date)
    on = [F.struct(F.lit(z).alias("zone"), F.lit(d).cast("date").alias(DATE)) for z, d in sorted(picked.items())]
    return rows.filter(F.struct("zone", DATE).isin(on)) if on else rows


def newest_micros(spark: SparkSession, path: str) -> int | None:
    """max(time) of a table in microseconds, from the index of its newest date."""
    parts = state(spark, path).parts
    newest = max((d for d, _ in parts), default=None)
    return max((e.high for e in entries(spark, path, [p for p in parts if p[0] == newest])), default=None)


def read_peaks(spark: SparkSession, path: str, schema: T.StructType, at: int) -> DataFrame:
    """`zone`, `peak`: the largest demand from `at` (microseconds) on. Whole dates by the index, the date that `at` cuts by its rows."""
    parts = state(spark, path).parts
    edge = str(datetime.fromtimestamp(at // 1_000_000, timezone.utc).date())
    tops: dict[str, float] = {}
    zones = set()
    for e in entries(spark, path, [p for p in parts if p[0] > edge]):
        zones.add(e.zone)
        if e.top is not None:
            tops[e.zone] = max(e.top, tops.get(e.zone, e.top))
    whole = spark.createDataFrame([(z, tops.get(z)) for z in sorted(zones, key=str)], "zone string, demand_mw double")
    cut = _read(spark, path, schema, [p for p in parts if p[0] == edge]).filter(F.col("time") >= F.timestamp_micros(F.lit(at)))
    return whole.union(cut.select("zone", "demand_mw")).groupBy("zone").agg(F.max("demand_mw").alias("peak"))


def changed(spark: SparkSession, path: str, since_commit: int | None) -> tuple[int, set[str]]:
    """The newest commit, and the dates that commits after `since_commit` have rewritten; all dates for None."""
    now = state(spark, path)
    if since_commit is None:
        return now.number, set(now.moved)
    return now.number, {d for d, n in now.moved.items() if n > since_commit}


def since(df: DataFrame, at: Column | None) -> DataFrame:
    """Trailing slice. The added date filter prunes partitions, the time filter is exact."""
    if at is None:
        return df
    sliced = df.filter(F.col("time") >= at)
    return sliced.filter(F.col(DATE) >= F.to_date(at)) if DATE in df.columns else sliced


def _micros_literal(df: DataFrame, value: Column) -> Column | None:
    """An aggregate timestamp as a literal, by way of microseconds: no local time is involved."""
    micros = df.agg(F.unix_micros(value)).first()[0]
    return None if micros is None else F.timestamp_micros(F.lit(micros))


def newest_time(df: DataFrame) -> Column | None:
    """max(time) of any frame as a literal, so that what follows filters on a constant."""
    return _micros_literal(df, F.max("time"))


def high_water(spark: SparkSession, path: str) -> Column | None:
    """max(time) of a table as a literal, or None if it has no rows. No row is read."""
    micros = newest_micros(spark, path)
    return None if micros is None else F.timestamp_micros(F.lit(micros))


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn(DATE, F.to_date("time"))


# --- writers --------------------------------------------------------------------------


@dataclass
class Change:
    """What a writer does to a table: the dates it touches in a state, and its rows of such dates in that state."""

    dates: Callable[[State], set[str]]
    rows: Callable[[State, set[str]], DataFrame]
    #: Rows that the dates hold stay.
    adds: bool = False
    #: All other dates go.
    alone: bool = False


def _put(spark: SparkSession, path: str, df: DataFrame, number: int) -> list[tuple[str, str]]:
    """Write `df` as a folder of its own name, with its index; its parts.

    Rebalanced by date: adaptive execution splits a date that holds too much and merges small
    ones, so no task writes a whole hot date. Sorted inside files for min/max skipping.
    """
    folder = f"{number}-{uuid.uuid4().hex[:8]}"
    order = [DATE, *[c for c in ("zone", "time") if c in df.columns]]
    rows = _dated(df).hint("rebalance", DATE).sortWithinPartitions(*order)
    target = f"{path}/{VERSION}={folder}"
    rows.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(DATE).parquet(target)
    dates = sorted(n[len(DATE) + 1 :] for n in _names(spark, target) if n.startswith(f"{DATE}="))
    if dates:
        _describe(spark, path, folder, dict(df.dtypes))
    return [(d, folder) for d in dates]


def _apply(spark: SparkSession, path: str, change: Change, batch_id: str | None = None, seen: dict[str, int] | None = None) -> None:
    """Write the rows of a change and commit them; when another writer was first, again for the dates that it moved."""
    now, own, touched = state(spark, path), [], set()
    todo = change.dates(now)
    if not todo and not change.alone and seen is None:
        return
    for _ in range(ATTEMPTS):
        if batch_id is not None and now.has(batch_id):
            break
        if todo or (change.alone and not own):
            own = [p for p in own if p[0] not in todo] + _put(spark, path, change.rows(now, todo), now.number + 1)
            touched |= todo
        stays = [p for p in now.parts if change.adds or not (change.alone or p[0] in touched)]
        moved = touched | {d for d, _ in own} | (set(now.dates()) if change.alone else set())
        new = State(now.number + 1, stays + sorted(own), list(now.batches), dict(now.runs), {}, dict(now.moved) | dict.fromkeys(sorted(moved), now.number + 1), now.seen | (seen or {}))
        new.zones = _newest_by_zone(spark, path, now, new.parts, moved)
        new.add(batch_id)
        try:
            _commit(spark, path, new)
        except FileExistsError:
            later = state(spark, path)
            todo = set()
            if not change.alone:
                held, holds = ({d: {p for p in s.parts if p[0] == d} for d in s.dates()} for s in (now, later))
                asked = change.dates(later)
                todo = {d for d in asked if d not in touched or held.get(d) != holds.get(d)}
            now = later
            continue
        _forget(spark, path, now, new)
        return
    else:
        raise RuntimeError(f"{path}: overtaken by other writers {ATTEMPTS} times")
    for _, folder in set(own):  # the batch came in by another writer meanwhile
        _delete(spark, f"{path}/{VERSION}={folder}")


def _on(df: DataFrame, dates: set[str]) -> DataFrame:
    return df.filter(F.to_date("time").isin([date.fromisoformat(d) for d in sorted(dates)]))


def _dates_of(df: DataFrame) -> set[str]:
    """Bounded by the calendar, whatever the number of rows."""
    return {str(r[0]) for r in df.select(F.to_date("time")).distinct().collect()}


def write_table(df: DataFrame, path: str, seen: dict[str, int] | None = None) -> None:
    """Full refresh."""
    _apply(df.sparkSession, path, Change(lambda now: set(), lambda now, dates: df, alone=True), seen=seen)


def rewrite_dates(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    new: DataFrame,
    combine: Callable[[DataFrame, DataFrame], DataFrame],
) -> None:
    """Replace the rows of the dates in `new` by combine(old rows, new rows)."""
    dates = _dates_of(new)
    rows = new.select(*schema.fieldNames())

    def combined(now: State, some: set[str]) -> DataFrame:
        old = _read(spark, path, schema, [p for p in now.parts if p[0] in some]).drop(DATE)
        return combine(old, rows if some == dates else _on(rows, some))

    _apply(spark, path, Change(lambda now: dates, combined))


def replace_dates(spark: SparkSession, path: str, df: DataFrame, dates: set[str], seen: dict[str, int] | None = None) -> None:
    """Put `df` in place of all rows of `dates`, and note which commits of other tables it was made from."""
    _apply(spark, path, Change(lambda now: dates, lambda now, some: df if some == dates else _on(df, some)), seen=seen)


def _unique(batch: DataFrame, keys: list[str]) -> DataFrame:
    twice = batch.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").first()
    if twice:
        raise ValueError(f"a batch without an order column holds a key {twice['n']} times: {twice}")
    return batch


def upsert_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    batch: DataFrame,
    keys: list[str],
    order_col: str | None = None,
    update_cols: list[str] | None = None,
) -> None:
    """Last write wins on `keys`, or only for `update_cols`. Keys of a batch are unique, or
    `order_col` says which row is the last."""
    batch = merge.last_per_key(batch, keys, order_col) if order_col else _unique(batch, keys)
    rewrite_dates(
        spark, path, schema, batch, lambda old, new: merge.keyed_upsert(old, new, keys, None, update_cols)
    )


def merge_table(spark: SparkSession, path: str, schema: T.StructType, new: DataFrame, keys: list[str]) -> None:
    """Delete and insert by key. `new` is written once, then read for dates and for rows."""
    staged = materialize(new, "increment")
    rewrite_dates(spark, path, schema, staged, lambda old, n: merge.incremental_merge(old, n, keys))


def with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])


def append_batch(df: DataFrame, path: str, batch_id: str) -> None:
    """Append rows; a batch that is in already is not written again."""
    spark = df.sparkSession
    if not state(spark, path).has(batch_id):
        # a date added to by others meanwhile needs no new rows from this writer
        once: set[str] = set()

        def rows(now: State, some: set[str]) -> DataFrame:
            once.update(some)
            return df.withColumn(BATCH, F.lit(batch_id))

        dates = _dates_of(df)
        _apply(spark, path, Change(lambda now: dates - once, rows, adds=True), batch_id)


def read_appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_table(spark, path, schema)


def replace_zones_table(
    spark: SparkSession, path: str, schema: T.StructType, new: DataFrame, zones: list[str], batch_id: str
) -> None:
    """Delete all rows of the listed zones, then insert `new`. Dates without such rows stay as
    they are; rows that stay keep their batch."""
    fresh = new.select(*schema.fieldNames()).withColumn(BATCH, F.lit(batch_id))
    own = _dates_of(fresh)

    def dates(now: State) -> set[str]:
        return own | {e.date for e in entries(spark, path, now.parts) if e.zone in zones}

    def rows(now: State, some: set[str]) -> DataFrame:
        old = _read(spark, path, with_batch(schema), [p for p in now.parts if p[0] in some]).drop(DATE)
        return merge.replace_zones(old, _on(fresh, some), zones)

    _apply(spark, path, Change(dates, rows), batch_id)


def append_absent_hours(
    spark: SparkSession, path: str, schema: T.StructType, candidates: DataFrame, batch_id: str
) -> None:
    """Append the candidate rows of hours the table does not hold."""
    if state(spark, path).has(batch_id):
        return
    wanted = candidates.select(*schema.fieldNames())
    dates = _dates_of(wanted)

    def rows(now: State, some: set[str]) -> DataFrame:
        held = _read(spark, path, schema, [p for p in now.parts if p[0] in some])
        return merge.absent_hours(held, _on(wanted, some)).withColumn(BATCH, F.lit(batch_id))

    _apply(spark, path, Change(lambda now: dates, rows, adds=True), batch_id)


def append_snapshot(df: DataFrame, path: str, synced_at: Column) -> None:
    """Append a full snapshot under one stamp, so that the latest one can be selected.
    Writing the same snapshot again replaces it."""
    stamped = df.withColumn("synced_at", synced_at)
    stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("synced_at").parquet(path)


def read_latest_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The latest snapshot of a written log; the stamp is looked up first, so that the read
    is of one partition."""
    table = read_or_empty(spark, path, _nullable(schema, T.StructField("synced_at", T.TimestampType())))
    last = _micros_literal(table, F.max("synced_at"))
    return table if last is None else table.filter(F.col("synced_at") == last)


def latest_snapshot(df: DataFrame, stamp_col: str = "synced_at") -> DataFrame:
    """Rows of the latest snapshot, selected by a scalar subquery on the stamp."""
    return df.filter(F.col(stamp_col) == df.agg(F.max(stamp_col)).scalar())
