import json

import pytest
from conftest import values

from zoneflow.functions.codec import decode_messages, encode_messages, split_valid
from zoneflow.schemas import CONTRACTS, LOAD, MESSAGE
from zoneflow.sources import tables
from zoneflow.streaming import ingest

GOOD = {
    "time": "2026-01-01T00:00:00+00:00",
    "zone": "AEP",
    "source": "pjm",
    "demand_mw": 100.0,
    "demand_forecast_mw": None,
    "net_generation_mw": None,
    "total_interchange_mw": None,
    "is_verified": True,
}


def _without(key):
    return {k: v for k, v in GOOD.items() if k != key}


CASES = [
    (json.dumps(GOOD), True),
    (json.dumps(GOOD | {"is_verified": None}), True),
    (json.dumps(GOOD | {"note": "extra"}), True),
    (json.dumps(GOOD | {"demand_mw": "12.5"}), True),
    (json.dumps(GOOD | {"demand_mw": 7}), True),
    (json.dumps(GOOD | {"time": "2026-01-01T01:00:00-05:00"}), True),
    ("not json", False),
    ("", False),
    (None, False),
    ("[1]", False),
    (json.dumps([GOOD]), False),
    (json.dumps(GOOD) + " }", False),
    (json.dumps(GOOD) + "," + json.dumps(GOOD), False),
    (json.dumps(_without("is_verified")), False),
    (json.dumps(_without("demand_mw")), False),
    (json.dumps(GOOD | {"demand_mw": None}), False),
    (json.dumps(GOOD | {"demand_mw": "12x"}), False),
    (json.dumps(GOOD | {"demand_mw": "1d"}), False),
    (json.dumps(GOOD | {"demand_mw": True}), False),
    (json.dumps(GOOD | {"demand_mw": {"v": 1}}), False),
    (json.dumps(GOOD | {"time": "soon"}), False),
    (json.dumps(GOOD | {"time": "2026"}), False),
    (json.dumps(GOOD | {"time": 2026}), False),
    (json.dumps(GOOD | {"is_verified": 3.5}), False),
    (json.dumps(GOOD | {"zone": None}), False),
]


def test_validity(spark):
    rows = [("k", v, i) for i, (v, _) in enumerate(CASES)]
    got = {r.offset: r.is_valid for r in decode_messages(spark.createDataFrame(rows, MESSAGE), CONTRACTS["load"]).collect()}
    wrong = [CASES[i] for i in got if got[i] != CASES[i][1]]
    assert not wrong and len(got) == len(CASES)


def test_split_keeps_original_text(spark):
    rows = [("k", v, i) for i, (v, _) in enumerate(CASES)]
    good, dead = split_valid(decode_messages(spark.createDataFrame(rows, MESSAGE), CONTRACTS["load"]), CONTRACTS["load"])
    assert good.columns == [*LOAD.fieldNames(), "offset"]
    assert {r.value for r in dead.collect()} == {v for v, ok in CASES if not ok}
    assert [r[0] for r in values(good.filter("offset = 5"), "time")] == ["2026-01-01 06:00:00"]


def test_encode_writes_nulls(frame):
    df = frame([("2026-01-01 00:00:00", "A", float("nan"), None)], "time timestamp, zone string, mw double, ok boolean")
    r = encode_messages(df, "zone", df.columns).first()
    assert r.key == "A"
    assert json.loads(r.value) == {"time": "2026-01-01T00:00:00+00:00", "zone": "A", "mw": None, "ok": None}


def _topic(spark, path, rows, batch):
    spark.createDataFrame(rows, MESSAGE).coalesce(1).write.parquet(f"{path}/batch{batch}")


def _message(offset, mw, zone="AEP", hour=0):
    return (zone, json.dumps(GOOD | {"zone": zone, "demand_mw": mw, "time": f"2026-01-01T{hour:02}:00:00+00:00"}), offset)


def test_stream_upserts_and_dead_letters(spark, tmp_path):
    topic, table, dlq = str(tmp_path / "topic"), str(tmp_path / "load"), str(tmp_path / "dlq")

    def drain(checkpoint="cp"):
        source = ingest.file_source(spark, f"{topic}/*", files_per_batch=1)
        return ingest.drain(source, CONTRACTS["load"], table, dlq, str(tmp_path / checkpoint))

    def state():
        return values(tables.read_table(spark, table, LOAD), "zone", "time", "demand_mw")

    _topic(spark, topic, [_message(0, 1.0), _message(1, 2.0), _message(2, 9.0, "DOM", 5), ("k", "junk", 3)], 1)
    done = drain()
    assert (done.written, done.dead_lettered) == (3, 1)
    assert state() == [("AEP", "2026-01-01 00:00:00", 2.0), ("DOM", "2026-01-01 05:00:00", 9.0)]

    # nothing new: nothing happens; then a revision replaces the row
    assert drain().written == 0
    _topic(spark, topic, [_message(4, 3.0)], 2)
    assert drain().written == 1
    after = state()
    assert after == [("AEP", "2026-01-01 00:00:00", 3.0), ("DOM", "2026-01-01 05:00:00", 9.0)]

    # the whole topic again, from the earliest offset
    assert drain("cp2").written == 4
    assert state() == after
    assert {r.value for r in spark.read.parquet(dlq).collect()} == {"junk"}


def test_failed_batch_is_taken_again(spark, tmp_path, monkeypatch):
    """An outage while writing stops the run; nothing is recorded as read."""
    topic, table = str(tmp_path / "topic"), str(tmp_path / "load")
    _topic(spark, topic, [_message(0, 1.0)], 1)

    def drain():
        source = ingest.file_source(spark, f"{topic}/*")
        return ingest.drain(source, CONTRACTS["load"], table, str(tmp_path / "dlq"), str(tmp_path / "cp"))

    with monkeypatch.context() as m:
        m.setattr(tables, "upsert_table", lambda *a, **k: 1 / 0)
        with pytest.raises(Exception, match="ZeroDivisionError|division"):
            drain()
    assert drain().written == 1
    assert tables.read_table(spark, table, LOAD).count() == 1


def test_replayed_batch_changes_nothing(spark, tmp_path):
    batch = spark.createDataFrame([_message(0, 1.0), ("k", "junk", 1)], MESSAGE)
    for _ in range(2):
        ingest.write_batch(batch, CONTRACTS["load"], str(tmp_path / "load"), str(tmp_path / "dlq"), "q-0")
    assert tables.read_table(spark, str(tmp_path / "load"), LOAD).count() == 1
    assert spark.read.parquet(str(tmp_path / "dlq")).count() == 1


def test_weather_append_replay(spark, tmp_path):
    contract = CONTRACTS["weather"]
    value = json.dumps({"time": "2026-01-01T00:10:00+00:00", "zone": "A", "temperature": 1.0, "precipitation": 0.0, "wind_speed": 1.0, "cloud_cover": 5.0})
    batch = spark.createDataFrame([("A", value, 0), ("A", value, 1)], MESSAGE)
    path = str(tmp_path / "weather")
    for tag in ("q-0", "q-0", "q-1"):
        ingest.write_batch(batch, contract, path, str(tmp_path / "dlq"), tag)
    # repeats inside a batch and across batches stay, a replay of the same batch does not
    assert tables.read_appended(spark, path, contract.schema).count() == 4


def test_kafka_source_needs_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        ingest.topic_source(spark, "localhost:1", "load")


def test_open_hours_take_a_batch_once(spark, frame, tmp_path):
    """Readings of one hour over two batches; a stream that starts anew adds them again, a replay does not."""
    from zoneflow.schemas import WEATHER
    from zoneflow.streaming import hourly

    path, log = str(tmp_path / "hours"), str(tmp_path / "log")
    ddl = "time timestamp, zone string, temperature double, precipitation double, wind_speed double, cloud_cover double"
    for k, t in enumerate((1.0, 4.0)):
        rows = frame([(f"2026-01-01 00:{m:02}:00", "A", t, None, 1.0, 5.0) for m in range(k + 1)], ddl)
        rows.coalesce(1).write.mode("append").parquet(log)
    readings = spark.readStream.schema(WEATHER).option("maxFilesPerTrigger", 1).parquet(log)
    for _ in range(2):
        hourly.upsert_open_hours(readings, path, str(tmp_path / "checkpoint"))
    got = hourly.read_hours(spark, path).drop("time").collect()
    assert [tuple(r) for r in got] == [("A", 3.0, None, 1.0, 5.0, 3)]
