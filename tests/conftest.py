import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from zoneflow import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
FULL = "/root/testdata/sf0.1"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return session.local_session("tests", "8", partitions=4)


@pytest.fixture
def frame(spark):
    """Rows with UTC timestamps written as text."""

    def make(rows, schema):
        df = spark.createDataFrame(rows, schema.replace("timestamp", "string"))
        stamps = [c.split()[0] for c in schema.split(",") if c.strip().endswith("timestamp")]
        return df.withColumns({c: df[c].cast("timestamp") for c in stamps})

    return make


def utc(text: str) -> str:
    return dt.datetime.fromisoformat(text).strftime("%Y-%m-%d %H:%M:%S")


def values(df, *columns):
    """Rows as plain tuples, timestamps as text, sorted."""
    from pyspark.sql import functions as F

    cols = columns or df.columns
    types = dict(df.dtypes)
    out = df.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if types[c] == "timestamp" else c for c in cols])
    return sorted((tuple(r) for r in out.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
