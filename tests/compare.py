"""Run registered queries against their SQL twins in DuckDB.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
         "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def compare(df, con, sql: str) -> str | None:
    """None when row counts, names, types and values agree, else what differs."""
    got_names = df.columns
    got = _rows(got_names, df.collect())
    cur = con.execute(sql)
    want_names = [c[0] for c in cur.description]
    want_types = {c[0]: str(c[1]) for c in cur.description}
    want = _rows(want_names, cur.fetchall())
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    bad_types = {n: (t, want_types[n]) for n, t in df.dtypes if TYPES.get(t, t) != want_types[n]}
    if bad_types:
        return f"types {bad_types}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    diff = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(diff)} of {len(got)} rows differ: {diff[0]}" if diff else None


def main() -> int:
    import __spark_entry__ as entry
    from zoneflow.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session("compare", "8"), duck(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            problem = compare(df, con, sql[name]) if name in sql else f"no oracle, {df.count()} rows"
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None and name in sql
        print(f"{'ok ' if problem is None else '-- '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} bad, unknown oracle names: {sorted(set(sql) - set(queries))}")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main()))
