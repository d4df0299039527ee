"""Hard negatives and nearest vectors against full comparisons."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from zoneflow.llm import common, hard_negatives, neighbours

from .conftest import rows as sorted_rows

SCHEMA = "vec_id long, embedding array<float>, label int, id string, part string, floor int, block string, turn int, home int, windows int, hits int, vector int, _f string"
DIM = 12


def _table(seed: int = 3, n: int = 400):
    """Clusters, a third of the rows one vector or close to it, ties, equal rows, null ids, odd vectors."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(DIM)] for _ in range(8)]
    hot, out = [round(x, 2) for x in centres[0]], []
    for i in range(n):
        if i % 3 == 0:
            v = hot if i % 2 else [x + rng.choice([0, 0, 0.01]) for x in hot]
        elif i % 3 == 1:
            v = [x + rng.gauss(0, 0.4) for x in rng.choice(centres)]
        else:
            v = [rng.choice([0.0, 0.5, -0.5]) for _ in range(DIM)]
        out.append((i, v, rng.randrange(10) if i % 4 else 3))
    out += [out[7], out[100], out[100], (None, hot, 3), (None, hot, 4), (2000, [5 * x for x in hot], 3), (2100, None, 1), (2200, hot, None)]
    out += [(2300, [float("nan")] + hot[1:], 2), (2400, [float("inf")] + hot[1:], 2), (2500, [None] + hot[1:], 2), (2600, [0.0] * DIM, 2), (2700, [], 2), (2800, [1.0, 2.0], 2)]
    return [(i, v, c, "x", "y", 1, "z", 2, 3, 4, 5, 6, "f") for i, v, c in out]


def _usable(v):
    return v is not None and len(v) == DIM and all(x is not None and math.isfinite(x) for x in v)


def _order(score, i):
    return (-score, i is None, i or 0)


def _mined(table, moved: bool):
    rows = []
    for i, v, c, *_ in table:
        if c is not None and _usable(v):
            c = (c + 1) % 10 if moved and i is not None and i % 7 == 0 else c
            rows.append((i, [math.floor(256 * float(np.float32(x))) for x in v], c))
    for a, (i, v, c) in enumerate(rows):
        if i is None or i % 100:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), j, d) for b, (j, w, d) in enumerate(rows) if b != a]
        positives = sorted(((s, j) for s, j, d in scored if d == c), key=lambda p: _order(*p))[:5]
        for ps, j in positives:
            window = [(s, k) for s, k, d in scored if d != c and 80 * ps <= 100 * s <= 100 * ps]
            for rank, (s, k) in enumerate(sorted(window, key=lambda p: _order(*p))[:5], 1):
                yield (i, j, rank, k, ps, s)


@pytest.mark.parametrize("seed,small", [(3, False), (3, True), (4, True)])
def test_hard_negatives(spark, tmp_path, seed, small, monkeypatch):
    """With one block, and with blocks so small that floors, waves and several steps come into play."""
    if small:
        for name, value in {"ROWS": 40, "ANCHORS": 3, "FIRST": 4, "STEP": 2, "CHUNK": 2}.items():
            monkeypatch.setattr(hard_negatives, name, value)
    common.prepared(spark)
    table = _table(seed)
    spark.createDataFrame(table, SCHEMA).repartition(3).write.parquet(str(tmp_path / "v"))
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.mine(spark.read.parquet(str(tmp_path / "v")), F.col("id") % 100 == 0, label=moved)
    want = sorted(_mined(table, True), key=repr)
    assert sorted_rows(got) == want and len(want) > 50


def test_hard_negatives_large_numbers(spark):
    """Scores beyond what doubles hold exactly are added up as whole numbers."""
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1, 1]) * float(2**21 + rng.randrange(2**20)) for _ in range(DIM)], i % 2) for i in range(60)]
    got = hard_negatives.mine(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), F.col("id") % 100 == 0)
    assert sorted_rows(got) == sorted(_mined([(*r,) for r in rows], False), key=repr)


def _near(table, k):
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v, *_ in table if _usable(v) and any(v)]
    for a, (i, v) in enumerate(rows):
        if i is not None and i % 20 == 0:
            scored = []
            for b, (j, w) in enumerate(rows):
                if b != a:
                    s = 0.0
                    for x, y in zip(v, w):
                        s += x * y
                    scored.append((s, j))
            yield i, sorted(scored, key=lambda p: _order(*p))[:k]


@pytest.mark.parametrize("small", [False, True])
def test_neighbours(spark, tmp_path, small, monkeypatch):
    """Two lists: exact. Many lists, in pieces: nine tenths of the neighbours at least, and their scores exact."""
    if small:
        for name, value in {"ROWS": 16, "PIECE": 20, "ASKED": 4, "EDGES": 4}.items():
            monkeypatch.setattr(neighbours, name, value)
    common.prepared(spark)
    table = _table()
    spark.createDataFrame(table, SCHEMA).repartition(3).write.parquet(str(tmp_path / "v"))
    got: dict = {}
    for q, rank, v, s in neighbours.nearest(spark.read.parquet(str(tmp_path / "v")), 20, F.col("id") % 20 == 0).collect():
        got.setdefault(q, []).append((rank, v, s))
    want: dict = {}
    for q, best in _near(table, 20):
        want.setdefault(q, []).extend((n, j, s) for n, (s, j) in enumerate(best, 1))
    assert got.keys() == want.keys()
    if not small:
        assert {q: sorted(x, key=repr) for q, x in got.items()} == {q: sorted(x, key=repr) for q, x in want.items()}
        return
    truth = {q: {(j, s) for _, j, s in x} for q, x in want.items()}
    hit = sum(len(truth[q] & {(j, s) for _, j, s in x}) for q, x in got.items())
    assert hit >= 0.9 * sum(map(len, truth.values()))
    for x in got.values():  # a repeated id asks more than once
        x.sort(key=lambda r: r[0])
        assert [r for r, *_ in x] == [*np.repeat(range(1, 21), len(x) // 20)]
        assert [s for *_, s in x] == sorted((s for *_, s in x), reverse=True)


def test_recall_on_given_vectors(spark):
    """Vectors without any clusters, the hard case."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    held = {r.vec_id: np.array(r.embedding, float) for r in df.collect()}
    ids = np.array(sorted(held))
    x = np.stack([held[i] for i in ids])
    got: dict = {}
    for q, _, v, s in neighbours.nearest(df, 20, F.col("id") % 20 == 0).collect():
        got.setdefault(q, set()).add(v)
        assert abs(s - held[q] @ held[v]) < 1e-12
    hit = 0
    for q in got:
        s = x @ held[q]
        s[ids == q] = -9
        hit += len(got[q] & set(ids[np.lexsort((ids, -s))[:20]].tolist()))
    assert len(got) == 100 and hit >= 0.95 * 2000


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mine(empty, F.col("id") % 100 == 0).count() == 0
    assert neighbours.nearest(empty, 20, F.col("id") % 20 == 0).count() == 0
    lone = spark.createDataFrame([(20, [1.0, 2.0], 1), (100, [0.0, 0.0], 1), (None, None, None)], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine(lone, F.col("id") % 100 == 0).count() == 0
    assert neighbours.nearest(lone, 20, F.col("id") % 20 == 0).count() == 0
    none = spark.createDataFrame([(7, [1.0], 1), (9, [1.0], 2)], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine(none, F.col("id") % 100 == 0).count() == 0
    assert neighbours.nearest(none, 20, F.col("id") % 20 == 0).count() == 0
