"""Nearest vectors by balanced posting lists: boundary vectors in several lists, a graph over the lists' centres."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.llm import common, vectors

common.shipped(__name__)
common.shipped(vectors.__name__)

#: Vectors the lists are fitted on, and their components in all; rows of a list; lists, at most.
SAMPLE, VALUES, ROWS, LISTS = 1 << 16, 1 << 23, 256, 1 << 13
#: A vector goes to lists no further than so many times its nearest centre, COPIES at most; a query searches those of its own bound.
BOUNDARY, COPIES, RATIO = 1.02, 8, 1.12
#: Edges of a centre in the graph, and how far beyond the bound a search goes on.
EDGES, SLACK = 16, 1.06
#: Rows and queries of a list that are compared in one group; a longer list is dealt in pieces.
PIECE, ASKED = 1 << 14, 1 << 12


def _halves(x: np.ndarray, index: np.ndarray, parts: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Parted in `parts` of equal size, each time by the line between two means at which both sides are equal."""
    if parts < 2 or len(index) < 2:
        return [index]
    y, left = x[index], parts // 2
    cut = len(y) * left // parts
    ends = y[rng.choice(len(y), 2, replace=False)]
    axis = ends[0] - ends[1]
    for _ in range(6):
        order = np.argsort(y @ axis, kind="stable")
        axis = y[order[cut:]].mean(axis=0) - y[order[:cut]].mean(axis=0)
    order = np.argsort(y @ axis, kind="stable")
    return _halves(x, index[order[:cut]], left, rng) + _halves(x, index[order[cut:]], parts - left, rng)


class Lists:
    """Centres of the lists, the graph over them, and the search for centres within a bound."""

    def __init__(self, sample: np.ndarray, parts: int) -> None:
        found = _halves(sample, np.arange(len(sample)), parts, np.random.default_rng(42))
        self.centres = np.stack([sample[i].mean(axis=0) for i in found])
        n = len(found)
        edges = [np.stack([np.roll(np.arange(n), 1), np.roll(np.arange(n), -1)], axis=1)]
        if n > 1:
            squares, near = (self.centres**2).sum(axis=1), []
            for at in range(0, n, 1024):
                d = squares - 2 * self.centres[at : at + 1024] @ self.centres.T
                near.append(np.argsort(d, axis=1, kind="stable")[:, 1 : EDGES + 1])
            edges.append(np.concatenate(near))
        self.edges = np.concatenate(edges, axis=1)
        self.starts = np.unique(np.linspace(0, n - 1, 16).astype(np.int64))

    def within(self, points: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Point, list and distance, for the lists that the graph reaches within `ratio` times the nearest."""
        n, found = len(self.centres), []
        step = max(1, (1 << 21) // n)
        for at in range(0, len(points), step):
            p = points[at : at + step]
            far = np.full((len(p), n), np.inf)
            rows, cols = np.repeat(np.arange(len(p)), len(self.starts)), np.tile(self.starts, len(p))
            while len(rows):
                for k in range(0, len(rows), 1 << 15):
                    r, c = rows[k : k + (1 << 15)], cols[k : k + (1 << 15)]
                    far[r, c] = np.sqrt(((p[r] - self.centres[c]) ** 2).sum(axis=1))
                best = far.min(axis=1)
                on = far[rows, cols] <= ratio * SLACK * best[rows]
                near = np.zeros(far.shape, bool)
                near[np.repeat(rows[on], self.edges.shape[1]), self.edges[cols[on]].ravel()] = True
                rows, cols = np.nonzero(near & np.isinf(far))
            rows, cols = np.nonzero(far <= ratio * far.min(axis=1, keepdims=True))
            found.append((rows + at, cols, far[rows, cols]))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def _placed(lists, dim: int, longest: float, ask: bool):
    """Each vector once for each of its lists; `home` marks the nearest one.

    A further component brings all vectors to one length, so that the largest inner product is the least distance;
    a query has none, and its length does not matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = vectors.matrix(batch.column("vector"), dim)
            square = (x**2).sum(axis=1)
            if ask:
                point = np.column_stack([x * (longest / np.sqrt(square))[:, None], np.zeros(len(x))])
            else:
                point = np.column_stack([x, np.sqrt(np.maximum(longest**2 - square, 0))])
            row, part, far = lists.value.within(point, RATIO if ask else BOUNDARY)
            order = np.lexsort((part, far, row))
            row, part = row[order], part[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            keep = np.ones(len(row), bool) if ask else rank < COPIES
            row, part, rank = row[keep], part[keep], rank[keep]
            taken = batch.take(pa.array(row))
            yield pa.record_batch([*taken.columns, pa.array(part), pa.array(rank == 0)], names=[*batch.schema.names, "part", "home"])

    return run


def _nearest(dim: int, k: int):
    """The `k` nearest rows of a piece to each of its queries, no further than the query's floor."""

    def run(key: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
        f, r = held.column("_f").to_numpy(), held.column("_r").to_numpy()
        order, number, nameless = vectors.ranked(held.column("id"), f, r)
        f, r, number, nameless = f[order], r[order], number[order], nameless[order]
        x, q = vectors.matrix(held.column("vector"), dim)[order], vectors.matrix(asked.column("vector"), dim)
        own, floor = list(zip(asked.column("_f").to_pylist(), asked.column("_r").to_pylist())), asked.column("floor").to_numpy(zero_copy_only=False)
        place = {z: i for i, z in enumerate(zip(f.tolist(), r.tolist()))}
        lists = []
        longest = float(np.sqrt((x**2).sum(axis=1)).max(initial=0))
        for at in range(0, len(q), 256):
            scores = q[at : at + 256] @ x.T
            for i, s in enumerate(scores):
                if (me := place.get(own[at + i])) is not None:
                    s[me] = -np.inf
                # products summed up in another order can differ in the last digits: more rows first, then the measure itself
                slack = 1e-12 * dim * longest * float(np.sqrt((q[at + i] ** 2).sum())) + 1e-300
                least = np.partition(s, len(s) - k)[len(s) - k] if len(s) > k else -np.inf
                near = np.flatnonzero((s >= max(least, floor[at + i]) - slack) & (s > -np.inf))
                exact = vectors.inner(x[near], q[at + i][None])
                near, exact = near[best := np.lexsort((near, -exact))[:k]], exact[best]
                lists.append((near, exact))
        hits = vectors.packed(lists, number, nameless, f, r, np.float64)
        out = pa.table([asked.column("_f"), asked.column("_r"), asked.column("id"), hits], names=["_f", "_r", "id", "hits"])
        return out.filter(pa.array([len(at) > 0 for at, _ in lists], pa.bool_()))

    return run


def _counts(df: DataFrame, size: int) -> DataFrame:
    """Pieces of each list: one row for a list, LISTS at most."""
    return df.groupBy("part").agg(F.ceil(F.count("*") / size).cast("int").alias("pieces"))


def _searched(asked: DataFrame, held: DataFrame, dim: int, k: int) -> DataFrame:
    """`asked` against `held`, list by list; a pair of pieces is a group."""
    rows = held.join(F.broadcast(_counts(held, PIECE)), "part").withColumn("piece", F.pmod(F.xxhash64("_f", "_r"), "pieces").cast("int")).drop("pieces")
    rows = rows.join(F.broadcast(_counts(asked, ASKED)), "part").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    ask = asked.join(F.broadcast(_counts(asked, ASKED)), "part").withColumn("turn", F.pmod(F.xxhash64("_f", "_r"), "pieces").cast("int")).drop("pieces")
    ask = ask.join(F.broadcast(_counts(held, PIECE)), "part").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    rows = rows.select(*[F.col(c).alias(f"{c}_") for c in ("part", "piece", "turn")], "_f", "_r", "id", "vector")
    ask = ask.select("part", "piece", "turn", "_f", "_r", "id", "vector", "floor")
    return ask.groupBy("part", "piece", "turn").cogroup(rows.groupBy("part_", "piece_", "turn_")).applyInArrow(_nearest(dim, k), f"_f long, _r long, id long, hits array<{vectors.HIT.format('double')}>")


def fit(rows: DataFrame, dim: int, longest: float, n: int) -> Lists:
    """Lists of about ROWS rows from a sample of SAMPLE vectors and VALUES components at most, by hashes of the row keys."""
    wanted = min(SAMPLE, max(VALUES // dim, 64))
    share = F.pmod(F.xxhash64("_r", "_f"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, 0.95 * wanted / n)))
    taken = (rows if n <= wanted else rows.where(share)).select("vector").limit(wanted).toArrow()
    x = vectors.matrix(taken.column("vector"), dim)
    order = np.lexsort(x.T[::-1])
    x = x[order]
    point = np.column_stack([x, np.sqrt(np.maximum(longest**2 - (x**2).sum(axis=1), 0))])
    return Lists(point, max(1, min(LISTS, len(point) // 8, -(-n // ROWS))))


def nearest(df: DataFrame, k: int, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score`: of each row that `queries` says, the `k` rows of largest inner product.

    `queries` is a condition on `id`, the id. Every row is in the index: in the list whose centre is
    nearest and in those hardly further (BOUNDARY). Lists are parts of equal size of a bounded sample.
    A query searches, through the graph of centres, the lists within RATIO times its nearest centre:
    first the nearest one, whose k-th score is its floor in the others. Where these hold fewer than k
    rows, it searches all lists. So results are those of a full
    comparison but for neighbours in lists beyond the bound; where there is one list they are exact.
    Scores are of the given vectors, in double precision, summed up in their order.

    A row is not its own neighbour, a row equal to it is. Ties go to the smaller id, a null id last.
    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
    those of another length than most. Repeated ids are rows like others. No rows give no rows.
    """
    rows = common.keyed(df, id_col, vector_col)
    rows = rows.select("_f", "_r", rows[id_col].cast("long").alias("id"), rows[vector_col].cast("array<double>").alias("vector"))
    rows = common.written(rows.where(vectors.usable(F.col("vector")) & F.exists("vector", lambda x: x != 0)), "vectors")
    rows, dim = vectors.of_one_length(rows, "vector")
    schema = "query_id long, rank int, vec_id long, score double"
    if not dim:
        return common.frame(df.sparkSession, [], schema)
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    n, longest = rows.agg(F.count("*"), F.sqrt(F.max(square))).first()
    index = fit(rows, dim, longest, n)
    lists = df.sparkSession.sparkContext.broadcast(index)
    kinds = "_f long, _r long, id long, vector array<double>, part long, home boolean"
    held = common.written(rows.mapInArrow(_placed(lists, dim, longest, False), kinds), "posting-lists")
    asked = common.written(rows.where(queries).mapInArrow(_placed(lists, dim, longest, True), kinds), "queries")
    none = F.lit(float("-inf"))
    home = common.written(_searched(asked.where("home").withColumn("floor", none), held, dim, k).groupBy("_f", "_r", "id").agg(vectors.first("hits", k).alias("hits")), "home-hits")
    floors = home.select("_f", "_r", F.when(F.size("hits") == k, -F.element_at("hits", -1)["less"]).otherwise(none).alias("floor"))
    rest = asked.where("not home").join(floors, ["_f", "_r"], "left").withColumn("floor", F.coalesce("floor", none))
    both = _searched(common.written(rest, "queries"), held, dim, k).union(home)
    best = common.written(both.groupBy("_f", "_r", "id").agg(vectors.first("hits", k).alias("hits")), "best-hits")
    full = best.where(F.size("hits") >= min(k, n - 1))
    short = asked.where("home").join(full, ["_f", "_r"], "left_anti")
    if not short.isEmpty():  # the lists within the bound held too few rows: all lists
        everywhere = short.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(len(index.centres) - 1).cast("long")))).withColumn("floor", none)
        rest = _searched(common.written(everywhere, "queries"), held, dim, k)
        best = full.union(rest.groupBy("_f", "_r", "id").agg(vectors.first("hits", k).alias("hits")))
    return best.select(F.col("id").alias("query_id"), F.posexplode("hits").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), (F.lit(0.0) - F.col("hit.less")).alias("score")
    )
