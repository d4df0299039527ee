"""Hard negatives by threshold joins: bounded indexes, partial scores, thresholds lowered until windows are full."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.llm import common, vectors

common.shipped(__name__)
common.shipped(vectors.__name__)

#: Rows of a block at most, or at least where that gives up to BLOCKS blocks; anchors of a block. Every pair of blocks is a group.
ROWS, LEAST, BLOCKS, ANCHORS = 1 << 16, 1 << 11, 64, 1 << 15
#: Of so many blocks one is joined first: what it finds bounds the thresholds of the others.
FIRST = 16
#: Components that are added before remaining norms are looked at; anchors that are scored at once.
STEP, CHUNK = 8, 64
#: Thresholds as shares of the largest possible score; below the last one there is none.
SHARES = (0.8, 0.6, 0.45, 0.35, 0.25, 0.15, 0.05)
#: Whole numbers up to here are exact in doubles; with larger products 64-bit integers are added.
EXACT = float(1 << 52)


class Index:
    """The vectors of a block by component, large components first.

    A vector is listed under its first components only: as soon as the norm of the rest, times the
    largest anchor's, stays below the threshold, the rest alone cannot reach it. Vectors are in the
    order of how many components they are listed under, so a component's list is a run of rows.
    """

    def __init__(self, x: np.ndarray, largest: float) -> None:
        self.x, self.largest = x, largest
        tail = np.cumsum((x.astype(np.float64) ** 2)[:, ::-1], axis=1)[:, ::-1]
        self.norms = np.sqrt(np.column_stack([tail[:, ::STEP], np.zeros(len(x))]))

    def at(self, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows by falling number of listed steps, and those numbers."""
        listed = (self.norms[:, :-1] * self.largest * (1 + 1e-9) >= threshold).sum(axis=1)
        order = np.argsort(-listed, kind="stable")
        return order, listed[order]


def joined(q: np.ndarray, index: Index, threshold: np.ndarray, allowed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, row and score of all allowed pairs whose score reaches the anchor's threshold, or hardly misses it.

    Lists of the first half of the steps are added up for all rows; then pairs that cannot reach the
    threshold by what is left of both norms go, and the others are completed step by step.
    """
    order, listed = index.at(float(threshold.min()))
    x, norms = index.x[order], index.norms[order]
    tail = np.cumsum((q.astype(np.float64) ** 2)[:, ::-1], axis=1)[:, ::-1]
    left = np.sqrt(np.column_stack([tail[:, ::STEP], np.zeros(len(q))]))
    steps = norms.shape[1] - 1
    half = max(1, steps // 2)
    partial = np.zeros((len(q), len(x)), q.dtype)
    for s in range(half):
        n = int(np.searchsorted(-listed, -s))
        cut = slice(s * STEP, (s + 1) * STEP)
        partial[:, :n] += q[:, cut] @ x[:n, cut].T
    done = np.minimum(listed, half)
    rest = norms[np.arange(len(x)), done]
    low = threshold - 1e-6 * np.maximum(1, np.abs(threshold))
    i, j = np.nonzero(partial + left[:, done] * rest * (1 + 1e-9) >= low[:, None])
    ok = allowed(i, order[j])
    i, j = i[ok], j[ok]
    score = partial[i, j]
    for s in range(steps):
        late = done[j] <= s
        if late.any():
            cut = slice(s * STEP, (s + 1) * STEP)
            score[late] += (q[i[late], cut] * x[j[late], cut]).sum(axis=1)
            over = np.ones(len(j), bool)
            over[late] = score[late] + left[i[late], s + 1] * norms[j[late], s + 1] * (1 + 1e-9) >= low[i[late]]
            i, j, score = i[over], j[over], score[over]
    over = score >= low[i]
    return i[over], order[j[over]], score[over].astype(np.int64)


def filled(q: np.ndarray, x: np.ndarray, windows: list[tuple[int, int, int]], allowed, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window (anchor, lowest, highest score): the `k` best rows in it, of equal ones the first, and their scores.

    Rows are in the order of their ids. An anchor's threshold falls until all its windows hold k rows or lie above it.
    """
    empty = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    out = [empty] * len(windows)
    if not len(x) or not windows:
        return out
    # the block's large components first
    energy = np.argsort(-(x.astype(np.float64) ** 2).sum(axis=0), kind="stable")
    q, x = q[:, energy], x[:, energy]
    norm = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
    longest = float(np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)).max())
    if norm.max() * longest >= EXACT:
        q, x = q.astype(np.int64), x.astype(np.int64)
    else:
        q, x = q.astype(np.float64), x.astype(np.float64)
    index = Index(x, float(norm.max()))
    of: dict[int, list[int]] = {}
    for w, (a, _, _) in enumerate(windows):
        of.setdefault(a, []).append(w)
    lowest = {a: min(windows[w][1] for w in ws) for a, ws in of.items()}
    highest = {a: max(windows[w][2] for w in ws) for a, ws in of.items()}
    open_ = sorted(of)
    for share in (*SHARES, None):
        level = {}
        for a in open_:
            most = min(norm[a] * longest, highest[a])
            level[a] = max(lowest[a], share * most if share is not None and most > 0 else lowest[a])
        still = []
        for at in range(0, len(open_), CHUNK):
            some = np.array(open_[at : at + CHUNK])
            i, j, score = joined(q[some], index, np.array([level[a] for a in some], np.float64), lambda i, j, some=some: allowed(some[i], j))
            best = np.lexsort((j, -score, i))
            i, j, score = i[best], j[best], score[best]
            ends = np.searchsorted(i, np.arange(len(some) + 1))
            for n, a in enumerate(some.tolist()):
                row, s = j[ends[n] : ends[n + 1]], score[ends[n] : ends[n + 1]]
                short = False
                for w in of[a]:
                    # scores fall: a window is a run
                    b, e = int(np.searchsorted(-s, -windows[w][2], side="left")), int(np.searchsorted(-s, -windows[w][1], side="right"))
                    out[w] = (row[b:e][:k], s[b:e][:k])
                    short |= e - b < k and level[a] > windows[w][1]
                if short:
                    still.append(a)
        open_ = still
        if not open_:
            break
    return out


def _group(dim: int, k: int, same: bool):
    """Each window of a block's anchors against a block of rows."""

    def run(key: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
        f, r = held.column("_f").to_numpy(), held.column("_r").to_numpy()
        order, number, nameless = vectors.ranked(held.column("id"), f, r)
        f, r, number, nameless = f[order], r[order], number[order], nameless[order]
        label, x = held.column("label").to_numpy()[order], vectors.whole(held.column("vector"), dim)[order]
        af, ar, own = asked.column("_f").to_numpy(), asked.column("_r").to_numpy(), asked.column("label").to_numpy()
        lists = asked.column("windows").to_pylist()
        windows = [(a, w["low"], w["high"]) for a, ws in enumerate(lists) for w in ws]

        def allowed(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            if same:
                return (own[i] == label[j]) & ((af[i] != f[j]) | (ar[i] != r[j]))
            return own[i] != label[j]

        found = filled(vectors.whole(asked.column("vector"), dim), x, windows, allowed, k)
        at = np.array([a for a, _, _ in windows], np.int64)
        high = pa.array([w["high"] for ws in lists for w in ws], pa.int64())
        out = pa.table([pa.array(af[at]), pa.array(ar[at]), high, vectors.packed(found, number, nameless, f, r, np.int64)], names=["_f", "_r", "high", "hits"])
        return out.filter(pa.array([len(x) > 0 for x, _ in found], pa.bool_()))

    return run


_WINDOWS = "windows array<struct<low:long,high:long>>"


def _best(asked: DataFrame, rows: DataFrame, blocks: int, dim: int, k: int, same: bool) -> DataFrame:
    """`_f`, `_r`, `high`, `hits`: of each window of `asked` the `k` best rows. One of FIRST blocks goes first and raises the windows' lower ends."""
    n = asked.count()
    turns = -(-n // ANCHORS)
    ask = asked.withColumn("turn", F.pmod(F.xxhash64("_f", "_r"), F.lit(max(turns, 1))).cast("int"))
    first = max(1, blocks // FIRST)

    def wave(asked: DataFrame, low: int, high: int) -> DataFrame:
        held = rows.where(F.col("block").between(low, high - 1)).withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(max(turns, 1) - 1))))
        held = held.select(F.col("block").alias("block_"), F.col("turn").alias("turn_"), "_f", "_r", "id", "label", "vector")
        mine = asked.withColumn("block", F.explode(F.sequence(F.lit(low), F.lit(high - 1))))
        out = mine.groupBy("block", "turn").cogroup(held.groupBy("block_", "turn_")).applyInArrow(_group(dim, k, same), f"_f long, _r long, high long, hits array<{vectors.HIT.format('long')}>")
        return out.groupBy("_f", "_r", "high").agg(vectors.first("hits", k).alias("hits"))

    found = common.written(wave(ask, 0, first), "first-hits")
    if first == blocks:
        return found
    full = found.where(F.size("hits") == k).groupBy("_f", "_r").agg(F.map_from_entries(F.collect_list(F.struct("high", -F.element_at("hits", -1)["less"]))).alias("floors"))
    raised = F.transform("windows", lambda w: F.struct(F.greatest(w["low"], F.coalesce(F.element_at("floors", w["high"]), w["low"])).alias("low"), w["high"].alias("high")))
    rest = wave(common.written(ask.join(full, ["_f", "_r"], "left").withColumn("windows", F.when(F.col("floors").isNull(), F.col("windows")).otherwise(raised)).drop("floors"), "raised"), first, blocks)
    return rest.union(found).groupBy("_f", "_r", "high").agg(vectors.first("hits", k).alias("hits"))


def mine(
    df: DataFrame, anchors: Column, per_anchor: int = 5, per_positive: int = 5, low: int = 80, high: int = 100, scale: int = 256,
    label: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """`anchor_id`, `positive_id`, `rank`, `negative_id`, `positive_score`, `negative_score`.

    `anchors` is a condition on `id`, `label` an expression of `id` and `label` that replaces the
    label. Components become floor(scale * component); a score is the whole inner product with the
    anchor. An anchor's positives are its `per_anchor` best other rows of its label. Negatives of a
    positive are the `per_positive` best rows of other labels whose score is between `low` and `high`
    per cent of the positive's. Both are windows of threshold joins between blocks of anchors and of
    rows; no pair below a window is passed on, and at most the window's number of each block is.

    Higher scores come first, ties by the smaller id, a null id last. Equal rows and repeated ids are
    rows like others; an anchor of a repeated id has its results each time. Rows with a null label, a
    null or empty vector or a null or non-finite component take no part, nor do vectors of another
    length than most. A positive with a score below zero has no negatives. Components and scores have
    to fit 64 bits. No rows, no anchors, or one label only give no rows.
    """
    rows = common.keyed(df, id_col, vector_col, label_col)
    rows = rows.select("_f", "_r", rows[id_col].cast("long").alias("id"), rows[label_col].cast("long").alias("label"), rows[vector_col].cast("array<double>").alias("vector"))
    rows = rows.where(F.col("label").isNotNull() & vectors.usable(F.col("vector"))).withColumn("vector", F.transform("vector", lambda x: F.floor(x * F.lit(float(scale)))))
    if label is not None:
        rows = rows.withColumn("label", label.cast("long"))
    rows = common.written(rows, "vectors")
    rows, dim = vectors.of_one_length(rows, "vector")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not dim:
        return common.frame(df.sparkSession, [], schema)
    n = rows.count()
    blocks = max(-(-n // ROWS), min(BLOCKS, -(-n // LEAST)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("_r", "_f"), F.lit(blocks)).cast("int"))
    ask = rows.where(anchors).select("_f", "_r", "id", "label", "vector")
    ends = F.array(F.struct(F.lit(-(1 << 62)).cast("long").alias("low"), F.lit(1 << 62).cast("long").alias("high")))
    found = common.written(_best(ask.withColumn("windows", ends), rows, blocks, dim, per_anchor, True), "positives")
    positives = found.select("_f", "_r", F.inline(F.transform("hits", lambda h: F.struct(h["id"].alias("positive_id"), h["_f"].alias("pf"), h["_r"].alias("pr"), (-h["less"]).alias("score")))))
    positives = common.written(positives, "positive-rows")
    # ceil(low * score / high) for scores of at least zero
    windows = positives.where("score >= 0").select("_f", "_r", F.struct(F.expr(f"(cast(score as decimal(20)) * {low} + {high - 1}) div {high}").alias("low"), F.col("score").alias("high")).alias("w"))
    windows = windows.groupBy("_f", "_r").agg(F.collect_set("w").alias("windows"))
    negatives = _best(common.written(ask.join(windows, ["_f", "_r"]), "windows"), rows, blocks, dim, per_positive, False)
    out = positives.join(negatives.withColumnRenamed("high", "score"), ["_f", "_r", "score"]).join(ask.select("_f", "_r", F.col("id").alias("anchor_id")), ["_f", "_r"])
    out = out.select("anchor_id", "positive_id", F.col("score").alias("positive_score"), F.posexplode("hits").alias("at", "hit"))
    return out.select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.id").alias("negative_id"), "positive_score", (-F.col("hit.less")).alias("negative_score")
    )
