"""Quality scores from preference pairs: Bradley-Terry by logistic loss on feature differences."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.llm import common

common.shipped(__name__)

#: Labelled rows of each class that the fit may read, and pairs it draws from them.
SAMPLE, PAIRS = 20_000, 200_000
#: The score that the chosen quantile gets: at or above, a text is predicted to be good.
THRESHOLD = 0.3
RIDGE, ROUNDS, SEED = 1e-3, 25, 7
_UPPER, _DIGIT, _SPACE = bytes(range(65, 91)), b"0123456789", b" \t\n\x0b\x0c\r"
_KINDS = (_UPPER, _DIGIT, b"\n", b"#*$%&<>", b"|", b"!", b".,;:?", bytes(range(128, 192)))
N_FEATURES = len(_KINDS) + 8


def features(text: str | None) -> list[float]:
    """Shares of kinds of bytes, sizes of words, and how much repeats. All zero but one for no text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    n = len(data) + 1
    out = [math.sqrt((len(data) - len(data.translate(None, k))) / n) for k in _KINDS]
    words = data.lower().split()
    m = len(words)
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    lines = [x for x in data.split(b"\n") if x]
    out += [
        1.0,
        math.log1p(m),
        sum(map(len, words)) / m / 10 if m else 0.0,
        len(counts) / m if m else 0.0,
        max(counts.values()) / m if m else 0.0,
        len(pairs) / (m - 1) if m > 1 else 1.0,
        len(set(lines)) / len(lines) if lines else 1.0,
        sum(1 for w in words if not w[-1:].isalnum() and w[-1] < 128) / m if m else 0.0,
    ]
    return out


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [features(t) for t in batch.column("text").to_pylist()]
        yield pa.record_batch([batch.column("doc_id"), pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "x"])


@dataclass
class Ranking:
    """Scores and the line between good and bad."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    line: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; the line gets THRESHOLD."""
        raw = ((x - self.mean) / self.scale) @ self.weights - self.line + math.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(raw, -500, 500)))


def fit(good: np.ndarray, bad: np.ndarray, share_bad: float, n_pairs: int = PAIRS) -> Ranking:
    """Weights under which good rows beat bad ones, by Newton steps; the line is the quantile that parts labels best.

    `share_bad`: share of bad rows among all labelled ones, which weighs the two kinds of errors.
    """
    k = good.shape[1]
    both = np.concatenate([good, bad])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-9
    good, bad = (good - mean) / scale, (bad - mean) / scale
    rng = np.random.default_rng(SEED)
    d = good[rng.integers(0, len(good), n_pairs)] - bad[rng.integers(0, len(bad), n_pairs)]
    w = np.zeros(k)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -50, 50)))
        slope = d.T @ (1 - p) / n_pairs - RIDGE * w
        curve = (d * (p * (1 - p))[:, None]).T @ d / n_pairs + RIDGE * np.eye(k)
        step = np.linalg.solve(curve, slope)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    g, b = np.sort(good @ w), np.sort(bad @ w)
    lines = np.unique(np.quantile(np.concatenate([g, b]), np.linspace(0, 1, 1001)))
    right = share_bad * np.searchsorted(b, lines) / len(b) + (1 - share_bad) * (1 - np.searchsorted(g, lines) / len(g))
    best = lines[right >= right.max() - 1e-12]
    return Ranking(mean, scale, w, float(best[len(best) // 2]))


def _scores(ranking: Ranking):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)
            yield pa.record_batch([batch.column("doc_id"), pa.array(ranking.score(x))], names=["doc_id", "score"])

    return run


def _sample(rows: DataFrame, n: int) -> np.ndarray:
    """Features of about SAMPLE of `n` rows, never more: those with the smallest hashes.

    A share of the hashes' range is collected, not the first rows of an order: that would bring
    SAMPLE rows of every task to the driver.
    """
    key = F.pmod(F.xxhash64("doc_id", "x"), F.lit(1 << 40))
    share = 1.0 if n <= SAMPLE else 0.95 * SAMPLE / n
    found = rows.where(key < int(share * (1 << 40))).select(key.alias("key"), "doc_id", "x").collect()
    return np.array([r.x for r in sorted(found, key=lambda r: (r.key, r.doc_id))[:SAMPLE]])


def rank(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """`doc_id`, `held_out`, `score`, `predicted` for each row.

    Features come from the text alone. The fit reads at most SAMPLE rows of each label, those with
    the smallest hashes of id and features, and never held-out ones. `held_out` is over `doc_id`.

    Null and empty texts are scored like any other. Rows with a null id, or with ids that no label
    has, are scored but not learned from; a label that is null or neither 0 nor 1 is none. Where
    labels of one kind are missing, all scores are 0.5. An empty table gives no rows.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    facts = common.written(rows.mapInArrow(_features, f"doc_id {kind}, x array<double>"), "text-features")
    marks = labels.select(labels[id_col].alias("doc_id"), labels[label_col].alias("label")).where("doc_id is not null and label in (0, 1)")
    learn = common.written(facts.join(marks.where(~held_out), "doc_id"), "labelled-features")
    sizes = dict(tuple(r) for r in learn.groupBy("label").agg(F.count("*")).collect())
    some = {k: _sample(learn.where(F.col("label") == k), sizes.get(k, 0)) for k in (0, 1)}
    held = F.coalesce(held_out, F.lit(False)).alias("held_out")
    if not sizes.get(0) or not sizes.get(1):
        scored = facts.select("doc_id", F.lit(0.5).alias("score"))
    else:
        ranking = fit(some[1], some[0], sizes[0] / (sizes[0] + sizes[1]))
        scored = facts.mapInArrow(_scores(ranking), f"doc_id {kind}, score double")
    return scored.select("doc_id", held, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
