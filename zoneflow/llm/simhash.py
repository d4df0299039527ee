"""SimHash fingerprints and their near copies by anchors of a covering code."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm import common

common.shipped(__name__)

#: Bits of a block of the code, and the blocks' first bits: two Hamming codes of length 31.
BLOCK, SHIFTS = 31, (0, 31)
#: Rows of replicated fingerprints that are compared at once, and rows of an anchor compared at once.
CHUNK, TILE = 200_000, 2048
_SEED = 42


def fingerprint(text: str | None, words: int = 3) -> int:
    """64 bits: bit b is set where over half of the shingles' hashes have it."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    if len(parts) < words:
        shingles = [b" ".join(parts)]
    elif words == 3:
        shingles = [b"%b %b %b" % x for x in zip(parts, parts[1:], parts[2:])]
    else:
        shingles = [b" ".join(x) for x in zip(*(parts[i:] for i in range(words)))]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(s, _SEED) for s in shingles], "<u8")
    sums = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        sums += np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * sums > len(h), bitorder="little").tobytes(), "little")


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.record_batch([*batch.columns[:3], pa.array(fps.view(np.int64))], names=["_f", "_r", "doc_id", "fp"])

    return run


def _syndrome(x: np.ndarray) -> np.ndarray:
    """Of 31-bit words: the position, from 1, of the bit to flip for the nearest code word; 0 for none."""
    s = np.zeros(len(x), np.int64)
    for k in range(5):
        mask = sum(1 << (p - 1) for p in range(1, BLOCK + 1) if p >> k & 1)
        s |= (np.bitwise_count(x & mask).astype(np.int64) & 1) << k
    return s


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the fingerprint, anchor, whether it is the nearest; for each anchor in reach.

    The code's covering radius is 1. Fingerprints that differ in 3 bits at most differ in 1 at
    most on one of the two blocks; there the anchor nearest to one lies within 2 of the other.
    So each goes to all anchors within 2 of each block: the nearest one and those two flips away.
    """
    index, keys, home = [], [], []
    everyone = np.arange(len(fps))
    for b, shift in enumerate(SHIFTS):
        x = ((fps >> np.uint64(shift)) & np.uint64((1 << BLOCK) - 1)).astype(np.int64)
        s = _syndrome(x)
        near = np.where(s > 0, x ^ (1 << np.maximum(s - 1, 0)), x)
        index.append(everyone), keys.append(near | b << BLOCK), home.append(np.ones(len(fps), bool))
        for p in range(1, BLOCK + 1):
            q = p ^ s
            ok = np.flatnonzero((s > 0) & (q > p))
            index.append(ok), keys.append((x[ok] ^ (1 << (p - 1)) ^ (1 << (q[ok] - 1))) | b << BLOCK), home.append(np.zeros(len(ok), bool))
    return np.concatenate(index), np.concatenate(keys), np.concatenate(home)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column("fp").to_numpy(zero_copy_only=False)
        at, key, home = anchors(fps.view(np.uint64))
        yield pa.record_batch([pa.array(key), pa.array(fps[at]), pa.array(home)], names=["anchor", "fp", "home"])


def _forest(nodes: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each linked node with the smallest node it reaches in these links."""
    used, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(used))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low), np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low), np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return nodes[used], nodes[used[label]]


def _compare(limit: int):
    def tile(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links among the fingerprints of one large anchor, block against block, kept as a forest."""
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in range(0, len(fp), TILE):
            for j in range(i, len(fp), TILE):
                x, y = np.nonzero(np.bitwise_count(fp[i : i + TILE, None] ^ fp[None, j : j + TILE]) <= limit)
                node, root = _forest(np.arange(len(fp)), x + i, y + j)
                a.append(node), b.append(root)
        return np.concatenate(a), np.concatenate(b)

    def links(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(anchor)]]))
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at, n in zip(starts[sizes > 64], sizes[sizes > 64]):
            x, y = tile(fp[at : at + n])
            a.append(x + at), b.append(y + at)
        size = np.repeat(sizes, sizes)
        left = np.flatnonzero((size <= 64) & (size > 1))
        d = 1
        while len(left):
            left = left[left + d < len(anchor)]
            left = left[anchor[left] == anchor[left + d]]
            right = left + d
            ok = (home[left] | home[right]) & (np.bitwise_count(fp[left] ^ fp[right]) <= limit)
            a.append(left[ok]), b.append(right[ok])
            d += 1
        used, where = np.unique(fp, return_inverse=True)
        node, root = _forest(used, where[np.concatenate(a)], where[np.concatenate(b)])
        keep = node != root
        return pa.record_batch([pa.array(node[keep].view(np.int64)), pa.array(root[keep].view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def columns():
            t = pa.Table.from_batches(held)
            return (t.column(c).to_numpy() for c in ("anchor", "fp", "home"))

        for batch in batches:
            held.append(batch)
            if sum(len(x) for x in held) >= CHUNK:
                anchor, fp, home = columns()
                if anchor[0] == anchor[-1]:  # one anchor alone: wait for its end
                    held[:] = [pa.record_batch([pa.array(anchor), pa.array(fp), pa.array(home)], names=["anchor", "fp", "home"])]
                    continue
                end = int(np.searchsorted(anchor, anchor[-1]))
                yield links(anchor[:end], fp[:end].view(np.uint64), home[:end])
                held[:] = [pa.record_batch([pa.array(x[end:]) for x in (anchor, fp, home)], names=["anchor", "fp", "home"])]
        if held:
            anchor, fp, home = columns()
            if len(anchor):
                yield links(anchor, fp.view(np.uint64), home)

    return run


def near_duplicates(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`_f`, `_r` (the row), `doc_id`, `fingerprint`, `root`, `component_id` for each row.

    Fingerprints link at 3 or fewer differing bits. Only distinct fingerprints are compared, each
    at the anchors of a covering code that it can share with a near one; what an anchor links is
    passed on as a forest, never as all pairs. `root` is the component's smallest fingerprint,
    `component_id` the smallest doc_id that links reach, so any copies come together however many
    they are.

    Null, empty and blank texts have fingerprint zero and link like any other. A null doc_id takes
    part; a component of such rows alone has a null id. An empty table gives no rows.
    """
    rows = common.keyed(docs, id_col, text_col)
    rows = rows.select("_f", "_r", rows[id_col].cast("long").alias("doc_id"), rows[text_col].alias("text"))
    prints = common.written(rows.mapInArrow(_fingerprints(words), "_f long, _r long, doc_id long, fp long"), "fingerprints")
    distinct = common.written(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-prints")
    near = distinct.select("fp").mapInArrow(_replicate, "anchor long, fp long, home boolean")
    edges = near.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_compare(3), "a long, b long")
    roots = common.components(edges)
    linked = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    low = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    named = common.written(linked.join(low, "root").select("fp", "root", "component_id"), "named-prints")
    return prints.join(named, "fp").select("_f", "_r", "doc_id", common.unsigned_hex(F.col("fp")).alias("fingerprint"), "root", "component_id")


def one_of_each(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, one of each component: that of the smallest doc_id, of equal ones the first in its file."""
    docs = common.filed(docs)
    found = near_duplicates(docs, words, id_col, text_col)
    stays = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_f", "_r")).alias("m"))
    return common.among(docs, stays.select("m._f", "m._r"))
