"""Repeated passages by blockwise suffix sorting.

A string of SPAN bytes is found twice when two suffixes agree in their first SPAN bytes. Suffixes
are dealt to buckets by the smallest fingerprint among the SPAN bytes, so equal strings meet in one
bucket; neighbouring suffixes mostly share it, and such a run travels as one piece of text. What
cannot repeat (a fingerprint that occurs once) and what needs no order (all pieces of a bucket are
equal) is settled without bytes. The other buckets are sorted, block by block, in bounded memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.llm import common

common.shipped(__name__)

#: Bytes of a repeated string, and of the fingerprints that choose its bucket.
SPAN, GRAM = 200, 50
#: Bytes of text worked on at once; positions fit the low bits of a comparison key.
SEGMENT_BITS = 20
#: A difference cover of 32: every difference of residues is one of two members. Fixed values.
PERIOD, COVER = 32, (1, 2, 3, 4, 8, 12, 20)
#: Distinct pieces of a bucket that one block sorts; a bucket with more is split into its equal strings.
BLOCK_PIECES = 4096
#: Bytes of pieces sorted together, whole buckets at a time.
BLOCK_BYTES = 4 << 20
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MASK = (1 << 64) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


class Rolling:
    """Hashes of any stretch of up to 2^SEGMENT_BITS bytes: polynomials modulo 2^64 from running sums."""

    def __init__(self, base: int, size: int = 1 << SEGMENT_BITS) -> None:
        self.up, self.down = (self._powers(b, size + 1) for b in (base, pow(base, -1, 1 << 64)))

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base & _MASK, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=out[1:])
        return out

    def between(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * self.down[start]


def _window_least(key: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        key = np.minimum(key[:-have], key[have:])
        have *= 2
    rest = width - have
    return np.minimum(key[: len(key) - rest], key[rest:]) if rest else key


def runs(data: np.ndarray, bounds: np.ndarray, rolling: list[Rolling]) -> tuple[np.ndarray, ...]:
    """Of texts side by side: text, first start, starts, bucket, hash of the piece; for each run of starts."""
    step, out = (1 << SEGMENT_BITS) - SPAN, []
    for low in range(0, max(len(data) - SPAN + 1, 0), step):
        part = data[low : low + step + SPAN - 1]
        first, second = (r.sums(part) for r in rolling)
        n = len(part) - GRAM + 1
        at = np.arange(n)
        h = _mixed((first[GRAM:] - first[:n]) * rolling[0].down[:n])
        least = _window_least((h >> np.uint64(SEGMENT_BITS) << np.uint64(SEGMENT_BITS)) | at.astype(np.uint64), SPAN - GRAM + 1)
        where = (least & np.uint64((1 << SEGMENT_BITS) - 1)).astype(np.int64)
        starts = np.arange(len(where))
        text = np.searchsorted(bounds, starts + low, "right") - 1
        ok = starts + low + SPAN <= bounds[np.minimum(text + 1, len(bounds) - 1)]
        new = np.ones(len(where) + 1, bool)
        new[1:-1] = (where[1:] != where[:-1]) | (text[1:] != text[:-1]) | (ok[1:] != ok[:-1])
        edge = np.flatnonzero(new)
        a, b = edge[:-1], edge[1:]
        a, b = a[ok[a]], b[ok[a]]
        whole = b - 1 + SPAN
        piece = _mixed(rolling[0].between(first, a, whole)) * np.uint64(3) + _mixed(rolling[1].between(second, a, whole))
        out.append((text[a], a + low - bounds[text[a]], b - a, h[where[a]], piece))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column without nulls, side by side, and where each value begins."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if column.buffers()[2] is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rolling = [Rolling(b) for b in _BASES]
    for batch in batches:
        data, bounds = _bytes_of(batch.column("text"))
        text, at, n, bucket, piece = runs(data, bounds, rolling)
        keys = [batch.column(c).take(pa.array(text)) for c in ("_f", "_r")]
        yield pa.record_batch([*keys, pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(bucket.view(np.int64)), pa.array(piece.view(np.int64))], names=["_f", "_r", "at", "n", "bucket", "piece"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of wanted pieces."""
    for batch in batches:
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
            for low in range(0, len(wanted), 10_000):
                some = wanted[low : low + 10_000]
                cols = [pa.array([w[c] for w in some], pa.int64()) for c in ("bucket", "piece", "times")]
                yield pa.record_batch([*cols, pa.array([text[w["at"] : w["at"] + w["n"] - 1 + SPAN] for w in some], pa.binary())], names=["bucket", "piece", "times", "data"])


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Order-keeping numbers from 0 for rows of keys, first key first."""
    out = np.unique(keys[0], return_inverse=True)[1].astype(np.uint64)
    for k in keys[1:]:
        low = np.unique(k, return_inverse=True)[1].astype(np.uint64)
        out = np.unique(out << np.uint64(32) | low, return_inverse=True)[1].astype(np.uint64)
    return out


class Block:
    """Text of one block with the ranks of its cover sample."""

    def __init__(self, data: bytes) -> None:
        self.text = np.frombuffer(data + bytes(-len(data) % PERIOD + 2 * SPAN + 4 * PERIOD), np.uint8)
        self._words = np.lib.stride_tricks.sliding_window_view(self.text, 8)
        n = (len(self.text) - PERIOD) // PERIOD
        sample = (np.arange(n)[:, None] * PERIOD + np.array(COVER)).ravel()
        ranks = _dense(*(self.word(sample + 8 * k) for k in range(PERIOD // 8)))
        shift = 1  # in periods; a member a period on is a member
        while shift * PERIOD < SPAN:
            ahead = np.zeros_like(ranks)
            skip = shift * len(COVER)
            ahead[:-skip] = ranks[skip:] + np.uint64(1)
            ranks = np.unique(ranks << np.uint64(32) | ahead, return_inverse=True)[1].astype(np.uint64)
            shift *= 2
        self.rank = np.zeros(len(self.text), np.uint64)
        self.rank[sample] = ranks
        self.ahead = np.array([min((c - r) % PERIOD for c in COVER) for r in range(PERIOD)])

    def word(self, at: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(self._words[at]).view(">u8").ravel().astype(np.uint64)

    def repeated(self, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Whether a suffix agrees in SPAN bytes with another of its group; all of a group have one residue.

        Suffixes are ordered by group and first 16 bytes; ties go by the rank of the next member
        of the cover, which lies less than 16 bytes on. Neighbours of that order are compared.
        """
        ahead = self.ahead[at % PERIOD]
        rank = self.rank[at + ahead]
        key = _dense(group, self.word(at), self.word(at + 8))
        order = np.lexsort((rank, key))
        left, right = order[:-1], order[1:]
        same = key[left] == key[right]
        equal = same & (rank[left] == rank[right])
        open_ = np.flatnonzero(same & ~equal)
        for k in range(16, SPAN, 8):
            a, b = left[open_], right[open_]
            open_ = open_[self.word(at[a] + k) == self.word(at[b] + k)]
        equal[open_] = True
        out = np.zeros(len(at), bool)
        out[left[equal]] = out[right[equal]] = True
        return out


def anchored(data: bytes, rolling: list[Rolling]) -> int:
    """Where in a piece its bucket's fingerprint stands; the same for equal pieces."""
    part = np.frombuffer(data[:SPAN], np.uint8)
    sums = rolling[0].sums(part)
    n = SPAN - GRAM + 1
    h = _mixed((sums[GRAM:] - sums[:n]) * rolling[0].down[:n])
    return int(np.argmin((h >> np.uint64(SEGMENT_BITS) << np.uint64(SEGMENT_BITS)) | np.arange(n, dtype=np.uint64)))


def _sorted_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of repeated suffixes in each piece. Rows come sorted by bucket; a block holds whole buckets."""
    rolling = [Rolling(b, SPAN) for b in _BASES]

    def solve(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        data, at, group, owner, index = bytearray(), [], [], [], {}
        for i, (bucket, _, _, piece) in enumerate(rows):
            anchor = anchored(piece, rolling)
            data += bytes((-(len(data) + anchor)) % PERIOD)  # anchors share a residue, so do suffixes as far before them
            n = len(piece) - SPAN + 1
            low = len(data)
            at.append(np.arange(low, low + n))
            number = index.setdefault(bucket, len(index))
            group.append(np.arange(anchor, anchor - n, -1) + number * (2 * SPAN) + SPAN)
            owner.append(np.full(n, i))
            data += piece
        at, group, owner = np.concatenate(at), np.concatenate(group), np.concatenate(owner)
        hit = Block(bytes(data)).repeated(at, group.astype(np.uint64))
        firsts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        hit |= np.array([t > 1 for _, _, t, _ in rows])[owner]
        edge = np.flatnonzero(np.concatenate([[True], (hit[1:] != hit[:-1]) | (owner[1:] != owner[:-1]), [True]]))
        a, b = edge[:-1], edge[1:]
        a, b = a[hit[a]], b[hit[a]]
        who = owner[a]
        keys = [pa.array(np.array([r[k] for r in rows], np.int64)[who]) for k in (0, 1)]
        return pa.record_batch([*keys, pa.array((a - firsts[who]).astype(np.int32)), pa.array((b - a).astype(np.int32))], names=["bucket", "piece", "skip", "n"])

    held, size = [], 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "piece", "times", "data"))):
            if size > BLOCK_BYTES and row[0] != held[-1][0]:
                yield solve(held)
                held, size = [], 0
            held.append(row)
            size += len(row[3])
    if held:
        yield solve(held)


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every suffix of a piece with its place before the anchor and two hashes of its SPAN bytes."""
    rolling = [Rolling(b, 1 << 12) for b in _BASES]
    for batch in batches:
        for bucket, piece, times, data in zip(*(batch.column(c).to_pylist() for c in ("bucket", "piece", "times", "data"))):
            part = np.frombuffer(data, np.uint8)
            start = np.arange(len(part) - SPAN + 1)
            one, two = (_mixed(r.between(r.sums(part), start, start + SPAN)).view(np.int64) for r in rolling)
            flat = [pa.array(np.full(len(start), x, np.int64)) for x in (bucket, piece, times)]
            yield pa.record_batch([*flat, pa.array(start.astype(np.int32)), pa.array(one), pa.array(two)], names=["bucket", "piece", "times", "skip", "one", "two"])


def spans(rows: DataFrame) -> DataFrame:
    """(`_f`, `_r`, `at`, `n`): SPAN bytes from each of `n` starts from `at` on also start elsewhere. `rows`: `_f`, `_r`, `text` (binary)."""
    steps = common.Steps(rows.sparkSession)
    found = steps.write(rows.mapInArrow(_runs, "_f long, _r long, at int, n int, bucket long, piece long"), "suffix-runs")
    twice = found.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1").select("bucket")
    twice = steps.write(twice, "repeated-buckets")  # else both sides of the join are one stage, and a hot bucket is not split
    found = steps.write(found.join(twice, "bucket"), "repeated-runs")
    steps.drop("suffix-runs", "repeated-buckets")
    pieces = found.groupBy("bucket", "piece").agg(F.count("*").alias("times"), F.min(F.struct("_f", "_r", "at", "n")).alias("one"))
    pieces = steps.write(pieces, "pieces")
    kinds = steps.write(pieces.groupBy("bucket").agg(F.count("*").alias("kinds")), "buckets")
    alike = found.join(kinds.where("kinds = 1"), "bucket").select("_f", "_r", "at", "n")
    mixed = pieces.join(kinds.where("kinds > 1"), "bucket")
    wanted = mixed.groupBy("one._f", "one._r").agg(F.collect_list(F.struct("bucket", "piece", "times", "one.at", "one.n")).alias("wanted"))
    data = rows.join(wanted, ["_f", "_r"]).select("text", "wanted").mapInArrow(_pieces, "bucket long, piece long, times long, data binary")
    data = steps.write(data.join(kinds.where("kinds > 1"), "bucket"), "piece-bytes")
    steps.drop("pieces")
    small = data.where(F.col("kinds") <= BLOCK_PIECES).drop("kinds").repartition("bucket").sortWithinPartitions("bucket")
    hit = small.mapInArrow(_sorted_blocks, "bucket long, piece long, skip int, n int")
    each = data.where(F.col("kinds") > BLOCK_PIECES).drop("kinds").mapInArrow(_strings, "bucket long, piece long, times long, skip int, one long, two long")
    equal = each.groupBy("bucket", "one", "two").agg(F.sum("times").alias("times")).where("times > 1").drop("times")
    hit = hit.unionByName(each.join(equal, ["bucket", "one", "two"]).select("bucket", "piece", "skip", F.lit(1).alias("n")))
    hit = steps.write(hit, "repeated-suffixes")
    steps.drop("piece-bytes")
    some = found.drop("n").join(hit, ["bucket", "piece"]).select("_f", "_r", (F.col("at") + F.col("skip")).alias("at"), "n")
    out = steps.write(alike.unionByName(some), "repeated-spans")
    steps.drop("repeated-runs", "buckets", "repeated-suffixes")
    return out


def _covered(size: int, found: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((x["at"], x["at"] + x["n"] - 1 + SPAN) for x in found or []):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    assert not out or out[-1][1] <= size
    return out


def _rest(text: bytes, gone: list[tuple[int, int]]) -> bytes:
    ends = [0, *(b for _, b in gone)]
    return b"".join(text[a:b] for a, b in zip(ends, [*(a for a, _ in gone), len(text)]))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist()):
            gone = _covered(len(text), found)
            out.append((len(text), sum(b - a for a, b in gone), len(gone), hashlib.sha256(_rest(text, gone)).hexdigest()))
        cols = list(zip(*out)) if out else [[]] * 4
        yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _cleaned(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Texts without their repeated bytes; null where none repeats."""
    out = []
    for text, found in zip(texts.to_pylist(), spans.to_pylist()):
        if not found:
            out.append(None)
            continue
        inner = []  # whole characters only: a character that is covered in part stays
        for a, b in _covered(len(text), found):
            while a < b and text[a] & 0xC0 == 0x80:
                a += 1
            while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
                b -= 1
            inner.append((a, b))
        out.append(_rest(text, inner).decode())
    return pa.array(out, pa.string())


def _found(rows: DataFrame, text: Column) -> DataFrame:
    """The repeated starts `found` in each row's `text`, bytes without nulls; only rows that have some."""
    found = spans(rows.select("_f", "_r", text.alias("text")))
    return found.groupBy("_f", "_r").agg(F.collect_list(F.struct("at", "n")).alias("found"))


def _bytes(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256` for each row.

    Every byte goes that a SPAN-byte string covers which also starts anywhere else, in the same
    text or another. Texts are UTF-8 bytes, null ones empty; strings never cross texts. Copies of a
    text of SPAN bytes or more lose all of it. Equal rows count as two texts. Texts shorter than
    SPAN stay whole. An empty table gives no rows.
    """
    rows = common.keyed(docs, id_col, text_col)
    text = _bytes(F.col(text_col))
    rows = rows.join(_found(rows, text), ["_f", "_r"], "left").select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), "found")
    return rows.mapInArrow(_digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The rows of `docs`, repeated bytes taken out of their texts; characters stay whole.

    A text without repeats is left as it is, a null one null. `chars_col` is counted anew where a
    text has changed, if there is such a column.
    """
    docs = common.filed(docs)
    found = _found(common.keyed(docs, text_col), _bytes(F.col(text_col)))
    rows = common.whole(docs).join(found, ["_f", "_r"], "left")
    old, new = F.col("_row"), F.col("cleaned")
    # one join: texts that stay as they are go to no Python
    rows = rows.withColumn("cleaned", F.arrow_udf(_cleaned, "string")(F.when(F.col("found").isNotNull(), _bytes(old[text_col])), "found"))
    changed = {text_col: F.coalesce(new, old[text_col])}
    if chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        changed[chars_col] = F.when(new.isNull(), old[chars_col]).otherwise(F.length(new).cast(kind))
    return rows.select([changed.get(c, old[c]).alias(c) for c in docs.columns])
