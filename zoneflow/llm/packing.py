"""Concatenate and cut: all token ids in one line, cut into windows of fixed length."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm import common

common.shipped(__name__)

#: Word to ids that a task remembers before it starts anew.
REMEMBERED = 200_000
#: A space before something that is surely not white space begins a new token in any text.
_STARTS = re.compile(r" (?=\S)")


class Encoder:
    """Ids of a byte-level BPE vocabulary file, as little-endian 16-bit ids. No special token is added; those
    that stand in a text are their own ids.

    Words repeat, so ids are remembered by word. A text is parted before every space that stands
    before a visible character; no token of this kind of vocabulary crosses such a place.
    """

    def __init__(self, vocabulary: str) -> None:
        import tiktoken

        with open(vocabulary, encoding="utf-8") as f:
            said = json.load(f)
        tokens, added = said["model"]["vocab"], {t["content"]: t["id"] for t in said.get("added_tokens", [])}
        plain = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
        shown = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        ranks = {bytes(shown[c] for c in t): i for t, i in tokens.items() if all(c in shown for c in t)}
        ranks = {t: i for t, i in ranks.items() if t.decode("utf-8", "replace") not in added}
        self._added = {t: np.array([i], "<u2").tobytes() for t, i in added.items()}
        # of two that begin at a place the longer one
        self._cuts = re.compile("|".join(f"({re.escape(t)})" for t in sorted(added, key=len, reverse=True)) or r"(?!)")
        from public_tokenizers import PATTERN

        self._encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._known: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        out, at = [], 0
        for m in self._cuts.finditer(text):
            out += [self._plain(text[at : m.start()]) if m.start() > at else b"", self._added[m[0]]]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])]) if out else self._plain(text)

    def _plain(self, text: str) -> bytes:
        first, *rest = _STARTS.split(text)
        known, encode = self._known, self._encode
        if len(known) > REMEMBERED:
            known.clear()
        out = [np.array(encode(first), "<u2").tobytes()]
        try:
            out += map(known.__getitem__, rest)
        except KeyError:
            del out[1:]
            for w in rest:
                x = known.get(w)
                if x is None:
                    x = known[w] = np.array(encode(" " + w), "<u2").tobytes()
                out.append(x)
        return b"".join(out)


def _tokenize(vocabulary: str):
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.int64()), ("base", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, base = Encoder(vocabulary), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = [encoder.ids(t or "") + b"\0\0" for t in batch.column("text").to_pylist()]
            n = np.array([len(x) // 2 for x in ids], np.int64)
            ends = base + np.cumsum(n)
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), pa.array(np.full(len(n), part)), pa.array(ends - n), pa.array(n), pa.array(ids, pa.binary())], schema=schema)
            base = int(ends[-1]) if len(n) else base

    return run


def _cut(length: int, total: int):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "sequence_padded"]
    schema = pa.schema([(c, pa.int64()) for c in names])
    last = max(total - 1, 0) // length
    rest = total - last * length
    padded = rest if rest & (rest - 1) == 0 else length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, at, n, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "at", "n", "ids"))):
                ids = memoryview(np.frombuffer(raw, "<u2").astype("<u4").tobytes())
                start = 0
                while start < n:
                    seq, off = divmod(at + start, length)
                    size = min(n - start, length - off)
                    crc = zlib.crc32(ids[4 * start : 4 * (start + size)])
                    out.append((doc, start, size, crc, n, seq, off, rest if seq == last else length, padded if seq == last else length))
                    start += size
            cols = zip(*out) if out else [[] for _ in names]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in cols], schema=schema)

    return run


def pack(docs: DataFrame, vocabulary: str, length: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of documents in sequences of `length` tokens; only the last sequence has padding.

    A document is its ids and then id 0. First pass: each task writes its documents' ids with the
    number of ids before them in the task. Totals by task, summed up in task order, give the place
    of every document in the line of all ids. Second pass: each document is cut where the line is;
    a document that crosses a cut gives a piece to each side. `sequence_tokens` and
    `sequence_padded` describe the piece's sequence: padding goes to `length`, and a number of
    tokens that is a power of two gets none.

    Null and empty texts are one id. Equal rows are packed each. An empty table gives no rows.
    The totals broadcast have one row per task of the first pass.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    ids = common.written(rows.mapInArrow(_tokenize(vocabulary), "doc_id long, part long, base long, n long, ids binary"), "token-ids")
    sums = sorted((r.part, r.t) for r in ids.groupBy("part").agg(F.max(F.col("base") + F.col("n")).alias("t")).collect())
    ends = np.cumsum([0] + [t for _, t in sums]).tolist()
    first = common.frame(docs.sparkSession, [(p, e) for (p, _), e in zip(sums, ends)], "part long, first long")
    placed = ids.join(F.broadcast(first), "part").select("doc_id", (F.col("first") + F.col("base")).alias("at"), "n", "ids")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long, sequence_padded long"
    return placed.mapInArrow(_cut(length, ends[-1]), schema)
