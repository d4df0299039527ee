"""Two tokenizations of the same texts, aligned: windows between shared ends at white space, counted links."""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm import common

common.shipped(__name__)

#: White space and its visible sign in pieces.
SPACE, SIGN = " ", "▁"
#: Words whose ids a task remembers before it starts anew.
REMEMBERED = 400_000
#: A segment is closed at so many different windows or so many windows in all, so that it fits a task.
KINDS, PLACES = 400_000, 1 << 22
#: Windows, or pairs, of a row that a segment writes when it is closed.
BLOCK = 1 << 13
#: Pairs whose counts every task holds, the most frequent ones: 24 bytes each. The others are joined.
FREQUENT = 1 << 20
#: Neither vocabulary has a token that crosses such a place: a space between two visible signs or after a line end.
_APART = re.compile(rf"(?<=[^{SPACE}{SIGN}]){SPACE}(?=\S)")
#: A word that can be looked up together with others.
_PLAIN = re.compile(rf"[^\s{SIGN}]{{1,63}}")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


class Byte:
    """A byte-level BPE vocabulary file: ids of texts, special tokens as plain text, and bytes of ids."""

    def __init__(self, path: str) -> None:
        import json

        import tiktoken
        from public_tokenizers import PATTERN

        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        plain = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
        shown = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        special = {t["content"] for t in said.get("added_tokens", [])}
        ranks = {bytes(shown[c] for c in t): i for t, i in said["model"]["vocab"].items() if t not in special}
        self.encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes[i] = token


class Piece:
    """A piece model: ids of texts, before which it sets a space, and bytes of ids."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(p)) else p.replace(SIGN, SPACE).encode() for p in pieces]
        lone = model.piece_to_id(SIGN)
        # the model gives no id for nothing, also where its own space is asked for
        self.encode = lambda text: model.encode(text) if text else [lone]


class Tokens:
    """Ids of both vocabularies for a space and a word, as 16-bit numbers; None where a side does not spell it.

    No token crosses a space between visible signs, so the ids of a text are those of its words, and words repeat.
    """

    def __init__(self, a: str, b: str) -> None:
        self.a, self.b = Byte(a), Piece(b)
        self.known: dict[str, tuple[bytes, bytes] | None] = {}

    def _found(self, word: str) -> tuple[bytes, bytes] | None:
        a, b, whole = self.a.encode(SPACE + word), self.b.encode(word), (SPACE + word).encode("utf-8", "surrogatepass")
        if b"".join([self.a.bytes[i] for i in a]) == whole == b"".join([self.b.bytes[i] for i in b]):
            return array("H", a).tobytes(), array("H", b).tobytes()
        return None

    def _learn(self, words: list[str]) -> None:
        """All at once, as one text. A word without blanks has a token that begins with a space at its start only."""
        text = SPACE.join(words)
        whole, sides = (SPACE + text).encode("utf-8", "surrogatepass"), []
        for side, ids in ((self.a, self.a.encode(SPACE + text)), (self.b, self.b.encode(text))):
            spelled = [side.bytes[i] for i in ids]
            if b"".join(spelled) != whole:  # some word is not spelled: each by itself
                self.known.update((w, self._found(w)) for w in words)
                return
            sides += [array("H", ids).tobytes(), [2 * k for k, x in enumerate(spelled) if x[:1] == b" "] + [2 * len(ids)]]
        a, p, b, q = sides
        self.known.update(zip(words, zip([a[i:j] for i, j in zip(p, p[1:])], [b[i:j] for i, j in zip(q, q[1:])])))

    def words(self, text: str) -> list[tuple[bytes, bytes] | None]:
        words, known = _APART.split(text), self.known
        try:
            return list(map(known.__getitem__, words))
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            new = [w for w in dict.fromkeys(words) if w not in known]
            if plain := [w for w in new if _PLAIN.fullmatch(w)]:
                self._learn(plain)
            odd = {w: self._found(w) for w in new if w not in known}
            known.update((w, f) for w, f in odd.items() if len(w) < 64)
            return [known[w] if w in known else odd[w] for w in words]


class Windows:
    """Windows by their ids on both sides, each aligned once, numbered in the order of their first place."""

    def __init__(self, tokens: Tokens) -> None:
        sides = (tokens.a.bytes, tokens.b.bytes)
        self.long = [[len(x) for x in side] for side in sides]
        self.name = [b"%d" % i for i in range(max(map(len, sides)))]
        self.size = np.zeros((3, 1024), np.int64)
        self.clear()

    def clear(self) -> None:
        self.number: dict[tuple[bytes, bytes], int] = {}
        self.text: list[bytes] = []
        self.links: list[array] = []
        self.times: list[np.ndarray] = []
        self.places = 0

    def align(self, key: tuple[bytes, bytes]) -> int:
        """Groups between shared ends as text, and a link for each stretch between any two ends."""
        a, b = array("H", key[0]), array("H", key[1])
        (long_a, long_b), name = self.long, self.name
        links, groups, i, j, p, q, end = [], [], 0, 0, 0, 0, len(a)
        x, y = long_a[a[0]], long_b[b[0]]
        while True:
            links.append(a[i] << 16 | b[j])
            if x < y:
                i += 1
                x += long_a[a[i]]
            elif y < x:
                j += 1
                y += long_b[b[j]]
            else:
                i, j = i + 1, j + 1
                if i == p + 1 and j == q + 1:
                    groups.append(b"%b|%b" % (name[a[p]], name[b[q]]))
                else:
                    groups.append(b"%b|%b" % (b",".join([name[k] for k in a[p:i]]), b",".join([name[k] for k in b[q:j]])))
                if i == end:
                    break
                p, q = i, j
                x, y = x + long_a[a[i]], y + long_b[b[j]]
        n = len(self.links)
        if n == self.size.shape[1]:
            self.size = np.concatenate([self.size, np.zeros_like(self.size)], axis=1)
        self.size[:, n] = end, len(b), len(groups)
        self.links.append(array("q", links))
        self.text.append(b";".join(groups))
        self.number[key] = n
        return n

    def of(self, words: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, list[int], bytes]:
        """Numbers of a text's windows; its tokens on both sides and shared ends; its groups.

        Words are spelled by both sides, so both end where a word ends, and both go on with a token that
        begins with a space: windows are the words, by their ids.
        """
        found = list(map(self.number.get, words))
        if None in found:
            get = self.number.get
            found = [self.align(k) if (n := get(k)) is None else n for k in words]
        held = np.array(found, np.int32)
        self.places += len(found)
        self.times.append(held)
        return held, self.size[:, held].sum(axis=1).tolist(), b";".join(map(self.text.__getitem__, found))

    def counted(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All links window after window, the windows' numbers of links, and how often each window came."""
        flat = np.frombuffer(b"".join(self.links), np.int64)
        times = np.zeros(len(self.links), np.int64)
        for held in self.times:
            np.add.at(times, held, 1)
        return flat, np.array([len(x) for x in self.links], np.int64), times


_COLUMNS = {"segment": pa.int64(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64()}
_COLUMNS |= {"groups": pa.string(), "windows": pa.binary(), "first": pa.int64(), "lengths": pa.binary(), "links": pa.binary()}
_COLUMNS |= {"pair": pa.list_(pa.int64()), "times": pa.list_(pa.int64())}
_TABLE = "segment long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, windows binary, first long, lengths binary, links binary, pair array<long>, times array<long>"


def _batch(**columns: list) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.record_batch([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in _COLUMNS.items()], schema=pa.schema(list(_COLUMNS.items())))


def _aligned(a: str, b: str, whole: bool):
    """Rows of texts (`windows`) and, when a segment is closed, of blocks of its windows (`links`) and its counted pairs (`pair`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(a, b)
        windows, segment = Windows(tokens), TaskContext.get().partitionId() << 24
        names = ("segment", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "windows")

        def closed() -> Iterator[pa.RecordBatch]:
            flat, lengths, times = windows.counted()
            ends = np.cumsum(lengths)
            for at in range(0, len(times), BLOCK):
                cut = slice(at, at + BLOCK)
                links = flat[ends[at] - lengths[at] : ends[cut][-1]]
                yield _batch(segment=[segment], first=[at], lengths=[lengths[cut].tobytes()], links=[links.tobytes()])
            pair, back = np.unique(flat, return_inverse=True)
            sums = np.bincount(back, np.repeat(times, lengths), len(pair)).astype(np.int64)
            for at in range(0, len(pair), BLOCK):
                yield _batch(pair=[pair[at : at + BLOCK]], times=[sums[at : at + BLOCK]])
            windows.clear()

        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = tokens.words(text) if text else [None]
                if None in words:
                    rows.append((segment, doc, 0, 0, 0, 0, "", b""))
                    continue
                held, (n_a, n_b, groups), said = windows.of(words)
                # a link for each stretch between any two ends, of which the shared ones count once
                rows.append((segment, doc, n_a, n_b, groups, n_a + n_b - groups, said.decode() if whole else hashlib.sha256(said).hexdigest(), held.tobytes()))
                if len(windows.number) >= KINDS or windows.places >= PLACES:
                    yield _batch(**dict(zip(names, zip(*rows))))
                    yield from closed()
                    rows, segment = [], segment + 1
            if rows:
                yield _batch(**dict(zip(names, zip(*rows))))
        yield from closed()

    return run


def _values(known):
    """Sums over the links of each window whose pair is `known`; the other links one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, count, best = known.value
        for batch in batches:
            out = []
            for segment, first, lengths, links in zip(*(batch.column(c).to_pylist() for c in ("segment", "first", "lengths", "links"))):
                links = np.frombuffer(links, np.int64)
                window = np.repeat(np.arange(len(lengths) // 8), np.frombuffer(lengths, np.int64))
                at = np.minimum(np.searchsorted(pair, links), max(len(pair) - 1, 0))
                ok = pair[at] == links if len(pair) else np.zeros(len(links), bool)
                sums = np.zeros((2, len(lengths) // 8), np.int64)
                np.add.at(sums[0], window[ok], best[at[ok]]), np.add.at(sums[1], window[ok], count[at[ok]])
                out.append((segment, first, sums.tobytes(), first + window[~ok], links[~ok]))
            cols = list(zip(*out)) if out else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds)], names=["segment", "first", "sums", "window", "link"])

    return run


def _sums(key: tuple, docs: pa.Table, blocks: pa.Table) -> pa.Table:
    """Of each text of a segment, the sums over its windows."""
    held = [np.frombuffer(x, np.int32) for x in docs.column("windows").to_pylist()]
    value = np.zeros((2, 1 + max([-1, *(int(x.max()) for x in held if len(x))])), np.int64)
    for first, sums, best, total in zip(*(blocks.column(c).to_pylist() for c in ("first", "sums", "best", "total"))):
        if sums is None:
            value[:, first] += (best, total)
        else:
            block = np.frombuffer(sums, np.int64).reshape(2, -1)
            value[:, first : first + block.shape[1]] += block
    found = np.array([value[:, x].sum(axis=1) for x in held], np.int64).reshape(-1, 2)
    kept = docs.drop_columns(["segment", "windows"])
    return kept.append_column("n_best", pa.array(found[:, 0])).append_column("count_sum", pa.array(found[:, 1]))


def _pairs(rows: DataFrame) -> DataFrame:
    """`link` (both ids in one number), `b`, `count`: how many links of the corpus hold the pair, and `best`."""
    counts = rows.select(F.inline(F.arrays_zip("pair", "times"))).groupBy(F.col("pair").alias("link")).agg(F.sum("times").alias("count"))
    counts = common.written(counts.withColumn("b", F.col("link").bitwiseAND(0xFFFF)), "pair-counts")
    # one row for each id of the second vocabulary at most
    best = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(F.broadcast(best), "b").select("link", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def _rows(docs: DataFrame, a: str, b: str, id_col: str, text_col: str, whole: bool) -> DataFrame:
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return common.written(texts.mapInArrow(_aligned(a, b, whole), _TABLE), "aligned")


def pairs(docs: DataFrame, a: str, b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`a`, `b`, `count`, `best`: linked ids, how many links of all texts hold the pair, whether none holds b more often."""
    found = _pairs(_rows(docs, a, b, id_col, text_col, False))
    return found.select(F.shiftright("link", 16).alias("a"), "b", "count", "best")


def align(docs: DataFrame, a: str, b: str, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """`doc_id`, `n_a`, `n_b`, `n_groups`, `n_links`, `groups`, `n_best`, `count_sum` for each row.

    `a` is a byte-level BPE file and `b` a piece model. Both encode a space and the text. Places where
    a token of each ends cut the bytes into groups; `groups` lists their ids, as text (`whole`) or as
    its SHA-256. Tokens whose bytes overlap are linked; `count_sum` and `n_best` are over the links of
    a text, by counts over all texts.

    A text is encoded whole, word by word where no token of either side can cross. Windows are cut at
    shared ends, verified by the bytes of both sides, that a token with a leading space follows on
    both. A window is known by its ids; it is aligned once in a segment, a
    run of texts with a bounded number of windows. Links are counted by window, not by place, and
    counts come back by window; only window numbers go with a text, to its segment's values.

    Null and empty texts, and those that either side does not spell byte for byte (such as a text with
    the sign that pieces have for a space), have no tokens: zeros and an empty `groups`. Equal rows and
    null ids are rows like others. An empty table gives no rows.
    """
    rows = _rows(docs, a, b, id_col, text_col, whole)
    counted = common.written(_pairs(rows), "pairs")
    often = counted.where(common.most(counted, "count", FREQUENT)).select("link", "count", F.col("best").cast("long").alias("best")).toArrow().sort_by("link")
    known = docs.sparkSession.sparkContext.broadcast(tuple(often.column(c).to_numpy() for c in ("link", "count", "best")))
    blocks = rows.where("links is not null").select("segment", "first", "lengths", "links")
    blocks = common.written(blocks.mapInArrow(_values(known), "segment long, first long, sums binary, window array<long>, link array<long>"), "window-values")
    rare = blocks.select("segment", F.inline(F.arrays_zip("window", "link"))).join(counted, "link")
    rare = rare.select(F.col("segment").alias("part"), F.col("window").alias("first"), F.lit(None).cast("binary").alias("sums"), F.col("best").cast("long").alias("best"), F.col("count").alias("total"))
    values = blocks.select(F.col("segment").alias("part"), "first", "sums", F.lit(0).cast("long").alias("best"), F.lit(0).cast("long").alias("total")).union(rare)
    texts = rows.where("windows is not null").select("segment", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "windows")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long"
    return texts.groupBy("segment").cogroup(values.groupBy("part")).applyInArrow(_sums, schema)
