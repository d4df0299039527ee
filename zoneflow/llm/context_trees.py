"""Context-tree weighting over the bytes of texts: code length of texts under one model of the corpus.

A text is coded as its words, a blank after each, and an end. The context of a byte is the DEPTH
bytes before it, over the borders of words; before a text's first byte stand ends.

Each byte is eight binary choices. For each choice and each depth of context there is a
Krichevsky-Trofimov estimate, and a node weighs its own estimate against its deeper contexts, half
and half at first. Estimates of a fixed corpus do not depend on its order, so all weights follow
from counts; they are the ones that coding the training texts byte by byte would arrive at. So the
corpus comes in as counts of contexts with their next byte, which tasks count before they are shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.llm import common

common.shipped(__name__)

#: Bytes of context: with the byte itself they have to fit into a long.
DEPTH = 5
#: Words and (context, byte) pairs that tasks hold at most; the rarer ones are joined.
HELD_WORDS, HELD_PAIRS = 1 << 18, 1 << 21
#: Different words, or pairs, that a task counts before it passes them on.
COUNTED_WORDS, COUNTED_PAIRS = 300_000, 800_000
#: Bytes of text that are looked at together; pairs that are weighted together, more where contexts share three bytes.
STRETCH, WEIGHTED = 1 << 18, 20_000
#: Rows of counts that a task passes on at once: a batch is held whole on both sides.
PASSED_ON = 1 << 14
_END = b"\n"


def words_of(text: str | None) -> list[bytes]:
    """Words and the end, which is the empty word."""
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), b""]


def _passed_on(names: list[str], columns: list[pa.Array]) -> Iterator[pa.RecordBatch]:
    whole = pa.record_batch(columns, names=names)
    for low in range(0, len(whole), PASSED_ON):
        yield whole.slice(low, PASSED_ON)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    learned, other = Counter(), Counter()

    def flush() -> Iterator[pa.RecordBatch]:
        words = [*learned, *other]
        c = np.concatenate([np.fromiter(learned.values(), np.int64, len(learned)), np.zeros(len(other), np.int64)])
        seen = np.concatenate([c[: len(learned)], np.fromiter(other.values(), np.int64, len(other))])
        learned.clear(), other.clear()
        return _passed_on(["word", "c", "seen"], [pa.array(words, pa.binary()), pa.array(c), pa.array(seen)])

    for batch in batches:
        for text, held in zip(batch.column("text").to_pylist(), batch.column("held_out").to_pylist()):
            (other if held else learned).update(words_of(text))
            if len(learned) + len(other) > COUNTED_WORDS:
                yield from flush()
    yield from flush()


def coded(texts: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Context and byte of each coded byte as one number, and the number of its text, a stretch at a time.

    `texts` are lists of words and the end; texts come in their order.
    """
    lines = [_END * DEPTH + b" ".join([*words[:-1], _END]) for words in texts]
    ends = np.cumsum([0, *map(len, lines)])
    buffer = np.frombuffer(b"".join(lines), np.uint8)
    for low in range(DEPTH, len(buffer), STRETCH):
        high = min(low + STRETCH, len(buffer))
        owner = np.repeat(np.arange(len(lines)), np.diff(np.clip(ends, low, high)))
        key = np.zeros(high - low, np.int64)
        for d in range(DEPTH + 1):
            key |= buffer[low - d : high - d].astype(np.int64) << (8 * d)
        inside = np.arange(low, high) - ends[owner] >= DEPTH
        yield key[inside], owner[inside]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        key = np.concatenate([h[0] for h in held])
        order = np.argsort(key, kind="stable")  # of sorted runs
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=key[:1] - 1))
        sums = (np.add.reduceat(np.concatenate([h[k] for h in held])[order], first) for k in (1, 2))
        return (key[first], *sums)

    def passed_on() -> Iterator[pa.RecordBatch]:
        return _passed_on(["key", "c", "seen"], [pa.array(x) for x in held.pop()])

    for batch in batches:
        out = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        for key, owner in coded([words_of(t) for t in batch.column("text").to_pylist()]):
            apart = out[owner]
            for keys, learned in ((key[~apart], 1), (key[apart], 0)):
                kinds, n = np.unique(keys, return_counts=True)
                held.append((kinds, n * learned, n))
            if sum(len(h[0]) for h in held) > 2 * COUNTED_PAIRS:
                held[:] = [merged()]
                if len(held[0][0]) > COUNTED_PAIRS:
                    yield from passed_on()
    if held:
        held[:] = [merged()]
        yield from passed_on()


def log_gamma(x: np.ndarray) -> np.ndarray:
    """For x > 0, by Stirling's series eight steps on."""
    z = x + 8.0
    series = (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    for k in range(8):
        series = series - np.log(x + k)
    return series


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - np.log(np.pi)


def _choices(byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of the eight choices of a byte: its node (1 and the bits before it), its bit."""
    j = np.arange(8)
    return (1 << j) | (byte[:, None] >> (8 - j)), (byte[:, None] >> (7 - j)) & 1


def _weigh(kt: np.ndarray, below: np.ndarray, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log of the weighted probability of nodes, and the weight of their own estimate."""
    both = np.where(leaf, kt, np.logaddexp(kt, below) - np.log(2))
    return both, np.where(leaf, 1.0, np.exp(np.minimum(kt - np.log(2) - both, 0)))


def _subtree(frame: pd.DataFrame) -> pd.DataFrame:
    """All pairs of some contexts of three bytes: the chance of each choice from depth 3 on.

    Rows with a key hold the eight chances; rows with a node hold the node's weighted probability
    under its three bytes `near`.
    """
    key, c = frame["key"].to_numpy(), frame["c"].to_numpy(np.float64)
    context, (node, bit) = key >> 8, _choices(key & 255)
    node, bit = node.ravel(), bit.ravel()
    context, count = np.repeat(context, 8), np.repeat(c, 8)
    levels = []
    for d in range(3, DEPTH + 1):
        ids = (context & ((1 << (8 * d)) - 1)) << 8 | node
        _, first, where = np.unique(ids, return_index=True, return_inverse=True)
        ones = np.bincount(where, count * bit, len(first))
        levels.append((where, first, np.bincount(where, count, len(first)) - ones, ones))
    chance, deeper = np.zeros(len(node)), None
    for where, first, zeros, ones in reversed(levels):
        kt = log_kt(zeros, ones)
        below = kt if deeper is None else np.bincount(where[deeper[0]], deeper[1], len(kt))
        both, weight = _weigh(kt, below, np.full(len(kt), deeper is None))
        own = (np.where(bit, ones[where], zeros[where]) + 0.5) / (zeros + ones + 1)[where]
        chance = weight[where] * own + (1 - weight[where]) * chance
        deeper = first, both
    top = pd.DataFrame({"key": -1, "seen": 0, "chances": None, "node": node[first], "log_p": both, "near": context[first] & 0xFFFFFF})
    rows = pd.DataFrame({"key": key, "seen": frame["seen"].to_numpy(), "chances": list(chance.reshape(-1, 8)), "node": -1, "log_p": 0.0, "near": -1})
    return pd.concat([rows, top], ignore_index=True)


def _second(frame: pd.DataFrame) -> pd.DataFrame:
    """Depth 2 of all contexts that end in one byte, 256 at most.

    Of `frame`, rows with a byte are counts, rows with a node the weighted probability of all longer contexts.
    Rows with a byte come out with weight and own chance of each choice, rows with a node with the
    weighted probability of all these contexts.
    """
    counts, longer = frame[frame["byte"] >= 0], frame[frame["byte"] < 0]
    two, c = counts["two"].to_numpy(), counts["c"].to_numpy(np.float64)
    node, bit = (x.ravel() for x in _choices(counts["byte"].to_numpy()))
    ids, first, where = np.unique(np.repeat(two, 8) << 8 | node, return_index=True, return_inverse=True)
    ones = np.bincount(where, np.repeat(c, 8) * bit, len(ids))
    zeros = np.bincount(where, np.repeat(c, 8), len(ids)) - ones
    at = np.searchsorted(ids, longer["two"].to_numpy() << 8 | longer["node"].to_numpy())
    both, weight = _weigh(log_kt(zeros, ones), np.bincount(at, longer["log_p"].to_numpy(), len(ids)), np.zeros(len(ids), bool))
    own = (np.where(bit, ones[where], zeros[where]) + 0.5) / (zeros + ones + 1)[where]
    per = lambda x: list(x.reshape(-1, 8))
    rows = pd.DataFrame({"three": two << 8 | counts["byte"].to_numpy(), "own": per(own), "weight": per(weight[where]), "last": -1, "node": -1, "log_p": 0.0})
    sums = np.bincount(node[first], both, 256)  # of all contexts that end in the byte
    top = pd.DataFrame({"three": -1, "own": None, "weight": None, "last": int(two[0] & 255), "node": np.arange(256), "log_p": sums})
    return pd.concat([rows, top], ignore_index=True)


def _shallow(last_byte: np.ndarray, byte: np.ndarray, c: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, ...]:
    """Weight of the own estimate and chance of a one, for no context [node] and for one byte [byte, node].

    `below`: log of the weighted probability of all longer contexts, by last byte and node.
    """
    node, bit = _choices(byte)
    counts = np.zeros((2, 256, 256))
    np.add.at(counts, (bit.ravel(), np.repeat(last_byte, 8), node.ravel()), np.repeat(c.astype(np.float64), 8))
    both, weight1 = _weigh(log_kt(counts[0], counts[1]), below, np.zeros((256, 1), bool))
    zeros, ones = counts.sum(axis=1)
    _, weight0 = _weigh(log_kt(zeros, ones), both.sum(axis=0), np.zeros(256, bool))
    return weight0, (ones + 0.5) / (zeros + ones + 1), weight1, (counts[1] + 0.5) / (counts.sum(axis=0) + 1)


def _lengths(weight0, one0, weight1, one1):
    """Log10 of a byte's chance in its context, from the chances of deeper contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("key").to_numpy()
            deep, own, weight = (batch.column(k).flatten().to_numpy(zero_copy_only=False).reshape(-1, 8) for k in ("chances", "own", "weight"))
            node, bit = _choices(key & 255)
            last = ((key >> 8) & 255)[:, None]
            chance = lambda one: np.where(bit, one, 1 - one)
            p = weight * own + (1 - weight) * deep
            w = weight1[last, node]
            p = w * chance(one1[last, node]) + (1 - w) * p
            p = weight0[node] * chance(one0[node]) + (1 - weight0[node]) * p
            yield pa.record_batch([pa.array(key), batch.column("seen"), pa.array(np.log10(p).sum(axis=1))], names=["key", "seen", "log_p"])

    return run


def _summed(counted: DataFrame, by: str) -> DataFrame:
    """Tasks have counted already, so rows are dealt out as they are: no second table of a task's counts beside its own."""
    return counted.repartition(by).groupBy(by).agg(F.sum("c").alias("c"), F.sum("seen").alias("seen"))


def model(rows: DataFrame) -> DataFrame:
    """`key`, `seen`, `log_p` for each pair of context and byte in `rows` (`text`, `held_out`)."""
    pairs = _summed(rows.select("text", "held_out").mapInArrow(_pairs, "key long, c long, seen long"), "key")
    pairs = common.written(pairs, "context-pairs")
    groups = pairs.count() // WEIGHTED + 1
    together = F.pmod(F.xxhash64(F.expr("(key >> 8) & 16777215")), F.lit(groups))
    deep = pairs.groupBy(together.alias("g")).applyInPandas(_subtree, "key long, seen long, chances array<double>, node int, log_p double, near long")
    deep = common.written(deep, "context-chances")
    counts = pairs.groupBy(F.expr("(key >> 8) & 65535").alias("two"), F.expr("key & 255").alias("byte")).agg(F.sum("c").alias("c"))
    longer = deep.where("node >= 0").groupBy(F.expr("near & 65535").alias("two"), "node").agg(F.sum("log_p").alias("log_p"))
    both = counts.select("two", "byte", "c", F.lit(-1).alias("node"), F.lit(0.0).alias("log_p")).union(longer.select("two", F.lit(-1), F.lit(0), "node", "log_p"))
    second = both.groupBy(F.expr("two & 255")).applyInPandas(_second, "three long, own array<double>, weight array<double>, last int, node int, log_p double")
    second = common.written(second, "context-seconds")
    below = np.zeros((256, 256))
    for r in second.where("node >= 0").select("last", "node", "log_p").collect():  # 256 x 256 at most
        below[r["last"], r.node] = r.log_p
    short = pairs.groupBy(F.expr("(key >> 8) & 255").alias("last"), F.expr("key & 255").alias("byte")).agg(F.sum("c").alias("c")).collect()  # 256 x 256 at most
    shallow = _shallow(*(np.array([r[k] for r in short], np.int64) for k in ("last", "byte", "c")), below)
    every = deep.where("node < 0").select("key", "seen", "chances", F.expr("key & 16777215").alias("three"))
    every = every.join(second.where("node < 0").select("three", "own", "weight"), "three").drop("three")
    return common.written(every.mapInArrow(_lengths(*shallow), "key long, seen long, log_p double"), "context-lengths")


def _texts(words, c, keys, log_p, n_learned: int, n_different: int):
    over = n_learned + 0.1 * (n_different + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = dict(zip(words.value, range(len(words.value))))
        counts, known, lengths = c.value, keys.value, log_p.value
        base = np.log10((counts + 0.1) / over)
        for batch in batches:
            if not len(batch):
                continue
            out, texts = [], [words_of(t) for t in batch.column("text").to_pylist()]
            for own in texts:
                at = np.fromiter((index.get(w, -1) for w in own), np.int64, len(own))
                have = at[at >= 0]
                rest = [own[i] for i in np.flatnonzero(at < 0)]
                out.append((len(own), sum(map(len, own)) + len(own), int((counts[have] > 0).sum()), float(base[have].sum()), rest))
            score, missing, owners = np.zeros(len(texts)), [], []
            for key, owner in coded(texts):
                kinds, kind = np.unique(key, return_inverse=True)
                at = np.minimum(np.searchsorted(known, kinds), max(len(known) - 1, 0))
                have = known[at] == kinds if len(known) else np.zeros(len(kinds), bool)
                value = np.where(have, lengths[at], 0.0) if len(known) else np.zeros(len(kinds))
                score += np.bincount(owner, value[kind], len(texts))
                lost = ~have[kind]
                missing.append(key[lost]), owners.append(owner[lost])
            missing, owners = np.concatenate(missing), np.concatenate(owners)
            ends = np.searchsorted(owners, np.arange(len(texts) + 1)).astype(np.int32)
            cols = [pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.binary())))]
            names = ["n_tokens", "n_coded", "n_known", "base_score", "rest", "score", "missing"]
            cols += [pa.array(score), pa.ListArray.from_arrays(pa.array(ends), pa.array(missing))]
            yield pa.record_batch([*(batch.column(k) for k in ("_f", "_r", "doc_id", "held_out")), *cols], names=["_f", "_r", "doc_id", "held_out", *names])

    return run


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: `doc_id`, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`, `bits_per_byte`.

    `held_out` says which rows are not learned from. `score` is the log10 of the text's probability
    under the model, `bits_per_byte` its code length; `base_score` is the contract's sum over
    counted words.

    Every word and every context of the corpus is counted. Words and contexts that tasks hold are the
    most frequent, HELD_WORDS and HELD_PAIRS at most; a text's other ones are joined. Null and empty
    texts are an end alone. Equal rows are scored each. Without rows to learn from all chances are a
    half per bit. An empty table gives no rows.
    """
    rows = common.keyed(docs, id_col, text_col)
    rows = rows.select("_f", "_r", rows[id_col].alias("doc_id"), held_out.alias("held_out"), rows[text_col].alias("text"))
    counted = rows.select("text", "held_out").mapInArrow(_count, "word binary, c long, seen long")
    words = common.written(_summed(counted, "word"), "word-counts")
    n_learned, n_different = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    pairs = model(rows)
    sc = docs.sparkSession.sparkContext
    most, mostly = common.most(words, "seen", HELD_WORDS), common.most(pairs, "seen", HELD_PAIRS)
    held = words.where(most).select("word", "c").toArrow()
    shared = [sc.broadcast(held.column("word").to_pylist()), sc.broadcast(held.column("c").to_numpy())]
    held = pairs.where(mostly).select("key", "log_p").toArrow()
    order = np.argsort(held.column("key").to_numpy())
    shared += [sc.broadcast(held.column(k).to_numpy()[order]) for k in ("key", "log_p")]
    kinds = "_f long, _r long, doc_id {}, held_out boolean, n_tokens long, n_coded long, n_known long, base_score double, rest array<binary>, score double, missing array<long>"
    kind = rows.schema["doc_id"].dataType.simpleString()
    texts = common.written(rows.mapInArrow(_texts(*shared, n_learned, n_different), kinds.format(kind)), "text-scores")
    base = F.log10((F.col("c") + 0.1) / (n_learned + 0.1 * (n_different + 1)))
    rare = texts.where(F.size("rest") > 0).select("_f", "_r", F.explode("rest").alias("word")).join(words.where(~most), "word")
    rare = rare.select("_f", "_r", (F.col("c") > 0).cast("long").alias("k"), base.alias("b"), F.lit(0.0).alias("s"))
    seldom = texts.where(F.size("missing") > 0).select("_f", "_r", F.explode("missing").alias("key")).join(pairs.where(~mostly), "key")
    rare = rare.union(seldom.select("_f", "_r", F.lit(0), F.lit(0.0), "log_p")).groupBy("_f", "_r").agg(*[F.sum(k).alias(k) for k in "kbs"])
    out = texts.drop("rest", "missing").join(rare, ["_f", "_r"], "left")
    plus = lambda c, more: (F.col(c) + F.coalesce(more, F.lit(0))).alias(c)
    total = out.select("doc_id", "held_out", "n_tokens", plus("n_known", "k"), F.lit(n_learned).cast("long").alias("train_tokens"), plus("base_score", "b"), plus("score", "s"), "n_coded")
    return total.withColumn("bits_per_byte", -F.col("score") / float(np.log10(2)) / F.col("n_coded")).drop("n_coded")
