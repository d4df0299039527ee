"""Url filters, preference ranking and context trees against plain Python and held-out rows."""

import math
import re
import tracemalloc
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm.conftest import SMALL, pairs, rows
from zoneflow.llm import context_trees, preference, url_filters, workload

URL = re.compile(r"://([^/?#]*)([^?#]*)")


def _parts(url):
    m = URL.search(url or "")
    return (m[1].encode().lower().decode(), m[2]) if m else ("", "")


def _rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in url_filters.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


ODD_URLS = [None, "", "no scheme", "http://", "https://Example.ORG", "https://sub.EXAMPLE.org/es/x", "a://b.org/1?://c.com/de/", "x://notexample.org/es/", "http://example.org/en/12#a", "ftp://a.b.com/de/é?q", "http://fr.com/FR/", "http://com/fr/", "://org/", "http://xn--é日.net/Ünder/the", "http://...net//", "http://the.net/" + "theof" * 3000, "http://a.com\n.org/x\ny"]


@pytest.fixture(scope="module")
def urls(spark):
    data = [(None if i == 3 else i, u, None if i % 2 else "<p>the of the of sub under</p>", "x", ["t"]) for i, u in enumerate(ODD_URLS * 2)]
    return spark.createDataFrame(data, "page_id long, url string, html string, host string, tokens array<string>")


def _bayes(found):
    """`found`: page, host, path, tokens. By counting anew for every page."""
    sides = [Counter(), Counter()]
    sizes = [0, 0]
    for _, h, p, tokens in found:
        if verdict := _rule(h, p)[1]:
            side = verdict == "block"
            sizes[side] += 1
            sides[side].update(tokens)
    n = len(set(sides[0]) | set(sides[1]))
    totals = [sum(s.values()) + n + 1 for s in sides]
    for page, h, p, tokens in found:
        rule, verdict = _rule(h, p)
        odds = math.log((sizes[1] + 1) / (sizes[0] + 1)) + sum(math.log((sides[1][t] + 1) / totals[1]) - math.log((sides[0][t] + 1) / totals[0]) for t in tokens)
        yield page, h, p, rule, verdict or ("block" if odds > 0 else "allow"), None if rule else odds


@pytest.mark.parametrize("limit", [url_filters.BROADCAST, 0])
@pytest.mark.parametrize("name", ["urls", "pages"])
def test_verdicts(request, spark, monkeypatch, name, limit):
    monkeypatch.setattr(url_filters, "BROADCAST", limit)
    pages = request.getfixturevalue("urls") if name == "urls" else spark.read.parquet(f"{SMALL}/pages.parquet")
    counts = Counter()
    for r in pages.select("html").collect():
        counts.update(w for w in re.findall("[a-z]+", re.sub("<[^>]*>", " ", r.html or "").lower()) if len(w) <= url_filters.LONGEST)
    assert {r.word: r.n for r in url_filters.lexicon(pages).collect()} == dict(counts)
    total = sum(counts.values()) + 1
    log_p, unknown = {w: math.log(n / total) for w, n in counts.items()}, -math.log(total) - 2.0
    words = cache(lambda piece: url_filters.segment(piece, log_p, unknown))
    found = [(r.page_id, h, p, url_filters.tokens_of(h, p, words)) for r in pages.select("page_id", "url").collect() for h, p in [_parts(r.url)]]
    want, got = sorted(_bayes(found), key=repr), rows(url_filters.judge(pages))
    assert [w[:5] for w in want] == [g[:5] for g in got]
    assert all(w[5] == g[5] or math.isclose(w[5], g[5], rel_tol=1e-6, abs_tol=1e-6) for w, g in zip(want, got))


def test_rare_words_split_names_too(spark):
    """However many words are more frequent: each counted word is found in a name."""
    many = " ".join(f"{a}{b}{c}x" for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyz")
    pages = [(i, "http://a.net/zorkblim", f"<p>{many}</p>") for i in range(3)] + [(9, "http://zorkblim.net/", "<p>zork blim</p>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    pieces = spark.createDataFrame([("zorkblim",), ("aku",), ("é",)], "piece string")
    assert {r.piece: r.words for r in url_filters.words_of(pieces, url_filters.lexicon(df)).collect()}["zorkblim"] == ["zork", "blim"]


def test_segments():
    log_p = {w: math.log(p) for w, p in {"the": 0.3, "ring": 0.1, "thering": 0.001, "in": 0.2, "g": 0.01}.items()}
    assert url_filters.segment("thering", log_p, -20) == ["the", "ring"]
    assert url_filters.segment("thezz", log_p, -20) in (["the", "z", "z"], ["the", "zz"])
    assert url_filters.segment("", log_p, -20) == []
    splits = lambda s: [[s]] if len(s) == 1 else [[s[:i], *r] for i in range(1, len(s)) for r in splits(s[i:])] + [[s]]
    cost = lambda ws: sum(log_p.get(w, -20 * len(w)) for w in ws)
    for name in ("ringthe", "ingthe", "gring", "xthein"):
        assert math.isclose(cost(url_filters.segment(name, log_p, -20)), max(cost(s) for s in splits(name)))


def test_no_pages_no_rows(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_filters.judge(none).collect() == []


def _auc(scores, labels):
    good, bad = [s for s, y in zip(scores, labels) if y], [s for s, y in zip(scores, labels) if not y]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


def test_held_out_quality(spark):
    d = "/root/testdata/sf0.01"
    got = workload.QUERIES["op6_preference"](spark, d)
    assert got.count() == spark.read.parquet(f"{d}/documents.parquet").count()
    held = got.where("held_out").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    assert len(held) > 50
    assert _auc([r.score for r in held], [r.quality for r in held]) > 0.95
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.93
    assert got.where("score < 0 or score > 1 or predicted <> cast(score >= 0.3 as int)").count() == 0


def test_scores_come_from_texts_alone(spark, odd):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (7, 3, 0), (500, 1, 1)], "doc_id long, quality int, toxic int")
    held = F.col("doc_id") % 5 == 0
    got = preference.rank(odd, labels, held).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    again = preference.rank(odd.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("z")), labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality"))), held)
    assert rows(again) == sorted((tuple(r) for r in got), key=repr)
    one_kind = preference.rank(odd, labels.where("quality = 1"), held)
    assert {r.score for r in one_kind.collect()} == {0.5}
    assert preference.rank(odd.limit(0), labels, held).collect() == []


def test_pairs_teach_the_order():
    rng = np.random.default_rng(0)
    good, bad = rng.normal([1, 0, 0], 1, (500, 3)), rng.normal([-1, 0, 0], 1, (100, 3))
    r = preference.fit(good, bad, 1 / 6, 20_000)
    assert r.weights[0] > 3 * abs(r.weights[1:]).max()
    assert math.isclose(r.score(np.array([[0.0, 0, 0]]) + r.mean)[0], r.score(r.mean[None])[0])
    assert (r.score(good) >= 0.3).mean() > 0.9 and (r.score(bad) >= 0.3).mean() < 0.5


def _kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)


class SlowTree:
    """Weighted probabilities by the definition, from all coded bytes anew."""

    def __init__(self, texts):
        self.nodes = defaultdict(Counter)  # (choice, context) -> bit counts, with all contexts' suffixes
        self.longer = defaultdict(set)
        self.off = {}
        for t in texts:
            for context, byte in self.coded(t):
                for node, bit in self.choices(byte):
                    for d in range(len(context) + 1):
                        short = context[len(context) - d :]
                        self.nodes[node, short][bit] += 1
                        if d:
                            self.longer[node, short[1:]].add(short)

    @staticmethod
    def coded(text):
        line = b"\n" * context_trees.DEPTH + b"".join(w + b" " for w in context_trees.words_of(text)[:-1]) + b"\n"
        return [(line[i - context_trees.DEPTH : i], line[i]) for i in range(context_trees.DEPTH, len(line))]

    @staticmethod
    def choices(byte):
        return [((1 << j) | byte >> (8 - j), byte >> (7 - j) & 1) for j in range(8)]

    def log_w(self, node, context, path, bit):
        """With one more `bit` on `path`, if it is not None."""
        on = bit is not None and path.endswith(context)
        if not on and (node, context) in self.off:
            return self.off[node, context]
        c = self.nodes.get((node, context), Counter())
        own = _kt(c[0] + (on and bit == 0), c[1] + (on and bit == 1))
        if len(context) == context_trees.DEPTH:
            return own
        seen = self.longer.get((node, context), set())
        if on:
            seen = seen | {path[len(path) - len(context) - 1 :]}
        below = sum(self.log_w(node, k, path, bit) for k in seen)
        out = math.log(0.5) + max(own, below) + math.log1p(math.exp(-abs(own - below)))
        if not on:
            self.off[node, context] = out
        return out

    def log10(self, text):
        out = 0.0
        for context, byte in self.coded(text):
            for node, bit in self.choices(byte):
                out += self.log_w(node, b"", context, bit) - self.log_w(node, b"", context, None)
        return out / math.log(10)


def test_lengths_are_the_tree_s(spark, monkeypatch):
    texts = [(i, t) for i, t in enumerate(["the then Thin é", "then in\x00n the", None, "", "other thé other others", "unseen inn", "the then  Thin é"])]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    held = F.col("doc_id") == 5
    learned = [w for i, t in texts if i != 5 for w in context_trees.words_of(t)]
    tree, counts = SlowTree([t for i, t in texts if i != 5]), Counter(learned)
    want = {}
    for i, t in texts:
        own = context_trees.words_of(t)
        over = len(learned) + 0.1 * (len(counts) + 1)
        want[i] = (i == 5, len(own), sum(w in counts for w in own), len(learned), sum(math.log10((counts[w] + 0.1) / over) for w in own), tree.log10(t))
    for words, keys, stretch, weighted in ((1 << 20, 1 << 21, 1 << 20, 100_000), (2, 5, 7, 9), (0, 0, 1, 1)):
        for name, value in (("HELD_WORDS", words), ("HELD_PAIRS", keys), ("STRETCH", stretch), ("WEIGHTED", weighted)):
            monkeypatch.setattr(context_trees, name, value)
        got = {r.doc_id: tuple(r)[1:7] for r in context_trees.score(docs, held).collect()}
        assert got.keys() == want.keys()
        for i in want:
            assert got[i][:4] == want[i][:4]
            assert got[i][4:] == pytest.approx(want[i][4:], abs=1e-6)


def test_tasks_hold_little():
    """Counts go on in short batches, add up, and neither counting nor weighting takes hundreds of MB beside the executor."""

    def peak(work):
        tracemalloc.start()
        try:
            return work(), tracemalloc.get_traced_memory()[1] / 1e6
        finally:
            tracemalloc.stop()

    rng = np.random.default_rng(1)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789 ", np.uint8)
    texts = [rng.choice(letters, 140_000).tobytes().decode() for _ in range(48)]
    batches = [pa.record_batch([pa.array(texts[i : i + 8]), pa.array([k % 4 == 0 for k in range(8)])], names=["text", "held_out"]) for i in range(0, 48, 8)]
    own = [context_trees.words_of(t) for t in texts]
    lengths = [[len(w) for w in own], [sum(len(w) + 1 for w in words) for words in own]]
    for count, n, most in ((context_trees._count, lengths[0], 100), (context_trees._pairs, lengths[1], 250)):
        sums, mb = peak(lambda count=count: [(len(b), sum(b.column("c").to_pylist()), sum(b.column("seen").to_pylist())) for b in count(iter(batches))])
        assert max(x[0] for x in sums) < 1 << 16 and mb < most
        assert sum(x[1] for x in sums) == sum(k for i, k in enumerate(n) if i % 4) and sum(x[2] for x in sums) == sum(n)
    frame = pd.DataFrame({"key": rng.integers(0, 1 << 48, context_trees.WEIGHTED), "c": 1, "seen": 1})
    assert peak(lambda: context_trees._subtree(frame))[1] < 120


def test_order_of_words_matters(spark):
    """What was learned from comes cheaper than the same words in another order."""
    line = "many small words stand in a row here"
    turned = " ".join(reversed(line.split()))
    docs = spark.createDataFrame([(i, line) for i in range(20)] + [(20, line), (21, turned)], "doc_id long, text string")
    got = {r.doc_id: r for r in context_trees.score(docs, F.col("doc_id") >= 20).collect()}
    assert got[20].base_score == pytest.approx(got[21].base_score) and got[20].score > got[21].score + 5


def test_odd_texts_have_lengths(odd):
    held = F.coalesce(F.col("doc_id") % 10 == 0, F.lit(False))
    got = context_trees.score(odd, held)
    assert sorted(((r.doc_id, r.n_tokens) for r in got.collect()), key=repr) == sorted(((i, len(context_trees.words_of(t))) for i, t in pairs(odd)), key=repr)
    assert got.where("score >= 0 or base_score >= 0 or bits_per_byte <= 0 or bits_per_byte > 40 or n_known > n_tokens").count() == 0


def test_held_out_texts_are_coded_short(spark):
    """Well below the bytes' own entropy, by about as much as for texts that were learned from."""
    d = "/root/testdata/sf0.01"
    got = workload.QUERIES["op7_context_trees"](spark, d)
    assert got.where("held_out").agg(F.avg((F.col("score") > F.col("base_score")).cast("int"))).first()[0] > 0.5
    mean = {r.held_out: r.b for r in got.groupBy("held_out").agg(F.avg("bits_per_byte").alias("b")).collect()}
    data = b" ".join(w for r in spark.read.parquet(f"{d}/documents.parquet").select("text").collect() for w in context_trees.words_of(r.text))
    shares = np.array([n / len(data) for n in Counter(data).values()])
    assert mean[True] < 0.75 * -(shares * np.log2(shares)).sum() and mean[True] < 1.1 * mean[False]


def test_nothing_to_learn_from(spark, empty):
    docs = spark.createDataFrame([(1, "ab c")], "doc_id long, text string")
    (r,) = context_trees.score(docs, F.lit(True)).collect()
    assert r.n_known == 0 and r.train_tokens == 0 and math.isclose(r.bits_per_byte, 8.0)
    assert context_trees.score(empty, F.lit(False)).collect() == []
