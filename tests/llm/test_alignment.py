"""Alignment of two tokenizations against a plain walk over byte ranges."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from zoneflow.llm import alignment, common, workload

from .conftest import pairs

A, B = workload.vocabulary(), workload.vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabularies():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=B)


def _decoded(vocabularies, text):
    """Ids and bytes of each token, by the libraries themselves."""
    first, second = vocabularies
    plain = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    shown = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    a = [(i, bytes(shown[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in second.encode(text):
        p = second.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()))
    return a, b


def _brute(vocabularies, texts):
    found = []
    for t in texts:
        a, b = _decoded(vocabularies, t) if t else ([], [])
        whole = (" " + (t or "")).encode()
        if not a or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            found.append(([], [], [], []))
            continue
        ranges = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                out.append((at, at + len(x), i))
                at += len(x)
            ranges.append(out)
        links, j = [], 0
        for s, e, i in ranges[0]:
            while ranges[1][j][1] <= s:
                j += 1
            k = j
            while k < len(ranges[1]) and ranges[1][k][0] < e:
                links.append((i, ranges[1][k][2]))
                k += 1
        shared = sorted({e for _, e, _ in ranges[0]} & {e for _, e, _ in ranges[1]})
        groups, low = [], 0
        for high in shared:
            groups.append("|".join(",".join(str(i) for s, e, i in r if low <= s and e <= high) for r in ranges) if len(whole) < 3000 else "")
            low = high
        found.append((a, b, links, groups))
    counts = Counter(x for f in found for x in f[2])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return found, counts, most


def _want(vocabularies, texts):
    found, counts, most = _brute(vocabularies, texts)
    for a, b, links, groups in found:
        yield len(a), len(b), len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), ";".join(groups)


@pytest.mark.parametrize("small", [False, True])
def test_against_ranges(spark, odd, vocabularies, small, monkeypatch):
    """With segments and known pairs as they are, and so small that every way is taken."""
    if small:
        for name, value in {"KINDS": 40, "PLACES": 3000, "BLOCK": 7, "FREQUENT": 5, "REMEMBERED": 50}.items():
            monkeypatch.setattr(alignment, name, value)
    extra = ["  two  spaces ", "tail ", " ", "<|endoftext|> <s> <unk> <0x0A>", "a▁b c", "tab\tand\nnew \n line", "ﬁ x 　wide", "\x1c \x85   q", "don't we'll  it's", "नमस्ते दुनिया", "🙂 🙂🙂"]
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(extra)], "doc_id long, text string")
    docs = odd.select("doc_id", "text").unionByName(more)
    rows = pairs(docs)
    want = Counter((i, *w) for (i, _), w in zip(rows, _want(vocabularies, [t for _, t in rows])))
    got = Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in alignment.align(docs, A, B, whole=True).collect())
    long = {i for i, t in rows if t and len(t.encode()) >= 2999}
    cut = lambda c: Counter({(k[:-1] if k[0] in long else k): n for k, n in c.items()})
    assert cut(got) == cut(want)
    marked = [r for r in got if r[0] == 1004]
    assert marked == [(1004, 0, 0, 0, 0, 0, 0, "")]


def test_query_digest_and_pairs(spark, given, vocabularies):
    rows = pairs(given)
    texts = dict(rows)
    found, counts, most = _brute(vocabularies, [t for _, t in rows])
    got = {(r.a, r.b): (r["count"], r.best) for r in alignment.pairs(given, A, B).collect()}
    assert got == {x: (n, n == most[x[1]]) for x, n in counts.items()}
    short = [i for i, t in rows if t and len(t.encode()) < 2999]
    want = {i: hashlib.sha256(";".join(f[3]).encode()).hexdigest() for (i, _), f in zip(rows, found) if i in set(short)}
    out = {r.doc_id: r.groups_sha256 for r in workload.QUERIES["op12_alignment"](spark, "/root/testdata/sf0.001").collect()}
    assert len(out) == len(texts) and {i: out[i] for i in want} == want


def test_empty_and_clashing(spark, empty):
    assert alignment.align(empty, A, B).count() == 0
    docs = spark.createDataFrame([(1, "a b", "x", 3), (None, "a b", "y", 4)], "doc_id long, text string, segment string, links int")
    got = alignment.align(docs, A, B).orderBy(F.col("doc_id").asc_nulls_first()).collect()
    assert [(r.doc_id, r.n_a, r.n_links, r.count_sum) for r in got] == [(None, 2, 2, 4), (1, 2, 2, 4)]
    assert common.written(alignment.pairs(docs, A, B), "pairs").count() == 2
