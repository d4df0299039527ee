"""Sharding, packing, near copies and repeated passages against plain Python."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm.conftest import pairs, rows
from zoneflow.llm import packing, sharding, simhash, suffixes, workload


@pytest.mark.parametrize("name", ["odd", "given"])
def test_shards(request, name):
    docs = request.getfixturevalue(name)
    got = sharding.shard(docs, 5).collect()
    size = lambda t: len((t or "").encode()) + 8
    want = sorted(((i, size(t), zlib.crc32((t or "").encode())) for i, t in pairs(docs)), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == want
    where, slots, loads = defaultdict(set), defaultdict(list), Counter()
    for r in got:
        where[r.text_crc32, r.size].add(r.shard)
        slots[r.shard].append(r.slot)
        loads[r.shard] += r.size
    assert all(len(s) == 1 for s in where.values()) and set(where) and set().union(*where.values()) <= set(range(5))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = Counter()
    for r in got:
        groups[r.text_crc32, r.size] += r.size
    fair = sum(loads.values()) / 5
    assert max(loads.values()) <= max(max(groups.values()), fair * 1.02)


def test_heap_takes_largest_first():
    assert sharding.least_loaded([(5, 0), (4, 1), (3, 2), (3, 3), (3, 4)], 2) == {0: 0, 1: 1, 2: 1, 3: 0, 4: 1}


@pytest.mark.parametrize("name", ["odd", "given"])
def test_packed_ids_are_the_tokenizer_s(request, name):
    from tokenizers import Tokenizer

    docs = request.getfixturevalue(name)
    t = Tokenizer.from_file(workload.vocabulary())
    t.encode_special_tokens = True
    ids = [(i, [*t.encode(x or "", add_special_tokens=False).ids, 0]) for i, x in pairs(docs)]
    got = packing.pack(docs, workload.vocabulary(), 64).collect()
    whole = Counter((i, len(x)) for i, x in ids)
    assert Counter((r.doc_id, r.doc_tokens) for r in got if r.start == 0) == whole
    crc = lambda x: zlib.crc32(b"".join(n.to_bytes(4, "little") for n in x))
    known = defaultdict(list)
    for i, x in ids:
        known[i, len(x)].append(x)
    for r in got:
        assert any(crc(x[r.start : r.start + r.length]) == r.ids_crc32 for x in known[r.doc_id, r.doc_tokens])
    line = sorted((r.sequence_id, r.offset, r.length) for r in got)
    at = 0
    for s, o, n in line:
        assert (s, o) == divmod(at, 64) and o + n <= 64
        at += n
    assert at == sum(len(x) for _, x in ids)


def _links(texts, words=3):
    prints = [simhash.fingerprint(t, words) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i] = root[root[i]]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    return prints, [find(i) for i in range(len(texts))]


def _slow_print(text):
    import xxhash

    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i : i + 3]) for i in range(max(len(w) - 2, 1))] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("name", ["odd", "given"])
def test_near_copies(request, name):
    docs = request.getfixturevalue(name)
    some = pairs(docs)
    prints, roots = _links([t for _, t in some])
    assert [_slow_print(t) for _, t in some if len(t or "") < 5000] == [p for p, (_, t) in zip(prints, some) if len(t or "") < 5000]
    low = {}
    for (i, _), r in zip(some, roots):
        low[r] = i if low.get(r) is None else low[r] if i is None else min(low[r], i)
    want = sorted(((i, f"{p:016x}", low[r]) for (i, _), p, r in zip(some, prints, roots)), key=repr)
    found = simhash.near_duplicates(docs)
    assert rows(found.select("doc_id", "fingerprint", "component_id")) == want
    assert simhash.one_of_each(docs).count() == len(set(roots))


def test_anchors_lose_no_link():
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 300, dtype=np.uint64)
    y = x.copy()
    for i in range(300):
        for b in rng.integers(0, 64, i % 4):
            y[i] ^= np.uint64(1 << int(b))
    at, key, home = simhash.anchors(np.concatenate([x, y]))
    reach, near = defaultdict(set), defaultdict(set)
    for i, k, h in zip(at, key, home):
        reach[i].add(k)
        if h:
            near[i].add(k)
    assert all(near[i] & reach[i + 300] for i in range(300))


def test_large_anchors_are_compared_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 8)
    base = 0x0F0F0F0F0F0F0F0F
    fps = [base ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(a)]
    import numpy as np
    import pyarrow as pa

    batch = pa.record_batch([pa.array([7] * len(fps)), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array([True] * len(fps))], names=["anchor", "fp", "home"])
    (out,) = list(simhash._compare(3)(iter([batch])))
    assert len(out) == len(fps) - 1 and len(set(out.column("b").to_pylist())) == 1


def _repeats(texts, span):
    seen = Counter(t[k : k + span] for t in texts for k in range(len(t) - span + 1))
    for t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - span + 1):
            if seen[t[k : k + span]] > 1:
                gone[k : k + span] = b"\1" * span
        runs = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        yield len(t), sum(gone), runs, hashlib.sha256(bytes(x for x, y in zip(t, gone) if not y)).hexdigest()


@pytest.mark.parametrize("limit", [suffixes.BLOCK_PIECES, 1])
@pytest.mark.parametrize("name", ["odd", "given"])
def test_repeated_passages(request, monkeypatch, name, limit):
    monkeypatch.setattr(suffixes, "BLOCK_PIECES", limit)
    docs = request.getfixturevalue(name)
    some = pairs(docs)
    want = [(i, *r) for (i, _), r in zip(some, _repeats([(t or "").encode() for _, t in some], 200))]
    assert rows(suffixes.repeats(docs)) == sorted(want, key=repr)


def test_segments_meet(monkeypatch):
    """A text longer than a segment gives the same starts as a shorter segment's pieces together."""
    import numpy as np

    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    bounds = np.array([0, 1500, 1600, 5000])
    for bits in (20, 10):
        monkeypatch.setattr(suffixes, "SEGMENT_BITS", bits)
        rolling = [suffixes.Rolling(b, 1 << bits) for b in suffixes._BASES]
        text, at, n, _, _ = suffixes.runs(data, bounds, rolling)
        starts = sorted((t, a + k) for t, a, m in zip(text, at, n) for k in range(m))
        assert starts == [(0, k) for k in range(1301)] + [(2, k) for k in range(3201)]


def test_cover_has_every_difference():
    assert {(a - b) % suffixes.PERIOD for a in suffixes.COVER for b in suffixes.COVER} == set(range(suffixes.PERIOD))


def test_passages_leave_whole_characters(odd):
    before = {r.doc_id: r for r in odd.collect() if r.doc_id not in (None, 3)}
    out = suffixes.without_repeats(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    for r in out.collect():
        if r.doc_id in before:
            was = before[r.doc_id]
            assert (r.text is None) == (was.text is None) and r.cleaned == "c" and r._f == "f"
            assert r.text == was.text or r.n_chars == len(r.text) < len(was.text)


@pytest.mark.parametrize("apply", [lambda d: sharding.shard(d, 4), lambda d: packing.pack(d, workload.vocabulary()), simhash.near_duplicates, simhash.one_of_each, suffixes.repeats, suffixes.without_repeats])
def test_no_rows_give_no_rows(empty, apply):
    assert apply(empty).collect() == []


def test_special_tokens_that_stand_in_a_text():
    """Ids are those of the tokenizer itself, also where a text holds the end-of-text marker."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(workload.vocabulary())
    encoder = packing.Encoder(workload.vocabulary())
    texts = ["<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|><|endoftext|>\n b ", " <|endoftext|>", "<|endoftext|", "x <|endoftext|>  y", "no marker"]
    for t in texts:
        assert np.frombuffer(encoder.ids(t), "<u2").tolist() == plain.encode(t, add_special_tokens=False).ids, t
