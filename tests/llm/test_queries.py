"""The registered queries: columns and types, SQL twins, and the pipeline stage by stage."""

import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from compare import compare, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from llm.conftest import SMALL  # noqa: E402
from llm.test_narrow import _repeats  # noqa: E402
from llm.test_native import _all, _hits, _kept  # noqa: E402
from llm.test_stages import similar_groups  # noqa: E402
from zoneflow.llm import common, oracle, packing, workload  # noqa: E402

COLUMNS = {
    "op1": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op2": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op3": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op4": "page_id bigint, host string, path string, rule string, verdict string",
    "op5": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op6": "doc_id bigint, held_out boolean, score double, predicted int",
    "op7": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op8": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op9": "doc_id bigint, fingerprint string, component_id bigint",
    "op10": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op11": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint",
    "op13": "query_id bigint, rank int, vec_id bigint, score double",
    "op12": "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string",
}


@pytest.mark.parametrize("name", sorted(workload.QUERIES))
def test_columns(spark, name):
    df = entry.queries()[name](spark, SMALL)
    want = [tuple(c.split()) for c in COLUMNS[name.split("_")[0]].split(", ")]
    assert df.dtypes[: len(want)] == want
    key = want[0][0]
    if key in ("doc_id", "page_id"):
        table = "pages" if key == "page_id" else "documents"
        ids = {r[0] for r in spark.read.parquet(f"{SMALL}/{table}.parquet").select(key).collect()}
        assert {r[0] for r in df.select(key).collect()} == ids
    if name in ("op5_decontamination", "op8_licenses", "op10_quality_rules"):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    if name in oracle.ORACLES:
        assert compare(df, duck(SMALL), oracle.ORACLES[name]) is None


def test_pipeline(spark, given):
    """Each stage against plain Python on what its predecessor kept."""
    docs, columns = given, given.columns
    for name, stage in corpus_pipeline.STAGES:
        before = _all(docs)
        out = stage(spark, docs, SMALL)
        if name == "packing":
            break
        assert out.columns == columns and out.dtypes == given.dtypes
        out = common.written(out, "stage")
        after = _all(out)
        if name == "quality rules":
            want = {r[0] for r in _kept(before) if r[-1]}
            assert sorted(after) == sorted(b for b in before if b[0] in want)
        elif name == "near dedup":
            low = similar_groups([b[:2] for b in before])
            assert {a[0] for a in after} == low and len(after) == len(low)
        elif name == "suffix dedup":
            texts, sizes = dict(a[:2] for a in after), [r for r in _repeats([t.encode() for _, t, _ in before], 200)]
            assert len(after) == len(before)
            for (i, t, _), (n, gone, runs, _) in zip(before, sizes):
                left = len(texts[i].encode())
                assert n - gone <= left <= n - gone + 6 * runs and (gone or texts[i] == t)
        else:
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
            clean = {h[0] for h in _hits([b[:2] for b in before], items) if h[2] == 0}
            assert {a[0] for a in after} == clean and set(after) <= set(before)
        docs = out
    pieces = out.collect()
    encoder = packing.Encoder(workload.vocabulary())
    want = Counter({i: len(encoder.ids(t)) // 2 + 1 for i, t, _ in before})
    got = Counter()
    for p in pieces:
        got[p.doc_id] += p.length
    assert got == want
    again = Counter()
    for p in corpus_pipeline.run(spark, SMALL).collect():
        again[p.doc_id] += p.length
    assert again == want
