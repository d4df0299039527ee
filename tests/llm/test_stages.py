"""The filtering functions on frames that are no plain file scan, and the pipeline's near copies."""

import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm.conftest import SMALL, rows
from zoneflow import session
from zoneflow.llm import common, decontamination, near_copies, quality_rules, simhash, suffixes


def _docs():
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    return [(1, own(1), "h", 0), (2, own(2), "h", 0), (3, own(2), "h", 0), (4, "too short", "h", 0), (5, f"{own(5)} {own(1)}", "h", 0)]


@pytest.mark.parametrize("make", ["rows", "union"])
@pytest.mark.parametrize("stage", ["kept", "one_of_each", "clean", "without_repeats"])
def test_stages_on_frames_that_are_no_files(spark, stage, make):
    data, schema = _docs(), "doc_id long, text string, source string, n_chars long"
    if make == "rows":
        df = spark.createDataFrame(data, schema)
    else:
        df = spark.createDataFrame(data[:2], schema).union(spark.createDataFrame(data[2:], schema))
    if stage == "kept":
        assert {r[0] for r in rows(quality_rules.kept(df))} == {1, 2, 3, 5}
    elif stage == "one_of_each":
        assert {r[0] for r in rows(simhash.one_of_each(df))} == {1, 2, 4, 5}
    elif stage == "clean":
        bench = spark.createDataFrame([(1, " ".join(data[1][1].split()[5:20]))], "item_id long, text string")
        assert {r[0] for r in rows(decontamination.clean(df, bench))} == {1, 4, 5}
    else:
        left = {r[0]: r[1] for r in rows(suffixes.without_repeats(df))}
        assert len(left) == 5 and left[2] == left[3] == left[1] == "" and left[4] == "too short"
        assert left[5] == data[4][1][: len(data[4][1]) - len(data[0][1])]


def similar_groups(data):
    """Smallest id of each group of texts linked by five-word Jaccard >= 0.8."""
    grams = []
    for _, t in data:
        w = (t or "").encode().lower().split()
        grams.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    root = list(range(len(data)))
    for i in range(len(data)):
        for j in range(i):
            both = len(grams[i] & grams[j])
            if grams[i] == grams[j] or (both and 5 * both >= 4 * (len(grams[i]) + len(grams[j]) - both)):
                a, b = root[i], root[j]
                root = [a if r == b else r for r in root]
    low = {}
    for (i, _), r in zip(data, root):
        low[r] = min(i, low.get(r, i))
    return set(low.values())


def test_near_dedup_goes_by_five_words_and_similarity(spark):
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(10**6)}"
    common = [word() for _ in range(12)]  # a line that all the texts share
    texts = [None, "", " \n", "one two", "One  two", "one two three"]
    for _ in range(25):
        base = [word() for _ in range(rng.randrange(20, 150))] + common
        for k in range(8):
            copy = list(base)
            for at in rng.sample(range(len(base)), min(k, 4)):
                copy[at] = word()
            texts.append(" ".join(copy))
    data = list(enumerate(texts))
    df = spark.createDataFrame(data, "doc_id long, text string")
    want = similar_groups(data)
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()} == want
    assert {r.doc_id for r in simhash.one_of_each(df).collect()} != want  # 3 bits are another rule


def test_sketches_rule_out_no_similar_pair():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.choice([1, 5, 60, 64, 65, 300, 1500])
        base = [rng.randrange(-(2**63), 2**63) for _ in range(n)]
        other = base[: rng.randrange(n + 1)] + [rng.randrange(-(2**63), 2**63) for _ in range(rng.randrange(n + 1))]
        x, y = (near_copies.np.unique(near_copies.np.array(s, near_copies.np.int64)) for s in (base, other or base))
        shared = len(set(x.tolist()) & set(y.tolist()))
        bits = near_copies.apart(near_copies.sketch(x), near_copies.sketch(y))
        assert bits <= len(x) + len(y) - 2 * shared
        assert near_copies._within(bits, len(x), len(y)) or 5 * shared < 4 * (len(x) + len(y) - shared)


@pytest.mark.parametrize("light,many", [(0, 0), (0, 16), (2, 16), (32, 16)])
def test_near_dedup_of_large_groups(spark, light, many, monkeypatch):
    """Hundreds of texts that meet often and are linked in chains, or not at all; pairs by shingle, in blocks, or both."""
    monkeypatch.setattr(near_copies, "MANY", many)
    monkeypatch.setattr(near_copies, "LIGHT", light)
    monkeypatch.setattr(near_copies, "BLOCK", 20)
    monkeypatch.setattr(near_copies, "PIECE", 7)
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10**6)}"
    base = [word() for _ in range(60)]
    texts = []
    for _ in range(90):  # each has words of its own: near to the first, not to each other
        copy = list(base)
        for at in rng.sample(range(60), 2):
            copy[at] = word()
        texts.append(" ".join(copy))
    for k in range(60):  # a chain: each differs from the one before in one word
        base[k % 60] = word()
        texts.append(" ".join(base))
    texts += texts[:30] + [" ".join(base[:n]) for n in range(30, 60)]
    data = list(enumerate(texts))
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert {r.doc_id for r in near_copies.one_of_each(df).collect()} == similar_groups(data)


def test_near_dedup_compares_no_template_pages(spark, monkeypatch):
    """1,500 pages with 60 own words and a template of 400: alike by less than 0.8. Their own shingles come first, so they never meet."""
    rng = random.Random(2)
    template = [f"t{k}" for k in range(400)]
    data = [(i, " ".join([f"w{rng.randrange(10**7)}" for _ in range(60)] + template)) for i in range(1500)]
    asked = []
    verified = near_copies._verified
    monkeypatch.setattr(near_copies, "_verified", lambda pairs, *a: asked.append(pairs.count()) or verified(pairs, *a))
    kept = near_copies.one_of_each(spark.createDataFrame(data, "doc_id long, text string"))
    assert kept.count() == 1500 and sum(asked) < 50_000


def test_near_dedup_of_no_rows(empty):
    assert near_copies.one_of_each(empty).collect() == []


def _folders(spark):
    return set(os.listdir(os.path.dirname(session.scratch(spark, "none").removeprefix("file:"))))


def _labels(folders):
    return sorted(f.rpartition("-")[0] for f in folders)


@pytest.mark.parametrize("stage,left", [(near_copies.one_of_each, {"near-kept", "edges"}), (suffixes.without_repeats, {"repeated-spans"}), (suffixes.repeats, {"repeated-spans"})])
def test_what_a_stage_leaves_in_the_scratch_folder(spark, odd, stage, left):
    """Only what the returned rows are read from, not the tables in between."""
    os.makedirs(os.path.dirname(session.scratch(spark, "none").removeprefix("file:")), exist_ok=True)
    before = _folders(spark)
    assert stage(odd).collect()
    assert set(_labels(_folders(spark) - before)) <= left


def test_written_tables_leave_no_shuffle_files(spark):
    files = lambda: {f for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("|").split("|") if "shuffle_" in f}
    df = spark.range(10_000).groupBy((F.col("id") % 1000).alias("k")).agg(F.count("*").alias("n"))
    before, setting = files(), spark.conf.get(common.RELEASE)
    assert df.collect() and files() - before  # what is not written stays until garbage is collected
    before = files()
    steps = common.Steps(spark)
    assert common.written(df, "counts").count() == steps.write(df, "counts").count() == 1000
    both = [f for f in files() - before if spark._jvm.java.io.File(f).length() > 1000]  # the two count() shuffle a number each
    assert not both and spark.conf.get(common.RELEASE) == setting
    with pytest.raises(Exception, match="no such"):
        common.written(df.select(F.raise_error(F.lit("no such"))), "counts")
    assert spark.conf.get(common.RELEASE) == setting


def test_near_dedup_reads_each_text_once_for_its_prefixes(spark, odd, monkeypatch):
    """The index and the join with it read one shuffle, and no table of all prefixes is written."""
    read, made = spark.sparkContext.accumulator(0), near_copies._prefixes

    def counted(known):
        def run(batches):
            def each():
                for b in batches:
                    read.add(b.num_rows)
                    yield b

            return made(known)(each())

        return run

    labels, write = [], common.Steps.write
    monkeypatch.setattr(near_copies, "_prefixes", counted)
    monkeypatch.setattr(common.Steps, "write", lambda self, df, label: labels.append(label) or write(self, df, label))
    for threshold in ("-1", "10m"):
        monkeypatch.setattr(read, "_value", 0)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            near_copies.one_of_each(odd)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert read.value == odd.count()
    assert "near-prefixes" not in labels


def test_few_contaminated_rows_go_without_a_shuffle_of_the_others(spark, given):
    bench = spark.createDataFrame([(1, " ".join(given.first().text.split()[:20]))], "item_id long, text string")
    clean = decontamination.clean(given, bench)
    left = {r.doc_id for r in clean.collect()}
    hit = {r.doc_id for r in decontamination.hits(given, bench).where("n_hit > 0").collect()}
    assert hit and left == {r.doc_id for r in given.collect()} - hit
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_pipeline_keeps_one_written_stage(spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(k, lambda spark, docs, sf_dir, k=k: docs.where(F.col("doc_id") % k != 0)) for k in (2, 3, 5, 7)])
    os.makedirs(os.path.dirname(session.scratch(spark, "none").removeprefix("file:")), exist_ok=True)
    before = _folders(spark)
    ids = [r.doc_id for r in corpus_pipeline.run(spark, SMALL).collect()]
    assert ids and all(i % k for i in ids for k in (2, 3, 5, 7))
    assert len(_folders(spark) - before) == 1
