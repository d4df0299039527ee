import random

import pytest

from zoneflow.llm import common

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n string, word int, size string, _f string, cleaned string"
SMALL = "/root/testdata/sf0.001"


def prose(rng: random.Random, words: int) -> str:
    stems = ["the", "of", "and", "ré", "über", "ció", "ing", "st", "ent", "on", "li", "mar", "to"]
    out = []
    for _ in range(words):
        out.append("".join(rng.choices(stems, k=rng.choice([1, 1, 2, 3]))))
    for i in range(11, words, 12):
        out[i] += "\n"
    return " ".join(out).capitalize()


def odd_texts() -> list[str | None]:
    """Nulls, blanks, long texts, copies, near copies, shared passages, periodic bytes, wide characters."""
    rng = random.Random(5)
    passage, long = prose(rng, 70), prose(rng, 20_000)
    near = prose(rng, 300).split(" ")
    texts: list[str | None] = [None, None, "", "", " \t\n ", "one", "Two Words", "a b c d e f g h i", long, passage, passage]
    texts += [prose(rng, rng.randrange(1, 60)) for _ in range(60)]
    texts += [prose(rng, 40) + " " + passage + " " + prose(rng, 30) for _ in range(5)]
    for _ in range(12):
        w = list(near)
        w[rng.randrange(300)] = "changed"
        texts.append(" ".join(w))
    texts += ["ab" * 400, "x" * 900, "x" * 199, "y" * 200, "z" * 200 + "q", "éß日" * 120, "日" * 300, "q" + "日" * 300]
    texts += ["same line here now\n" * 12 + "other", "w1 w2 w3 w4 w5 w6 " * 9, "\n\n\n", "a b \u0085c d e  f   g \n h"]
    texts += [texts[20]] * 9
    return texts


@pytest.fixture(scope="session")
def odd(spark, tmp_path_factory):
    """The odd texts as rows, some with null or repeated ids, two of them wholly equal; and as a file."""
    common.prepared(spark)
    rows = []
    for i, t in enumerate(odd_texts()):
        rows.append((None if i == 15 else 3 if i == 16 else i, t, None if i % 7 == 0 else "en", None if i % 11 == 0 else f"s{i % 3}", len(t or ""), "x", 1, "y", "f", "c"))
    rows.append(rows[-1])
    df = spark.createDataFrame(rows, SCHEMA)
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    df.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def given(spark):
    common.prepared(spark)
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(df) -> list[tuple]:
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
