"""Benchmark passages in documents: a set join on the rarest shingle of each item-sized window.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.llm import common

#: Words of a window, and of the shingles that find it.
WINDOW, SHINGLE = 10, 3
#: Up to so many distinct benchmark shingles are broadcast (24 bytes each); beyond, documents are shuffled.
BROADCAST = 2_000_000


def _key(words: Column, at: Column, n: int) -> Column:
    return F.xxhash64(*[F.get(words, at + k) for k in range(n)])


def _words(df: DataFrame, text_col: str) -> DataFrame:
    return df.withColumn("words", common.split_words(common.lowered(F.col(text_col)), common.NOT_WORD)).drop(text_col)


def _shingles(rows: DataFrame) -> DataFrame:
    """Every shingle of a row: `n` words from `pos`. Single words stand for windows shorter than a shingle."""
    at = rows.select("*", F.size("words").alias("n_words"), F.posexplode("words").alias("pos", "word"))
    three = F.when(F.col("pos") + SHINGLE <= F.col("n_words"), _key(F.col("words"), F.col("pos"), SHINGLE))
    return at.select(*rows.columns, "n_words", "pos", F.xxhash64("word").alias("one"), three.alias("three"))


def _small(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= BROADCAST else df


def _windows(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`item_id`, `start`, `win` (words) of every window of every item."""
    items = _words(benchmark.select(benchmark[id_col].alias("item_id"), benchmark[text_col].alias("text")), "text").where(F.size("words") > 0)
    last = F.greatest(F.size("words") - WINDOW, F.lit(0))
    return items.select("item_id", "words", F.explode(F.sequence(F.lit(0), last)).alias("start")).select(
        "item_id", F.slice("words", F.col("start") + 1, F.lit(WINDOW)).alias("win")
    )


def occurrences(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """(`_f`, `_r`, `s`, `e`, `items`): words s to e-1 of a row are a window, with the items that have it.

    Of a window's shingles the rarest in the documents is its prefix: a document that holds the
    window holds it. Documents' shingles are joined with the prefixes alone; the shingle's place
    in the window gives where the window would begin, which has to lie in the text, and the words
    there are compared.
    """
    wins = windows.groupBy("win").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    wins = common.written(wins.withColumn("len", F.size("win")), "windows")
    places = wins.select("win", F.explode(F.sequence(F.lit(0), F.greatest(F.col("len") - SHINGLE, F.lit(0)))).alias("k"), "len")
    long = F.col("len") >= SHINGLE
    places = places.select("win", "k", long.alias("long"), F.when(long, _key(F.col("win"), F.col("k"), SHINGLE)).otherwise(_key(F.col("win"), F.col("k"), 1)).alias("key"))
    single = wins.where(F.col("len") < SHINGLE).select("win", F.posexplode("win").alias("k", "w")).select("win", "k", F.lit(False).alias("long"), F.xxhash64("w").alias("key"))
    places = common.written(places.where("long").unionByName(single), "places")
    keys = common.written(places.select("long", "key").distinct(), "window-keys")
    n = keys.count()
    kinds = F.array(F.struct(F.lit(True).alias("long"), F.col("three").alias("key")), F.struct(F.lit(False).alias("long"), F.col("one").alias("key")))
    if keys.where("not long").isEmpty():
        one_kind = _shingles(rows).select("*", F.lit(True).alias("long"), F.col("three").alias("key"))
    else:
        one_kind = _shingles(rows).select("*", F.inline(kinds))
    met = one_kind.where("key is not null")
    rarity = common.written(met.select("long", "key").join(_small(keys, n), ["long", "key"]).groupBy("long", "key").agg(F.count("*").alias("seen")), "rarity")
    rare = places.join(rarity, ["long", "key"])  # a window with an unseen shingle occurs nowhere
    need = places.groupBy("win").agg(F.count("*").alias("need"))
    rare = rare.groupBy("win").agg(F.count("*").alias("got"), F.min(F.struct("seen", "k", "long", "key")).alias("p")).join(need, "win").where("got = need")
    prefix = common.written(wins.join(rare.select("win", "p.*"), "win").select("long", "key", "k", "len", "win", "items"), "prefixes")
    s = F.col("pos") - F.col("k")
    inside = (s >= 0) & (s + F.col("len") <= F.col("n_words"))
    if n <= BROADCAST:
        hit = met.join(F.broadcast(prefix), ["long", "key"]).where(inside)
    else:  # places alone go to the prefixes; a text comes to the places that are left
        hit = met.select("_f", "_r", "n_words", "pos", "long", "key").join(prefix, ["long", "key"]).where(inside).join(rows, ["_f", "_r"])
    hit = hit.where(F.slice("words", s + 1, F.col("len")) == F.col("win"))
    return hit.select("_f", "_r", s.alias("s"), (s + F.col("len")).alias("e"), "items")


def hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """For each row: `_f`, `_r`, `doc_id`, `n_words`, `n_hit`, `n_items`, `items` (sorted, comma-joined).

    Words are lower-cased runs of digits, letters and all beyond ASCII. A window is ten consecutive
    words of an item, or the whole of a shorter item. A document word within an occurrence is hit.

    Null and empty texts have no words; items without words have no windows. Items of equal text
    are all counted; rows of equal item_id are one item; a null item_id hits words but is not
    counted as an item. Equal documents are judged each. Without items nothing is hit; an empty
    documents table gives no rows.
    """
    rows = common.keyed(docs, id_col, text_col).withColumnRenamed(id_col, "doc_id")
    rows = _words(rows, text_col)
    found = common.written(occurrences(rows.select("_f", "_r", "words"), _windows(benchmark, item_col, text_col)), "occurrences")
    runs = found.select("_f", "_r", "s", "e").distinct()
    before = F.max("e").over(Window.partitionBy("_f", "_r").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1))
    covered = runs.withColumn("n", F.greatest(F.col("e") - F.greatest("s", F.coalesce(before, F.lit(0))), F.lit(0)))
    n_hit = covered.groupBy("_f", "_r").agg(F.sum("n").alias("n_hit"))
    items = found.select("_f", "_r", F.explode("items").alias("item")).groupBy("_f", "_r").agg(F.sort_array(F.collect_set("item")).alias("items"))
    marks = n_hit.join(items, ["_f", "_r"], "left")
    sizes = common.written(rows.select("_f", "_r", "doc_id", F.size("words").alias("n_words")), "word-counts")
    out = sizes.join(marks, ["_f", "_r"], "left")
    return out.select(
        "_f", "_r", "doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size(F.coalesce("items", F.array().cast("array<string>"))), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce(F.array_join("items", ","), F.lit("")).alias("items"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """The rows of `docs` without a hit word."""
    docs = common.filed(docs)
    return common.without(docs, hits(docs, benchmark, **names).where("n_hit > 0"))
