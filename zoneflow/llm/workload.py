"""The registered queries over the given tables, one for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.llm import alignment, common, context_trees, decontamination, hard_negatives, licenses, neighbours, packing, preference, quality_rules, sharding, simhash, suffixes, url_filters

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(common.prepared(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_sharding(s: SparkSession, d: str) -> DataFrame:
    return sharding.shard(table(s, d, "documents"), 24)


@query
def op2_suffixes(s: SparkSession, d: str) -> DataFrame:
    return suffixes.repeats(table(s, d, "documents"))


@query
def op3_packing(s: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(s, d, "documents"), vocabulary(), 1024)


@query
def op4_url_filters(s: SparkSession, d: str) -> DataFrame:
    return url_filters.judge(table(s, d, "pages"))


@query
def op5_decontamination(s: SparkSession, d: str) -> DataFrame:
    found = decontamination.hits(table(s, d, "documents"), table(s, d, "benchmark"))
    digest = F.sha2("items", 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, (F.col("n_hit") > 0).alias("contaminated"))


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


@query
def op6_preference(s: SparkSession, d: str) -> DataFrame:
    return preference.rank(table(s, d, "documents"), table(s, d, "labels"), remainder(F.col("doc_id"), 5) == 0)


@query
def op7_context_trees(s: SparkSession, d: str) -> DataFrame:
    held_out = F.coalesce(remainder(F.col("doc_id"), 10) == 0, F.lit(False))
    return context_trees.score(table(s, d, "documents"), held_out)


@query
def op8_licenses(s: SparkSession, d: str) -> DataFrame:
    return licenses.scan(table(s, d, "documents"))


@query
def op9_simhash(s: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(table(s, d, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op10_quality_rules(s: SparkSession, d: str) -> DataFrame:
    judged = quality_rules.judge(table(s, d, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op11_hard_negatives(s: SparkSession, d: str) -> DataFrame:
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(s, d, "embeddings"), F.col("id") % 100 == 0, label=moved)


@query
def op12_alignment(s: SparkSession, d: str) -> DataFrame:
    aligned = alignment.align(table(s, d, "documents"), vocabulary(), vocabulary("piece_bpe_32k.model"))
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


@query
def op13_neighbours(s: SparkSession, d: str) -> DataFrame:
    return neighbours.nearest(table(s, d, "embeddings"), 20, F.col("id") % 20 == 0)
