"""Shards of nearly equal bytes by longest-processing-time scheduling of groups of equal texts."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.llm import common

#: Groups of at least 1/(GRAIN x shards) of all bytes are placed one by one: GRAIN x shards at most.
GRAIN = 64
#: Smaller groups go by hash to LEVELS x BINS x shards bundles; each level takes half of what is left.
LEVELS, BINS = 20, 8
#: Consecutive rows of a file that are counted, and numbered, together.
BLOCK = 8192


def least_loaded(sizes: list[tuple[int, int]], n_shards: int) -> dict[int, int]:
    """Item to shard: largest item first, always to the shard with the fewest bytes."""
    heap = [(0, s) for s in range(n_shards)]
    out = {}
    for size, item in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        out[item] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def shard(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's shard and its slot there.

    A row's size is its UTF-8 bytes plus 8. Rows of equal text stay together. A group of a
    sizeable share of all bytes is an item of its own; the number of such groups is bounded by
    their share. All other groups are hashed to bundles whose sizes fall by half from level to
    level, so the last bundles to be placed hold next to nothing and level the shards. The
    driver's heap gets only those two bounded lists.

    Slots are gapless: rows are counted by shard and block of a file, and numbered within it, so
    no shard is gathered in a task. Null texts are in one group with empty ones and have the
    checksum of no bytes. Equal rows get slots of their own. An empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    rows = common.written(
        common.keyed(docs, id_col, text_col).select(
            "_f", "_r", F.col(id_col).alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
            F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
            F.xxhash64(F.coalesce(text, F.lit(""))).alias("g"),
        ),
        "shard-rows",
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    groups = rows.groupBy("g").agg(F.sum("size").alias("size"))
    large = [(r.g, r.size_) for r in groups.where(F.col("size") * (GRAIN * n_shards) >= total).withColumnRenamed("size", "size_").collect()]
    bins = BINS * n_shards
    u = F.pmod(F.xxhash64("g", F.lit("level")), F.lit(1 << 40))
    level = F.least(F.lit(LEVELS - 1), 40 - F.length(F.conv(F.greatest(u, F.lit(1)).cast("string"), 10, 2)))
    bundle = (level * bins + F.pmod(F.xxhash64("g", F.lit("bin")), F.lit(bins))).cast("int").alias("bundle")
    own = F.broadcast(common.frame(spark, [(g, i) for i, (g, _) in enumerate(large)], "g long, own int"))
    rows = rows.join(own, "g", "left").withColumn("bundle", F.when(F.col("own").isNull(), bundle))
    small = rows.where("own is null").groupBy("bundle").agg(F.sum("size").alias("n")).collect()
    placed = least_loaded([(r.n, r.bundle) for r in small] + [(n, -1 - i) for i, (_, n) in enumerate(large)], n_shards)
    where = F.broadcast(common.frame(spark, list(placed.items()), "item int, shard int"))
    rows = rows.withColumn("item", F.coalesce("bundle", -1 - F.col("own"))).join(where, "item")

    rows = rows.withColumn("block", F.floor(F.col("_r") / BLOCK).cast("long"))
    key = ["shard", "_f", "block"]
    before = Window.partitionBy("shard").orderBy("_f", "block").rowsBetween(Window.unboundedPreceding, -1)
    first = rows.groupBy(*key).agg(F.count("*").alias("n")).select(*key, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    slot = F.row_number().over(Window.partitionBy(*key).orderBy("_r")) - 1
    return rows.withColumn("within", slot).join(first, key).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("first") + F.col("within")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
