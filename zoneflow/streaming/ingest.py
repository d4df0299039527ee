"""Streaming ingest: decode, split, write, dead-letter; replays change nothing."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from zoneflow import session
from zoneflow.functions.codec import decode_messages, split_valid
from zoneflow.schemas import MESSAGE, Contract
from zoneflow.sources import tables


#: A micro-batch is decoded, counted and written; these bounds keep one small, also on a first run.
OFFSETS_PER_BATCH, FILES_PER_BATCH = 5_000_000, 64


def topic_source(
    spark: SparkSession,
    servers: str,
    topic: str,
    offsets_per_batch: int | None = OFFSETS_PER_BATCH,
    min_partitions: int | None = None,
) -> DataFrame:
    """Topic from its earliest offset. Needs the Kafka connector on the classpath; progress
    is kept in the query's checkpoint, which takes the place of a manual commit.

    `offsets_per_batch` bounds a micro-batch; `min_partitions` splits the offsets of a topic
    partition over several tasks, for topics whose key puts most messages into one.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if offsets_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", offsets_per_batch)
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    raw = reader.load()
    return raw.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "partition", "offset"
    )


def topic_sink(messages: DataFrame, servers: str, topic: str) -> None:
    writer = messages.select("key", "value").write.format("kafka")
    writer.option("kafka.bootstrap.servers", servers).option("kafka.acks", "all").option(
        "kafka.enable.idempotence", "true"
    ).option("topic", topic).save()


def file_source(spark: SparkSession, path: str, files_per_batch: int | None = FILES_PER_BATCH) -> DataFrame:
    """Messages as Parquet files of (key, value, offset): a topic's stand-in."""
    reader = spark.readStream.schema(MESSAGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


@dataclass
class IngestResult:
    written: int = 0
    dead_lettered: int = 0


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """Identity of a stream: written into its checkpoint folder once, so it is gone with it."""
    path = f"{checkpoint}/zoneflow-run"
    try:
        tables.write_small(spark, path, uuid.uuid4().hex)
    except FileExistsError:
        pass
    return tables.read_small(spark, path)


def write_batch(
    batch: DataFrame, contract: Contract, table_path: str, dlq_path: str, batch_tag: str
) -> IngestResult:
    """One micro-batch. Keyed tables are upserted; the unkeyed one gets a batch partition.
    Both, and the dead letters, can be written again with the same result.

    The source is read and decoded once, into a staged table; both counts are observed on the way.
    """
    spark = batch.sparkSession
    staged, seen = session.scratch(spark, "batch"), Observation()
    decoded = decode_messages(batch, contract)
    counted = decoded.observe(seen, F.count_if("is_valid").alias("written"), F.count_if(~F.col("is_valid")).alias("dead_lettered"))
    try:
        counted.write.parquet(staged)
        done = IngestResult(**seen.get)
        rows, dead = split_valid(spark.read.schema(decoded.schema).parquet(staged), contract)
        if done.dead_lettered:
            dead.write.mode("overwrite").parquet(f"{dlq_path}/{tables.BATCH}={batch_tag}")
        if done.written and contract.keys:
            tables.upsert_table(spark, table_path, contract.schema, rows, list(contract.keys), "offset")
        elif done.written:
            tables.append_batch(rows.select(*contract.schema.fieldNames()), table_path, batch_tag)
        return done
    finally:
        session.delete(spark, staged)


def drain(
    messages: DataFrame, contract: Contract, table_path: str, dlq_path: str, checkpoint: str
) -> IngestResult:
    """Take what is available now, write it, stop. A failed batch is taken again next time,
    because its offsets are only recorded after it was written. Counts are of all batches."""
    total = IngestResult()
    run = run_id(messages.sparkSession, checkpoint)

    def each(batch: DataFrame, batch_id: int) -> None:
        done = write_batch(batch, contract, table_path, dlq_path, f"{run}-{batch_id}")
        total.written += done.written
        total.dead_lettered += done.dead_lettered

    query = (
        messages.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return total
