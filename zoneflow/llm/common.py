"""What the operators share: row keys, word patterns, written intermediate tables, components."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow import session

#: A word of the contracts on white space, and the bytes that part such words.
BLANK = r"[\x20\x09-\x0D]"
#: What parts words of digits, letters and everything beyond ASCII.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of a batch handed to Python: texts can be long, so batches are short.
TEXT_BATCH = 256
#: Spark's setting that a run's shuffle files go when it ends, not when the driver happens to collect its garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shipped(module: str) -> None:
    """Tasks get the module's functions themselves, so executors need no copy of this library."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


shipped(__name__)


def prepared(spark: SparkSession) -> SparkSession:
    """UTC and short Arrow batches, so that a batch of long texts stays small."""
    session.configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH))
    return spark


def _write(df: DataFrame, path: str) -> DataFrame:
    """The files of `df`, zstd. What was shuffled for them goes: the files are read from here on, not the plan."""
    spark = df.sparkSession
    before = spark.conf.get(RELEASE, "false")
    spark.conf.set(RELEASE, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)


def written(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again: survives lost executors."""
    return _write(df, session.scratch(df.sparkSession, label))


class Steps:
    """Written tables of a job by name. A name's table is deleted when the next one of that name is written, or dropped.

    For tables that nothing reads any more by then.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: dict[str, str] = {}

    def write(self, df: DataFrame, label: str) -> DataFrame:
        path = session.scratch(self.spark, label)
        out = _write(df, path)
        self.drop(label)
        self.paths[label] = path
        return out

    def drop(self, *labels: str) -> None:
        for path in filter(None, (self.paths.pop(label, None) for label in labels)):
            session.delete(self.spark, path)


def _place(docs: DataFrame) -> list[Column]:
    """File and row number of a file scan's rows. Asked for as metadata, so a column of that name is no matter; fails for other frames."""
    meta = docs.metadataColumn("_metadata")
    return [F.xxhash64(meta["file_path"]).alias("_f"), meta["row_index"].alias("_r")]


def filed(docs: DataFrame) -> DataFrame:
    """`docs` where it is a plain file scan, else written once.

    For callers of both `keyed` and `whole` or `among`: each would write a copy of its own, and the
    keys of two copies never meet.
    """
    try:
        docs.select(*_place(docs))
        return docs
    except AnalysisException:
        return written(docs, "rows")


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """`columns` with `_f`, `_r`: the file and the position in it name a row, whatever its ids are.

    Equal rows get different keys. A frame that is no plain file scan is written first.
    """
    names = [docs[c] for c in columns]
    try:
        return docs.select(*_place(docs), *names)
    except AnalysisException:
        return keyed(written(docs.select(*names), "rows"), *columns)


def whole(docs: DataFrame) -> DataFrame:
    """`_f`, `_r` and the row itself as one struct `_row`, so that no name of its columns can clash."""
    try:
        return docs.select(*_place(docs), F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    except AnalysisException:
        return whole(written(docs, "rows"))


def among(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of `docs` named by `keys`; `docs` has to be the frame they were made from, and `filed`."""
    return whole(docs).join(keys.select("_f", "_r"), ["_f", "_r"], "left_semi").select("_row.*")


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The other rows. For few keys: they are written, so Spark sees their size and sends them to the rows, not both by key."""
    keys = written(keys.select("_f", "_r"), "gone-rows")
    return whole(docs).join(keys, ["_f", "_r"], "left_anti").select("_row.*")


def lowered(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def split_words(text: Column, separator: str) -> Column:
    """Non-empty parts between separators; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), separator), lambda w: w != "")


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once for a row."""
    return F.transform(F.array(value), body)[0]


def unsigned_hex(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small frame of the driver's own rows."""
    return spark.createDataFrame(rows, T._parse_datatype_string(schema))


def most(df: DataFrame, by: str, limit: int) -> Column:
    """Holds for the rows with the largest `by`, `limit` rows at most. Reads the counts of each value of `by`."""
    sizes = sorted(df.groupBy(by).agg(F.count("*")).collect(), reverse=True) if df.count() > limit else []
    total, least = 0, 0
    for value, n in sizes:
        total += n
        if total > limit:
            least = value + 1
            break
    return F.col(by) >= least


def components(edges: DataFrame) -> DataFrame:
    """`node`, `root` (smallest node reachable) for every node of `edges` (`a`, `b`, both long).

    Alternates large-star and small-star until nothing changes: every edge ends at the root of
    its component. A hub's edges are joined to one row, its minimum, so a hub can be split.
    Each round is written to the shared folder.
    """
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    state = None
    while True:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.inline(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.greatest("b", "m").alias("a"), F.col("m").alias("b"))))).where("a <> b").distinct()
        now = written(small, "edges")
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
