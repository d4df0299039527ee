"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """All storage is UTC, so hour buckets and dates are computed in UTC.

    Both settings are runtime settings: they hold for queries planned from here on.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def local_session(name: str = "zoneflow", cores: str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names. Only a local master may do without one: there every
    task runs on the one machine, and a temporary folder is shared."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"master {master}: name a folder that all machines share in spark.checkpoint.dir")
        named = tempfile.mkdtemp(prefix="zoneflow-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


_marked: set[str] = set()


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder. All of an application's are deleted when it ends."""
    root = f"{shared_dir(spark)}/zoneflow/{spark.sparkContext.applicationId}"
    if root not in _marked:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _marked.add(root)
    return f"{root}/{label}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder or file of any store that Spark writes to."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage with a written table in the shared folder.

    Unlike a cached frame it survives lost executors, and unlike a checkpointed one it has
    real file sizes, so Spark itself decides from them whether a join side is small enough
    to broadcast.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
