"""Tables that cut a plan's lineage, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``. Only a session on one machine may lack it and gets a temporary folder; on a cluster its absence is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not (spark.sparkContext.master or "").startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="statuta-"))
        atexit.register(shutil.rmtree, _LOCAL[0], True)
    return f"file://{_LOCAL[0]}"


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _located(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def stage(df: DataFrame, name: str, made: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again. ``made`` collects the paths that the caller removes; what
    nobody removes, since a result still reads it, goes when the session's process ends."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    if made is not None:
        made.append(path)
    at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def at_end(spark: SparkSession, path: str) -> None:
    """Delete a folder when the driver's process ends."""
    target, store = _located(spark, path)
    store.deleteOnExit(target)


def make(spark: SparkSession, path: str) -> None:
    target, store = _located(spark, path)
    store.mkdirs(target)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders through the file system that holds them."""
    for path in paths:
        target, store = _located(spark, path)
        store.delete(target, True)
