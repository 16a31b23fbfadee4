"""Tables that jobs hand to later jobs, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Tables that this process has written and not yet deleted.
WRITTEN: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``.

    Only a local master may do without the setting; it then gets a temporary folder, which is
    remembered in the session and deleted when the process ends. On a cluster a missing setting is an error.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="taxoloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        at = f"file://{folder}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/taxoloom-{name}-{uuid.uuid4().hex}"
    WRITTEN.add(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage is cut, and a lost
    executor costs no more than its running tasks. The table stays until :func:`forget` or :func:`clean`."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    WRITTEN.discard(path)


def forget(df: DataFrame) -> None:
    """Delete the files of a table that :func:`materialize` wrote, once nothing reads it."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/taxoloom-" in path:
            delete(spark, path)


def clean(spark: SparkSession) -> None:
    """Delete all tables that this process has written. Call it when the results that read them are written elsewhere."""
    for path in list(WRITTEN):
        delete(spark, path)


def dealt_out(df: DataFrame) -> DataFrame:
    """The rows of a file scan over all cores, where fewer parts of it than there are cores hold rows: a row group is the least
    that a scan can split, however small its parts."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = df.select("_metadata.file_path", "_metadata.file_block_start").distinct().limit(cores).count()
    return df if parts >= cores else df.repartition(cores)
