"""Shared scratch tables: how these operators cut lineage.

``spark.checkpoint.dir`` names a folder that the driver and all executors share. Tables written
there survive a lost executor, unlike cached blocks. The setting is read from the session. Where it
is unset, a session on one machine (master ``local``) gets a temporary folder; on a cluster that is
an error, as no executor could read such a folder.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session, without a trailing slash."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="rallyframe-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table called ``name``."""
    return f"{shared_dir(spark)}/rallyframe-scratch/{name}-{uuid.uuid4().hex}"


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """Write ``df`` as a table in buckets of ``column`` and read it back; grouping by it then needs no shuffle."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    df.write.format("parquet").bucketBy(buckets, column).option("path", path).saveAsTable(table)
    return spark.table(table)


def discard(df: DataFrame) -> None:
    """Remove a table that ``write_scratch`` wrote, once all that was made of it is written too."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/rallyframe-scratch/" in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files of DataFrames that nothing refers to any more.

    It does so when the driver collects garbage, which can be long after an iterative job has moved on.
    """
    gc.collect()
    spark._jvm.System.gc()


def drop_scratch(spark: SparkSession) -> None:
    """Remove all scratch tables below this session's shared folder.

    Call it once the results of the operators have been written or collected.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/rallyframe-scratch")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
