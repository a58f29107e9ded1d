"""Derived tables that are written once and read by all that follows from them.

They lie in the folder that ``spark.checkpoint.dir`` names, which the driver and all executors share, so a
lost executor costs no recomputation. A session on one machine without the setting gets a folder of its
own; on a cluster that is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_FOLDER, _TABLE = "rallyframe-derived", "rallyframe_derived_"
#: Rows that one task sorts or holds together.
TASK_ROWS = 250_000


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session, without a trailing slash."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="rallyframe-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{_FOLDER}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def task_count(rows: DataFrame) -> int:
    """Tasks that hold at most about TASK_ROWS of ``rows`` each; one a core at least."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // TASK_ROWS))


def by_key(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` of a stored table, partitioned by ``keys`` into as many tasks as they need.

    The number of tasks grows with the table, so what one of them sorts doesn't. Windows and groups whose keys begin
    with these need no shuffle after it.
    """
    return rows.repartition(task_count(rows), *keys)


def bucketed(rows: DataFrame, name: str, key: str, many: int | None = None) -> DataFrame:
    """``rows`` written once as a table in buckets of ``key`` and read back, a task a bucket.

    There are as many buckets as ``by_key`` makes tasks, or ``many``. Windows, groups and joins whose keys begin with ``key``
    need no shuffle after it, and what they sort is a bucket, however large the table is. Without buckets a scan's tasks grow with it.
    """
    spark = rows.sparkSession
    many = many or task_count(rows)
    table = f"{_TABLE}{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{_FOLDER}/{table}"
    rows.repartition(many, key).write.format("parquet").bucketBy(many, key).option("path", path).saveAsTable(table)
    return spark.table(table)


def remove(spark: SparkSession) -> None:
    """Removes all that ``written`` and ``bucketed`` wrote below this session's shared folder, once results are stored."""
    for table in spark.catalog.listTables(pattern=f"{_TABLE}*"):
        spark.sql(f"DROP TABLE IF EXISTS {table.name}")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{_FOLDER}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
