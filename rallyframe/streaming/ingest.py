"""Incremental ingest (an extension): new files in, their partitions rewritten, then stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rallyframe.sources import files


def ingest(spark: SparkSession, source: str, schema: str, target: str, state: str, keys: list[str], order: list[str], by: list[str]) -> None:
    """Appends files that arrived at ``source`` since the last run to the partitioned ``target``.

    Within a batch the last row of ``keys`` by ``order`` wins; a partition that new rows touch is
    rewritten with old and new rows, so a repeated batch changes nothing. ``state`` holds the
    stream's checkpoint.
    """

    def merge(batch: DataFrame, _: int) -> None:
        new = latest(batch, keys, order)
        touched = new.select(*by).distinct()
        rows = new
        if files.exists(spark, target):
            # A batch touches few partitions: one row each.
            old = spark.read.parquet(target).join(touched, by, "left_semi")
            rows = latest(old.unionByName(new), keys, order)
        # Cut from what it overwrites: the table is read above and replaced here.
        rows = rows.checkpoint()
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(target)

    stream = spark.readStream.schema(schema).parquet(source)
    query = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", state).foreachBatch(merge).start()
    query.awaitTermination()


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order``."""
    rest = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("__best")
    return rows.groupBy(*keys).agg(best).select(*keys, "__best.*").select(*rows.columns)


def windowed(events: DataFrame, time: str, width: str, late: str, keys: list[str], value: str) -> DataFrame:
    """Counts and sums in tumbling windows of a stream, with a watermark for late rows."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
