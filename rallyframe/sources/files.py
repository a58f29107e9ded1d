"""Reading and writing tables: typed scans, content keys, season partitions, documents.

A source that failed to answer must fail the job. ``scan`` gives an empty table only where the
caller says that the path may be absent; anything else Spark can't read raises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Schemas of the raw feeds; ids are longs, game ids strings with their zeros.
SCHEDULE = "GAME_ID string, GAME_DATE date, MATCHUP string"
RATINGS = "TEAM_ID long, TEAM_NAME string, GP int, W int, L int, OFF_RATING double, DEF_RATING double, NET_RATING double, PACE double"
BOX = (
    "GAME_ID string, TEAM_ID long, TEAM_ABBREVIATION string, TEAM_CITY string, PLAYER_ID long, PLAYER_NAME string, NICKNAME string, "
    "START_POSITION string, COMMENT string, MIN string, FGM int, FGA int, FG_PCT double, FG3M int, FG3A int, FG3_PCT double, FTM int, "
    "FTA int, FT_PCT double, OREB int, DREB int, REB int, AST int, STL int, BLK int, TO int, PF int, PTS int, PLUS_MINUS double"
)


def content_key(name: Column, params: Column) -> Column:
    """``name_`` and the first eight hex digits of the md5 of sorted ``k=v`` parts, with ``.csv``."""
    parts = F.array_sort(F.transform(F.map_entries(params), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return F.concat(name, F.lit("_"), F.substring(F.md5(F.array_join(parts, "_").cast("binary")), 1, 8), F.lit(".csv"))


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def scan(spark: SparkSession, path: str, schema: str, *, kind: str = "csv", may_be_absent: bool = False) -> DataFrame:
    """A table with an explicit schema."""
    if may_be_absent and not exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    return reader.csv(path, header=True, enforceSchema=False, mode="FAILFAST") if kind == "csv" else reader.format(kind).load(path)


def schedule(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Games of all seasons: one row for each game id, padded and in order of it."""
    rows = spark.read.schema(SCHEDULE).csv(paths, header=True)
    padded = rows.where(F.col("GAME_ID").isNotNull()).withColumn("GAME_ID", F.lpad("GAME_ID", 10, "0"))
    return padded.dropDuplicates(["GAME_ID"]).orderBy("GAME_ID")


def write_partitions(rows: DataFrame, path: str, by: list[str]) -> None:
    """Parquet by season and the like; only partitions that ``rows`` has are replaced."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def partitions(spark: SparkSession, path: str, by: list[str]) -> DataFrame:
    """The distinct partition values of a stored table."""
    return spark.read.parquet(path).select(*by).distinct().orderBy(*by)


def no_nan(rows: DataFrame) -> DataFrame:
    """NaN and infinities of floating columns as nulls."""
    kinds = dict(rows.dtypes)
    fixed = {c: F.when(~F.isnan(c) & (F.abs(F.col(c)) < float("inf")), F.col(c)) for c in rows.columns if kinds[c] in ("double", "float")}
    return rows.withColumns(fixed) if fixed else rows


def write_documents(docs: DataFrame, path: str, keys: list[str], doc: str = "doc") -> None:
    """One JSON text file per combination of ``keys``; rewriting the same rows gives the same files."""
    docs.select(*keys, F.col(doc).alias("value")).repartition(*keys).write.mode("overwrite").partitionBy(*keys).text(path)
