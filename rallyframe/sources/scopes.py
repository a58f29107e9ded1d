"""Tables of a season's scope from stored stints, and the readers they need.

A scope is the regular season, the playoffs or both; only its partitions of the stint store are read. What was
never built is an empty table, as a season in progress has no playoffs yet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rallyframe.functions.scalar import safe_ratio
from rallyframe.operators import rapm
from rallyframe.sources import files, seasons

# Scopes and the season types they hold.
SCOPES = {"reg": ("Regular Season",), "playoffs": ("Playoffs",), "all": ("Regular Season", "Playoffs")}
NAMES = "player long, name string"


def names(spark: SparkSession, out: str) -> DataFrame:
    """player, name as stored; empty if none were."""
    return files.scan(spark, f"{out}/names", NAMES, kind="parquet", may_be_absent=True)


def scope_stints(spark: SparkSession, out: str, season: str, scope: str) -> DataFrame:
    """The stored stints of a season's scope."""
    return seasons.stints(spark, out, [season], list(SCOPES[scope]))


def advanced(spark: SparkSession, folder: str, season: str, scope: str, schema: str) -> DataFrame | None:
    """The stored rates of a season's scope, or None if they were never built or can't be read."""
    path = f"{folder.rstrip('/')}/advanced_{season}_{scope}.parquet"
    if not files.exists(spark, path):
        return None
    rows = spark.read.schema(schema).parquet(path)
    try:
        rows.limit(1).collect()
    except Exception:  # noqa: BLE001 a file that is cut off counts as not built; NotFetched is no Exception
        return None
    return rows


def scope_table(spark: SparkSession, out: str, season: str, scope: str, box: DataFrame | None = None) -> DataFrame:
    """season, player, name, on/off and possessions of everyone in a season's scope, best on/off first; no ridge.

    A player without a stored name goes by the id. ``box`` has player, gp and per-game fga, fta, tov with any other
    columns, which follow, with usage; players it lacks have nulls.
    """
    stints = rapm.usable(scope_stints(spark, out, season, scope))
    table = rapm.net_ratings(stints).join(rapm.possessions(stints), "player", "left").join(names(spark, out), "player", "left")
    table = table.withColumns({"season": F.lit(season), "name": F.coalesce("name", F.col("player").cast("string")), "poss": F.bround("poss", 1)})
    if box is not None:
        table = table.join(box, "player", "left")
        usage = safe_ratio((F.col("fga") + 0.44 * F.col("fta") + F.col("tov")) * F.col("gp"), F.col("on_poss_o")) * 100
        table = table.withColumn("usg", F.bround(usage, 1))
    first = ["season", "player", "name"]
    return table.select(*first, *(c for c in table.columns if c not in first)).orderBy(F.desc_nulls_last("on_off"), "player")
