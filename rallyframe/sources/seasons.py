"""Seasons from stored answers to stored stints, and the stints read back.

``build`` reads the schedules of the seasons asked for, all their games' plays by one scan, builds every
game together and replaces those seasons' partitions. What it can't build is written beside them with the
reason, and what a log leaves open is written as warnings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rallyframe.operators import season
from rallyframe.sources import feeds, files

SEASON_TYPES = ("Regular Season", "Playoffs")
BY = ["season", "season_type"]
STINTS = (
    "game string, t_start double, t_end double, home long, away long, home_lineup array<long>, away_lineup array<long>, home_pts double, "
    "away_pts double, home_poss double, away_poss double, score_margin double, season string, season_type string"
)


def scheduled(spark: SparkSession, folder: str, seasons: list[str], types: tuple[str, ...] = SEASON_TYPES) -> DataFrame:
    """game, season, season_type of all games of the seasons; a type that wasn't played has none."""
    rows = feeds.read_many(spark, folder, "game_ids", [{"season": s, "season_type": t} for s in seasons for t in types])
    return rows.where("GAME_ID is not null").select(F.lpad("GAME_ID", 10, "0").alias("game"), *BY).dropDuplicates(["game"])


def build(spark: SparkSession, folder: str, out: str, seasons: list[str], types: tuple[str, ...] = SEASON_TYPES, stored_only: bool = False) -> DataFrame:
    """Builds and stores the seasons; season, season_type, games, games_with_stints, stints of each that has games.

    Below ``out``: stints, warnings and quarantined by season and type, and names. A schedule that isn't
    stored raises ``NotFetched``, and so do plays that aren't, but with ``stored_only`` such games are
    quarantined as not fetched. Game ids, a few hundred a season, pass the driver, as the paths of the scan.
    """
    games = scheduled(spark, folder, seasons, types)
    listed = [{"game_id": r.game} for r in games.select("game").orderBy("game").collect()]
    absent = feeds.missing(spark, folder, "pbp", listed)
    if absent and not stored_only:
        raise feeds.NotFetched(f"plays of {len(absent)} games, {absent[0]['game_id']} first")
    unfetched = {a["game_id"] for a in absent}
    raw = feeds.read_many(spark, folder, "pbp", [a for a in listed if a["game_id"] not in unfetched])
    made = season.built(feeds.plays(raw))
    left = made.quarantined.unionByName(spark.createDataFrame([(g, "not fetched") for g in sorted(unfetched)], "game string, reason string"))
    silent = games.join(made.spans.select("game").distinct(), "game", "left_anti").join(left, "game", "left_anti").select("game", F.lit("no plays").alias("reason"))
    files.write_partitions(made.stints.join(games, "game"), f"{out}/stints", BY)
    files.write_partitions(made.warnings.join(games, "game"), f"{out}/warnings", BY)
    files.write_partitions(left.unionByName(silent).join(games, "game"), f"{out}/quarantined", BY)
    made.names.write.mode("overwrite").parquet(f"{out}/names")
    each = stints(spark, out).where(F.col("season").isin(*seasons)).groupBy(*BY, "game").agg(F.count("*").alias("n"))
    found = games.join(each.select("game", "n"), "game", "left").groupBy(*BY)
    return found.agg(F.count("*").alias("games"), F.count("n").alias("games_with_stints"), F.coalesce(F.sum("n"), F.lit(0)).alias("stints"))


def stints(spark: SparkSession, out: str, seasons: list[str] | None = None, types: list[str] | None = None) -> DataFrame:
    """Stored stints, only the partitions asked for."""
    rows = files.scan(spark, f"{out}/stints", STINTS, kind="parquet", may_be_absent=True)
    if seasons is not None:
        rows = rows.where(F.col("season").isin(*seasons))
    return rows if types is None else rows.where(F.col("season_type").isin(*types))
