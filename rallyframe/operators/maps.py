"""Names, teams and histories as small dimension tables taken from the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rallyframe.functions import scalar
from rallyframe.operators import lineups, ordering


def first_identity(mentions: DataFrame, group: list[str], key: str, fields: list[str], order: list[str], games: int | None = 40) -> DataFrame:
    """group, key, fields: what a key is first called in each group, in ``order``.

    Looks at a group's first ``games`` games only (column game), which is the rule and not a
    shortcut: later names are another era's. Mentions with a null among the fields don't count.
    """
    rows = mentions.dropna(subset=[key, *fields])
    if games is not None:
        early = mentions.select(*group, "game").distinct()
        early = ordering.top_per_group(early, group, [F.col("game")], games, "__n").select(*group, "game")
        rows = rows.join(early, [*group, "game"], "left_semi")
    first = rows.groupBy(*group, key).agg(F.min_by(F.struct(*(F.trim(f).alias(f) for f in fields)), F.struct(*order)).alias("__f"))
    return first.select(*group, key, "__f.*")


def conferences(feeds: dict[str, DataFrame], key: str) -> DataFrame:
    """key, conf: which of several filtered feeds lists a team; the last one that does wins."""
    rows = None
    for n, (name, feed) in enumerate(feeds.items()):
        one = feed.select(key, F.lit(name).alias("conf"), F.lit(n).alias("nth"))
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy(key).agg(F.max_by("conf", "nth").alias("conf"))


def team_map(identities: DataFrame, confs: DataFrame, key: str) -> DataFrame:
    """identities (key, city, nickname, abbr, ...) with name, slug and conf."""
    name = F.concat_ws(" ", "city", "nickname")
    return identities.withColumns({"name": name, "slug": scalar.slugify(name)}).join(confs, key, "left")


def history(maps: DataFrame, key: str, season: str) -> DataFrame:
    """All identities in order of franchise and season."""
    return maps.orderBy(key, season)


def with_team(rows: DataFrame, teams: DataFrame, key: str, *, keep_unknown: bool = True) -> DataFrame:
    """Rows with their team's columns; rows of unknown teams stay, or go if the output is by team."""
    return rows.join(teams, key, "left" if keep_unknown else "inner")


def seasons(first: int, last: int, spark) -> DataFrame:
    """season: every year from ``first`` to ``last``."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("season"))


def seasons_of(rows: DataFrame, season: str) -> DataFrame:
    """season: every year from the first to the last of ``rows``; none without any."""
    one = rows.agg(F.min(season).alias("first"), F.max(season).alias("last")).where("first IS NOT NULL")
    return one.select(F.explode(F.sequence("first", "last")).alias("season"))


def box_feed(rows: DataFrame, player: str, season: str, per_game: list[str]) -> DataFrame:
    """player, name, gp, per_game means weighted by gp, and the team of the last season.

    ``rows`` has player, season, name, team, gp and the means. The name is the first season's.
    """
    means = lineups.weighted_mean(rows, [player], per_game, "gp")
    named = rows.groupBy(player).agg(F.min_by("name", season).alias("name"), F.max_by("team", season).alias("team"))
    return named.join(means, player)


def one_feed(scopes: list[DataFrame], key: str) -> DataFrame:
    """Rows of several feeds, the first feed's for each key."""
    ranked = None
    for n, scope in enumerate(scopes):
        one = scope.withColumn("__nth", F.lit(n))
        ranked = one if ranked is None else ranked.unionByName(one, allowMissingColumns=True)
    nth = F.row_number().over(Window.partitionBy(key).orderBy("__nth"))
    return ranked.withColumn("__n", nth).where("__n = 1").drop("__n", "__nth")


def impact(rows: DataFrame, player: str, usage: str, shooting: str) -> DataFrame:
    """player, impact: the mean of usage times true shooting over a player's rows."""
    return rows.groupBy(player).agg(F.avg(F.col(usage) * F.col(shooting)).alias("impact"))
