"""Published documents: what goes into each, as one row of JSON, and how it is stored.

Documents hold no NaN: a number that isn't one is null. Fields keep their order and nulls are
written out, so equal data give equal bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rallyframe.functions import scalar
from rallyframe.sources import files

# Published names of a player's columns, in order. The first group is a game's means,
# the second percentages and rates, the third per 100 possessions; the fourth on and off the floor.
PER_GAME = ("pts", "reb", "oreb", "dreb", "ast", "stl", "blk", "tov", "pf", "fgm", "fga", "fg3m", "fg3a", "ftm", "fta")
RATES = {"fg": "fg_pct", "fg3": "fg3_pct", "ft": "ft_pct"} | {n: n for n in ("efg", "ts", "par3", "ftr", "astp", "orbp", "drbp", "trbp", "stlp", "blkp", "tovp")}
PER_100 = ("pts", "reb", "ast", "stl", "blk", "tov", "stocks")
ON_OFF = {"on_o": "on_ortg", "on_d": "on_drtg", "on": "on_net", "off_o": "off_ortg", "off_d": "off_drtg", "off": "off_net", "onoff": "on_off"}
LEAST_POSSESSIONS = 100
_JSON = {"ignoreNullFields": "false"}


def _or_else(column: str, columns: list[str]) -> Column:
    """An own column, else the official feed's of the same name (feed_*), else null."""
    own = scalar.known_number(F.col(column).cast("double")) if column in columns else F.lit(None).cast("double")
    return F.coalesce(own, scalar.known_number(F.col(f"feed_{column}").cast("double"))) if f"feed_{column}" in columns else own


def player_fields(columns: list[str]) -> list[Column]:
    """The published columns of a player, from rows that have at least player, name and poss."""
    one = lambda column: F.bround(_or_else(column, columns), 1)
    text = lambda c: F.col(c) if c in columns else F.lit(None).cast("string")
    return [
        F.col("player").alias("id"), F.col("name").alias("n"), (F.col("team_id") if "team_id" in columns else F.lit(None).cast("long")).alias("tid"),
        text("team_name").alias("t"), text("abbr").alias("ta"), text("conf").alias("conf"), text("slug").alias("slug"),
        F.bround(_or_else("gp", columns), 0).cast("int").alias("gp"), one("min_pg").alias("min"),
        F.bround(F.col("poss").cast("double"), 0).cast("long").alias("poss"), one("usg").alias("usg"),
        *(one(f"{n}_pg").alias(n) for n in PER_GAME), *(one(c).alias(n) for n, c in RATES.items()),
        *(one(f"{n}_100").alias(f"{n}100") for n in PER_100), *(one(c).alias(n) for n, c in ON_OFF.items()),
    ]


def player_stats(rows: DataFrame, keys: list[str], meta: dict[str, Column]) -> DataFrame:
    """keys, doc: players by points, unknown points last, and the document's own facts.

    A key is a season and scope, so a document holds the players of one league.
    """
    fields = player_fields(rows.columns)
    shown = rows.select(*keys, F.struct(*fields).alias("__p"))
    order = F.struct(F.col("__p.pts").isNull().alias("no"), (-F.col("__p.pts")).alias("pts"), F.col("__p.id").alias("id"), F.col("__p").alias("p"))
    docs = shown.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["p"]).alias("players"))
    return _document(docs, keys, {"players": F.col("players")}, meta | {"n_players": F.size("players")})


def player_impact(rows: DataFrame, keys: list[str], alpha: float, meta: dict[str, Column]) -> DataFrame:
    """keys, doc: ratings of players with enough possessions, best first; possessions as ``rposs``.

    The name of that field is its own because the document is merged into those of other scopes.
    """
    kept = rows.where(F.col("poss") >= LEAST_POSSESSIONS)
    two = lambda c: F.bround(scalar.known_number(F.col(c).cast("double")), 2).alias(c)
    shown = F.struct(
        F.col("player").alias("id"), F.col("name").alias("n"), F.col("team_id").alias("tid"), F.col("team_name").alias("t"), "conf",
        F.bround(F.col("poss").cast("double"), 0).cast("long").alias("rposs"), two("orapm"), two("drapm"), two("rapm"),
    )
    order = F.struct(F.col("rapm").isNull().alias("no"), (-F.col("rapm")).alias("r"), F.col("player").alias("id"), shown.alias("p"))
    docs = kept.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["p"]).alias("players"))
    return _document(docs, keys, {"players": F.col("players")}, meta | {"n_players": F.size("players"), "alpha": F.lit(alpha)})


def shot_documents(compact: DataFrame, keys: list[str], zones: DataFrame, extra: list[str]) -> DataFrame:
    """keys, doc: a team's shots (``operators.shots.compact``) with its zones (keys, records) and the columns ``extra``."""
    joined = compact.join(zones.select(*keys, F.col("records").alias("team_zones")), keys, "left")
    body = {c: F.col(c) for c in (*extra, "gp", "players", "player_ids", "shots", "team_zones")}
    return _document(joined, keys, body, {})


def shot_index(teams: DataFrame, keys: list[str], team: list[str], meta: dict[str, Column]) -> DataFrame:
    """keys, doc: the teams that have shot documents by name, and the zones' names."""
    order = F.struct(*team)
    docs = teams.groupBy(*keys).agg(F.array_sort(F.collect_list(order)).alias("teams"))
    names = F.array(*map(F.lit, scalar.ZONE_NAMES))
    return _document(docs, keys, {"teams": F.col("teams"), "zone_names": names}, meta | {"n_teams": F.size("teams")})


def team_maps(teams: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """keys, doc: a season's teams by abbreviation."""
    entry = F.struct(F.col("abbr").alias("key"), F.struct(*fields).alias("value"))
    docs = teams.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("m"))
    return docs.select(*keys, F.to_json("m", _JSON).alias("doc"))


def _document(rows: DataFrame, keys: list[str], body: dict[str, Column], meta: dict[str, Column]) -> DataFrame:
    known = [F.struct(*(c.alias(n) for n, c in meta.items())).alias("meta")] if meta else []
    return rows.select(*keys, F.to_json(F.struct(*(c.alias(n) for n, c in body.items()), *known), _JSON).alias("doc"))


def write_table(rows: DataFrame, path: str, by: list[str] | None = None) -> None:
    """A result table as CSV with a header, by season and scope where ``by`` says so; NaN becomes empty."""
    writer = files.no_nan(rows).write.mode("overwrite").option("header", True)
    if by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    writer.csv(path)


def all_seasons(spark: SparkSession, path: str, schema: str, by: list[str]) -> DataFrame:
    """The union of a result table's season partitions; what was made of it lies elsewhere and isn't read."""
    return spark.read.schema(schema).csv(path, header=True).where(F.concat_ws("", *by) != "")


def stale_documents(stored: DataFrame, kept: DataFrame, keys: list[str]) -> DataFrame:
    """Stored documents that are no longer made; removing them is left to the caller."""
    return stored.select(*keys).join(kept.select(*keys).distinct(), keys, "left_anti")


def seasons_index(published: DataFrame, season: str) -> DataFrame:
    """doc: the seasons there are, newest first."""
    one = published.agg(F.sort_array(F.collect_set(season), asc=False).alias("seasons"))  # one entry a season
    return one.select(F.to_json(F.struct("seasons"), _JSON).alias("doc"))
