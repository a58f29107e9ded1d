"""Shots: zones, rollups, baselines and territory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rallyframe.functions import scalar
from rallyframe.operators import ranks


def prepared(raw: DataFrame, x: str, y: str, season: str) -> DataFrame:
    """Shots with zone_idx and zone in their own season's era; without heaves and null places."""
    arc, corner = scalar.era_value(F.col(season), 1), scalar.era_value(F.col(season), 2)
    placed = raw.withColumn("zone_idx", scalar.zone_index(F.col(x), F.col(y), arc, corner))
    return placed.where("zone_idx >= 0").withColumn("zone", scalar.zone_name(F.col("zone_idx")))


def zone_table(shots: DataFrame, keys: list[str], made: str, points: str) -> DataFrame:
    """keys, zone_idx, fgm, fga, pts."""
    return shots.groupBy(*keys, "zone_idx").agg(F.sum(made).alias("fgm"), F.count("*").alias("fga"), F.sum(points).alias("pts"))


def baselines(shots: DataFrame, season: str, made: str) -> DataFrame:
    """season, zone_idx, lg_fga, lg_pct for all 14 zones of each season; null pct where unused."""
    spark = shots.sparkSession
    zones = spark.range(len(scalar.ZONE_NAMES)).select(F.col("id").cast("int").alias("zone_idx"))
    seen = shots.groupBy(season, "zone_idx").agg(F.sum(made).alias("m"), F.count("*").alias("lg_fga"))
    dense = shots.select(season).distinct().crossJoin(F.broadcast(zones))  # 14 rows, fixed
    joined = dense.join(seen, [season, "zone_idx"], "left")
    return joined.select(season, "zone_idx", F.coalesce("lg_fga", F.lit(0)).alias("lg_fga"), scalar.safe_ratio(F.col("m"), F.col("lg_fga")).alias("lg_pct"))


def zone_records(shots: DataFrame, keys: list[str], made: str) -> DataFrame:
    """keys, records: array of [zone_idx, makes, attempts] in index order, used zones only."""
    sums = shots.groupBy(*keys, "zone_idx").agg(F.sum(made).cast("int").alias("m"), F.count("*").cast("int").alias("a"))
    return sums.groupBy(*keys).agg(F.array_sort(F.collect_list(F.array("zone_idx", "m", "a"))).alias("records"))


def territory(rows: DataFrame, keys: list[str], name: str, points: str) -> DataFrame:
    """The name with most points of each key, alphabetical among equals; none without points."""
    order = Window.partitionBy(*keys).orderBy(F.desc(points), name)
    return rows.where(F.col(points) > 0).withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def density_ceiling(rows: DataFrame, keys: list[str], x: str, y: str, width: float, share: float) -> DataFrame:
    """keys, ceiling: the count at position floor(n * share) of the sorted occupied square bins."""
    bins = rows.groupBy(*keys, F.floor(F.col(x) / width).alias("bx"), F.floor(F.col(y) / width).alias("by")).agg(F.count("*").alias("n"))
    order = Window.partitionBy(*keys).orderBy("n", "bx", "by")
    whole = F.count("*").over(Window.partitionBy(*keys))
    at = F.least(F.floor(whole * share), whole - 1)
    return bins.withColumns({"__i": F.row_number().over(order) - 1, "__at": at}).where("__i = __at").select(*keys, F.col("n").alias("ceiling"))


def half_court(rows: DataFrame, y: str) -> DataFrame:
    """Shots taken in the attacking half."""
    return rows.where(F.col(y).between(0, 420))


def prepared_feed(raw: DataFrame, season: str) -> DataFrame:
    """A raw shot feed (LOC_X, LOC_Y, SHOT_MADE_FLAG, SHOT_TYPE) with zone, made, shot_value, points and era.

    The value is the feed's own; only where it says neither, the zone's.
    """
    kept = prepared(raw.dropna(subset=["LOC_X", "LOC_Y"]).withColumns({c: F.col(c).cast("double") for c in ("LOC_X", "LOC_Y")}), "LOC_X", "LOC_Y", season)
    said = F.when(F.col("SHOT_TYPE").startswith("3PT"), 3).when(F.col("SHOT_TYPE").startswith("2PT"), 2)
    value = F.coalesce(said, F.when(F.col("zone_idx") >= 9, 3).otherwise(2))
    made = F.coalesce(F.col("SHOT_MADE_FLAG").cast("int"), F.lit(0))
    return kept.withColumns({"made": made, "shot_value": value, "points": made * value, "era": scalar.era_value(F.col(season), 3)})


def one_season(shots: DataFrame, season: str) -> DataFrame:
    """season: the only one there is; an error with several or none."""
    found = shots.agg(F.count_distinct(season).alias("n"), F.min(season).alias(season))
    message = F.concat(F.lit("expected one season, found "), F.col("n").cast("string"))
    return found.select(F.when(F.col("n") == 1, F.col(season)).otherwise(F.raise_error(message)).alias(season))


def hexagons(rows: DataFrame, keys: list[str], x: str, y: str, made: str, width: float, least: int = 3) -> DataFrame:
    """keys, hx, hy, n, pct: shots and share made in each pointy-topped hexagon ``width`` across, from ``least`` shots on.

    Hexagon centres are two rectangular lattices, one shifted by half a cell; a point belongs to
    the nearer of its nearest centre in each.
    """
    height = width * 3**0.5
    px, py = F.col(x), F.col(y)
    first = [F.round(px / width) * width, F.round(py / height) * height]
    second = [(F.floor(px / width) + 0.5) * width, (F.floor(py / height) + 0.5) * height]
    far = lambda c: F.pow(px - c[0], 2) + F.pow(py - c[1], 2)
    nearer = far(first) <= far(second)
    placed = rows.withColumns({"hx": F.when(nearer, first[0]).otherwise(second[0]), "hy": F.when(nearer, first[1]).otherwise(second[1])})
    return placed.groupBy(*keys, "hx", "hy").agg(F.count("*").alias("n"), F.avg(F.col(made).cast("double")).alias("pct")).where(F.col("n") >= least)


def arc_check(rows: DataFrame, season: str, x: str, y: str, three: Column, tolerance: float = 12.0, least: int = 50) -> DataFrame:
    """season, table_arc, measured_arc, ok: the first percentile of three-point distances above the break against the era's arc.

    Seasons with fewer than ``least`` such shots measure nothing and aren't ok.
    """
    r = F.sqrt(F.col(x) * F.col(x) + F.col(y) * F.col(y))
    above = three & (F.col(y) > 100)
    first = ranks.quantiles(rows.select(season, F.when(above, r).alias("r")), [season], "r", {"p": 0.01})
    sums = rows.groupBy(season).agg(F.count_if(above).alias("n")).join(first, season)
    table = scalar.era_value(F.col(season), 1).cast("double")
    measured = F.when(F.col("n") >= least, F.col("p"))
    return sums.select(season, table.alias("table_arc"), F.bround(measured, 1).alias("measured_arc"), F.coalesce(F.abs(measured - table) <= tolerance, F.lit(False)).alias("ok"))


def label_places(spark) -> DataFrame:
    """era, zone_idx, x, y: where each zone's label is drawn in each era."""
    import math

    # Bearings in degrees of the labels of each ring, and how far beyond the arc they stand.
    close, mid, beyond = (30, 90, 150), (18, 54, 90, 126, 162), ((54, 26.0), (90, 30.0), (126, 26.0))
    out = []
    for first, arc, corner, _ in scalar.ERAS:
        at = lambda r, a: (r * math.cos(math.radians(a)), r * math.sin(math.radians(a)))
        ring = (scalar.RIM_RADIUS + scalar.CLOSE_RADIUS) / 2
        side = corner + 18 if corner < arc else arc + 14
        places = [(0.0, 5.0), *(at(ring, a) for a in close), *(at((scalar.CLOSE_RADIUS + arc) / 2, a) for a in mid)]
        places += [(side, 6.0), *(at(arc + more, a) for a, more in beyond), (-side, 6.0)]
        out += [(first, z, float(px), float(py)) for z, (px, py) in enumerate(places)]
    return spark.createDataFrame(out, "era int, zone_idx int, x double, y double")


def misplaced_labels(spark) -> DataFrame:
    """era, zone_idx, got of labels that don't lie in their zone (none should)."""
    places = label_places(spark)
    got = scalar.zone_index(F.col("x"), F.col("y"), scalar.era_value(F.col("era"), 1), scalar.era_value(F.col("era"), 2))
    return places.withColumn("got", got).where("got <> zone_idx").select("era", "zone_idx", "got")


def compact(shots: DataFrame, keys: list[str]) -> DataFrame:
    """keys, gp, games, players, player_ids, shots: a flat array of [game, x, y, made, player] positions.

    ``shots`` has game, date, event, x, y, made, name and player. Games are numbered by date and id,
    names alphabetically; shots stand in order of game and event, so equal data give equal documents.
    """
    own = Window.partitionBy(*keys)
    coded = shots.withColumns({
        "__g": F.dense_rank().over(own.orderBy("date", "game")) - 1,
        "__p": F.when(F.col("name").isNull(), -1).otherwise(F.dense_rank().over(own.orderBy(F.col("name").asc_nulls_last())) - 1),
    })
    shot = F.struct("game", "event", F.array("__g", F.col("x").cast("int"), F.col("y").cast("int"), F.col("made").cast("int"), "__p").alias("five"))
    flat = F.flatten(F.transform(F.array_sort(F.collect_list(shot)), lambda s: s["five"]))
    games = F.array_sort(F.collect_set(F.struct("__g", F.col("game").cast("string").alias("id"), F.col("date").cast("string").alias("date"))))
    named = coded.where("name is not null").groupBy(*keys, "name").agg(F.min_by("player", F.struct("game", "event")).alias("player"))
    people = named.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("name", "player"))).alias("people"))
    docs = coded.groupBy(*keys).agg(games.alias("games"), flat.alias("shots")).join(people, keys, "left")
    return docs.select(
        *keys,
        F.size("games").alias("gp"),
        F.transform("games", lambda g: F.struct(g["id"].alias("id"), g["date"].alias("date"))).alias("games"),
        F.coalesce(F.transform("people", lambda p: p["name"]), F.array().cast("array<string>")).alias("players"),
        F.coalesce(F.transform("people", lambda p: p["player"]), F.array().cast("array<long>")).alias("player_ids"),
        "shots",
    )


def of_players(rows: DataFrame, players: DataFrame, keys: list[str]) -> DataFrame:
    """The shots of each of ``players`` (keys, player, name), with shot_name, the shots' own spelling.

    ``rows`` has keys, player and name. A player's shots are those with the id; only if there are none, those with the
    name, since feeds spell names differently. Shots of nobody are left out.
    """
    mine = players.select(*keys, F.col("player").alias("__p"), F.col("name").alias("__n"))
    spelled = rows.withColumnRenamed("name", "shot_name")
    by_id = mine.join(spelled.where("player IS NOT NULL"), [*(mine[k] == spelled[k] for k in keys), mine["__p"] == spelled["player"]], "left_semi").select(*keys, "__p").withColumn("__has", F.lit(True))
    known = mine.join(by_id.distinct(), [*keys, "__p"], "left")
    rest = known.where("__has IS NULL").groupBy(*keys, "__n").agg(F.min("__p").alias("__p"))
    one = spelled.join(mine.select(*keys, F.col("__p").alias("player"), F.col("__n").alias("player_name")), [*keys, "player"])
    two = spelled.drop("player").join(rest.select(*keys, F.col("__n").alias("shot_name"), F.col("__p").alias("player"), F.col("__n").alias("player_name")), [*keys, "shot_name"])
    return one.unionByName(two)
