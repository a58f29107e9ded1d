"""Refresh of a store of stints and season sums: only games whose plays changed are built again.

The store is a log of versions that are never rewritten. A version holds the stints and the players' shares
of the games built in it, the sums as of then, and last the manifest: each game with a digest of its plays
and the version it was built in. A version counts once its manifest is complete, so a refresh that
fails leaves the one before in force and can be run again. Sums are carried forward: what changed and
removed games had added is taken off, what they add now is put on. All of it is whole numbers and decimals,
so sums are the same as after a full rebuild.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rallyframe.operators import season
from rallyframe.sources import feeds, files
from rallyframe.sources.seasons import BY, SEASON_TYPES, STINTS

SUMS = {"stints": "long", "secs": "decimal(20,2)", "poss": "decimal(20,2)", "points": "long", "against": "long"}
_KEY = [*BY, "player"]
MANIFEST = "game string, season string, season_type string, digest string, version int"
SHARES = "game string, season string, season_type string, player long, games long, " + ", ".join(f"{c} {k}" for c, k in SUMS.items()) + ", version int"


def version(spark: SparkSession, store: str) -> int:
    """The version in force; 0 before the first."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{store}/manifest")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return 0
    names = [f.getPath().getName() for f in fs.listStatus(at)]
    done = [int(n.split("=")[1]) for n in names if n.startswith("as_of=") and files.exists(spark, f"{store}/manifest/{n}/_SUCCESS")]
    return max(done, default=0)


def manifest(spark: SparkSession, store: str, as_of: int | None = None) -> DataFrame:
    """game, season, season_type, digest, version of the games in force."""
    n = version(spark, store) if as_of is None else as_of
    return files.scan(spark, f"{store}/manifest/as_of={n}", MANIFEST, kind="parquet", may_be_absent=n == 0)


def _built(spark: SparkSession, store: str, what: str, schema: str, known: DataFrame) -> DataFrame:
    """Rows of the games of ``known`` (game, version), each from the version it was built in."""
    rows = files.scan(spark, f"{store}/{what}", schema, kind="parquet", may_be_absent=True)
    return rows.join(known.select("game", "version"), ["game", "version"])


def stints(spark: SparkSession, store: str) -> DataFrame:
    """The stints in force."""
    return _built(spark, store, "stints", f"{STINTS}, version int", manifest(spark, store)).drop("version")


def sums(spark: SparkSession, store: str) -> DataFrame:
    """season, season_type, player, games and SUMS in force."""
    n = version(spark, store)
    kinds = "season string, season_type string, player long, games long, " + ", ".join(f"{c} {k}" for c, k in SUMS.items())
    return files.scan(spark, f"{store}/sums/as_of={n}", kinds, kind="parquet", may_be_absent=n == 0)


def digests(plays: DataFrame) -> DataFrame:
    """game, digest of a game's plays in any order; repeated rows count."""
    row = F.xxhash64(*sorted(plays.columns))
    other = F.xxhash64(F.lit(1), *sorted(plays.columns))
    parts = plays.groupBy("game").agg(F.count("*").alias("n"), F.bit_xor(row).alias("x"), F.sum((other % (1 << 31)).cast("decimal(38,0)")).alias("s"), F.bit_xor(F.when(other % 2 == 0, row)).alias("e"))
    return parts.select("game", F.concat_ws("-", F.col("n").cast("string"), F.hex("x"), F.col("s").cast("string"), F.hex("e")).alias("digest"))


def shares(found: DataFrame) -> DataFrame:
    """What each game of ``found`` (stints with season and type) adds to its players' sums."""
    def side(own: str, other: str):
        return F.struct(F.col(f"{own}_lineup").alias("lineup"), F.col(f"{own}_pts").cast("long").alias("points"), F.col(f"{other}_pts").cast("long").alias("against"))

    secs, poss = (F.col("t_end") - F.col("t_start")).cast("decimal(20,2)"), F.round(F.col("home_poss") + F.col("away_poss"), 2).cast("decimal(20,2)")
    rows = found.select("game", *BY, secs.alias("secs"), poss.alias("poss"), F.inline(F.array(side("home", "away"), side("away", "home"))))
    each = rows.select("game", *BY, "secs", "poss", "points", "against", F.explode("lineup").alias("player"))
    total = lambda c: F.sum(c).cast(SUMS[c]).alias(c)
    return each.groupBy("game", *_KEY).agg(F.lit(1).cast("long").alias("games"), F.count("*").alias("stints"), *(total(c) for c in ("secs", "poss", "points", "against")))


def refresh(spark: SparkSession, store: str, plays: DataFrame, games: DataFrame) -> int:
    """Brings ``store`` up to ``plays`` (see ``operators.season``) of ``games`` (game, season, season_type); the version in force after.

    A game is built if its plays' digest, season or type isn't the manifest's; games no longer there are taken
    out. If nothing changed there is no new version. What a game quarantined adds is nothing.
    """
    before = version(spark, store)
    old = manifest(spark, store, before)
    now = digests(plays).join(games.select("game", *BY), "game")
    same = [F.col(f"now.{c}").eqNullSafe(F.col(f"old.{c}")) for c in ("digest", *BY)]
    both = now.alias("now").join(old.alias("old"), F.col("now.game") == F.col("old.game"), "full")
    kept = same[0] & same[1] & same[2]
    state = both.select(
        F.coalesce("now.game", "old.game").alias("game"), *(F.coalesce(f"now.{c}", f"old.{c}").alias(c) for c in BY), F.col("now.digest").alias("digest"),
        F.when(F.col("now.game").isNull(), "gone").when(F.col("old.game").isNull(), "new").when(kept, "kept").otherwise("changed").alias("what"),
        F.col("old.version").alias("version"),
    )
    state = season.written(state, "state")
    if state.where("what <> 'kept'").isEmpty():
        return before
    after = before + 1
    building = state.where("what IN ('new', 'changed')").select("game", *BY)
    # Written alone, so that its size in bytes, by which Spark chooses the join, is that of the keys.
    wanted = season.written(building.select("game"), "building")
    made = season.built(plays.join(wanted, "game", "left_semi"))
    fresh = season.written(made.stints.join(building, "game"), "fresh")
    fresh.write.mode("overwrite").parquet(f"{store}/stints/version={after}")
    made.quarantined.write.mode("overwrite").parquet(f"{store}/quarantined/version={after}")
    added = season.written(shares(fresh), "added")
    added.write.mode("overwrite").parquet(f"{store}/shares/version={after}")
    off = _built(spark, store, "shares", SHARES, state.where("what IN ('gone', 'changed')")).where(F.col("version") <= before)
    columns = ["games", *SUMS]
    signed = lambda rows, sign: rows.select(*_KEY, *((F.col(c) * sign).cast("decimal(25,2)").alias(c) for c in columns))
    every = signed(sums(spark, store), 1).unionByName(signed(off, -1)).unionByName(signed(added, 1))
    kinds = {"games": "long"} | SUMS
    total = every.groupBy(*_KEY).agg(*(F.sum(c).cast(kinds[c]).alias(c) for c in columns)).where("games > 0")
    total.write.mode("overwrite").parquet(f"{store}/sums/as_of={after}")
    entry = state.where("what <> 'gone'").select("game", *BY, "digest", F.when(F.col("what") == "kept", F.col("version")).otherwise(after).cast("int").alias("version"))
    entry.write.mode("overwrite").parquet(f"{store}/manifest/as_of={after}")
    return after


#: Feeds whose answers change while a season is played, with the parameters beside season and type.
VOLATILE = {
    "game_ids": [{}],
    "shot_chart": [{"player_id": 0, "team_id": 0}],
    "player_stats": [{"per_mode": p, "measure_type": m} for p, m in (("PerGame", "Base"), ("Per100Possessions", "Base"), ("Totals", "Base"), ("PerGame", "Advanced"), ("Totals", "Advanced"))],
}


def forget(spark: SparkSession, folder: str, of_season: str, dry_run: bool = False, types: tuple[str, ...] = SEASON_TYPES) -> list[str]:
    """Removes stored answers of a season in play that are out of date, so that they are fetched anew; their file names.

    These are the feeds of VOLATILE, and plays of games whose log stops before the end. The schedule is read first,
    as it is one of them. A season that was never fetched has nothing to forget.
    """
    from rallyframe.operators import verify

    schedules = [{"season": of_season, "season_type": t} for t in types]
    gone = feeds.missing(spark, folder, "game_ids", schedules)
    listed = feeds.read_many(spark, folder, "game_ids", [a for a in schedules if a not in gone])
    ids = [{"game_id": r.game} for r in listed.where("GAME_ID is not null").select(F.lpad("GAME_ID", 10, "0").alias("game")).distinct().orderBy("game").collect()]
    absent = {a["game_id"] for a in feeds.missing(spark, folder, "pbp", ids)}
    stored = [a for a in ids if a["game_id"] not in absent]
    raw = feeds.read_many(spark, folder, "pbp", stored)
    logs = raw.select(F.lpad("GAME_ID", 10, "0").alias("game"), F.col("PERIOD").alias("period"), F.col("EVENTMSGTYPE").alias("code"))
    whole = {r.game for r in verify.complete_games(logs).where("complete").collect()}
    names = [feeds.file_of(feed, season=of_season, season_type=t, **more) for feed, each in VOLATILE.items() for t in types for more in each]
    names += [feeds.file_of("pbp", **a) for a in stored if a["game_id"] not in whole]
    out = [n for n in names if files.exists(spark, f"{folder.rstrip('/')}/{n}")]
    for name in [] if dry_run else out:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
    return out
