"""Every raw feed in one table: what it is keyed by, its columns, and where it lies.

A feed is read from the folder of stored answers; what fetched them is outside Spark. A stored
answer with no rows is an answer and gives an empty table. One that isn't there raises
``NotFetched``, which is no ``Exception``, so that a broad handler can't turn it into an empty one.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rallyframe.operators import ordering
from rallyframe.sources import files


class NotFetched(BaseException):
    """A feed that never answered; distinct from one that answered with no rows."""


@dataclass(frozen=True)
class Feed:
    """name: of the stored files; keys: parameters in their names; schema: columns, None to keep what is there."""

    name: str
    keys: tuple[str, ...]
    schema: str | None = None


PLAYS = (
    "GAME_ID string, EVENTNUM int, EVENTMSGTYPE int, EVENTMSGACTIONTYPE int, PERIOD int, PCTIMESTRING string, HOMEDESCRIPTION string, "
    "NEUTRALDESCRIPTION string, VISITORDESCRIPTION string, SCORE string, "
    + ", ".join(f"PERSON{n}TYPE int, PLAYER{n}_ID long, PLAYER{n}_NAME string, PLAYER{n}_TEAM_ID long" for n in (1, 2, 3))
    + ", PLAYER1_TEAM_CITY string, PLAYER1_TEAM_NICKNAME string, PLAYER1_TEAM_ABBREVIATION string"
)
ROTATION = "GAME_ID string, TEAM_ID long, PERSON_ID long, PLAYER_NAME string, IN_TIME_REAL double, OUT_TIME_REAL double, HOME_AWAY string"
SHOTS = (
    "GAME_ID string, GAME_EVENT_ID int, GAME_DATE string, PLAYER_ID long, PLAYER_NAME string, TEAM_ID long, LOC_X double, LOC_Y double, "
    "SHOT_MADE_FLAG int, SHOT_TYPE string"
)
# Feeds, the parameters their stored names are made of, and their columns.
FEEDS = {
    f.name: f
    for f in (
        Feed("shot_chart", ("season", "player_id", "team_id", "season_type"), SHOTS),
        Feed("player_index", ("season",)),
        Feed("player_stats", ("season", "season_type", "per_mode", "measure_type")),
        Feed("game_ids", ("season", "season_type"), files.SCHEDULE),
        Feed("pbp", ("game_id",), PLAYS),
        Feed("box_score", ("game_id",), files.BOX),
        Feed("rotation", ("game_id",), ROTATION),
        Feed("team_ratings", ("season", "season_type"), files.RATINGS),
        Feed("player_game_log", ("player_id", "season", "season_type")),
    )
}


def file_of(feed: str, **parameters) -> str:
    """The file name of one answer of a feed: ``content_key`` of its parameters."""
    if set(parameters) != set(FEEDS[feed].keys):
        raise ValueError(f"{feed} is keyed by {', '.join(FEEDS[feed].keys)}")
    parts = "_".join(sorted(f"{k}={v}" for k, v in parameters.items()))
    return f"{feed}_{hashlib.md5(parts.encode()).hexdigest()[:8]}.csv"


def path_of(spark: SparkSession, folder: str, feed: str, **parameters) -> str:
    """Where one answer of a feed is stored."""
    return f"{folder.rstrip('/')}/{file_of(feed, **parameters)}"


def read(spark: SparkSession, folder: str, feed: str, **parameters) -> DataFrame:
    """One stored answer, columns as declared; columns that the answer lacks are null."""
    return _scan(spark, folder, feed, [parameters], with_keys=False)


def missing(spark: SparkSession, folder: str, feed: str, answers: list[dict]) -> list[dict]:
    """Those of ``answers`` that are not stored, by one listing of the folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    there = {f.getPath().getName() for f in store.listStatus(at)} if store.exists(at) else set()
    return [a for a in answers if file_of(feed, **a) not in there]


def read_many(spark: SparkSession, folder: str, feed: str, answers: list[dict]) -> DataFrame:
    """Several answers as one table with their parameters as columns, by one scan; all must be stored.

    Columns go by the header that the files share; a file with another one fails the job. A parameter that is a
    column of the feed already, in any case, is not added.
    """
    return _scan(spark, folder, feed, answers, with_keys=True)


def _scan(spark: SparkSession, folder: str, feed: str, answers: list[dict], with_keys: bool) -> DataFrame:
    absent = missing(spark, folder, feed, answers)
    if absent:
        raise NotFetched(f"{feed} {absent[0]}" + (f" and {len(absent) - 1} more" if len(absent) > 1 else ""))
    known, schema = FEEDS[feed].keys, FEEDS[feed].schema
    if not answers:
        return spark.createDataFrame([], ", ".join([*filter(None, [schema]), *(f"{k} string" for k in known if k.upper() not in (schema or "").upper())]))
    # The list of answers is the caller's, so the table of their parameters is no larger than what the driver holds anyway.
    paths = sorted({path_of(spark, folder, feed, **a) for a in answers})
    header = spark.read.option("header", True).csv(paths[0]).schema
    text = ", ".join(f"`{f.name}` string" for f in header)
    rows = spark.read.schema(text).csv(paths, header=True, enforceSchema=False).withColumn("__file", F.col("_metadata.file_name"))
    of = spark.createDataFrame([(file_of(feed, **a), *(str(a[k]) for k in known)) for a in answers], ", ".join(["__file string", *(f"__{k} string" for k in known)])).distinct()
    there = {f.name.upper() for f in (header if schema is None else StructType.fromDDL(schema))}
    extra = [k for k in known if with_keys and k.upper() not in there]
    return declared(rows.join(F.broadcast(of), "__file"), schema, {k: F.col(f"__{k}") for k in extra}, ["__file", *(f"__{k}" for k in known)])


def declared(rows: DataFrame, schema: str | None, extra: dict[str, Column] | None = None, drop: list[str] = ()) -> DataFrame:
    """Rows with the declared columns and kinds only; a missing column is null, text that is no number too. ``extra`` columns follow."""
    more = [c.alias(k) for k, c in (extra or {}).items()]
    if schema is None:
        return rows.select(*(c for c in rows.columns if c not in drop), *more)
    kinds = StructType.fromDDL(schema)
    return rows.select(*((F.col(f.name) if f.name in rows.columns else F.lit(None)).try_cast(f.dataType).alias(f.name) for f in kinds), *more)


def plays(rows: DataFrame) -> DataFrame:
    """A play feed in the engine's terms (see ``operators.box`` and ``operators.season``), each row once, in chronological order.

    Rows without a readable clock are left out. The order is by period, clock and number: numbers
    alone aren't in order. begins and ends are the period's; side is the bench whose column has text.
    """
    from rallyframe.functions import scalar

    once = rows.dropDuplicates().withColumn("remaining", scalar.clock_seconds(F.col("PCTIMESTRING")))
    scheme = ordering.period_scheme(once, "GAME_ID", "PERIOD", "remaining")
    lasts = lambda remaining: scalar.elapsed(F.col("PERIOD"), remaining, F.col("regular"), F.col("n_regular"))
    ends = lasts(F.lit(0))
    begins = scalar.period_offset(F.col("PERIOD"), F.col("regular"), F.col("n_regular"))
    timed = once.join(scheme, "GAME_ID").withColumns({"t": lasts(F.col("remaining")), "begins": begins, "ends": ends})
    timed = ordering.chronological(timed.where("t is not null"), ["GAME_ID"], ["PERIOD", "t", "EVENTNUM"])
    fields = lambda k: ((f"PLAYER{k}_ID", f"p{k}"), (f"PERSON{k}TYPE", f"k{k}"), (f"PLAYER{k}_TEAM_ID", f"t{k}"), (f"PLAYER{k}_NAME", f"n{k}"))
    slots = [F.col(c).alias(n) for k in (1, 2, 3) for c, n in fields(k)]
    said = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) != ""
    return timed.select(
        F.lpad("GAME_ID", 10, "0").alias("game"), "seq", F.col("PERIOD").alias("period"), "t", "begins", "ends", F.col("EVENTMSGTYPE").alias("code"),
        F.col("EVENTMSGACTIONTYPE").alias("action"), F.col("SCORE").alias("score"),
        scalar.box_description(F.col("HOMEDESCRIPTION"), F.col("NEUTRALDESCRIPTION"), F.col("VISITORDESCRIPTION")).alias("description"),
        F.when(said("HOMEDESCRIPTION"), "home").when(said("VISITORDESCRIPTION"), "away").alias("side"), *slots,
    )


def sided_rotation(home: DataFrame, away: DataFrame) -> DataFrame:
    """Both sides' rotations as one table with the side each was told to be."""
    return home.withColumn("HOME_AWAY", F.lit("home")).unionByName(away.withColumn("HOME_AWAY", F.lit("away")), allowMissingColumns=True)


def home_team(plays_: DataFrame) -> DataFrame:
    """game, home, away: the team that most home (and away) players of slot kinds 4 (and 5) belong to; null if they agree."""
    slots = F.array(*(F.struct(F.col(f"k{n}").alias("kind"), F.col(f"t{n}").alias("team"), (F.col("seq") * 3 + n).alias("at")) for n in (1, 2, 3)))
    votes = plays_.select("game", F.inline(slots)).where("kind in (4, 5) and team > 0")
    most = ordering.majority_vote(votes, ["game", "kind"], "team", "at")
    both = most.groupBy("game").agg(*(F.max(F.when(F.col("kind") == k, F.col("team"))).alias(n) for k, n in ((4, "home"), (5, "away"))))
    agree = F.coalesce(F.col("home") == F.col("away"), F.lit(False))
    return both.select("game", *(F.when(~agree, F.col(n)).alias(n) for n in ("home", "away")))


def relabelled(rotation: DataFrame, voted: DataFrame) -> DataFrame:
    """A rotation with sides by vote of the play log (game, home, away); without a vote the old side stays."""
    side = F.when(F.col("TEAM_ID") == F.col("home"), "home").when(F.col("TEAM_ID") == F.col("away"), "away").otherwise(F.col("HOME_AWAY"))
    joined = rotation.join(voted.withColumnRenamed("game", "GAME_ID"), "GAME_ID", "left")
    return joined.withColumn("HOME_AWAY", F.when(F.col("home").isNotNull() & F.col("away").isNotNull(), side).otherwise(F.col("HOME_AWAY"))).drop("home", "away")


def pruned(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Those of ``columns`` that the table has, in that order."""
    return rows.select(*(c for c in columns if c in rows.columns))


def padded(game: Column) -> Column:
    return F.lpad(game.cast("string"), 10, "0")
