"""From plays to stints of whole seasons in one call: who was where, which lineups met, what they did.

Input is ``feeds.plays``: game, seq, period, t, begins, ends, code, action, score, description, side and three slots of
player, kind, team and name. All games are one DataFrame throughout. Games that can't be built are
kept apart with the reason, so that one bad log costs no season.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rallyframe.functions import scalar
from rallyframe.operators import ordering, rotation, stints
from rallyframe.sources.stored import bucketed, task_count, written

SUBSTITUTION, FOUL = 8, 6
#: Kinds of a slot that mean a player on the floor.
PERSONS = (4, 5)
PLAYS = ("game", "seq", "period", "t", "begins", "ends", "code", "action", "score", "description", "side")


def _slots(*fields: str) -> Column:
    """The three slots as array<struct<slot, ...>>, fields by the first letter of their columns."""
    return F.array(*(F.struct(F.lit(n).alias("slot"), *(F.col(f"{f[0]}{n}").alias(f) for f in fields)) for n in (1, 2, 3)))


def player_teams(plays: DataFrame) -> DataFrame:
    """game, player, team: the team that most slots give a player; ties go to the first, slot by slot."""
    votes = plays.select("game", "seq", F.inline(_slots("player", "team"))).where("player > 0 and team > 0")
    at = F.struct("slot", "seq")
    counts = votes.groupBy("game", "player", "team").agg(F.count("*").alias("n"), F.min(at).alias("at"))
    best = F.max_by("team", F.struct("n", -F.col("at.slot"), -F.col("at.seq")))
    return counts.groupBy("game", "player").agg(best.alias("team"))


def player_names(plays: DataFrame) -> DataFrame:
    """player, name: the last non-blank name, game by game and slot by slot."""
    seen = plays.select("game", "seq", F.inline(_slots("player", "name"))).where("player > 0")
    named = seen.withColumn("name", F.trim("name"))
    return ordering.last_value(named, ["player"], "name", ["game", "slot", "seq"])


def team_sides(plays: DataFrame) -> DataFrame:
    """game, home, away of each game: the teams that most substitutions on a side name; null if either lacks or both agree.

    A substitution's text lies in its bench's column, so this needs no word of the feed on who is home.
    """
    votes = plays.where((F.col("code") == SUBSTITUTION) & (F.col("t1") > 0) & F.col("side").isNotNull())
    most = ordering.majority_vote(votes.select("game", "side", F.col("t1").alias("team"), "seq"), ["game", "side"], "team", "seq")
    both = most.groupBy("game").agg(*(F.max(F.when(F.col("side") == s, F.col("team"))).alias(s) for s in ("home", "away")))
    sound = F.col("home") != F.col("away")
    found = both.select("game", *(F.when(sound, F.col(s)).alias(s) for s in ("home", "away")))
    return plays.select("game").distinct().join(found, "game", "left")


def mentions(plays: DataFrame, teams: DataFrame, sides: DataFrame, many: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Mentions of players, as ``rotation`` reads them, for starters and for substitutions.

    The former take a player's team by vote of the game, the latter the team of the row. Who takes part
    in a play is on the floor, unless the play is a technical foul, which the bench can draw too. Slots that
    hold no person, as team rebounds do, are no mentions. A substitution needs both ids; one that is 0
    is no player, and the other side of it is evidence still, but no substitution. They are stored in ``many`` buckets.
    """
    sub = F.col("code") == SUBSTITUTION
    technical = (F.col("code") == FOUL) & scalar.is_technical(F.col("action"), F.col("description"))
    present = F.filter(_slots("player", "kind"), lambda s: (s["player"] > 0) & s["kind"].isin(*PERSONS))
    on = F.transform(present, lambda s: F.struct(s["slot"].alias("slot"), F.lit("on").alias("role"), s["player"].alias("player"), s["player"].alias("by")))
    side = lambda n, role: F.struct(F.lit(n).alias("slot"), F.lit(role).alias("role"), F.col(f"p{n}").alias("player"), F.col("p1").alias("by"))
    both = F.when(F.col("p1").isNotNull() & F.col("p2").isNotNull(), F.array(side(1, "out"), side(2, "in")))
    seen = F.when(sub, both).when(F.col("code").isin(*scalar.ON_COURT_EVENTS) & ~technical, on)
    # A game's players are a few dozen: one map a game, so that mentions needn't be shuffled by player.
    known = teams.groupBy("game").agg(F.map_from_entries(F.collect_list(F.struct("player", "team"))).alias("teams"))
    base = plays.join(sides.where("home is not null and away is not null").join(known, "game"), "game")
    rows = base.select("game", "period", "seq", "t", F.col("t1").alias("said"), "home", "away", "teams", F.inline(seen))
    rows = bucketed(rows.withColumn("voted", F.try_element_at("teams", "by")).drop("teams", "by"), "mentions", "game", many)
    columns = ["game", "period", "team", "seq", "slot", "t", "role", "player"]
    ours = lambda team: rows.where((F.col(team) == F.col("home")) | (F.col(team) == F.col("away"))).withColumn("team", F.col(team)).select(*columns)
    return ours("voted"), ours("said").where("role <> 'on'")


def states(openings: DataFrame, moves: DataFrame, periods: DataFrame) -> DataFrame:
    """game, period, team, t, nth, lineup, absent: a side's lineup from the opening of a period and after each substitution.

    One fold a side and period. absent names a player who was taken out without being on the floor.
    Substitutions before the period begins are left out.
    """
    subs = rotation.substitutions(moves).join(periods, ["game", "period"]).where("t >= begins")
    lists = subs.groupBy(*rotation.KEYS).agg(F.array_sort(F.collect_list(F.struct("seq", "t", "leaves", "enters"))).alias("subs"))
    held = openings.join(periods, ["game", "period"]).join(lists, rotation.KEYS, "left")
    players = held.schema["lineup"].dataType.simpleString()
    absent = held.schema["lineup"].dataType.elementType.simpleString()
    entry = lambda t, five, gone: F.struct(t.cast("double").alias("t"), five.alias("lineup"), gone.cast(absent).alias("absent"))
    first = F.array(entry(F.col("begins"), F.col("lineup"), F.lit(None)))

    def step(done: Column, sub: Column) -> Column:
        five = F.element_at(done, -1)["lineup"]
        gone = F.when(~F.array_contains(five, sub["leaves"]) & (F.size(five) > 0), sub["leaves"])
        return F.array_append(done, entry(sub["t"], rotation.substituted(five, sub["leaves"], sub["enters"]), gone))

    none = F.array().cast(lists.schema["subs"].dataType)
    path = F.aggregate(F.coalesce("subs", none), first.cast(f"array<struct<t:double,lineup:{players},absent:{absent}>>"), step)
    return held.select(*rotation.KEYS, F.posexplode(path).alias("nth", "s")).select(*rotation.KEYS, "nth", "s.t", "s.lineup", "s.absent")


def spans(changes: DataFrame, periods: DataFrame, sides: DataFrame) -> DataFrame:
    """game, period, t_start, t_end, home, away, home_lineup, away_lineup: both lineups between changes of either.

    A sweep over the times at which a side changes: each time carries the last state of either side.
    Changes at one time take effect together. Spans tile each period and none is empty.
    """
    side = changes.join(sides, "game")
    last = lambda s: F.max_by(F.when(F.col("team") == F.col(s), F.col("lineup")), F.when(F.col("team") == F.col(s), F.col("nth")))
    times = side.groupBy("game", "period", "t", "home", "away").agg(last("home").alias("h"), last("away").alias("a"))
    order = Window.partitionBy("game", "period").orderBy("t")
    held = order.rowsBetween(Window.unboundedPreceding, 0)
    swept = times.withColumns({"home_lineup": F.last("h", ignorenulls=True).over(held), "away_lineup": F.last("a", ignorenulls=True).over(held), "next": F.lead("t").over(order)})
    out = swept.join(periods, ["game", "period"]).withColumn("t_end", F.coalesce("next", "ends"))
    return out.where("t_end > t").select("game", "period", F.col("t").alias("t_start"), "t_end", "home", "away", "home_lineup", "away_lineup")


@dataclass(frozen=True)
class Built:
    """stints and player names; lineup warnings (game, period, team, warning); games left out (game, reason)."""

    stints: DataFrame
    spans: DataFrame
    names: DataFrame
    warnings: DataFrame
    quarantined: DataFrame


def _warnings(openings: DataFrame, changes: DataFrame) -> DataFrame:
    few = F.size("lineup") != rotation.FIVE
    opening = openings.where(few | ~F.col("certain")).select(
        *rotation.KEYS, F.when(few, F.concat(F.lit("only "), F.size("lineup").cast("string"), F.lit(" players at the start"))).otherwise("opening lineup inferred").alias("warning")
    )
    absent = changes.where("absent is not null")
    return opening.unionByName(absent.select(*rotation.KEYS, F.concat(F.col("absent").cast("string"), F.lit(" taken out at "), F.col("t").cast("string"), F.lit(" without being on the floor")).alias("warning")))


def built(plays: DataFrame) -> Built:
    """Stints of all games of ``plays``, and what there is to say about them.

    Plays and lineups are written once, in buckets of whole games that a task each reads. A game is quarantined if its substitutions don't tell the sides
    apart, if no span has five players on both sides, or if nothing happened in those that have.
    """
    names, many = player_names(plays), task_count(plays)
    plays = bucketed(plays.drop("n1", "n2", "n3"), "plays", "game", many)
    sides = written(team_sides(plays), "sides")
    periods = plays.groupBy("game", "period").agg(F.min("begins").alias("begins"), F.max("ends").alias("ends"))
    on, moves = mentions(plays, player_teams(plays), sides, many)
    openings = bucketed(rotation.openings(on, moves, periods), "openings", "game", many)
    changes = bucketed(states(openings, moves, periods), "changes", "game", many)
    met = bucketed(spans(changes, periods, sides), "spans", "game", many)
    events = plays.select("game", "seq", "t", "code", scalar.event_team(F.col("t1"), F.col("p1")).alias("team"), F.col("p1").alias("player"), "description", "score")
    found = written(stints.stints(events, met), "stints")
    five = met.where((F.size("home_lineup") == rotation.FIVE) & (F.size("away_lineup") == rotation.FIVE)).groupBy("game").agg(F.lit(True).alias("five"))
    done = found.groupBy("game").agg(F.lit(True).alias("done"))
    reason = F.when(F.col("home").isNull() | F.col("away").isNull(), "sides unknown").when(F.col("five").isNull(), "no span with five on both sides").when(F.col("done").isNull(), "nothing happened")
    left = sides.join(five, "game", "left").join(done, "game", "left").select("game", reason.alias("reason")).where("reason is not null")
    return Built(found, met, names, _warnings(openings, changes), left)
