"""Box scores from a play log: one play adds to at most two players' totals.

``plays`` has game, seq (log order), t, code, action, description and for each of three slots n the
player ``p``n, what kind of actor it is ``k``n and its team ``t``n. Whether a player's rebound is
offensive is told by the counters in its text, in the order of the counters; where the text has
none, by who missed last. Team rebounds have player 0: they count for a team, not for a player.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rallyframe.functions import scalar
from rallyframe.operators import state

# Counted stats, kinds of actors and event codes.
STATS = ("fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "oreb", "dreb", "ast", "stl", "blk", "tov", "pf", "pts")
PLAYER_KINDS, TEAM_KINDS = (4, 5), (2, 3)
MADE, MISSED, FREE_THROW, REBOUND, TURNOVER, FOUL, PERIOD_START, PERIOD_END = 1, 2, 3, 4, 5, 6, 12, 13


def actor(n: int) -> Column:
    """struct<player, team> of slot ``n`` if a player acts there, else null; an unknown team is 0."""
    player, team = F.col(f"p{n}"), F.col(f"t{n}")
    acts = F.col(f"k{n}").isin(*PLAYER_KINDS) & (player > 0)
    return F.when(acts, F.struct(player.alias("player"), F.when(team > 0, team).otherwise(0).cast("long").alias("team")))


def team_actor() -> Column:
    """struct<player 0, team> of slot 1 if a team acts there: such rows hold the team where a player's id stands."""
    acts = F.col("k1").isin(*TEAM_KINDS) & (F.col("p1") > 0)
    return F.when(acts, F.struct(F.lit(0).cast("long").alias("player"), F.col("p1").alias("team")))


def rebound_kinds(plays: DataFrame) -> DataFrame:
    """game, seq, counted: ``off`` or ``def`` for player rebounds whose counters tell."""
    told = plays.where(F.col("code") == REBOUND).select("game", "seq", actor(1)["player"].alias("player"), scalar.rebound_counts(F.col("description")).alias("n"))
    told = told.select("game", "seq", "player", F.col("n.off").alias("o"), F.col("n.def").alias("d")).where("player is not null and o is not null")
    kinds = state.resolve_rebounds(told, ["game", "player"], "o", "d", "seq")
    return kinds.select("game", "seq", F.col("kind").alias("counted"))


def with_missing_team(plays: DataFrame) -> DataFrame:
    """Adds ``missed``: the team whose miss may be rebounded before each play, null if none.

    Set by a missed shot and by a missed free throw that is the last of its trip; cleared by made
    shots, other free throws, rebounds, turnovers and the ends of periods; fouls and the rest leave it.
    """
    code, text = F.col("code"), F.col("description")
    live = (code == FREE_THROW) & (scalar.free_throw_made_by_text(text) == 0) & scalar.is_last_of_trip(text)
    sets = (code == MISSED) | live
    clears = code.isin(MADE, FREE_THROW, REBOUND, TURNOVER, PERIOD_START, PERIOD_END)
    team = F.nullif(actor(1)["team"], F.lit(0))
    return state.pending(plays, ["game"], ["seq"], sets, clears, team, "missed")


def box_events(plays: DataFrame) -> DataFrame:
    """game, seq, t, player, team and STATS: a row for each player (or team) that a play adds to."""
    code, text = F.col("code"), F.coalesce("description", F.lit(""))
    rows = with_missing_team(plays).withColumn("n", F.when((code == REBOUND) & actor(1).isNotNull(), scalar.rebound_counts(F.col("description"))))
    # Plays that don't tell are a group of their own, whose kinds aren't read.
    told = F.when(F.col("n.off").isNotNull(), actor(1)["player"])
    rows = rows.withColumns({"teller": told, "o": F.col("n.off"), "d": F.col("n.def")})
    rows = state.resolve_rebounds(rows, ["game", "teller"], "o", "d", "seq").withColumn("counted", F.when(F.col("teller").isNotNull(), F.col("kind")))
    rows = rows.withColumns({"a1": actor(1), "a2": actor(2), "a3": actor(3), "whole_team": team_actor()})
    by_miss = F.when(F.col("missed").isNotNull(), F.when(F.coalesce(F.col("a1.team"), F.col("whole_team.team")) == F.col("missed"), "off").otherwise("def"))
    kind = F.when(F.col("a1").isNotNull(), F.coalesce("counted", by_miss)).otherwise(by_miss)
    rows = rows.withColumn("kind", F.when(code == REBOUND, kind))
    three, made = text.contains("3PT"), scalar.free_throw_made_by_text(text) == 1
    shot, ft = code.isin(MADE, MISSED), code == FREE_THROW
    first = {
        "fgm": code == MADE, "fga": shot, "fg3m": (code == MADE) & three, "fg3a": shot & three, "ftm": ft & made, "fta": ft,
        "oreb": F.col("kind") == "off", "dreb": F.col("kind") == "def", "tov": code == TURNOVER, "pf": code == FOUL,
    }
    points = {"pts": F.when(code == MADE, scalar.shot_points(text)).when(ft & made, 1).otherwise(0)}
    second = {"ast": code == MADE, "blk": code == MISSED, "stl": code == TURNOVER}

    def entry(who: Column, on: Column, flags: dict[str, Column], values: dict[str, Column]) -> Column:
        counts = {s: values.get(s, F.coalesce(flags[s], F.lit(False)).cast("int") if s in flags else F.lit(0)) for s in STATS}
        full = F.struct(who["player"].alias("player"), who["team"].alias("team"), *(c.cast("int").alias(s) for s, c in counts.items()))
        return F.when(on & who.isNotNull(), full)

    technical = F.coalesce(F.col("action").isin(*scalar.TECHNICAL_COUNT), F.lit(False))
    counts = code.between(MADE, FOUL) & ~((code == FOUL) & technical) & ~((code == REBOUND) & F.col("kind").isNull())
    who = F.coalesce("a1", F.when(code == REBOUND, F.col("whole_team")))
    other = F.when(code.isin(MADE, TURNOVER), F.col("a2")).when(code == MISSED, F.col("a3"))
    entries = F.array(entry(who, counts, first, points), entry(other, F.lit(True), second, {}))
    return rows.select("game", "seq", "t", F.inline(F.filter(entries, lambda e: e.isNotNull())))


def summed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, STATS and reb of players; team rows are left out."""
    sums = rows.where("player > 0").groupBy(*keys).agg(*(F.sum(s).alias(s) for s in STATS))
    return sums.withColumn("reb", F.col("oreb") + F.col("dreb"))


def game_box(events: DataFrame) -> DataFrame:
    """A row for each game, player and team."""
    return summed(events, ["game", "player", "team"])


def season_box(events: DataFrame) -> DataFrame:
    """A row for each player."""
    return summed(events, ["player"])
