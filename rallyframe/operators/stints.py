"""Stints: what both sides did while ten players stayed the same.

All games are one DataFrame. Offensive rebounds come from a player's rising counter where the text
has one, else from who missed last; both are windows in log order. Events meet intervals as-of:
one between two kept intervals counts for the earlier, one outside all of a game's is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rallyframe.functions import scalar
from rallyframe.operators import intervals, state

# Event codes.
MADE, MISSED, FREE_THROW, REBOUND, TURNOVER = 1, 2, 3, 4, 5
COUNTS = ("pts", "fga", "oreb", "tov", "fta")


def counted(events: DataFrame) -> DataFrame:
    """game, seq, t, team and COUNTS of each event (game, seq, t, code, team, player, description, score)."""
    kept = events.where(F.col("code").between(MADE, TURNOVER) & F.col("team").isNotNull())
    code, text = F.col("code"), F.upper(F.coalesce("description", F.lit("")))
    made = scalar.free_throw_made_by_score(F.col("description"), F.col("score")) == 1
    person = (F.col("player") > 0) & (F.col("player") < scalar.TEAM_ID_FLOOR)
    counter = F.when((code == REBOUND) & person, F.regexp_extract(text, r"OFF:\s*(\d+)", 1).try_cast("int"))
    rows = state.rises(kept.withColumn("__n", counter), ["game", "player"], ["seq"], "__n", "__rose")
    sets = (code == MISSED) | ((code == FREE_THROW) & ~made)
    rows = state.pending(rows, ["game"], ["seq"], sets, ~sets, F.col("team"), "__missed")
    offensive = F.when(F.col("__n").isNotNull(), F.col("__rose")).otherwise(F.coalesce(F.col("__missed") == F.col("team"), F.lit(False)))
    return rows.select(
        "game",
        "seq",
        "t",
        "team",
        F.when(code == MADE, scalar.shot_points(text)).when((code == FREE_THROW) & made, 1).otherwise(0).alias("pts"),
        code.isin(MADE, MISSED).cast("int").alias("fga"),
        ((code == REBOUND) & offensive).cast("int").alias("oreb"),
        (code == TURNOVER).cast("int").alias("tov"),
        (code == FREE_THROW).cast("int").alias("fta"),
    )


def stints(events: DataFrame, spans: DataFrame) -> DataFrame:
    """game, t_start, t_end, home, away, lineups, points, possessions and the margin at the start.

    ``spans`` has game, t_start, t_end, home, away (team ids), home_lineup and away_lineup. Spans
    without five on both sides are left out, and so are those in which nothing happened.
    """
    five = spans.where((F.size("home_lineup") == 5) & (F.size("away_lineup") == 5))
    ends = five.groupBy("game").agg(F.max("t_end").alias("last_end"))
    placed = intervals.asof(counted(events), five, ["game"], "t", "t_start", ["home", "away"])
    placed = placed.join(ends, "game").where(F.col("t_start").isNotNull() & (F.col("t") <= F.col("last_end")))
    side = {"home": F.col("team") == F.col("home"), "away": F.col("team") == F.col("away")}
    sums = placed.groupBy("game", "t_start").agg(*(F.sum(F.when(on, F.col(c))).alias(f"{s}_{c}") for s, on in side.items() for c in COUNTS))
    names = [f"{s}_{c}" for s in side for c in COUNTS]
    out = five.join(sums, ["game", "t_start"], "left").na.fill(0, names)
    before = Window.partitionBy("game").orderBy("t_start").rowsBetween(Window.unboundedPreceding, -1)
    margin = F.coalesce(F.sum(F.col("home_pts") - F.col("away_pts")).over(before), F.lit(0))
    poss = {f"{s}_poss": scalar.possessions(*(F.col(f"{s}_{c}") for c in COUNTS[1:])) for s in side}
    out = out.withColumns({"score_margin": margin.cast("double"), **poss}).where(sum((F.col(n) for n in names), F.lit(0)) > 0)
    return out.select(
        "game", "t_start", "t_end", "home", "away", "home_lineup", "away_lineup",
        *(F.col(f"{s}_pts").cast("double").alias(f"{s}_pts") for s in side), "home_poss", "away_poss", "score_margin",
    )


def points_audit(found: DataFrame, scores: DataFrame) -> DataFrame:
    """game, stint_points, log_points, diff: stints against the last score of the log.

    ``scores`` has game, seq, score (``H-A``). Games whose first score is above three are skipped:
    their log began late.
    """
    totals = scores.withColumn("total", scalar.score_total(F.col("score"))).where(F.col("total").isNotNull())
    logs = totals.groupBy("game").agg(F.min_by("total", "seq").alias("first"), F.max_by("total", "seq").alias("log_points"))
    ours = found.groupBy("game").agg(F.sum(F.col("home_pts") + F.col("away_pts")).alias("stint_points"))
    both = ours.join(logs.where(F.col("first") <= 3), "game")
    return both.select("game", "stint_points", "log_points", (F.col("stint_points") - F.col("log_points")).alias("diff"))
