"""What was done while a player was on the floor, and the rates that follow.

Everything is added up before anything is divided, so that a scope over several seasons or season
types is a sum of counts and never a mean of rates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rallyframe.functions.scalar import safe_ratio
from rallyframe.operators import box, intervals

# Stats of both sides that rates refer to.
CONTEXT = ("fgm", "fga", "fg3a", "fta", "oreb", "dreb", "tov", "ast")
PER_GAME = ("pts", "reb", "oreb", "dreb", "ast", "stl", "blk", "tov", "pf", "fga", "fta", "fgm", "fg3m", "fg3a", "ftm")
PER_OFFENSE, PER_DEFENSE = ("pts", "ast", "oreb", "tov", "fga"), ("stl", "blk", "dreb")


def stint_totals(events: DataFrame, stints: DataFrame) -> DataFrame:
    """game, t_start, team and CONTEXT: box events as-of their stint; one before the first counts for the first."""
    placed = intervals.asof(events, stints.select("game", "t_start"), ["game"], "t", "t_start", [], clamp=True)
    return placed.where("t_start is not null").groupBy("game", "t_start", "team").agg(*(F.sum(c).alias(c) for c in CONTEXT))


def sides(stints: DataFrame) -> DataFrame:
    """Each stint twice, from either side: game, t_start, team, opponent, lineup, on_poss_o, on_poss_d, secs."""

    def one(own: str, other: str) -> Column:
        return F.struct(
            F.col(own).alias("team"), F.col(other).alias("opponent"), F.col(f"{own}_lineup").alias("lineup"),
            F.col(f"{own}_poss").alias("on_poss_o"), F.col(f"{other}_poss").alias("on_poss_d"),
        )

    return stints.select("game", "t_start", (F.col("t_end") - F.col("t_start")).alias("secs"), F.inline(F.array(one("home", "away"), one("away", "home"))))


def context(events: DataFrame, stints: DataFrame) -> DataFrame:
    """player, on_poss_o, on_poss_d, secs, tm_* and opp_*: sums over the stints a player was in."""
    totals = stint_totals(events, stints)
    own = totals.select("game", "t_start", "team", *(F.col(c).alias(f"tm_{c}") for c in CONTEXT))
    other = totals.select("game", "t_start", F.col("team").alias("opponent"), *(F.col(c).alias(f"opp_{c}") for c in CONTEXT))
    both = sides(stints).join(own, ["game", "t_start", "team"], "left").join(other, ["game", "t_start", "opponent"], "left")
    sums = ["on_poss_o", "on_poss_d", "secs", *(f"{s}_{c}" for s in ("tm", "opp") for c in CONTEXT)]
    each = both.withColumn("player", F.explode("lineup"))
    return each.groupBy("player").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums))


def appearances(stints: DataFrame) -> DataFrame:
    """player, gp: games in whose lineups a player is, whether or not a play names it."""
    each = stints.select("game", F.explode(F.array_union("home_lineup", "away_lineup")).alias("player"))
    return each.groupBy("player").agg(F.count_distinct("game").alias("gp"))


def with_box(played: DataFrame, totals: DataFrame) -> DataFrame:
    """Everyone who played, with totals of 0 if no play names them."""
    return played.join(totals, "player", "left").na.fill(0, [*box.STATS, "reb"])


def combined(scopes: list[DataFrame]) -> DataFrame:
    """Counts of several scopes added up by player."""
    rows = scopes[0]
    for more in scopes[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("player").agg(*(F.sum(c).alias(c) for c in rows.columns if c != "player"))


def advanced(rows: DataFrame) -> DataFrame:
    """Adds every rate to counts and context of players, percentages times 100; null where undefined."""
    c = {n: F.col(n) for n in (*box.STATS, "reb", "gp", "secs", "on_poss_o", "on_poss_d", *(f"{s}_{x}" for s in ("tm", "opp") for x in CONTEXT))}
    true_attempts = c["fga"] + 0.44 * c["fta"]
    uses = true_attempts + c["tov"]
    boards = {"orbp": ("oreb", c["tm_oreb"] + c["opp_dreb"]), "drbp": ("dreb", c["tm_dreb"] + c["opp_oreb"])}
    percents = {
        "fg_pct": (c["fgm"], c["fga"]),
        "fg3_pct": (c["fg3m"], c["fg3a"]),
        "ft_pct": (c["ftm"], c["fta"]),
        "efg": (c["fgm"] + 0.5 * c["fg3m"], c["fga"]),
        "ts": (c["pts"], 2 * true_attempts),
        "par3": (c["fg3a"], c["fga"]),
        "ftr": (c["fta"], c["fga"]),
        "tovp": (c["tov"], uses),
        "usg": (uses, c["tm_fga"] + 0.44 * c["tm_fta"] + c["tm_tov"]),
        "astp": (c["ast"], c["tm_fgm"] - c["fgm"]),
        **{name: (c[own], available) for name, (own, available) in boards.items()},
        "trbp": (c["reb"], boards["orbp"][1] + boards["drbp"][1]),
        "stlp": (c["stl"], c["on_poss_d"]),
        "blkp": (c["blk"], c["opp_fga"] - c["opp_fg3a"]),
    }

    def per(n: Column, of: Column) -> Column:
        return F.when(of != 0, n.cast("double") / of)

    out = {"min": c["secs"] / 60.0, "uses": uses, **{n: safe_ratio(a, b) * 100 for n, (a, b) in percents.items()}}
    out |= {"min_pg": per(c["secs"] / 60.0, c["gp"]), **{f"{n}_pg": per(c[n], c["gp"]) for n in PER_GAME}}
    out |= {f"{n}_100": per(c[n], c["on_poss_o"]) * 100 for n in PER_OFFENSE} | {f"{n}_100": per(c[n], c["on_poss_d"]) * 100 for n in PER_DEFENSE}
    # Rebounds happen at both ends; a side without possessions leaves the rate undefined.
    both_ends = F.when((c["on_poss_o"] != 0) & (c["on_poss_d"] != 0), c["on_poss_o"] + c["on_poss_d"])
    out |= {"reb_100": per(c["reb"], both_ends) * 100, "stocks_100": per(c["stl"] + c["blk"], c["on_poss_d"]) * 100}
    return rows.withColumns(out)
