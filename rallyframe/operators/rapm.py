"""Adjusted plus-minus: design rows of stints, their ridge, and the published table.

A stint gives two design rows, one for each side's possessions. A player's column when attacking is
its id, when defending the negative of it, so no dictionary of columns has to be built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rallyframe.functions.scalar import safe_ratio
from rallyframe.operators import lineups, solve
from rallyframe.sources.stored import written

# Least possessions, garbage time, the weight of an empty side.
LEAST_POSSESSIONS, REGULATION, GARBAGE_WINDOW, GARBAGE_MARGIN, FLOOR = 0.5, 2400.0, 300.0, 20.0, 0.01


def usable(stints: DataFrame) -> DataFrame:
    """Stints with at least half a possession."""
    return stints.where(F.col("home_poss") + F.col("away_poss") >= LEAST_POSSESSIONS)


def without_garbage(stints: DataFrame, window: float = GARBAGE_WINDOW, margin: float = GARBAGE_MARGIN) -> DataFrame:
    """Leaves out stints that begin in the last minutes (or overtime) of a game that is decided."""
    return stints.where(~((F.col("t_start") >= REGULATION - window) & (F.abs("score_margin") >= margin)))


def design_rows(stints: DataFrame, key: str) -> DataFrame:
    """key, side, w, y, cols of the two design rows of each stint.

    y is points per 100 possessions and w the possessions; a side without any weighs FLOOR.
    ``key`` identifies a stint.
    """

    def one(side: int, own: str, other: str) -> Column:
        w = F.greatest(F.col(f"{own}_poss").cast("double"), F.lit(FLOOR))
        attack, defence = F.col(f"{own}_lineup"), F.transform(f"{other}_lineup", lambda p: -p)
        return F.struct(F.lit(side).alias("side"), w.alias("w"), (F.col(f"{own}_pts") / w * 100).alias("y"), F.concat(attack, defence).alias("cols"))

    return stints.select(F.col(key), F.inline(F.array(one(0, "home", "away"), one(1, "away", "home"))))


def design(stints: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(row, col, w, y and key) for every player of a design row, and the rows alone."""
    rows = design_rows(stints, key).withColumn("row", F.col(key) * 2 + F.col("side")).drop("side")
    return rows.select("row", key, "w", "y", F.explode("cols").alias("col")), rows.drop("cols")


def possessions(stints: DataFrame) -> DataFrame:
    """player, poss: of both sides, over the stints in either of whose lineups a player is."""
    each = stints.select(F.explode(F.array_union("home_lineup", "away_lineup")).alias("player"), (F.col("home_poss") + F.col("away_poss")).alias("poss"))
    return each.groupBy("player").agg(F.sum("poss").alias("poss"))


def ratings(beta: DataFrame) -> DataFrame:
    """player, orapm, drapm, rapm of coefficients (col, beta): rounded halves and the rounded sum of these."""
    half = lambda on: F.coalesce(F.sum(F.when(on, F.col("beta"))), F.lit(0.0))
    sums = beta.groupBy(F.abs("col").alias("player")).agg(half(F.col("col") > 0).alias("o"), half(F.col("col") < 0).alias("d"))
    rounded = sums.select("player", F.bround("o", 2).alias("orapm"), F.bround(-F.col("d"), 2).alias("drapm"))
    return rounded.withColumn("rapm", F.bround(F.col("orapm") + F.col("drapm"), 2))


def net_ratings(stints: DataFrame) -> DataFrame:
    """player, team and on/off offence, defence and net per 100 possessions, for each player's primary team.

    Presence counts for all teams of a player; absence only for the primary one.
    """
    sided = stints.select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.col(own).alias("team"), F.col(f"{own}_lineup").alias("lineup"), F.col(f"{own}_pts").alias("pts"),
                        F.col(f"{other}_pts").alias("opp"), F.col(f"{own}_poss").alias("po"), F.col(f"{other}_poss").alias("pd"),
                    )
                    for own, other in (("home", "away"), ("away", "home"))
                )
            )
        )
    )
    values = ["pts", "opp", "po", "pd"]
    each = lineups.exploded(sided, "lineup", "player")
    with_team = each.groupBy("player", "team").agg(*(F.sum(v).alias(v) for v in values))
    primary = with_team.groupBy("player").agg(
        F.max_by(F.struct("team", *values), F.struct(F.col("po") + F.col("pd"), -F.col("team"))).alias("own"), *(F.sum(v).alias(f"on_{v}") for v in values)
    )
    whole = sided.groupBy("team").agg(*(F.sum(v).alias(f"all_{v}") for v in values))
    both = primary.withColumn("team", F.col("own.team")).join(whole, "team")
    both = both.withColumns({f"off_{v}": F.col(f"all_{v}") - F.col(f"own.{v}") for v in values})
    out = {}
    for p in ("on", "off"):
        out[f"{p}_ortg"] = safe_ratio(F.col(f"{p}_pts"), F.col(f"{p}_po")) * 100
        out[f"{p}_drtg"] = safe_ratio(F.col(f"{p}_opp"), F.col(f"{p}_pd")) * 100
        out[f"{p}_net"] = out[f"{p}_ortg"] - out[f"{p}_drtg"]
    out["on_off"] = out["on_net"] - out["off_net"]
    # Differences are taken before anything is rounded.
    out |= {f"{p}_poss_{side}": F.col(f"{p}_{column}") for p in ("on", "off") for side, column in (("o", "po"), ("d", "pd"))}
    return both.select("player", "team", *(F.bround(c, 1).alias(n) for n, c in out.items()))


def masked_rows(stints: DataFrame, key: str, mask: Column | None = None) -> DataFrame:
    """w, y, mask, cols of the design of usable stints, stored, as ``solve`` reads them; ``mask`` is of the key."""
    kept = design_rows(usable(stints), key)
    return written(kept.select("w", "y", (F.lit(0) if mask is None else mask).cast("long").alias("mask"), "cols"), "design")


def fitted(stints: DataFrame, key: str, alpha: float) -> DataFrame:
    """col, beta: the ridge of the design of usable stints. The design is worked out once."""
    return solve.frame(stints.sparkSession, solve.ridges(masked_rows(stints, key), [solve.Problem(alpha)]))


def assembled(rated: DataFrame, played: DataFrame, net: DataFrame, box: DataFrame) -> DataFrame:
    """The table of ratings with possessions, on/off and box columns, best first and unknowns last.

    ``box`` has player, gp and per-game fga, fta, tov; usage is of possessions on offence.
    """
    table = rated.join(played, "player", "left").join(net, "player", "left").join(box, "player", "left")
    usage = safe_ratio((F.col("fga") + 0.44 * F.col("fta") + F.col("tov")) * F.col("gp"), F.col("on_poss_o")) * 100
    return table.withColumns({"usg": F.bround(usage, 1), "poss": F.bround("poss", 1)}).orderBy(F.desc_nulls_last("rapm"), "player")


def per_game_columns(rows: DataFrame, per_game: list[str], shares: list[str]) -> DataFrame:
    """Box columns as published: per-game values to one place, shares as percentages, stocks as a sum."""
    plan = {c: F.bround(c, 1) for c in per_game} | {c: F.bround(F.col(c) * 100, 1) for c in shares}
    out = rows.withColumns(plan)
    return out.withColumn("stocks_100", F.col("stl_100") + F.col("blk_100")) if {"stl_100", "blk_100"} <= set(rows.columns) else out
