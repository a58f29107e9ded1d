"""Names for clusters of players and how well a player fits them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names in order, the first whose conditions on standard scores all hold is taken.
# A condition is a column, whether it must lie above or below, and the bound; the entry marked
# ``any`` needs one of its conditions only and then parts by its last.
BIG = (("OREB_PCT", ">", 0.7), ("DREB_PCT", ">", 0.9), ("BLK", ">", 0.8))
RULES = (
    ("Dominant Two-Way Big", (("BLK", ">", 2.0), ("USG_PCT", ">", 1.4))),
    ("Versatile Two-Way Forward", (("USG_PCT", ">", 0.7), ("BLK", ">", 0.8), ("OREB_PCT", ">", 0.6), ("TS_PCT", ">", 0.5))),
    ("Traditional Rim Protector", (("BLK", ">", 1.4), ("OREB_PCT", ">", 1.5))),
    ("High-Usage Frontcourt", (("USG_PCT", ">", 0.9), ("DREB_PCT", ">", 1.0), ("TS_PCT", "<", 0.0))),
    ("Glass Cleaner / Rebounder", (("OREB_PCT", ">", 1.0), ("FG3A", "<", -1.0), ("USG_PCT", "<", 0.0))),
    ("Turnover-Prone Frontcourt", (("E_TOV_PCT", ">", 1.0), ("AST_TO", "<", -0.8), ("DREB_PCT", ">", 0.2))),
    ("Interior Frontcourt", ("any", BIG, ("FG3A", "<", 0.0))),
    ("Frontcourt Contributor", ("any", BIG, None)),
    ("Playmaking Guard", (("AST_PCT", ">", 1.0), ("AST_TO", ">", 0.8))),
    ("Combo Guard / Facilitator", (("AST_PCT", ">", 0.8), ("E_TOV_PCT", ">", 0.6))),
    ("High-Volume Guard / Shot Creator", (("FG3A", ">", 0.9), ("USG_PCT", ">", 0.5), ("E_TOV_PCT", "<", 0.0))),
    ("Wing Primary Option", (("USG_PCT", ">", 0.7), ("OREB_PCT", ">", 0.0), ("FG3A", ">", 0.4))),
    ("High-Usage Athletic Wing", (("USG_PCT", ">", 0.7), ("FG3A", "<", 0.0))),
    ("Defensive Perimeter Wing", (("STL", ">", 0.7), ("TS_PCT", "<", -0.4))),
    ("3PT Volume Shooter", (("FG3A", ">", 0.6), ("TS_PCT", "<", -1.0))),
    ("Efficient Role Player", (("USG_PCT", "<", -0.8), ("TS_PCT", ">", 0.0))),
    ("Secondary Wing / Developing", (("STL", "<", -0.5), ("TS_PCT", "<", -0.2))),
    ("Role Wing", (("USG_PCT", "<", -0.4),)),
)
OTHERWISE = "Multi-Role Contributor"
FEATURES = ("USG_PCT", "AST_PCT", "OREB_PCT", "DREB_PCT", "TS_PCT", "E_TOV_PCT", "AST_TO", "FG3A", "BLK", "STL")
#: Further archetypes of a player are named from this share on, three at most.
SHARE, MOST = 0.2, 3


def _holds(condition: tuple[str, str, float]) -> Column:
    column, side, bound = condition
    z = F.coalesce(F.col(column), F.lit(0.0))
    return z > bound if side == ">" else z < bound


def archetype() -> Column:
    """The name of a profile of standard scores, columns FEATURES; a missing score counts as 0."""
    out = None
    for name, conditions in RULES:
        if conditions[0] == "any":
            _, some, last = conditions
            on = reduce(Column.__or__, map(_holds, some))
            on = on & _holds(last) if last else on
        else:
            on = reduce(Column.__and__, map(_holds, conditions))
        out = F.when(on, name) if out is None else out.when(on, name)
    return out.otherwise(OTHERWISE)


def profiles(rows: DataFrame, cluster: str, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """cluster, n and a score per feature: the cluster's median against all rows' median and deviation."""
    whole = rows.agg(*(F.median(f).alias(f"m_{f}") for f in features), *(F.stddev_samp(f).alias(f"s_{f}") for f in features))
    own = rows.groupBy(cluster).agg(F.count("*").alias("n"), *(F.median(f).alias(f) for f in features))
    # The league's figures are one row.
    for f in features:
        spread = whole.select(f"s_{f}").scalar()
        own = own.withColumn(f, F.when(spread > 0, (F.col(f) - whole.select(f"m_{f}").scalar()) / spread).otherwise(F.lit(0.0)))
    return own


def named(rows: DataFrame, cluster: str, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """cluster, n, archetype."""
    return profiles(rows, cluster, features).select(cluster, "n", archetype().alias("archetype"))


def leading_shares(names: Column, shares: Column) -> Column:
    """``First (60%) / Second (25%)``: the largest share always, others from SHARE on, three at most.

    Equal shares stay in the order of ``names``.
    """
    ranked = F.array_sort(F.zip_with(F.transform(names, lambda n, i: F.struct(i.alias("i"), n.alias("n"))), shares, lambda n, s: F.struct((-s).alias("s"), n["i"].alias("i"), n["n"].alias("n"))))
    kept = F.slice(F.filter(ranked, lambda r, i: (i == 0) | (-r["s"] >= SHARE)), 1, MOST)
    percent = lambda r: F.format_string("%s (%.0f%%)", r["n"], F.bround(-r["s"] * 100, 0))
    return F.array_join(F.transform(kept, percent), " / ")


def joined_season(base: DataFrame, style: DataFrame, advanced: DataFrame, key: str) -> DataFrame:
    """One row per player of ``base`` with the columns of the two others that it lacks."""
    out = base
    for more in (style, advanced):
        out = out.join(more.select(key, *(c for c in more.columns if c not in out.columns)), key, "left")
    return out
