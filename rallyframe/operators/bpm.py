"""Box ratings: standardised weighted ridge of a rating on box rates, and the rate formulas."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rallyframe.functions.scalar import safe_ratio

# Features of both halves, the penalty, and the least sample.
OFFENSE = ("AST_100", "TOV_100", "USG_PCT", "TS_PCT")
DEFENSE = ("STL_100", "BLK_100", "DREB_100", "OREB_100")
PENALTY, LEAST_POSSESSIONS, LEAST_ROWS = 10.0, 500, 10


def true_shooting(pts: Column, fga: Column, fta: Column) -> Column:
    return safe_ratio(pts, 2 * (fga + 0.44 * fta))


def fit(rows: DataFrame, features: tuple[str, ...], label: str, weight: str, penalty: float = PENALTY) -> dict[str, float] | None:
    """Coefficients of the raw features and ``intercept``; None with too few rows.

    Features are standardised by unweighted mean and population deviation, the fit is weighted
    and its intercept unpenalised. All sums come from one aggregation; the solve sees
    len(features) + 1 columns.
    """
    used = rows.where(F.col(weight) >= LEAST_POSSESSIONS).dropna(subset=[*features, label, weight])
    stats = used.agg(F.count("*").alias("n"), *(f(c).alias(f"{k}_{c}") for c in features for k, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    if stats["n"] < LEAST_ROWS:
        return None
    scale = {c: stats[f"s_{c}"] or 1.0 for c in features}
    z = [((F.col(c) - stats[f"m_{c}"]) / scale[c]) for c in features] + [F.lit(1.0)]
    w, y = F.col(weight), F.col(label)
    pairs = [(i, j) for i in range(len(z)) for j in range(i, len(z))]
    sums = used.agg(*(F.sum(w * z[i] * z[j]) for i, j in pairs), *(F.sum(w * x * y) for x in z)).first()
    g = np.zeros((len(z), len(z)))
    for value, (i, j) in zip(sums, pairs):
        g[i, j] = g[j, i] = value
    beta = np.linalg.solve(g + penalty * np.diag([1.0] * len(features) + [0.0]), np.array(sums[len(pairs) :]))
    raw = {c: float(beta[k] / scale[c]) for k, c in enumerate(features)}
    return raw | {"intercept": float(beta[-1] - sum(raw[c] * stats[f"m_{c}"] for c in features))}


def predicted(model: dict[str, float]) -> Column:
    """The rating to two places; null where a feature is."""
    total = F.lit(model["intercept"])
    for c, b in model.items():
        if c != "intercept":
            total = total + F.lit(b) * F.col(c)
    return F.bround(total, 2)


def missing_features(columns: list[str]) -> list[str]:
    """Features of either half that a table lacks."""
    return [f for f in (*OFFENSE, *DEFENSE) if f not in columns]


def rated(rows: DataFrame, weight: str = "POSS", offense: str = "ORAPM", defense: str = "DRAPM") -> DataFrame:
    """Adds OBPM, DBPM and BPM, the sum of the two as rounded. A table without all features is an error."""
    if missing_features(rows.columns):
        raise ValueError(f"features missing: {', '.join(missing_features(rows.columns))}")
    halves = {}
    for name, features, label in (("OBPM", OFFENSE, offense), ("DBPM", DEFENSE, defense)):
        model = fit(rows, features, label, weight)
        halves[name] = predicted(model) if model else F.lit(None).cast("double")
    return rows.withColumns(halves).withColumn("BPM", F.bround(F.col("OBPM") + F.col("DBPM"), 2))
