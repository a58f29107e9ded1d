"""How reliable, stable and independent ratings are."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rallyframe.operators import models, rapm, solve

# Least possessions in a half and a season, least players in common, least deviation.
HALF_POSSESSIONS, SEASON_POSSESSIONS, LEAST_COMMON, FLAT = 250.0, 500.0, 10, 1e-9


def correlation(a: str | Column, b: str | Column) -> Column:
    """Pearson's r, null where either side hardly varies."""
    varies = (F.stddev_pop(a) >= FLAT) & (F.stddev_pop(b) >= FLAT)
    return F.when(varies, F.corr(a, b))


def p_value(r: float, n: int) -> float:
    """Two-sided p of a correlation ``r`` of ``n`` pairs: the tail of Student's t with n - 2 degrees, by its density."""
    if n < 3 or abs(r) >= 1:
        return 0.0 if abs(r) >= 1 and n >= 3 else math.nan
    free = n - 2
    t = abs(r) * math.sqrt(free / (1 - r * r))
    # t = tan(u) * sqrt(free) turns the tail into an integral of cos(u) ** (free - 1) over a bounded range.
    u = np.linspace(math.atan(t / math.sqrt(free)), math.pi / 2, 20_001)
    log_scale = math.lgamma((free + 1) / 2) - math.lgamma(free / 2) - 0.5 * math.log(math.pi)
    return float(2 * math.exp(log_scale) * np.trapezoid(np.cos(u) ** (free - 1), u))


def half_mask(key: str, splits: int) -> Column:
    """A bit for each split: which half a stint is in, by a hash of its key."""
    return F.xxhash64(F.lit(20), F.col(key)).bitwiseAND(F.lit((1 << splits) - 1))


def half_possessions(stints: DataFrame, key: str, splits: int) -> DataFrame:
    """player, split, poss_0, poss_1: possessions in either half of each split, in one pass."""
    both = F.array_union("home_lineup", "away_lineup")
    rows = stints.select(F.explode(both).alias("player"), (F.col("home_poss") + F.col("away_poss")).alias("poss"), half_mask(key, splits).alias("mask"))
    one = lambda s: F.sum(F.when(F.shiftright("mask", s).bitwiseAND(F.lit(1)) == 1, F.col("poss")).otherwise(0.0))
    sums = rows.groupBy("player").agg(F.sum("poss").alias("poss"), *(one(s).alias(f"s{s}") for s in range(splits)))
    each = F.array(*(F.struct(F.lit(s).alias("split"), (F.col("poss") - F.col(f"s{s}")).alias("poss_0"), F.col(f"s{s}").alias("poss_1")) for s in range(splits)))
    return sums.select("player", F.inline(each))


def half_ratings(stints: DataFrame, key: str, alpha: float, splits: int) -> DataFrame:
    """player, split, half, orapm, drapm, rapm (not rounded) of the fits of all halves, which are solved together."""
    problems = [solve.Problem(alpha, split, half) for split in range(splits) for half in (0, 1)]
    fits = solve.ridges(rapm.masked_rows(stints, key, half_mask(key, splits)), problems)
    n, k = fits.beta.shape
    table = pa.table({"col": np.repeat(fits.columns, k), "split": np.tile(np.repeat(np.arange(splits), 2), n), "half": np.tile([0, 1], n * splits), "beta": fits.beta.ravel()})
    beta = stints.sparkSession.createDataFrame(table)
    part = lambda on: F.coalesce(F.sum(F.when(on, F.col("beta"))), F.lit(0.0))
    rated = beta.groupBy(F.abs("col").alias("player"), "split", "half").agg(part(F.col("col") > 0).alias("orapm"), (-part(F.col("col") < 0)).alias("drapm"))
    return rated.withColumn("rapm", F.col("orapm") + F.col("drapm"))


def reliability(stints: DataFrame, key: str, alpha: float, splits: int = 20, least: float = HALF_POSSESSIONS) -> DataFrame:
    """metric, r_raw, reliability, n_players_avg, n_splits_used: split halves, stepped up by Spearman and Brown.

    Splits with too few players in common are left out, and so are correlations of flat ratings. A stint's
    halves in all splits are the bits of one mask, and all halves are fitted together; at most 62 splits.
    """
    metrics = ("orapm", "drapm", "rapm")
    rated = half_ratings(stints, key, alpha, splits)
    a, b = (rated.where(F.col("half") == h).drop("half") for h in (0, 1))
    both = a.join(b.select("player", "split", *(F.col(m).alias(f"{m}_b") for m in metrics)), ["player", "split"])
    both = both.join(half_possessions(stints, key, splits), ["player", "split"]).where((F.col("poss_0") >= least) & (F.col("poss_1") >= least))
    found = both.groupBy("split").agg(F.count("*").alias("n"), *(correlation(m, f"{m}_b").alias(m) for m in metrics)).where(F.col("n") >= LEAST_COMMON)
    long = found.select("n", F.inline(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("r")) for m in metrics))))
    means = long.where("r is not null").groupBy("metric").agg(F.avg("r").alias("r"), F.avg("n").alias("n"), F.count("*").alias("used"))
    stepped = F.when(F.col("r") > -1, models.spearman_brown(F.col("r")))
    return means.select(
        "metric", F.bround("r", 3).alias("r_raw"), F.bround(stepped, 3).alias("reliability"), F.bround("n", 1).alias("n_players_avg"), F.col("used").alias("n_splits_used")
    )


def stability(seasons: DataFrame, metrics: tuple[str, ...], reliabilities: DataFrame | None = None, least: float = SEASON_POSSESSIONS) -> DataFrame:
    """season_a, season_b, metric, n_players, r_across and, with ``reliabilities`` (season, metric, reliability), the corrected r.

    ``seasons`` has season, player, poss and the metrics; a season is paired with the next one there is.
    """
    from pyspark.sql import Window

    kept = seasons.where(F.col("poss") >= least)
    after = seasons.select("season").distinct()
    after = after.withColumn("season_b", F.lead("season").over(Window.orderBy("season"))).where("season_b is not null")  # one row a season
    a = kept.join(after, "season")
    b = kept.select(F.col("season").alias("season_b"), "player", *(F.col(m).alias(f"{m}_b") for m in metrics))
    both = a.join(b, ["season_b", "player"]).groupBy(F.col("season").alias("season_a"), "season_b")
    pairs = both.agg(F.count("*").alias("n_players"), *(correlation(m, f"{m}_b").alias(m) for m in metrics)).where(F.col("n_players") >= LEAST_COMMON)
    entries = F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("r")) for m in metrics))
    out = pairs.select("season_a", "season_b", "n_players", F.inline(entries)).where("r is not null")
    if reliabilities is None:
        return out.select("season_a", "season_b", "metric", "n_players", F.bround("r", 3).alias("r_across"))
    for side in "ab":
        known = reliabilities.select(F.col("season").alias(f"season_{side}"), "metric", F.col("reliability").alias(f"reliability_{side}"))
        out = out.join(known, [f"season_{side}", "metric"], "left")
    usable = (F.col("reliability_a") > 0) & (F.col("reliability_b") > 0)
    corrected = F.when(usable, F.bround(F.col("r") / F.sqrt(F.col("reliability_a") * F.col("reliability_b")), 3))
    return out.select(
        "season_a", "season_b", "metric", "n_players", F.bround("r", 3).alias("r_across"), "reliability_a", "reliability_b", corrected.alias("stability_corrected")
    )


def correlations(rows: DataFrame, columns: list[str]) -> DataFrame:
    """a, b, r: Pearson's r of all pairs of ``columns`` over complete rows, in one pass, to three places."""
    kept = rows.dropna(subset=columns)
    pairs = [(a, b) for a in columns for b in columns]
    one = kept.agg(*(F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs))
    return one.select(F.inline(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.bround(f"`{a}|{b}`", 3).alias("r")) for a, b in pairs))))


def components(rows: DataFrame, columns: list[str]) -> DataFrame:
    """component, explained_variance, cumulative_variance, of the standardised ``columns`` over complete rows.

    Raises with fewer than ten of these. Only the matrix of correlations reaches the driver.
    """
    kept = rows.dropna(subset=columns)
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    found = kept.agg(F.count("*"), *(F.corr(columns[i], columns[j]) for i, j in pairs)).first()
    if found[0] < LEAST_COMMON:
        raise ValueError(f"only {found[0]} complete rows")
    matrix = np.eye(len(columns))
    for value, (i, j) in zip(found[1:], pairs):
        matrix[i, j] = matrix[j, i] = value
    share = np.sort(np.linalg.eigvalsh(matrix))[::-1] / len(columns)
    total = np.cumsum(share)
    out = [(k + 1, round(float(s), 3), round(float(t), 3)) for k, (s, t) in enumerate(zip(share, total))]
    return rows.sparkSession.createDataFrame(out, "component int, explained_variance double, cumulative_variance double")


def enough_components(explained: DataFrame, share: float = 0.9) -> DataFrame:
    """n: how many components explain ``share`` of the variance."""
    return explained.where(F.col("cumulative_variance") >= share).agg(F.min("component").alias("n"))
