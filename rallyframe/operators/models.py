"""Weighted ridge by sufficient statistics, cross-validation and soft assignment.

Design rows stay in long form (row, column, weight, label). Each row's columns are gathered once and
its products emitted from there, to be added up within each task before anything is shuffled; only
(columns x columns) numbers reach the driver, as arrays. Folds are sums: the training Gram of a fold
is the total less the fold's own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gram(long: DataFrame, row: str, col: str, weight: str, by: str | None = None) -> DataFrame:
    """i, j, w (and ``by``): weighted products of indicator columns, upper triangle."""
    extra = [by] if by else []
    rows = long.groupBy(row, *extra).agg(F.array_sort(F.collect_set(col)).alias("cols"), F.max(weight).alias("w"))
    from_here = F.transform("cols", lambda c, k: F.struct(c.alias("i"), F.slice("cols", k + 1, F.size("cols")).alias("rest")))
    pairs = rows.select(*extra, "w", F.explode(from_here).alias("of")).select(*extra, "w", "of.i", F.explode("of.rest").alias("j"))
    return pairs.groupBy(*extra, "i", "j").agg(F.sum("w").alias("w"))


def moments(long: DataFrame, col: str, weight: str, label: str, by: str | None = None) -> DataFrame:
    """i, w, wy (and ``by``): weight and weighted label of each column."""
    extra = [by] if by else []
    return long.groupBy(*extra, F.col(col).alias("i")).agg(F.sum(weight).alias("w"), F.sum(F.col(weight) * F.col(label)).alias("wy"))


class Sums:
    """The dense sufficient statistics of a design: Gram matrix, weights and weighted labels of its columns.

    The columns (players, say) number in the thousands at most, which bounds what the driver holds.
    """

    def __init__(self, long: DataFrame, row: str, col: str, weight: str, label: str, fold: str | None = None):
        table = moments(long, col, weight, label, fold).toArrow()
        products = gram(long, row, col, weight, fold).toArrow()
        self.columns = np.unique(table["i"].to_numpy())
        n = len(self.columns)
        self.folds = np.unique(table[fold].to_numpy()) if fold else np.zeros(1)
        of = lambda t: np.searchsorted(self.folds, t[fold].to_numpy()) if fold else np.zeros(t.num_rows, dtype=int)
        at = lambda t, c: np.searchsorted(self.columns, t[c].to_numpy())
        self.gram = np.zeros((len(self.folds), n, n))
        self.gram[of(products), at(products, "i"), at(products, "j")] = products["w"].to_numpy()
        self.gram = np.maximum(self.gram, self.gram.transpose(0, 2, 1))
        self.w, self.wy = np.zeros((len(self.folds), n)), np.zeros((len(self.folds), n))
        self.w[of(table), at(table, "i")], self.wy[of(table), at(table, "i")] = table["w"].to_numpy(), table["wy"].to_numpy()


def ridge(long: DataFrame, rows: DataFrame, row: str, col: str, weight: str, label: str, alpha: float) -> dict:
    """Column -> coefficient. The label is centred by its weighted mean; there is no intercept.

    ``rows`` has each design row once, with weight and label.
    """
    mean = rows.agg(F.sum(F.col(weight) * F.col(label)) / F.sum(weight)).first()[0]
    sums = Sums(long, row, col, weight, label)
    beta = np.linalg.solve(sums.gram[0] + alpha * np.eye(len(sums.columns)), sums.wy[0] - mean * sums.w[0])
    return dict(zip(sums.columns.tolist(), beta.tolist()))


def ridge_frame(long: DataFrame, rows: DataFrame, row: str, col: str, weight: str, label: str, alpha: float) -> DataFrame:
    """col, beta of ``ridge``."""
    beta = ridge(long, rows, row, col, weight, label, alpha)
    table = pa.table({"col": pa.array(list(beta), pa.int64()), "beta": pa.array(list(beta.values()), pa.float64())})
    return long.sparkSession.createDataFrame(table)


def normal_residuals(long: DataFrame, rows: DataFrame, row: str, col: str, weight: str, label: str, alpha: float, beta: DataFrame) -> DataFrame:
    """col, residual: what the normal equations of a fit (col, beta) leave over, zero but for rounding.

    Worked out in Spark from the rows, without the Gram matrix that the fit was solved with.
    """
    mean = rows.agg((F.sum(F.col(weight) * F.col(label)) / F.sum(weight)).alias("mean"))
    # The long rows come from an explode, which Spark's estimate of their size leaves out: joined with their own sums
    # they are broadcast. So the sums are a window's, and what is broadcast is a coefficient for each column.
    known = long.join(F.broadcast(beta.select(F.col("col").alias(col), "beta")), col)
    fitted = known.withColumn("fit", F.sum("beta").over(Window.partitionBy(row)))
    # Centred by a scalar, which is one row.
    left = fitted.withColumn("left", F.col(weight) * (F.col(label) - mean.scalar() - F.col("fit")))
    sums = left.groupBy(col).agg(F.sum("left").alias("left"), F.sum(weight).alias("size"))
    return sums.join(beta.select(F.col("col").alias(col), "beta"), col).select(col, ((F.col("left") - alpha * F.col("beta")) / F.col("size")).alias("residual"))


def ridge_cv(long: DataFrame, rows: DataFrame, row: str, col: str, weight: str, label: str, fold: str, alphas: list[float]) -> list[tuple[float, float]]:
    """(alpha, mean weighted RMSE over folds). Folds partition the rows; both tables carry ``fold``."""
    y = F.col(label)
    totals = rows.groupBy(fold).agg(F.sum(weight).alias("w"), F.sum(F.col(weight) * y).alias("wy"), F.sum(F.col(weight) * y * y).alias("wyy")).toArrow()
    sums = Sums(long, row, col, weight, label, fold)
    at = np.searchsorted(sums.folds, totals[fold].to_numpy())
    tw, twy, twyy = (totals[c].to_numpy()[np.argsort(at)] for c in ("w", "wy", "wyy"))
    errors = np.zeros((len(sums.folds), len(alphas)))
    for f in range(len(sums.folds)):
        mean = (twy.sum() - twy[f]) / (tw.sum() - tw[f])
        values, axes = np.linalg.eigh(sums.gram.sum(axis=0) - sums.gram[f])
        turned = axes.T @ ((sums.wy.sum(axis=0) - sums.wy[f]) - mean * (sums.w.sum(axis=0) - sums.w[f]))
        centred = twyy[f] - 2 * mean * twy[f] + mean * mean * tw[f]
        for k, alpha in enumerate(alphas):
            beta = axes @ (turned / (values + alpha))
            square = centred - 2 * beta @ (sums.wy[f] - mean * sums.w[f]) + beta @ sums.gram[f] @ beta
            errors[f, k] = np.sqrt(max(square, 0.0) / tw[f])
    return list(zip(alphas, errors.mean(axis=0).tolist()))


def best_alpha(scores: list[tuple[float, float]]) -> float:
    """The first alpha of least error."""
    return min(scores, key=lambda s: s[1])[0]


def softmax(distances: Column, temperature: float = 0.3) -> Column:
    """Shares of array<double> distances, nearer ones larger."""
    least = F.array_min(distances)
    raised = F.transform(distances, lambda d: F.exp((least - d) / temperature))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raised, lambda x: x / total)


def spearman_brown(r: Column) -> Column:
    return 2 * r / (1 + r)
