"""Fits solved together against dense ones, one by one."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rallyframe.operators import evaluate, models, rapm, solve
from rallyframe.sources import stored

KINDS = "row long, w double, y double, mask long, fold int, cols array<long>"


def rows_of(spark, n=400, columns=30, seed=3):
    rnd = random.Random(seed)
    made = [(i, rnd.uniform(0.1, 3), rnd.gauss(1, 2), rnd.getrandbits(4), i % 5, rnd.sample(range(-columns, columns, 2), rnd.randint(0, 10))) for i in range(n)]
    return spark.createDataFrame(made, KINDS).repartition(5), made


def dense(made, alpha, keep):
    ids = sorted({c for r in made for c in r[5]})
    x = np.array([[c in r[5] for c in ids] for r in made], float)
    w, y = np.array([r[1] * keep(r) for r in made]), np.array([r[2] for r in made])
    mean = (w * y).sum() / w.sum()
    return mean, x, np.linalg.solve((x * w[:, None]).T @ x + alpha * np.eye(len(ids)), (x * w[:, None]).T @ (y - mean))


def test_all_problems_equal_dense_solutions(spark, monkeypatch):
    monkeypatch.setattr(solve, "CHUNK", 7)
    rows, made = rows_of(spark)
    problems = [solve.Problem(a, bit, want) for a in (0.5, 20.0, 3000.0) for bit in range(4) for want in (0, 1)] + [solve.Problem(5.0)]
    fits = solve.ridges(rows, problems)
    for k, p in enumerate(problems):
        mean, _, beta = dense(made, p.alpha, lambda r, p=p: p.bit < 0 or (r[3] >> p.bit) & 1 == p.want)
        assert fits.means[k] == pytest.approx(mean) and np.allclose(fits.beta[:, k], beta, atol=1e-8)
    got = {r.col: r.beta for r in solve.frame(spark, fits, len(problems) - 1).collect()}
    long = rows.select("row", "w", "y", F.explode("cols").alias("col"))
    assert got == pytest.approx(models.ridge(long, rows, "row", "col", "w", "y", 5.0), abs=1e-8)


def test_folds_equal_dense_errors(spark):
    rows, made = rows_of(spark)
    alphas = [1.0, 50.0]
    for alpha, error in solve.cross_validated(rows, 5, alphas):
        want = []
        for f in range(5):
            mean, x, beta = dense(made, alpha, lambda r, f=f: r[4] != f)
            w, y = np.array([r[1] * (r[4] == f) for r in made]), np.array([r[2] for r in made])
            want.append(np.sqrt((w * (y - mean - x @ beta) ** 2).sum() / w.sum()))
        assert error == pytest.approx(np.mean(want), abs=1e-8)


def test_odd_designs(spark):
    none = spark.createDataFrame([], KINDS)
    assert solve.ridges(none, [solve.Problem(1.0)]).beta.shape == (0, 1)
    one = spark.createDataFrame([(1, 2.0, 3.0, 0, 0, [7]), (2, 1.0, 6.0, 0, 0, [])], KINDS)
    fits = solve.ridges(one, [solve.Problem(1.0), solve.Problem(1.0, 0, 1)])
    assert fits.means.tolist() == [4.0, 0.0] and fits.beta.ravel() == pytest.approx([-2 / 3, 0.0])
    with pytest.raises(ArithmeticError):
        solve.ridges(rows_of(spark)[0], [solve.Problem(1e-9)], most=1)


def test_too_many_numbers_for_the_driver_are_refused(spark, monkeypatch):
    monkeypatch.setattr(solve, "LARGEST", 10)
    with pytest.raises(ValueError, match="fewer problems"):
        solve.ridges(rows_of(spark)[0], [solve.Problem(1.0)])


def test_twenty_splits(spark):
    rnd = random.Random(2)
    skill = {p: rnd.gauss(0, 12) for p in range(100, 160)}
    made = []
    for stint in range(1500):
        ten = rnd.sample(sorted(skill), 10)
        home, away = sorted(ten[:5]), sorted(ten[5:])
        edge = sum(skill[p] for p in home) - sum(skill[p] for p in away)
        made.append((stint, 1999, home, away, 5.0 + edge / 20 + rnd.gauss(0, 1), 5.0 - edge / 20 + rnd.gauss(0, 1), 5.0, 5.0))
    stints = spark.createDataFrame(made, "stint long, season int, home_lineup array<long>, away_lineup array<long>, home_pts double, away_pts double, home_poss double, away_poss double")
    got = {r.metric: r for r in evaluate.reliability(stints, "stint", 50.0, least=100.0).collect()}
    assert set(got) == {"orapm", "drapm", "rapm"} and all(r.n_splits_used == 20 and r.n_players_avg == 60 for r in got.values())
    assert got["rapm"].r_raw > 0.8 and got["rapm"].reliability == pytest.approx(2 * got["rapm"].r_raw / (1 + got["rapm"].r_raw), abs=0.002)
    poss = {(r.player, r.split): r.poss_0 + r.poss_1 for r in evaluate.half_possessions(stints, "stint", 20).collect()}
    whole = {r.player: r.poss for r in rapm.possessions(stints).collect()}
    assert len(poss) == 20 * 60 and all(v == pytest.approx(whole[p]) for (p, _), v in poss.items())


def test_sums_of_a_wide_design_are_few(spark):
    """A scan of the blocks has no more tasks than cores, however many pieces the table has, and leaves no residual."""
    rows = rows_of(spark)[0].repartition(60)
    problems = [solve.Problem(20.0), solve.Problem(20.0, 1, 1)]
    fits = solve.ridges(rows, problems)
    assert np.nanmax(np.abs(solve.residuals(problems, fits))) < 1e-6
    blocks = solve.packed(rows, fits.columns)
    assert blocks.count() >= 60
    few = blocks.coalesce(spark.sparkContext.defaultParallelism)
    assert few.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    total = solve.added_up(blocks, len(fits.columns), 1, lambda b, into: b.spread(b.w[:, None], into))
    want = {r.c: r.w for r in rows.selectExpr("explode(cols) AS c", "w").groupBy("c").sum("w").toDF("c", "w").collect()}
    assert np.allclose(total[:, 0], [want[int(c)] for c in fits.columns])


def test_residuals_need_no_broadcast_of_the_design(spark):
    """A stint's lineups are an explode, so the design looks as small as the stints; only the coefficients may be broadcast."""
    stints = stored.written(spark.range(600).selectExpr("id", "1D + id % 3 AS w", "1D * (id % 7) AS y", "transform(sequence(0, 4), i -> (id * 3 + i * 5) % 23) AS cols"), "stints")
    rows = stints.select(F.col("id").alias("row"), "w", "y")
    long = stints.select(F.col("id").alias("row"), "w", "y", F.explode("cols").alias("col"))
    beta = models.ridge_frame(long, rows, "row", "col", "w", "y", 10.0)
    left = models.normal_residuals(long, rows, "row", "col", "w", "y", 10.0, beta)
    found = left.collect()
    assert len(found) == 23 and all(abs(r.residual) < 1e-9 for r in found)
    assert left._jdf.queryExecution().sparkPlan().toString().count("Generate explode") == 1
