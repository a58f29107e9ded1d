"""Sweeps, ranks and quantiles that no one task holds, against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rallyframe.operators import ranks, verify

SPANS = "game int, team int, player long, t_start double, t_end double"


def by_second(ours, official):
    """The contract of ``compare_seconds``, second by second."""
    on = [{}, {}]
    for side, spans in enumerate((official, ours)):
        for game, team, player, a, b in spans:
            for s in range(int(np.ceil(a)), int(np.floor(b))):
                on[side].setdefault((game, s), {}).setdefault(team, set()).add(player)
    teams = {}
    for side in on:
        for (game, _), by in side.items():
            teams.setdefault(game, set()).update(by)
    out = {}
    for (game, s), by in sorted(on[0].items()):
        if all(len(by.get(t, ())) == 5 for t in teams[game]):
            differs = any(by.get(t, set()) != on[1].get((game, s), {}).get(t, set()) for t in teams[game])
            covered, matched, mismatched, first = out.get(game, (0, 0, 0, None))
            out[game] = (covered + 1, matched + (not differs), mismatched + differs, s if differs and first is None else first)
    return out


def test_sweep_equals_seconds(spark):
    rnd = random.Random(3)

    def spans(noise):
        out = []
        for game in range(4):
            for team in (1, 2):
                at = 0.0
                while at < 300:
                    end = at + rnd.choice([0.4, 7, 20.5, 33])
                    for player in rnd.sample(range(10 * team, 10 * team + (6 if noise else 5)), 5):
                        out.append((game, team, player, at, end))
                        if rnd.random() < 0.2:  # the same player again, overlapping
                            out.append((game, team, player, at + 1, end + rnd.choice([0, 3])))
                    at = end + rnd.choice([0, 0, 0, 2])
        return out

    official = spans(False)
    ours = [(g, t, p + (rnd.random() < 0.03) * 50, a, b) for g, t, p, a, b in official] + spans(True)[:40]
    frame = lambda rows: spark.createDataFrame(rows, SPANS)
    got = {r.game: tuple(r)[1:] for r in verify.compare_seconds(frame(ours), frame(official)).collect()}
    assert got == by_second(ours, official) and got


def test_codes_of_one_large_group(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice([None, "a", "a", "a"]), rnd.choice([None, *range(300)])) for _ in range(3000)]
    frame = spark.createDataFrame(rows, "g string, v int")
    for group in (["g"], []):
        places = {}
        for g, v in rows:
            places.setdefault(g if group else 0, set()).add(v)
        order = {g: {v: i for i, v in enumerate(sorted(vs, key=lambda v: (v is not None, v)))} for g, vs in places.items()}
        got = ranks.dense_codes(frame, group, "v", "code").collect()
        assert len(got) == len(rows) and all(r.code == order[r.g if group else 0][r.v] for r in got)


def test_percentiles_equal_the_window(spark):
    rnd = random.Random(2)
    frame = spark.createDataFrame([(i % 2, rnd.choice([None, float("nan"), *map(float, range(50))]), rnd.random() < 0.7) for i in range(2000)], "g int, v double, p boolean")
    pair = [sorted((r.g, str(r.v), str(r.out)) for r in f(frame, F.col("p"), "g", "v", "out").collect()) for f in (ranks.pool_percentiles, ranks.spread_percentiles)]
    assert pair[0] == pair[1]


def test_quantiles_equal_numpy(spark):
    rnd = np.random.default_rng(4)
    groups = {"a": np.exp(rnd.normal(size=30_000) * 9), "b": np.round(rnd.normal(size=5000), 1), "c": np.array([7.0]), "d": np.array([1.0, 1.0, 2.0])}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("a", None), ("b", float("nan")), ("e", None)]
    shares = {"lo": 0.01, "mid": 0.5, "hi": 0.9, "top": 1.0}
    got = {r.g: [r[n] for n in shares] for r in ranks.quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", shares).collect()}
    for g, vs in groups.items():
        assert got[g] == pytest.approx(np.quantile(vs, list(shares.values())).tolist(), rel=1e-12)
    assert got["e"] == [None] * 4


def test_tasks_grow_with_the_table(spark, monkeypatch):
    """A game's plays, events and stints are sorted in tasks of bounded size; groups by game need no second shuffle."""
    from rallyframe.sources import stored

    monkeypatch.setattr(stored, "TASK_ROWS", 100)
    rows = stored.by_key(stored.written(spark.range(5000).selectExpr("id % 700 AS game", "id AS seq"), "rows"), "game")
    assert rows.rdd.getNumPartitions() == 50
    each = rows.groupBy("game", "seq").count()
    assert each._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_published_means_are_exact(spark, tmp_path):
    """3030 hundredths over 600 rows lie on half a place: in doubles they come out above or below by the order of rows."""
    from rallyframe.plans import games

    some = [0.1] * 150 + [0.07] * 150 + [0.03] * 150 + [0.002] * 150
    made = [(1, v) for v in some] + [(2, v) for v in reversed(some)] + [(3, v) for v in sorted(some, key=lambda v: hash((v, 3)))]
    line = spark.createDataFrame([(k, v, 24.5 if i % 2 else 24.6, 1) for i, (k, v) in enumerate(made)], "l_suppkey long, l_discount double, l_quantity double, l_linenumber int")
    line.coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = games.published_columns(spark, str(tmp_path)).collect()
    assert {(r.pts, r.fg_pct) for r in got} == {(24.6, 5.0)}
