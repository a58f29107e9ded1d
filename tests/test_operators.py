"""Operators on small logs with hand-checked results, and every query against DuckDB."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rallyframe.functions import scalar
from rallyframe.operators import intervals, lineups, models, ordering, ranks, reconcile, state
from rallyframe.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    return v


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    frame = catalog.QUERIES[name](spark, SF)
    rows = frame.collect()
    if name not in catalog.ORACLES:
        assert rows
        return
    found = duck.execute(catalog.ORACLES[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(frame.columns)
    key = lambda r: [(x is None, str(x)) for x in r]
    want = sorted((tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in found.fetchall()), key=key)
    assert sorted((tuple(plain(r[c]) for c in sorted(names)) for r in rows), key=key) == want


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_clocks_and_minutes(spark):
    lit = F.lit
    got = one(spark, *(scalar.clock_seconds(lit(x)) for x in ("10:05", "0:00", "x:1", "", None)))
    assert list(got) == [605.0, 0.0, None, None, None]
    got = one(spark, *(scalar.minutes_seconds(lit(x)) for x in ("30.000000:55", "12:07", "20", "", None, "DNP")))
    assert list(got) == [1855.0, 727.0, 1200.0, 0.0, 0.0, None]
    got = one(spark, *(scalar.elapsed(lit(p), lit(30.0), lit(600.0), lit(4)) for p in (1, 4, 5, 6)))
    assert list(got) == [570.0, 2370.0, 2670.0, 2970.0]


def test_text_rules(spark):
    lit = F.lit
    made = [scalar.free_throw_made_by_score(lit(d), lit(s)) for d, s in (("MISS x", "1-2"), ("x (3 PTS)", None), ("x", " "), ("x", "4-2"), (None, None))]
    assert list(one(spark, *made)) == [0, 1, 0, 1, 0]
    last = [scalar.is_last_of_trip(lit(d)) for d in ("Free Throw 1 of 2", "Free Throw 2 of 2", "Technical", None)]
    assert list(one(spark, *last)) == [False, True, True, True]
    counts = one(spark, scalar.rebound_counts(lit("A REBOUND (Off:2 Def:11)")).alias("r"), scalar.rebound_counts(lit("team")).alias("s"))
    assert (counts.r.off, counts.r["def"], counts.s.off) == (2, 11, None)
    assert list(one(spark, scalar.score_total(lit("10 - 7")), scalar.score_total(lit("x")), scalar.slugify(lit("  A & B's! ")))) == [17, None, "a-b-s"]
    assert list(one(spark, scalar.event_team(lit(0), lit(1_610_000_009)), scalar.event_team(lit(5), lit(1)), scalar.event_team(lit(0), lit(9)))) == [1_610_000_009, 5, None]


def test_period_scheme(spark):
    rows = [("a", p, 600.0) for p in range(1, 5)] + [("a", 5, 300.0), ("b", 1, 1190.0), ("b", 2, 1200.0), ("c", 1, 100.0), ("d", 1, 1500.0)]
    got = ordering.period_scheme(spark.createDataFrame(rows, "g string, p int, c double"), "g", "p", "c").collect()
    assert {r.g: (r.regular, r.n_regular) for r in got} == {"a": (600.0, 4), "b": (1200.0, 2), "c": (600.0, 4), "d": (1500.0, 1)}


def test_vote_ties_go_to_the_first(spark):
    rows = [(1, "x", 5), (1, "y", 1), (1, "y", 9), (1, "x", 7), (1, None, 0), (2, None, 1)]
    got = ordering.majority_vote(spark.createDataFrame(rows, "k int, v string, at int"), ["k"], "v", "at").collect()
    assert [(r.k, r.v, r.votes) for r in got] == [(1, "y", 2)]


def test_asof(spark):
    events = spark.createDataFrame([(1, t) for t in (0, 5, 7, 20)] + [(2, 3)], "g int, t int")
    starts = spark.createDataFrame([(1, 5, "a"), (1, 8, "b")], "g int, s int, name string")
    got = intervals.asof(events, starts, ["g"], "t", "s", ["name"]).orderBy("g", "t").collect()
    assert [r.name for r in got] == [None, "a", "a", "b", None]
    got = intervals.asof(events, starts, ["g"], "t", "s", ["name"], clamp=True).orderBy("g", "t").collect()
    assert [r.name for r in got] == ["a", "a", "a", "b", None]


def test_runs_and_gaps(spark):
    spans = spark.createDataFrame([(1, 0.0, 5.0), (1, 5.0, 9.0), (1, 11.0, 12.0)], "p int, a double, b double")
    assert [(r.a, r.b, r.n) for r in intervals.runs(spans, ["p"], "a", "b").orderBy("run").collect()] == [(0.0, 9.0, 2), (11.0, 12.0, 1)]
    assert [(r.b, r.next_start) for r in intervals.gaps(spans, ["p"], "a", "b").collect()] == [(9.0, 11.0)]
    grid = intervals.occupancy(spark.createDataFrame([(1, 0.5, 3.2, 7), (1, 2.0, 2.9, 8), (1, 2.0, 4.0, 9)], "g int, a double, b double, m int"), ["g"], "a", "b", "m")
    assert {r.second: r.members for r in grid.collect()} == {1: [7], 2: [7, 9], 3: [9]}


def test_pending_state_survives_neutral_rows(spark):
    rows = [(1, i, k) for i, k in enumerate(["miss", "foul", "rebound", "foul", "miss", "miss", "made"])]
    frame = spark.createDataFrame(rows, "g int, i int, k string")
    got = state.pending(frame, ["g"], ["i"], F.col("k") == "miss", F.col("k").isin("rebound", "made"), F.col("i"), "p").orderBy("i").collect()
    assert [r.p for r in got] == [None, 0, 0, None, None, 4, 5]


def test_rebounds_by_counters(spark):
    rows = [(1, 0, 1, 3), (1, 1, 0, 1), (1, 1, 1, 2), (1, 1, 1, 4)]
    got = state.resolve_rebounds(spark.createDataFrame(rows, "p int, o int, d int, i int"), ["p"], "o", "d", "i").orderBy("i").collect()
    assert [r.kind for r in got] == ["off", None, "def", None]


def test_on_off_equals_brute_force(spark):
    rnd = random.Random(2)
    stints = [(i, i % 3, sorted(rnd.sample(range(i % 3 * 10, i % 3 * 10 + 8), 5)), rnd.randint(0, 9)) for i in range(60)]
    got = lineups.on_off(spark.createDataFrame(stints, "id int, team int, five array<int>, pts int"), "team", "five", ["pts"]).collect()
    for r in got:
        own = [s for s in stints if s[1] == r.team]
        assert r.on_pts == sum(s[3] for s in own if r.member in s[2])
        assert r.off_pts == sum(s[3] for s in own if r.member not in s[2])


def test_percentiles(spark):
    rows = [("a", float(v), True) for v in (1, 2, 2, 5)] + [("a", 3.0, False), ("a", None, False), ("b", 1.0, True)]
    got = ranks.pool_percentiles(spark.createDataFrame(rows, "g string, v double, pool boolean"), F.col("pool"), "g", "v", "p").collect()
    assert sorted((r.g, r.v or -1, r.p if r.p is None else round(r.p, 3)) for r in got) == [
        ("a", -1, None), ("a", 1.0, 0.0), ("a", 2.0, 33.333), ("a", 2.0, 33.333), ("a", 3.0, 100.0), ("a", 5.0, 100.0), ("b", 1.0, None)
    ]


def test_ridge_matches_closed_form(spark):
    rnd = np.random.default_rng(5)
    n, p = 200, 8
    x = (rnd.random((n, p)) < 0.4).astype(float)
    w, y, fold = rnd.random(n) + 0.1, rnd.random(n) * 10, np.arange(n) % 5
    rows = spark.createDataFrame([(i, float(w[i]), float(y[i]), int(fold[i])) for i in range(n)], "r int, w double, y double, f int")
    long = spark.createDataFrame([(i, j, float(w[i]), float(y[i]), int(fold[i])) for i in range(n) for j in range(p) if x[i, j]], "r int, c int, w double, y double, f int")

    def fit(on, a):
        m = (w[on] * y[on]).sum() / w[on].sum()
        return m, np.linalg.solve((x[on] * w[on, None]).T @ x[on] + a * np.eye(p), (x[on] * w[on, None]).T @ (y[on] - m))

    got = models.ridge(long, rows, "r", "c", "w", "y", 3.0)
    assert np.allclose([got[j] for j in range(p)], fit(np.ones(n, bool), 3.0)[1])
    for a, e in models.ridge_cv(long, rows, "r", "c", "w", "y", "f", [1.0, 30.0]):
        errors = []
        for k in range(5):
            m, beta = fit(fold != k, a)
            on = fold == k
            errors.append(np.sqrt((w[on] * (y[on] - m - x[on] @ beta) ** 2).sum() / w[on].sum()))
        assert e == pytest.approx(np.mean(errors))


def test_reconcile_and_fallback(spark):
    a, b = spark.createDataFrame([(1, 5), (2, 3)], "k int, v int"), spark.createDataFrame([(2, 1), (3, 9)], "k int, v int")
    got = {r.k: (r.side, r.diff_v) for r in reconcile.full_compare(a, b, ["k"], ["v"]).collect()}
    assert got == {1: ("ours", None), 2: ("both", 2), 3: ("theirs", None)}
    doc = reconcile.document(spark.createDataFrame([(1, "b", None), (1, "a", 2)], "k int, n string, v int"), ["k"], ["n", "v"], ["n"]).first().doc
    assert doc == '[{"n":"a","v":2},{"n":"b","v":null}]'
