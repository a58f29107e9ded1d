"""Box scores, rates, ratings, checks and feeds on small games worked out by hand."""

import math

import numpy as np
import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from rallyframe.functions import scalar
from rallyframe.operators import archetypes, box, bpm, evaluate, intervals, models, ranks, rapm, rates, shots, verify
from rallyframe.sources import documents, feeds, files

PLAYS = "game int, seq int, t double, code int, action int, p1 long, k1 int, t1 long, p2 long, k2 int, t2 long, p3 long, k3 int, t3 long, description string"


def plays(spark, rows):
    """Plays of (code, description, slots, action) with slots of (player, kind, team)."""
    out = []
    for n, (code, text, slots, *action) in enumerate(rows, 1):
        slots = [*slots, *[(None, None, None)] * (3 - len(slots))]
        out.append((1, n, n * 10.0, code, action[0] if action else 0, *(x for s in slots for x in s), text))
    return spark.createDataFrame(out, PLAYS)


A, B, C = (11, 4, 1), (12, 4, 1), (21, 5, 2)


def test_box_of_a_game(spark):
    log = [
        (1, "A 3PT Jump Shot", [A, B]),  # three points, an assist
        (2, "MISS C Layup", [C, (None, 0, None), B]),  # a miss, blocked by B
        (4, "TEAM REBOUND", [(2, 3, None)]),  # team 2 rebounds its own miss: no player's
        (2, "MISS A Jump Shot", [A]),
        (6, "A foul", [C], 11),  # technical: no personal foul, and the miss stays
        (4, "B REBOUND", [B]),  # no counters: offensive by the pending miss
        (3, "MISS C Free Throw 1 of 2", [C]),
        (4, "A REBOUND", [A]),  # not reboundable: nothing
        (3, "C Free Throw 2 of 2", [C]),
        (5, "A Lost Ball", [A, C]),
        (4, "C REBOUND (Off:1 Def:0)", [C]),  # by counter, against the pending state
        (6, "B foul", [B], 1),
        (4, "A REBOUND", [(11, 0, None)]),  # no actor at all
        (None, "?", [A]),
    ]
    got = {r.player: r for r in box.game_box(box.box_events(plays(spark, log))).collect()}
    assert (got[11].pts, got[11].fga, got[11].fgm, got[11].fg3m, got[11].fg3a, got[11].tov, got[11].reb) == (3, 2, 1, 1, 1, 1, 0)
    assert (got[12].ast, got[12].blk, got[12].oreb, got[12].pf, got[12].reb) == (1, 1, 1, 1, 1)
    assert (got[21].fga, got[21].fta, got[21].ftm, got[21].pts, got[21].stl, got[21].oreb, got[21].pf) == (1, 2, 1, 1, 1, 1, 0)
    whole = [r for r in box.box_events(plays(spark, log)).collect() if r.player == 0]
    assert [(r.team, r.oreb, r.dreb) for r in whole] == [(2, 1, 0)]
    assert box.game_box(box.box_events(plays(spark, log).limit(0))).count() == 0


def test_counters_out_of_order(spark):
    log = [(4, "(Off:0 Def:1)", [A]), (4, "(Off:1 Def:2)", [A]), (4, "(Off:0 Def:2)", [A])]
    got = {r.seq: r.counted for r in box.rebound_kinds(plays(spark, log)).collect()}
    assert got == {1: "def", 3: "def", 2: "off"}


def test_rates(spark):
    counts = {c: 0 for c in (*box.STATS, "reb", *(f"{s}_{x}" for s in ("tm", "opp") for x in rates.CONTEXT))}
    one = counts | dict(player=1, gp=2, secs=1200.0, on_poss_o=50, on_poss_d=40, fgm=5, fga=10, pts=12, fta=5, tov=3, tm_fga=30, tm_fta=10, tm_tov=6, oreb=2, dreb=4, reb=6, stl=2, tm_oreb=5, opp_dreb=15)
    none = counts | dict(player=2, gp=0, secs=0.0, on_poss_o=0, on_poss_d=0)
    frame = spark.createDataFrame([{k: float(v) for k, v in x.items()} for x in (one, none)])
    got = {r.player: r for r in rates.advanced(frame).collect()}
    r = got[1.0]
    assert r.fg_pct == 50 and r.ts == pytest.approx(1200 / (2 * 12.2)) and r.usg == pytest.approx(100 * 15.2 / 40.4)
    assert r.orbp == 10 and r.stlp == 5 and r.pts_pg == 6 and r.pts_100 == 24 and r.reb_100 == pytest.approx(600 / 90)
    assert got[2.0].fg_pct is None and got[2.0].pts_pg is None and got[2.0].reb_100 is None


def test_ratios_need_a_finite_positive_denominator(spark):
    dens = [2.0, 0.0, -1.0, math.nan, math.inf, None]
    got = spark.createDataFrame([(d,) for d in dens], "d double").select(scalar.safe_ratio(F.lit(1), F.col("d")).alias("r")).collect()
    assert [r.r for r in got] == [0.5, None, None, None, None, None]


def test_pools_leave_out_nan(spark):
    rows = spark.createDataFrame([("g", v) for v in (1.0, 2.0, 3.0, math.nan)], "g string, v double")
    got = sorted((r.v, r.p) for r in ranks.pool_percentiles(rows, F.lit(True), "g", "v", "p").collect() if not math.isnan(r.v))
    assert got == [(1.0, 0.0), (2.0, 50.0), (3.0, 100.0)]
    assert [r.p for r in ranks.pool_percentiles(rows, F.lit(True), "g", "v", "p").where(F.isnan("v")).collect()] == [None]


def test_equal_starts_have_a_rule(spark):
    events = spark.createDataFrame([(1, 5.0)], "k int, t double")
    starts = spark.createDataFrame([(1, 3.0, 7), (1, 3.0, 9), (1, 3.0, 8)], "k int, start double, x int")
    assert [r.x for r in intervals.asof(events, starts, ["k"], "t", "start", ["x"]).collect()] == [9]


def test_ridge_against_numpy(spark):
    rnd = np.random.default_rng(1)
    x = rnd.random((60, 6)) < 0.5
    w, y = rnd.random(60) + 0.1, rnd.normal(size=60)
    long = spark.createDataFrame([(i, int(j), float(w[i]), float(y[i]), i % 3) for i in range(60) for j in np.flatnonzero(x[i])], "row int, col long, w double, y double, fold int")
    rows = spark.createDataFrame([(i, float(w[i]), float(y[i]), i % 3) for i in range(60)], "row int, w double, y double, fold int")
    beta = models.ridge(long, rows, "row", "col", "w", "y", 2.0)
    mean = (w * y).sum() / w.sum()
    want = np.linalg.solve((x * w[:, None]).T @ x + 2 * np.eye(6), x.T.astype(float) @ (w * (y - mean)))
    assert np.allclose([beta[j] for j in range(6)], want)
    scores = dict(models.ridge_cv(long, rows, "row", "col", "w", "y", "fold", [1.0, 5.0]))
    for alpha, got in scores.items():
        errors = []
        for f in range(3):
            own = np.arange(60) % 3 == f
            m = (w * y)[~own].sum() / w[~own].sum()
            b = np.linalg.solve((x * w[:, None])[~own].T @ x[~own] + alpha * np.eye(6), x[~own].T.astype(float) @ (w * (y - m))[~own])
            errors.append(np.sqrt((w[own] * (y[own] - m - x[own] @ b) ** 2).sum() / w[own].sum()))
        assert got == pytest.approx(np.mean(errors))


def test_ratings_are_rounded_by_halves(spark):
    beta = spark.createDataFrame([(7, 1.005), (-7, -2.345), (8, 0.1)], "col long, beta double")
    got = {r.player: (r.orapm, r.drapm, r.rapm) for r in rapm.ratings(beta).collect()}
    assert got[7] == (1.0, 2.34, 3.34)
    assert got[8] == (0.1, 0.0, 0.1)


def test_components_and_p_values(spark):
    rnd = np.random.default_rng(2)
    data = rnd.normal(size=(200, 3)) @ np.array([[1, 0.8, 0], [0, 1, 0], [0, 0, 1]])
    frame = spark.createDataFrame([tuple(map(float, r)) for r in data], "a double, b double, c double")
    got = [r.explained_variance for r in evaluate.components(frame, ["a", "b", "c"]).orderBy("component").collect()]
    want = np.sort(np.linalg.eigvalsh(np.corrcoef(data.T)))[::-1] / 3
    assert got == [round(float(v), 3) for v in want]
    assert evaluate.enough_components(evaluate.components(frame, ["a", "b", "c"])).first()["n"] == int((np.cumsum(want) >= 0.9).argmax()) + 1
    with pytest.raises(ValueError):
        evaluate.components(frame.limit(5), ["a", "b", "c"])
    # Student's t at its tabled 5 % points.
    for free, t in ((1, 12.7062), (10, 2.2281), (30, 2.0423)):
        assert evaluate.p_value(t / math.sqrt(free + t * t), free + 2) == pytest.approx(0.05, abs=1e-4)
    assert evaluate.p_value(1.0, 10) == 0.0 and math.isnan(evaluate.p_value(0.5, 2))


def test_gates(spark):
    docs = spark.createDataFrame([("s", i, '{"a":1}') for i in range(60)], "season string, player int, doc string")
    index = spark.createDataFrame([("s",)], "season string")
    alphas = spark.createDataFrame([(2.0,), (2.0,)], "alpha double")
    day = lambda x: F.lit(x).cast("date")
    verify.require(verify.gate(docs, "s", index, day("2024-05-01"), day("2024-05-03"), alphas, 2.0))
    faulty = docs.withColumn("doc", F.when(F.col("player") == 3, F.lit('{"a":NaN}')).otherwise(F.col("doc")))
    with pytest.raises(ValueError, match="NaN.*fresh.*penalty"):
        verify.require(verify.gate(faulty, "s", index, day("2024-05-01"), day("2024-05-09"), alphas.unionByName(alphas.withColumn("alpha", F.lit(3.0))), 2.0))
    with pytest.raises(ValueError, match="listed, enough"):
        verify.require(verify.gate(docs, "t", index, day("2024-05-01"), day("2024-05-03"), alphas, 2.0))


def test_one_season_or_an_error(spark):
    assert shots.one_season(spark.createDataFrame([(2004,), (2004,)], "season int"), "season").first()["season"] == 2004
    with pytest.raises(SparkRuntimeException, match="found 2"):
        shots.one_season(spark.createDataFrame([(2004,), (2005,)], "season int"), "season").collect()


def test_every_label_lies_in_its_zone(spark):
    assert shots.misplaced_labels(spark).count() == 0


def test_archetypes(spark):
    z = {f: 0.0 for f in archetypes.FEATURES}
    cases = [({"BLK": 2.1, "USG_PCT": 1.5}, "Dominant Two-Way Big"), ({"DREB_PCT": 1.0, "FG3A": -0.1}, "Interior Frontcourt"), ({"DREB_PCT": 1.0, "FG3A": 0.1}, "Frontcourt Contributor"),
             ({"USG_PCT": -0.5}, "Role Wing"), ({"USG_PCT": None}, "Multi-Role Contributor")]
    frame = spark.createDataFrame([tuple((z | c).values()) for c, _ in cases], ", ".join(f"{f} double" for f in z))
    assert [r.a for r in frame.select(archetypes.archetype().alias("a")).collect()] == [n for _, n in cases]


def test_feeds(spark, tmp_path):
    folder = str(tmp_path)
    path = feeds.path_of(spark, folder, "box_score", game_id="0010200001")
    assert path.startswith(f"{folder}/box_score_") and path.endswith(".csv")
    with pytest.raises(feeds.NotFetched):
        feeds.read(spark, folder, "box_score", game_id="0010200001")
    assert not issubclass(feeds.NotFetched, Exception)
    with pytest.raises(ValueError):
        feeds.path_of(spark, folder, "box_score", season="2004")
    with open(path, "w") as f:
        f.write("GAME_ID,PLAYER_ID,MIN,EXTRA\n0010200001,7,12:30,x\n0010200001,oops,,y\n")
    got = feeds.read(spark, folder, "box_score", game_id="0010200001")
    assert [(r.PLAYER_ID, r.MIN, r.PTS) for r in got.collect()] == [(7, "12:30", None), (None, None, None)] and "EXTRA" not in got.columns
    empty = feeds.path_of(spark, folder, "player_index", season="2004")
    with open(empty, "w") as f:
        f.write("PERSON_ID,NAME\n")
    assert feeds.read(spark, folder, "player_index", season="2004").count() == 0
    many = feeds.read_many(spark, folder, "box_score", [{"game_id": "0010200001"}])
    assert many.count() == 2


def test_feed_of_plays_in_order(spark):
    names = "GAME_ID string, EVENTNUM int, EVENTMSGTYPE int, EVENTMSGACTIONTYPE int, PERIOD int, PCTIMESTRING string, HOMEDESCRIPTION string"
    raw = spark.createDataFrame([("22", 3, 1, 0, 1, "9:00", "b"), ("22", 2, 2, 0, 1, "10:00", "a"), ("22", 2, 2, 0, 1, "10:00", "a"), ("22", 4, 1, 0, 2, "10:00", "c"), ("22", 5, 1, 0, 2, "x", "d")], names)
    got = feeds.plays(feeds.declared(raw, feeds.PLAYS)).orderBy("seq").collect()
    assert [(r.game, r.seq, r.t, r.description) for r in got] == [("0000000022", 1, 0.0, "a"), ("0000000022", 2, 60.0, "b"), ("0000000022", 3, 600.0, "c")]


def test_sides_are_voted(spark):
    rotation = spark.createDataFrame([("1", 5, "home"), ("1", 6, "home"), ("2", 5, "away")], "GAME_ID string, TEAM_ID long, HOME_AWAY string")
    voted = spark.createDataFrame([("1", 6, 5), ("2", None, None)], "game string, home long, away long")
    got = {(r.GAME_ID, r.TEAM_ID): r.HOME_AWAY for r in feeds.relabelled(rotation, voted).collect()}
    assert got == {("1", 5): "away", ("1", 6): "home", ("2", 5): "away"}
    both = feeds.sided_rotation(rotation.select("GAME_ID", "TEAM_ID").limit(1), rotation.select("GAME_ID", "TEAM_ID").limit(1))
    assert sorted(r.HOME_AWAY for r in both.collect()) == ["away", "home"]


def test_tables_and_documents_are_stored(spark, tmp_path):
    rows = spark.createDataFrame([("a", 2004, float("nan")), ("b", 2005, 1.5)], "name string, season int, v double")
    path = str(tmp_path / "t")
    documents.write_table(rows, path, ["season"])
    documents.write_table(rows.where("season = 2005").withColumn("v", F.lit(2.5)), path, ["season"])
    got = {(r.name, r.season): r.v for r in documents.all_seasons(spark, path, "name string, v double, season int", ["season"]).collect()}
    assert got == {("a", 2004): None, ("b", 2005): 2.5}
    player = spark.createDataFrame([(1, "A", 10.0, 12.0, "2004"), (2, "B", float("nan"), 3.0, "2004")], "player long, name string, pts_pg double, poss double, season string")
    doc = documents.player_stats(player, ["season"], {"season": F.col("season")}).first()["doc"]
    assert doc.index('"id":1') < doc.index('"id":2') and "NaN" not in doc and '"usg":null' in doc and '"n_players":2' in doc
    teams = spark.createDataFrame([("2004", "NYL", 5)], "season string, abbr string, id long")
    assert documents.team_maps(teams, ["season"], ["id", "abbr"]).first()["doc"] == '{"NYL":{"id":5,"abbr":"NYL"}}'
    index = documents.shot_index(teams, ["season"], ["abbr", "id"], {"scope": F.lit("reg")}).first()["doc"]
    assert index.startswith('{"teams":[{"abbr":"NYL","id":5}],"zone_names":["Restricted Area"')
    assert files.exists(spark, path)


def test_box_ratings_need_all_features(spark):
    with pytest.raises(ValueError, match="AST_100, TOV_100"):
        bpm.rated(spark.createDataFrame([(1, 2.0)], "player int, POSS double"))
