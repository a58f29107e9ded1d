"""Stints of a small game, by hand."""

from rallyframe.operators import stints

H, A = 1, 2
FIVE = [1, 2, 3, 4, 5]


def test_small_game(spark):
    spans = [("g", 0.0, 100.0, H, A, FIVE, FIVE), ("g", 100.0, 150.0, H, A, FIVE[:4], FIVE), ("g", 150.0, 200.0, H, A, FIVE, FIVE), ("g", 200.0, 300.0, H, A, FIVE, FIVE)]
    log = [
        (1, 10.0, 2, H, 7, "MISS 3PT", None),
        (2, 11.0, 4, H, 7, "REBOUND (Off:1 Def:0)", None),
        (3, 20.0, 1, H, 7, "3PT Jump (3 PTS)", "3 - 0"),
        (4, 30.0, 2, A, 9, "MISS layup", None),
        (5, 31.0, 4, A, 0, "team rebound", None),
        (6, 100.0, 5, A, 9, "turnover", None),
        (7, 120.0, 1, A, 9, "Layup (2 PTS)", "3 - 2"),
        (8, 160.0, 3, H, 8, "Free Throw 1 of 2 (1 PTS)", "4 - 2"),
        (9, 160.0, 3, H, 8, "MISS Free Throw 2 of 2", None),
        (10, 161.0, 4, H, 7, "REBOUND (Off:1 Def:3)", None),
        (11, 300.0, 1, A, 9, "Layup", "4 - 4"),
        (12, 301.0, 1, A, 9, "Layup", None),
        (13, 50.0, 6, A, 9, "foul", None),
    ]
    events = spark.createDataFrame([("g", *r) for r in log], "game string, seq int, t double, code int, team int, player long, description string, score string")
    got = stints.stints(events, spark.createDataFrame(spans, "game string, t_start double, t_end double, home int, away int, home_lineup array<int>, away_lineup array<int>"))
    rows = {r.t_start: (r.home_pts, r.away_pts, round(r.home_poss, 2), round(r.away_poss, 2), r.score_margin) for r in got.collect()}
    # The layup at 120 s falls into the span without five, so it counts for the one before.
    assert rows == {
        0.0: (3.0, 2.0, 1.0, 2.0, 0.0),
        150.0: (1.0, 0.0, 0.88, 0.0, 1.0),
        200.0: (0.0, 2.0, 0.0, 1.0, 2.0),
    }
    audit = stints.points_audit(got, events.select("game", "seq", "score")).first()
    assert (audit.stint_points, audit.log_points, audit["diff"]) == (8.0, 8, 0.0)
