"""Whole seasons from stored answers to stints: simulated games whose lineups and points are known, and odd games."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from rallyframe.operators import season
from rallyframe.sources import feeds, seasons
from rallyframe.sources.feeds import NotFetched

HOME, AWAY = 1_611_000_001, 1_611_000_002
COLUMNS = [c.split()[0] for c in feeds.PLAYS.split(", ")]
SCHEDULE = ["GAME_ID", "GAME_DATE", "MATCHUP"]


class Log:
    """Rows of a play feed."""

    def __init__(self, game):
        self.game, self.rows = game, []

    def add(self, period, t, code, home="", away="", slots=(), action=0, score="", neutral="", number=None):
        left = int(period * 600 - t)
        row = dict.fromkeys(COLUMNS, "")
        row |= {"GAME_ID": self.game, "EVENTNUM": number or len(self.rows) + 1, "EVENTMSGTYPE": code, "EVENTMSGACTIONTYPE": action, "PERIOD": period}
        row |= {"PCTIMESTRING": f"{left // 60}:{left % 60:02d}", "HOMEDESCRIPTION": home, "VISITORDESCRIPTION": away, "NEUTRALDESCRIPTION": neutral, "SCORE": score}
        for n, (kind, player, team) in enumerate(slots, 1):
            row |= {f"PERSON{n}TYPE": kind, f"PLAYER{n}_ID": player, f"PLAYER{n}_TEAM_ID": team, f"PLAYER{n}_NAME": f" P{player} " if kind in (4, 5) else ""}
        self.rows.append(row)


def simulated(game, seed):
    """A log, its spans {(t_start, t_end): (home five, away five)} and points {t_start: (home, away)}."""
    rnd, log, spans, points = random.Random(seed), Log(game), {}, {}
    squad = {HOME: range(100, 110), AWAY: range(200, 210)}
    kind = {HOME: 4, AWAY: 5}
    text = lambda team, words: {"home": words} if team == HOME else {"away": words}
    for period in range(1, 5):
        start = (period - 1) * 600
        five = {t: set(rnd.sample(squad[t], 5)) for t in squad}
        log.add(period, start, 12, neutral="Start", slots=[(0, 0, "")])
        log.add(period, start, 10, home="Jump Ball", slots=[(kind[t], min(five[t]), t) for t in squad] + [(kind[HOME], max(five[HOME]), HOME)])
        stops, last = sorted(rnd.sample(range(20, 590, 10), 4)), start
        for stop in [*stops, 600]:
            scored = {HOME: 0, AWAY: 0}
            for team in squad:
                for player in sorted(five[team]):
                    log.add(period, last + 1, 5, **text(team, "Lost Ball Turnover"), slots=[(kind[team], player, team)])
                shooter = rnd.choice(sorted(five[team]))
                for _ in range(rnd.randint(0, 3)):
                    three = rnd.random() < 0.4
                    scored[team] += 3 if three else 2
                    log.add(period, last + 2, 1, **text(team, f"{'3PT ' if three else ''}Jump Shot (2 PTS)"), slots=[(kind[team], shooter, team)], score="1 - 1")
                # The bench draws a technical, and a team has a rebound: nobody's evidence of being on.
                bench = next(p for p in squad[team] if p not in five[team])
                log.add(period, last + 2, 6, **text(team, "T.Foul"), slots=[(kind[team], bench, team)], action=11)
                log.add(period, last + 2, 4, **text(team, "Team Rebound"), slots=[(3 if team == AWAY else 2, team, "")])
            spans[float(last), float(start + stop)] = (sorted(five[HOME]), sorted(five[AWAY]))
            points[float(last)] = (float(scored[HOME]), float(scored[AWAY]))
            last = start + stop
            if stop < 600:
                team = rnd.choice([HOME, AWAY])
                # Numbers of substitutions are out of order, as they are in the feed.
                for n in range(rnd.randint(1, 2)):
                    out, new = rnd.choice(sorted(five[team])), rnd.choice([p for p in squad[team] if p not in five[team]])
                    log.add(period, last, 8, **text(team, "SUB"), slots=[(kind[team], out, team), (kind[team], new, team)], number=5000 + len(log.rows) + n)
                    five[team] = five[team] - {out} | {new}
        log.add(period, start + 600, 13, neutral="End", slots=[(0, 0, "")])
    log.rows.append(dict(log.rows[4]))  # a row that the feed has twice
    return log.rows, spans, points


def store(spark, folder, feed, rows, columns, **parameters):
    with open(feeds.path_of(spark, str(folder), feed, **parameters), "w", newline="") as f:
        writer = csv.DictWriter(f, columns)
        writer.writeheader()
        writer.writerows(rows)


def stored(spark, folder, games):
    """Games {id: rows} as one season, and a season type without games."""
    for game, rows in games.items():
        store(spark, folder, "pbp", rows, COLUMNS, game_id=game)
    listed = [{"GAME_ID": g, "GAME_DATE": "2010-06-01", "MATCHUP": "A @ B"} for g in games]
    store(spark, folder, "game_ids", listed, SCHEDULE, season="2010", season_type="Regular Season")
    store(spark, folder, "game_ids", [], SCHEDULE, season="2010", season_type="Playoffs")


def test_stored_answers_become_stints(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    games = {f"102100000{n}": simulated(f"102100000{n}", n) for n in range(1, 4)}
    odd = Log("1021000009")
    odd.add(1, 0, 1, home="Layup", slots=[(4, 100, HOME)])
    few = Log("1021000008")
    for team, side in ((HOME, "home"), (AWAY, "away")):
        few.add(1, 5, 8, **{side: "SUB"}, slots=[(4, 100 + team % 10, team), (4, 110 + team % 10, team)])
    stored(spark, raw, {g: rows for g, (rows, _, _) in games.items()} | {"1021000009": odd.rows, "1021000008": few.rows})
    counts = {(r.season, r.season_type): r.asDict() for r in seasons.build(spark, str(raw), out, ["2010"]).collect()}
    assert counts["2010", "Regular Season"]["games"] == 5 and counts["2010", "Regular Season"]["games_with_stints"] == 3
    got = seasons.stints(spark, out)
    found = {}
    for r in got.collect():
        assert (r.season, r.season_type, r.home, r.away) == ("2010", "Regular Season", HOME, AWAY)
        found.setdefault(r.game, {})[r.t_start, r.t_end] = (list(r.home_lineup), list(r.away_lineup), r.home_pts, r.away_pts)
    for game, (_, spans, points) in games.items():
        assert found[game] == {k: (*five, *points[k[0]]) for k, five in spans.items()}
    left = {r.game: r.reason for r in spark.read.parquet(f"{out}/quarantined").collect()}
    assert left == {"1021000009": "sides unknown", "1021000008": "no span with five on both sides"}
    names = {r.player: r.name for r in spark.read.parquet(f"{out}/names").collect()}
    assert names[100] == "P100"
    said = spark.read.parquet(f"{out}/warnings").where("game = '1021000008'").collect()
    assert {r.warning for r in said} == {"only 1 players at the start"}


def test_a_game_not_stored_is_no_empty_game(spark, tmp_path):
    stored(spark, tmp_path, {"1021000001": simulated("1021000001", 1)[0]})
    listed = [{"GAME_ID": g, "GAME_DATE": "2010-06-01", "MATCHUP": "A @ B"} for g in ("1021000001", "1021000007")]
    store(spark, tmp_path, "game_ids", listed, SCHEDULE, season="2010", season_type="Regular Season")
    with pytest.raises(NotFetched):
        seasons.build(spark, str(tmp_path), str(tmp_path / "out"), ["2010"])
    seasons.build(spark, str(tmp_path), str(tmp_path / "out"), ["2010"], stored_only=True)
    assert {r.reason for r in spark.read.parquet(f"{tmp_path}/out/quarantined").collect()} == {"not fetched"}
    with pytest.raises(NotFetched):
        seasons.build(spark, str(tmp_path), str(tmp_path / "out"), ["2011"], stored_only=True)


def test_absent_players_are_said(spark):
    rows = [("g", 1, 1, 5.0, 0.0, 600.0, 8, 0, "", "SUB", s, p, 4, t, p + 50, 4, t, None, None, None) for s, p, t in (("home", 1, 10), ("away", 2, 20))]
    rows += [("g", 2, 1, 9.0, 0.0, 600.0, 8, 0, "", "SUB", "home", 7, 4, 10, 1, 4, 10, None, None, None), ("g", 3, 1, 9.0, 0.0, 600.0, 8, 0, "", "SUB", "home", 7, 4, 10, 8, 4, 10, None, None, None)]
    kinds = "game string, seq int, period int, t double, begins double, ends double, code int, action int, score string, description string, side string, " + ", ".join(f"p{n} long, k{n} int, t{n} long" for n in (1, 2, 3))
    plays = spark.createDataFrame(rows, kinds).selectExpr("*", "'a' AS n1", "'b' AS n2", "'c' AS n3")
    made = season.built(plays)
    said = {r.warning for r in made.warnings.collect()}
    assert "7 taken out at 9.0 without being on the floor" in said
    assert made.stints.count() == 0


def test_ties_of_a_player_go_to_the_first_slot(spark):
    kinds = "game string, seq int, " + ", ".join(f"p{n} long, t{n} long" for n in (1, 2, 3))
    plays = spark.createDataFrame([("g", 1, 3, 20, 7, 20, None, None), ("g", 2, 7, 10, 5, None, 3, 20)], kinds)
    got = {r.player: r.team for r in season.player_teams(plays).collect()}
    assert got == {3: 20, 7: 10}


def test_mentions_are_stored_and_not_joined_by_player(spark):
    """Mentions of a game's players are read as they were written: no shuffle of every mention by player follows."""
    kinds = "game string, seq int, period int, t double, begins double, ends double, code int, action int, score string, description string, side string"
    kinds += "".join(f", p{n} long, k{n} int, t{n} long, n{n} string" for n in (1, 2, 3))
    slots = lambda *ps: [v for p, team in ps for v in (p, 4, team, f"P{p}")]
    rows = [("1", 1, 1, 5.0, 0.0, 600.0, 8, 0, None, "SUB", "home", *slots((101, 1), (102, 1), (0, 0))),
            ("1", 2, 1, 6.0, 0.0, 600.0, 8, 0, None, "SUB", "away", *slots((201, 2), (202, 2), (0, 0))),
            ("1", 3, 1, 7.0, 0.0, 600.0, 1, 0, None, "Shot", "home", *slots((103, 1), (0, 0), (0, 0)))]
    plays = spark.createDataFrame(rows, kinds)
    on, moves = season.mentions(plays, season.player_teams(plays), season.team_sides(plays))
    assert {(r.team, r.seq, r.role, r.player) for r in on.collect()} == {(1, 1, "out", 101), (1, 1, "in", 102), (2, 2, "out", 201), (2, 2, "in", 202), (1, 3, "on", 103)}
    assert {(r.team, r.role, r.player) for r in moves.collect()} == {(1, "out", 101), (1, "in", 102), (2, "out", 201), (2, "in", 202)}
    for found in (on, moves):
        assert "Exchange" not in found._jdf.queryExecution().toString()


def test_games_are_partitioned_once(spark, monkeypatch):
    """Plays and lineups lie in buckets of whole games: their scans don't grow with the table, and groups by game shuffle nothing."""
    from rallyframe.sources import stored

    monkeypatch.setattr(stored, "TASK_ROWS", 100)
    kinds = "game string, seq int, period int, t double, begins double, ends double, code int, action int, score string, description string, side string"
    kinds += "".join(f", p{n} long, k{n} int, t{n} long, n{n} string" for n in (1, 2, 3))
    slots = lambda *ps: [v for p, team in ps for v in (p, 4, team, f"P{p}")]
    rows = [(f"g{g}", 2 * i + s, 1, 10.0 * i, 0.0, 600.0, 8, 0, None, "SUB", ("home", "away")[s], *slots((100 * s + 101 + i, s + 1), (100 * s + 106 + i, s + 1), (0, 0))) for g in range(100) for i in range(4) for s in (0, 1)]
    made = season.built(spark.createDataFrame(rows, kinds))
    groups = made.spans.groupBy("game", "period").agg(F.max(F.struct("t_end")).alias("last"))
    plan = groups._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SelectedBucketsCount: 8 out of 8" in plan
    assert groups.count() == 100
    assert {r.player for r in made.names.where("name = 'P101'").collect()} == {101}
