"""Queries over whole games: logs, box scores, stints, rates, ratings and their checks, with DuckDB SQL.

Stand-in: a supplier's line items are the plays of a game, in order of line number, order and part.
Two teams of twelve players each play it; stints of fifty plays have lineups that change by one
player each. Everything is derived from the table's own columns, over the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rallyframe.functions import scalar
from rallyframe.operators import box, bpm, evaluate, models, rapm, rates, rotation, stints, verify
from rallyframe.plans.catalog import _query, _t
from rallyframe.sources.stored import by_key, written

# ---------------------------------------------------------------- stand-ins

_PLAYS = """base AS (SELECT l_suppkey AS game, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_linenumber, l_orderkey, l_partkey) AS INTEGER) AS seq,
 l_linenumber AS period, CAST(l_quantity AS INTEGER) % 9 AS q, l_partkey AS pk, l_orderkey AS ok, l_discount AS disc, l_quantity AS qty, 1 + l_orderkey % 2 AS team FROM lineitem),
 plays AS (SELECT game, seq, period, CAST(seq * 10 AS DOUBLE) AS t, CASE q WHEN 0 THEN 12 WHEN 7 THEN 8 WHEN 8 THEN 4 ELSE q END AS code, CAST(pk % 14 AS INTEGER) AS action,
 CASE WHEN pk % 13 = 0 THEN team ELSE team*100 + pk % 12 END AS p1, CASE WHEN pk % 13 = 0 THEN 2 ELSE 4 END AS k1, team AS t1,
 (CASE WHEN q = 5 THEN 3 - team ELSE team END)*100 + (pk // 12) % 12 AS p2, CASE WHEN pk % 3 = 0 THEN 0 ELSE 5 END AS k2, CASE WHEN q = 5 THEN 3 - team ELSE team END AS t2,
 (3 - team)*100 + (pk // 144) % 12 AS p3, CASE WHEN pk % 4 = 0 THEN 4 ELSE 0 END AS k3, 3 - team AS t3,
 CASE WHEN q = 1 THEN CASE WHEN disc > 0.05 THEN '3PT ' ELSE '' END || 'Jump Shot' WHEN q = 2 THEN 'MISS ' || CASE WHEN disc > 0.05 THEN '3PT ' ELSE '' END || 'Jump Shot'
  WHEN q = 3 THEN CASE WHEN pk % 5 < 2 THEN 'MISS ' ELSE '' END || 'Free Throw ' || (1 + ok % 2) || ' of 2'
  WHEN q IN (4, 8) THEN 'REBOUND' || CASE WHEN pk % 2 = 0 THEN ' (Off:' || (seq // 37) || ' Def:' || (seq // 53) || ')' ELSE '' END ELSE 'Play' END AS description FROM base)"""


def _plays(spark: SparkSession, d: str) -> DataFrame:
    li = by_key(_t(spark, d, "lineitem").select("l_suppkey", "l_linenumber", "l_orderkey", "l_partkey", "l_quantity", "l_discount"), "l_suppkey")
    seq = F.row_number().over(Window.partitionBy("l_suppkey").orderBy("l_linenumber", "l_orderkey", "l_partkey"))
    pk, ok, q, team = F.col("l_partkey"), F.col("l_orderkey"), F.col("q"), F.col("team")
    rows = li.select(
        F.col("l_suppkey").alias("game"), seq.alias("seq"), F.col("l_linenumber").alias("period"), (F.col("l_quantity").cast("int") % 9).alias("q"),
        "l_partkey", "l_orderkey", "l_discount", (1 + ok % 2).alias("team"),
    )
    whole = lambda c: F.floor(c).cast("long")
    other, three = 3 - team, F.when(F.col("l_discount") > 0.05, "3PT ").otherwise("")
    second = F.when(q == 5, other).otherwise(team)
    counters = F.concat(F.lit(" (Off:"), whole(F.col("seq") / 37).cast("string"), F.lit(" Def:"), whole(F.col("seq") / 53).cast("string"), F.lit(")"))
    text = (
        F.when(q == 1, F.concat(three, F.lit("Jump Shot")))
        .when(q == 2, F.concat(F.lit("MISS "), three, F.lit("Jump Shot")))
        .when(q == 3, F.concat(F.when(pk % 5 < 2, "MISS ").otherwise(""), F.lit("Free Throw "), (1 + ok % 2).cast("string"), F.lit(" of 2")))
        .when(q.isin(4, 8), F.concat(F.lit("REBOUND"), F.when(pk % 2 == 0, counters).otherwise("")))
        .otherwise("Play")
    )
    whole_team = pk % 13 == 0
    return rows.select(
        "game", "seq", "period", (F.col("seq") * 10).cast("double").alias("t"), F.when(q == 0, 12).when(q == 7, 8).when(q == 8, 4).otherwise(q).alias("code"),
        (pk % 14).cast("int").alias("action"), F.when(whole_team, team).otherwise(team * 100 + pk % 12).alias("p1"), F.when(whole_team, 2).otherwise(4).alias("k1"), team.alias("t1"),
        (second * 100 + whole(pk / 12) % 12).alias("p2"), F.when(pk % 3 == 0, 0).otherwise(5).alias("k2"), second.alias("t2"),
        (other * 100 + whole(pk / 144) % 12).alias("p3"), F.when(pk % 4 == 0, 4).otherwise(0).alias("k3"), other.alias("t3"), text.alias("description"),
    )


_SPANS = """spans AS (SELECT game, b, b*500.0::DOUBLE AS t_start, (b+1)*500.0::DOUBLE AS t_end, list_sort(list_transform([0,2,4,6,8], lambda i: 100 + (b+i) % 12)) AS home_lineup,
 list_sort(list_transform([0,2,4,6,8], lambda i: 200 + (b*5+i) % 12)) AS away_lineup FROM (SELECT DISTINCT game, CAST(floor(t/500) AS BIGINT) AS b FROM plays)),
 sided AS (SELECT game, t_start, t_end, 1 AS team, home_lineup AS lineup FROM spans UNION ALL SELECT game, t_start, t_end, 2, away_lineup FROM spans)"""


def _spans(plays: DataFrame) -> DataFrame:
    """game, t_start, t_end, home, away and lineups, five a side."""
    b = plays.select("game", F.floor(F.col("t") / 500).cast("long").alias("b")).distinct()
    five = lambda base, by: F.array_sort(F.transform(F.array(*map(F.lit, (0, 2, 4, 6, 8))), lambda i: F.lit(base).cast("long") + (F.col("b") * by + i) % 12))
    return b.select(
        "game", "b", (F.col("b") * 500.0).alias("t_start"), ((F.col("b") + 1) * 500.0).alias("t_end"), F.lit(1).cast("long").alias("home"), F.lit(2).cast("long").alias("away"),
        five(100, 1).alias("home_lineup"), five(200, 5).alias("away_lineup"),
    )


# A play's box entries, by rules written out anew: counters, pending misses, entries.
_BOX = f"""{_PLAYS}, c0 AS (SELECT game, seq, p1, CAST(nullif(regexp_extract(description, 'Off:([0-9]+)', 1), '') AS INTEGER) AS o, CAST(nullif(regexp_extract(description, 'Def:([0-9]+)', 1), '') AS INTEGER) AS f
  FROM plays WHERE code = 4 AND k1 = 4 AND description LIKE '%(Off:%'),
 c1 AS (SELECT *, coalesce(max(o) OVER w, 0) AS so, coalesce(max(f) OVER w, 0) AS sf FROM c0 WINDOW w AS (PARTITION BY game, p1 ORDER BY o, f, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 counted AS (SELECT game, seq, CASE WHEN o > so THEN 'off' WHEN f > sf THEN 'def' END AS counted FROM c1),
 m0 AS (SELECT *, CASE WHEN code = 2 OR (code = 3 AND description LIKE 'MISS%' AND description LIKE '%2 of 2') THEN CASE WHEN k1 = 4 THEN t1 ELSE 0 END WHEN code IN (1, 3, 4, 5, 12, 13) THEN 0 END AS st FROM plays),
 m1 AS (SELECT *, nullif(last_value(st IGNORE NULLS) OVER (PARTITION BY game ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS missed FROM m0),
 m2 AS (SELECT m1.*, CASE WHEN m1.code = 4 THEN coalesce(CASE WHEN k1 = 4 THEN counted END, CASE WHEN missed IS NOT NULL THEN CASE WHEN t1 = missed THEN 'off' ELSE 'def' END END) END AS kind FROM m1 LEFT JOIN counted USING (game, seq)),
 ev AS (SELECT game, seq, t, p1 AS player, t1 AS team, (code=1)::INT AS fgm, (code IN (1,2))::INT AS fga, (code=1 AND description LIKE '%3PT%')::INT AS fg3m, (code IN (1,2) AND description LIKE '%3PT%')::INT AS fg3a,
   (code=3 AND description NOT LIKE 'MISS%')::INT AS ftm, (code=3)::INT AS fta, coalesce(kind='off', false)::INT AS oreb, coalesce(kind='def', false)::INT AS dreb, 0 AS ast, 0 AS stl, 0 AS blk, (code=5)::INT AS tov, (code=6)::INT AS pf,
   CASE WHEN code=1 THEN CASE WHEN description LIKE '%3PT%' THEN 3 ELSE 2 END WHEN code=3 AND description NOT LIKE 'MISS%' THEN 1 ELSE 0 END AS pts
   FROM m2 WHERE k1 = 4 AND p1 > 0 AND code BETWEEN 1 AND 6 AND NOT (code = 6 AND action IN (11, 12, 13, 16, 17, 18, 19, 25)) AND NOT (code = 4 AND kind IS NULL)
  UNION ALL SELECT game, seq, t, 0, p1, 0,0,0,0,0,0, (kind='off')::INT, (kind='def')::INT, 0,0,0,0,0,0 FROM m2 WHERE k1 = 2 AND code = 4 AND kind IS NOT NULL
  UNION ALL SELECT game, seq, t, p2, t2, 0,0,0,0,0,0,0,0, (code=1)::INT, (code=5)::INT, 0,0,0,0 FROM m2 WHERE code IN (1, 5) AND k2 = 5
  UNION ALL SELECT game, seq, t, p3, t3, 0,0,0,0,0,0,0,0, 0, 0, 1,0,0,0 FROM m2 WHERE code = 2 AND k3 = 4)"""
_STATS = ", ".join(f"CAST(sum({s}) AS BIGINT) AS {s}" for s in box.STATS)


def _events(spark, d):
    return box.box_events(_plays(spark, d))


# ---------------------------------------------------------------- box scores


@_query(f"WITH {_BOX} SELECT game, seq, player, team, {', '.join(box.STATS)} FROM ev")
def box_events(spark, d):
    """One play, up to two entries."""
    return _events(spark, d).drop("t")


@_query(f"WITH {_BOX} SELECT game, player, team, {_STATS}, CAST(sum(oreb) + sum(dreb) AS BIGINT) AS reb FROM ev WHERE player > 0 GROUP BY 1, 2, 3")
def game_box(spark, d):
    return box.game_box(_events(spark, d))


@_query(f"WITH {_BOX} SELECT player, {_STATS}, CAST(sum(oreb) + sum(dreb) AS BIGINT) AS reb FROM ev WHERE player > 0 GROUP BY 1")
def season_box(spark, d):
    return box.season_box(_events(spark, d))


@_query(f"WITH {_BOX} SELECT game, seq, missed FROM m1")
def pending_miss_team(spark, d):
    return box.with_missing_team(_plays(spark, d)).select("game", "seq", "missed")


@_query(f"""WITH {_PLAYS} SELECT game, seq, CASE WHEN code = 6 AND action IN (11, 16, 17, 18, 19, 25, 30) THEN true ELSE false END AS technical,
 CAST(description NOT LIKE 'MISS%' AS INTEGER) AS made, CASE WHEN description LIKE '%1 of 2' THEN false ELSE true END AS last_of_trip, CASE WHEN description LIKE '%3PT%' THEN 3 ELSE 2 END AS worth,
 CASE WHEN k1 = 2 THEN p1 ELSE t1 END AS team FROM plays""")
def play_rules(spark, d):
    """Row rules of a play: technical fouls, free throws, last of a trip, worth, team."""
    text, code = F.col("description"), F.col("code")
    floor_id = F.when(F.col("k1") == 2, F.lit(None).cast("long")).otherwise(F.col("t1"))
    as_team = F.when(F.col("k1") == 2, F.col("p1") + scalar.TEAM_ID_FLOOR)
    team = scalar.event_team(floor_id, as_team)
    return _plays(spark, d).select(
        "game", "seq", ((code == 6) & scalar.is_technical(F.col("action"), F.lit(None).cast("string"))).alias("technical"), scalar.free_throw_made_by_text(text).alias("made"),
        scalar.is_last_of_trip(text).alias("last_of_trip"), scalar.shot_points(text).alias("worth"), F.when(team >= scalar.TEAM_ID_FLOOR, team - scalar.TEAM_ID_FLOOR).otherwise(team).alias("team"),
    )


# ---------------------------------------------------------------- rotation and stints

_MENTIONS = f"""{_PLAYS}, mentions AS (SELECT game, period, team, seq, slot, t, role, player FROM (
  SELECT game, period, t1 AS team, seq, 1 AS slot, t, CASE WHEN code = 8 THEN 'out' ELSE 'on' END AS role, p1 AS player FROM plays WHERE k1 = 4 AND code IN (1, 2, 3, 4, 5, 6, 8)
  UNION ALL SELECT game, period, t1, seq, 2, t, 'in', t1*100 + (p1 + 5) % 12 FROM plays WHERE k1 = 4 AND code = 8))"""


def _mentions(spark, d):
    p = _plays(spark, d).where("k1 = 4 and code in (1, 2, 3, 4, 5, 6, 8)")
    sub = F.col("code") == 8
    first = F.struct(F.lit(1).alias("slot"), F.when(sub, "out").otherwise("on").alias("role"), F.col("p1").alias("player"))
    entering = F.when(sub, F.struct(F.lit(2).alias("slot"), F.lit("in").alias("role"), (F.col("t1") * 100 + (F.col("p1") + 5) % 12).alias("player")))
    return p.select("game", "period", F.col("t1").alias("team"), "seq", "t", F.inline(F.filter(F.array(first, entering), lambda m: m.isNotNull())))


@_query(f"""WITH {_MENTIONS}, e AS (SELECT game, period, team, player, min(CASE WHEN role <> 'in' THEN seq END) AS seen, min(CASE WHEN role = 'in' THEN seq END) AS brought FROM mentions GROUP BY 1, 2, 3, 4)
 SELECT game, period, team, player, row_number() OVER (PARTITION BY game, period, team ORDER BY seen, player) AS nth FROM e WHERE seen IS NOT NULL AND (brought IS NULL OR seen < brought)""")
def starter_detection(spark, d):
    return rotation.starters(_mentions(spark, d))


@_query(f"""WITH {_MENTIONS}, w AS (SELECT DISTINCT game, period, t AS t_start FROM mentions WHERE role = 'out' UNION SELECT game, period, min(t) FROM plays GROUP BY 1, 2),
 e AS (SELECT game, period, max(t) + 10 AS ends FROM plays GROUP BY 1, 2)
 SELECT w.game, w.period, w.t_start, coalesce(lead(w.t_start) OVER (PARTITION BY w.game, w.period ORDER BY w.t_start), ends) AS t_end, CAST(2 AS BIGINT) AS teams
 FROM w JOIN e ON e.game = w.game AND e.period = w.period""")
def lineup_intervals(spark, d):
    """Substitution waves as intervals that tile each period, with a lineup for either team."""
    p = _plays(spark, d)
    periods = p.groupBy("game", "period").agg(F.min("t").alias("begins"), (F.max("t") + 10).alias("ends"))
    found = rotation.reconstructed(_mentions(spark, d), periods)
    return found.groupBy("game", "period", "t_start", "t_end").agg(F.count_distinct("team").alias("teams"))


@_query()
def lineup_openings(spark, d):
    """Opening lineups of every period, by search and both passes (P2, P3, P4); tests hold them against known games."""
    found = rotation.openings(_mentions(spark, d))
    return found.select("game", "team", "period", F.array_join("lineup", ",").alias("lineup"), "certain")


def _log(spark, d):
    return _log_of(_plays(spark, d))


def _log_of(plays: DataFrame) -> DataFrame:
    """Plays as stints read them, with a running score on every scoring row."""
    return plays.select("game", "seq", "t", "code", F.col("t1").alias("team"), F.col("p1").alias("player"), "description", _score().alias("score"))


def _score() -> Column:
    text, code = F.col("description"), F.col("code")
    points = F.when(code == 1, scalar.shot_points(text)).when((code == 3) & (scalar.free_throw_made_by_text(text) == 1), 1).otherwise(0)
    by = Window.partitionBy("game").orderBy("seq")
    side = lambda team: F.sum(F.when(F.col("t1") == team, points).otherwise(0)).over(by)
    return F.when(points > 0, F.concat_ws("-", side(1).cast("string"), side(2).cast("string")))


_STINTS = f"""{_PLAYS}, r0 AS (SELECT *, CASE WHEN code = 1 THEN CASE WHEN description LIKE '%3PT%' THEN 3 ELSE 2 END WHEN code = 3 AND description NOT LIKE 'MISS%' THEN 1 ELSE 0 END AS pts,
   CASE WHEN code = 4 AND description LIKE '%(Off:%' THEN CAST(regexp_extract(description, 'Off:([0-9]+)', 1) AS INTEGER) END AS n,
   CASE WHEN code = 2 OR (code = 3 AND description LIKE 'MISS%') THEN t1 ELSE 0 END AS st FROM plays WHERE code BETWEEN 1 AND 5),
 r1 AS (SELECT *, coalesce(max(n) OVER (PARTITION BY game, p1 ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen,
   nullif(last_value(st) OVER (PARTITION BY game ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS missed FROM r0),
 r2 AS (SELECT game, CAST(floor(t/500) AS BIGINT) AS b, t1 AS team, pts, (code IN (1,2))::INT AS fga, (code = 5)::INT AS tov, (code = 3)::INT AS fta,
   (code = 4 AND CASE WHEN n IS NOT NULL THEN n > seen ELSE coalesce(missed = t1, false) END)::INT AS oreb FROM r1),
 r3 AS (SELECT game, b, team, sum(pts) AS pts, sum(fga) AS fga, sum(tov) AS tov, sum(fta) AS fta, sum(oreb) AS oreb FROM r2 GROUP BY 1, 2, 3),
 side AS (SELECT *, greatest(fga - oreb + tov + 0.44*fta, 0) AS poss FROM r3),
 blocks AS (SELECT DISTINCT game, CAST(floor(t/500) AS BIGINT) AS b FROM plays),
 both_sides AS (SELECT k.game, k.b, coalesce(h.pts, 0) AS home_pts, coalesce(a.pts, 0) AS away_pts, coalesce(h.poss, 0) AS home_poss, coalesce(a.poss, 0) AS away_poss,
   coalesce(h.pts+h.fga+h.oreb+h.tov+h.fta, 0) + coalesce(a.pts+a.fga+a.oreb+a.tov+a.fta, 0) AS activity FROM blocks k LEFT JOIN side h ON h.game = k.game AND h.b = k.b AND h.team = 1 LEFT JOIN side a ON a.game = k.game AND a.b = k.b AND a.team = 2),
 built AS (SELECT game, b, b*500.0::DOUBLE AS t_start, (b+1)*500.0::DOUBLE AS t_end, CAST(home_pts AS DOUBLE) AS home_pts, CAST(away_pts AS DOUBLE) AS away_pts, CAST(home_poss AS DOUBLE) AS home_poss, CAST(away_poss AS DOUBLE) AS away_poss, activity,
   CAST(coalesce(sum(home_pts - away_pts) OVER (PARTITION BY game ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS score_margin FROM both_sides)"""


def _built(spark, d):
    plays = by_key(written(_plays(spark, d), "plays"), "game")
    return stints.stints(_log_of(plays), _spans(plays))


@_query(f"WITH {_STINTS} SELECT game, t_start, t_end, home_pts, away_pts, round(home_poss, 6) AS home_poss, round(away_poss, 6) AS away_poss, score_margin FROM built WHERE activity > 0")
def stint_build(spark, d):
    """Points and possessions of both sides by stint."""
    six = lambda c: F.round(c, 6).alias(c)
    return _built(spark, d).select("game", "t_start", "t_end", "home_pts", "away_pts", six("home_poss"), six("away_poss"), "score_margin")


@_query(f"""WITH {_STINTS}, log AS (SELECT game, sum(pts) AS total FROM r0 GROUP BY 1), f AS (SELECT game, arg_min(pts, seq) AS first FROM r0 WHERE pts > 0 GROUP BY 1)
 SELECT b.game, sum(home_pts + away_pts) AS stint_points, CAST(max(total) AS INTEGER) AS log_points, CAST(sum(home_pts + away_pts) - max(total) AS DOUBLE) AS diff FROM built b JOIN log USING (game) JOIN f USING (game) WHERE first <= 3 GROUP BY 1""")
def points_audit(spark, d):
    """Stints against the last score of the log."""
    found = stints.points_audit(_built(spark, d), _log(spark, d).where("score is not null"))
    return found.select("game", "stint_points", "log_points", "diff")


@_query(f"""WITH {_PLAYS}, {_SPANS}, bad AS (SELECT game, t_start, t_end - CASE WHEN b % 11 = 5 THEN 10 ELSE 0 END AS t_end, CASE WHEN b % 7 = 3 THEN 4 ELSE 5 END AS home, CASE WHEN b % 5 = 4 THEN 6 ELSE 5 END AS away FROM spans),
 g AS (SELECT *, coalesce(lead(t_start) OVER (PARTITION BY game ORDER BY t_start) <> t_end, false) AS gap FROM bad)
 SELECT game, round(sum((t_end - t_start) * (home + away)) / sum(t_end - t_start), 6) AS on_floor, count(*) FILTER (gap) AS n_gaps, count(*) FILTER (home <> 5 OR away <> 5) AS odd_sizes FROM g GROUP BY 1""")
def structure_audit(spark, d):
    """Players on the floor, gaps and odd sizes of spans in which some lack a player, have one too many or end early."""
    b = F.col("b")
    faults = {
        "t_end": F.col("t_end") - F.when(b % 11 == 5, 10).otherwise(0),
        "home_lineup": F.when(b % 7 == 3, F.slice("home_lineup", 2, 4)).otherwise(F.col("home_lineup")),
        "away_lineup": F.when(b % 5 == 4, F.array_append("away_lineup", F.lit(999).cast("long"))).otherwise(F.col("away_lineup")),
    }
    return verify.structure(_spans(_plays(spark, d)).withColumns(faults)).withColumn("on_floor", F.round("on_floor", 6))


@_query(f"""WITH {_PLAYS}, l AS (SELECT *, max(period) OVER (PARTITION BY game) AS last FROM plays) SELECT game, bool_or(last >= 4) AND bool_or(period = last AND code = 12) AS complete FROM l GROUP BY 1""")
def complete_games(spark, d):
    """The last period is late enough and its end is in the log."""
    p = _plays(spark, d).select("game", "period", F.when(F.col("code") == 12, 13).otherwise(F.col("code")).alias("code"))
    return verify.complete_games(p)


# ---------------------------------------------------------------- context and rates

_CTX = ", ".join(f"sum(coalesce({side}.{c}, 0)) AS {name}_{c}" for side, name in (("o", "tm"), ("x", "opp")) for c in rates.CONTEXT)
_CONTEXT = f"""{_BOX}, {_SPANS}, tt AS (SELECT game, floor(t/500)*500 AS t_start, team, {', '.join(f'sum({c}) AS {c}' for c in rates.CONTEXT)} FROM ev GROUP BY 1, 2, 3),
 ctx AS (SELECT player, sum(secs) AS secs, sum(po) AS on_poss_o, sum(pd) AS on_poss_d, {_CTX} FROM (SELECT game, t_start, t_end - t_start AS secs, team, unnest(lineup) AS player, CAST(t_start/500 AS BIGINT) % 7 + team AS po, CAST(t_start/500 AS BIGINT) % 7 + 3 - team AS pd FROM sided) s
  LEFT JOIN tt o ON o.game = s.game AND o.t_start = s.t_start AND o.team = s.team LEFT JOIN tt x ON x.game = s.game AND x.t_start = s.t_start AND x.team = 3 - s.team GROUP BY 1)"""


def _with_poss(plays: DataFrame) -> DataFrame:
    return _spans(plays).withColumns({"home_poss": F.col("b") % 7 + 1, "away_poss": F.col("b") % 7 + 2})


@_query(f"WITH {_CONTEXT} SELECT * REPLACE (CAST(secs AS DOUBLE) AS secs) FROM ctx")
def context_sums(spark, d):
    """What both sides did while a player was on the floor."""
    return rates.context(_events(spark, d), _with_poss(_plays(spark, d)))


@_query(f"WITH {_PLAYS}, {_SPANS} SELECT player, count(DISTINCT game) AS gp FROM (SELECT game, unnest(lineup) AS player FROM sided) GROUP BY 1")
def appearances(spark, d):
    """Games from lineups, not from plays."""
    return rates.appearances(_spans(_plays(spark, d)))


_ADV = f"""{_CONTEXT}, bx AS (SELECT player, {_STATS}, CAST(sum(oreb) + sum(dreb) AS BIGINT) AS reb FROM ev WHERE player > 0 GROUP BY 1), gpx AS (SELECT player, count(DISTINCT game) AS gp FROM (SELECT game, unnest(lineup) AS player FROM sided) GROUP BY 1),
 a AS (SELECT gpx.player, gp, {', '.join(f'coalesce({s}, 0) AS {s}' for s in (*box.STATS, 'reb'))}, ctx.* EXCLUDE (player) FROM gpx LEFT JOIN bx USING (player) LEFT JOIN ctx USING (player))"""
_PCT = {
    "fg_pct": ("fgm", "fga"), "fg3_pct": ("fg3m", "fg3a"), "ft_pct": ("ftm", "fta"), "efg": ("fgm+0.5*fg3m", "fga"), "ts": ("pts", "2*(fga+0.44*fta)"), "par3": ("fg3a", "fga"), "ftr": ("fta", "fga"),
    "tovp": ("tov", "fga+0.44*fta+tov"), "usg": ("fga+0.44*fta+tov", "tm_fga+0.44*tm_fta+tm_tov"), "astp": ("ast", "tm_fgm-fgm"), "orbp": ("oreb", "tm_oreb+opp_dreb"), "drbp": ("dreb", "tm_dreb+opp_oreb"),
    "trbp": ("reb", "tm_oreb+tm_dreb+opp_oreb+opp_dreb"), "stlp": ("stl", "on_poss_d"), "blkp": ("blk", "opp_fga-opp_fg3a"),
    "pts_100": ("pts", "on_poss_o"), "tov_100": ("tov", "on_poss_o"), "stl_100": ("stl", "on_poss_d"), "dreb_100": ("dreb", "on_poss_d"), "reb_100": ("reb", "on_poss_o+on_poss_d"), "stocks_100": ("stl+blk", "on_poss_d"),
}
_RATES = ", ".join(f"round(CASE WHEN {den} > 0 THEN 100.0*({num})/({den}) END, 5) AS {name}" for name, (num, den) in _PCT.items())
_PG = ", ".join(f"round(CAST({s} AS DOUBLE)/gp, 5) AS {s}_pg" for s in rates.PER_GAME)


def _advanced(spark, d):
    p = written(_plays(spark, d), "plays")
    e, s = written(box.box_events(p), "events"), written(_with_poss(p), "spans")
    played = rates.with_box(rates.appearances(s), box.season_box(e))
    return rates.advanced(played.join(rates.context(e, s), "player", "left"))


@_query(f"WITH {_ADV} SELECT player, round(secs/60.0, 5) AS min, {_RATES}, {_PG} FROM a")
def advanced_rates(spark, d):
    """Every rate of a season."""
    five = lambda c: F.round(c, 5).alias(c)
    return _advanced(spark, d).select("player", five("min"), *map(five, _PCT), *(five(f"{s}_pg") for s in rates.PER_GAME))


@_query(f"""WITH {_BOX}, g AS (SELECT player, CASE WHEN game % 3 = 0 THEN 'playoffs' ELSE 'reg' END AS scope, sum(pts) AS pts, sum(fga) AS fga, sum(fta) AS fta FROM ev WHERE player > 0 GROUP BY 1, 2)
 SELECT player, CAST(sum(pts) AS BIGINT) AS pts, round(100.0*sum(pts)/nullif(2*(sum(fga)+0.44*sum(fta)), 0), 6) AS ts FROM g GROUP BY 1""")
def combined_scopes(spark, d):
    """Two season types as one: counts are added, rates follow."""
    e = _events(spark, d).withColumn("post", F.col("game") % 3 == 0)
    parts = [box.summed(e.where(on), ["player"]) for on in (~F.col("post"), F.col("post"))]
    both = rates.combined(parts)
    ts = scalar.safe_ratio(F.col("pts"), 2 * (F.col("fga") + 0.44 * F.col("fta"))) * 100
    return both.select("player", "pts", F.round(ts, 6).alias("ts"))


# ---------------------------------------------------------------- ratings


def _rated_stints(spark, d):
    """Stints with a key and a season, stored: ratings read them more than once."""
    key = (F.col("game") * 100_000 + (F.col("t_start") / 500).cast("long")).alias("stint")
    return written(_built(spark, d).select("*", key, F.lit(1997).alias("season")), "stints")


_RAPM = f"""{_STINTS}, {_SPANS},
 u AS (SELECT built.*, home_lineup, away_lineup FROM built JOIN spans ON spans.game = built.game AND spans.b = built.b WHERE activity > 0 AND home_poss + away_poss >= 0.5),
 two AS (SELECT (game*100000 + b)*2 AS row, greatest(home_poss, 0.01) AS w, home_pts/greatest(home_poss, 0.01)*100 AS y, list_concat(home_lineup, list_transform(away_lineup, lambda p: -p)) AS cols FROM u
  UNION ALL SELECT (game*100000 + b)*2 + 1, greatest(away_poss, 0.01), away_pts/greatest(away_poss, 0.01)*100, list_concat(away_lineup, list_transform(home_lineup, lambda p: -p)) FROM u)"""


@_query(f"WITH {_RAPM} SELECT CAST(row AS BIGINT) AS row, CAST(unnest(cols) AS BIGINT) AS col, round(w, 6) AS w, round(y, 4) AS y FROM two")
def rapm_design(spark, d):
    """Two rows a stint, attackers and defenders as columns (L1, F16)."""
    long, _ = rapm.design(rapm.usable(_rated_stints(spark, d)), "stint")
    return long.select("row", "col", F.round("w", 6).alias("w"), F.round("y", 4).alias("y"))


@_query(f"WITH {_RAPM} SELECT CAST(count(*) AS BIGINT) AS kept FROM u WHERE NOT (t_start >= 2100 AND abs(score_margin) >= 20)")
def garbage_time_filter(spark, d):
    """Stints of decided games' last minutes left out."""
    return rapm.without_garbage(rapm.usable(_rated_stints(spark, d))).agg(F.count("*").alias("kept"))


_ALPHA = 2310.13


@_query(f"WITH {_RAPM} SELECT CAST(col AS BIGINT) AS col, 0.0::DOUBLE AS residual FROM (SELECT DISTINCT unnest(cols) AS col FROM two)")
def rapm_normal_equations(spark, d):
    """What the fit leaves over of its normal equations: nothing (L2)."""
    long, rows = rapm.design(rapm.usable(_rated_stints(spark, d)), "stint")
    beta = models.ridge_frame(long, rows, "row", "col", "w", "y", _ALPHA)
    left = models.normal_residuals(long, rows, "row", "col", "w", "y", _ALPHA, beta)
    return left.select("col", (F.round("residual", 5) + 0.0).alias("residual"))


@_query(f"WITH {_RAPM} SELECT player, round(sum(poss), 5) AS poss FROM (SELECT unnest(list_concat(home_lineup, away_lineup)) AS player, home_poss + away_poss AS poss FROM u) GROUP BY 1")
def player_possessions(spark, d):
    """Possessions of either lineup."""
    return rapm.possessions(rapm.usable(_rated_stints(spark, d))).select("player", F.round("poss", 5).alias("poss"))


_NET = f"""{_RAPM}, sd AS (SELECT 1 AS team, home_lineup AS lineup, home_pts AS pts, away_pts AS opp, home_poss AS po, away_poss AS pd FROM u UNION ALL SELECT 2, away_lineup, away_pts, home_pts, away_poss, home_poss FROM u),
 onx AS (SELECT unnest(lineup) AS player, team, pts, opp, po, pd FROM sd), o AS (SELECT player, team, sum(pts) AS pts, sum(opp) AS opp, sum(po) AS po, sum(pd) AS pd FROM onx GROUP BY 1, 2), al AS (SELECT team, sum(pts) AS pts, sum(opp) AS opp, sum(po) AS po, sum(pd) AS pd FROM sd GROUP BY 1)"""


@_query(f"""WITH {_NET} SELECT o.player, CAST(o.team AS BIGINT) AS team, round_even(o.pts/o.po*100, 1) AS on_ortg, round_even(o.opp/o.pd*100, 1) AS on_drtg, round_even((al.pts-o.pts)/(al.po-o.po)*100, 1) AS off_ortg,
 round_even((al.opp-o.opp)/(al.pd-o.pd)*100, 1) AS off_drtg FROM o JOIN al USING (team)""")
def net_ratings(spark, d):
    """On and off the floor, per 100 possessions."""
    return rapm.net_ratings(rapm.usable(_rated_stints(spark, d))).select("player", "team", "on_ortg", "on_drtg", "off_ortg", "off_drtg")


@_query()
def rapm_table(spark, d):
    """Ratings, on/off and box columns of a season (L4, J7, M9, M10, T1); the fit is held by its normal equations."""
    s = rapm.usable(_rated_stints(spark, d))
    beta = rapm.fitted(s, "stint", _ALPHA)
    b = _advanced(spark, d).select("player", "gp", *(F.col(f"{c}_pg").alias(c) for c in ("fga", "fta", "tov")))
    return rapm.assembled(rapm.ratings(beta), rapm.possessions(s), rapm.net_ratings(s), b).select("player", "orapm", "drapm", "rapm", "poss", "on_off", "usg")


@_query()
def split_half_reliability(spark, d):
    """Ratings of two halves against each other, over twenty splits solved together."""
    return evaluate.reliability(rapm.usable(_rated_stints(spark, d)), "stint", _ALPHA)


_YEARS = "y AS (SELECT l_suppkey AS player, year(l_shipdate) AS season, sum(l_quantity) AS poss, avg(l_discount) AS a, avg(l_tax) AS b FROM lineitem GROUP BY 1, 2)"


@_query(f"""WITH {_YEARS}, k AS (SELECT * FROM y WHERE poss >= 500), p AS (SELECT a.season AS season_a, b.season AS season_b, count(*) AS n_players, corr(a.a, b.a) AS ra, corr(a.b, b.b) AS rb FROM k a JOIN k b ON a.player = b.player AND b.season = a.season + 1 GROUP BY 1, 2 HAVING count(*) >= 10)
 SELECT CAST(season_a AS INTEGER) AS season_a, CAST(season_b AS INTEGER) AS season_b, n_players, unnest(['a', 'b']) AS metric, unnest([round_even(ra, 3), round_even(rb, 3)]) AS r_across FROM p""")
def rating_stability(spark, d):
    """Correlation of ratings across consecutive seasons."""
    y = _t(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("player"), F.year("l_shipdate").alias("season"))
    y = y.agg(F.sum("l_quantity").alias("poss"), F.avg("l_discount").alias("a"), F.avg("l_tax").alias("b"))
    return evaluate.stability(y, ("a", "b"))


_PART = ["p_size", "p_retailprice", "p_partkey"]


@_query("SELECT unnest(['p_size','p_size','p_size','p_retailprice','p_retailprice','p_retailprice','p_partkey','p_partkey','p_partkey']) AS a, unnest(['p_size','p_retailprice','p_partkey','p_size','p_retailprice','p_partkey','p_size','p_retailprice','p_partkey']) AS b,"
        " unnest([round_even(corr(x,x),3),round_even(corr(x,y),3),round_even(corr(x,z),3),round_even(corr(x,y),3),round_even(corr(y,y),3),round_even(corr(y,z),3),round_even(corr(x,z),3),round_even(corr(y,z),3),round_even(corr(z,z),3)]) AS r FROM (SELECT p_size AS x, p_retailprice AS y, p_partkey AS z FROM part)")  # fmt: skip
def metric_correlations(spark, d):
    """The matrix of correlations."""
    return evaluate.correlations(_t(spark, d, "part"), _PART)


@_query()
def metric_components(spark, d):
    """Principal components of standardised metrics (L9, W14); tests hold them against numpy."""
    return evaluate.components(_t(spark, d, "part"), _PART)


_BPM = ("AST_100", "TOV_100", "USG_PCT", "TS_PCT", "STL_100", "BLK_100", "DREB_100", "OREB_100")


@_query(f"WITH {_ADV} SELECT player, round(CASE WHEN fga+0.44*fta > 0 THEN pts/(2*(fga+0.44*fta)) END, 6) AS ts FROM a")
def true_shooting(spark, d):
    """True shooting as box ratings read it."""
    return _advanced(spark, d).select("player", F.round(bpm.true_shooting(F.col("pts"), F.col("fga"), F.col("fta")), 6).alias("ts"))


@_query()
def box_ratings(spark, d):
    """Box ratings fitted to adjusted ones (L5, L6); tests hold the fit against numpy."""
    columns = {"AST_100": "ast_100", "TOV_100": "tov_100", "USG_PCT": "usg", "TS_PCT": "ts", "STL_100": "stl_100", "BLK_100": "blk_100", "DREB_100": "dreb_100", "OREB_100": "oreb_100"}
    rows = _advanced(spark, d).withColumn("blk_100", F.col("blk") / F.nullif("on_poss_d", F.lit(0)) * 100)
    rows = rows.select("player", (F.col("on_poss_o") + F.col("on_poss_d")).cast("double").alias("POSS"), *(F.col(columns[c]).alias(c) for c in _BPM))
    s = rapm.usable(_rated_stints(spark, d))
    rated = rapm.ratings(rapm.fitted(s, "stint", _ALPHA)).select("player", F.col("orapm").alias("ORAPM"), F.col("drapm").alias("DRAPM"))
    return bpm.rated(rows.join(rated, "player")).select("player", "OBPM", "DBPM", "BPM")


@_query("""SELECT l_suppkey AS player, round_even(avg(l_quantity), 1) AS pts, round_even(avg(l_discount) * 100, 1) AS fg_pct, CAST(count(*) FILTER (l_linenumber = 1) AS DOUBLE) AS stl_100,
 CAST(count(*) FILTER (l_linenumber = 2) AS DOUBLE) AS blk_100, CAST(count(*) FILTER (l_linenumber <= 2) AS DOUBLE) AS stocks_100 FROM lineitem GROUP BY 1""")
def published_columns(spark, d):
    """Box columns as they are published: per-game values to a place, shares as percentages, stocks as a sum.

    Means are decimals until they are rounded: a mean that lies on half a place in doubles goes up or down
    by the order in which its rows were added.
    """
    line = F.col("l_linenumber")
    mean = lambda c: (F.sum(F.col(c).cast("decimal(28,10)")) / F.count(c)).alias({"l_quantity": "pts", "l_discount": "fg_pct"}[c])
    rows = _t(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("player")).agg(
        mean("l_quantity"), mean("l_discount"), F.count_if(line == 1).cast("double").alias("stl_100"), F.count_if(line == 2).cast("double").alias("blk_100")
    )
    return rapm.per_game_columns(rows, ["pts"], ["fg_pct"]).withColumns({c: F.col(c).cast("double") for c in ("pts", "fg_pct")})
