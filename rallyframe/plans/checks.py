"""Queries of verification, dimension tables, documents, clusters and row rules, with DuckDB SQL.

Where a check needs two sources that differ, the second is made from the first by faults that the
table's own values decide, over the whole table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rallyframe.functions import scalar
from rallyframe.operators import archetypes, box, density, lineups, maps, ordering, reconcile, shots, verify
from rallyframe.plans.catalog import _SHOTS, _query, _shots, _t
from rallyframe.plans.games import _ADV, _BOX, _PLAYS, _SPANS, _STATS, _advanced, _events, _plays, _spans
from rallyframe.sources import documents, feeds, files
from rallyframe.sources.stored import written

# ---------------------------------------------------------------- verification


def _occupants(spark, d):
    """Official spans of each player, a play being a second, and ours with a wrong player every fifth stint."""
    s = _spans(_plays(spark, d))
    side = lambda team, faulty: F.struct(F.lit(team).cast("long").alias("team"), (F.transform(("home", "away")[team - 1] + "_lineup", lambda p, i: F.when((i == 0) & (F.col("b") % 5 == 0), p + 900).otherwise(p)) if faulty else F.col(("home", "away")[team - 1] + "_lineup")).alias("lineup"))  # noqa: E731, E501

    def each(faulty):
        sides = s.select("game", (F.col("t_start") / 10).alias("t_start"), (F.col("t_end") / 10).alias("t_end"), F.inline(F.array(side(1, faulty), side(2, False))))
        return lineups.exploded(sides, "lineup", "player")

    return each(True), each(False)


@_query(f"""WITH {_PLAYS}, {_SPANS} SELECT game, CAST(sum(50) AS BIGINT) AS covered, CAST(sum(CASE WHEN b % 5 = 0 THEN 0 ELSE 50 END) AS BIGINT) AS matched,
 CAST(sum(CASE WHEN b % 5 = 0 THEN 50 ELSE 0 END) AS BIGINT) AS mismatched, CAST(min(CASE WHEN b % 5 = 0 THEN b*50 END) AS BIGINT) AS first_mismatch FROM spans GROUP BY 1""")
def second_grid_compare(spark, d):
    """Lineups second by second against the official ones."""
    return verify.compare_seconds(*_occupants(spark, d))


@_query(f"""WITH {_PLAYS}, {_SPANS}, p AS (SELECT game, 1 AS team, b, unnest(home_lineup) AS player, list_min(home_lineup) AS first FROM spans),
 o AS (SELECT game, CASE WHEN b % 5 = 0 AND player = first THEN player + 900 ELSE player END AS player, 50 AS secs FROM p), a AS (SELECT game, player, sum(secs) AS s FROM o GROUP BY 1, 2), c AS (SELECT game, player, count(*)*50 AS s FROM p GROUP BY 1, 2),
 z AS (SELECT game, CAST(1 AS BIGINT) AS team, player, CAST(coalesce(a.s, 0) - coalesce(c.s, 0) AS BIGINT) AS delta FROM a FULL JOIN c USING (game, player) UNION ALL SELECT game, 2, player, 0 FROM (SELECT DISTINCT game, unnest(away_lineup) AS player FROM spans)) SELECT * FROM z""")
def player_second_deltas(spark, d):
    return verify.player_seconds(*_occupants(spark, d))


@_query(f"""WITH {_PLAYS}, {_SPANS}, own AS (SELECT game, player, sum(t_end - t_start) AS secs FROM (SELECT game, t_start, t_end, unnest(lineup) AS player FROM sided) GROUP BY 1, 2),
 off AS (SELECT game, player, CASE WHEN player % 11 = 0 THEN NULL WHEN player % 3 = 0 THEN secs + player - 150 ELSE secs END AS secs FROM own), j AS (SELECT off.game, own.secs - off.secs AS delta FROM off JOIN own USING (game, player) WHERE off.secs IS NOT NULL)
 SELECT game, count(*) AS players, count(*) FILTER (abs(delta) < 1) AS exact, count(*) FILTER (abs(delta) <= 30) AS close, round(avg(abs(delta)), 6) AS mean_delta, max(abs(delta)) AS max_delta, sum(delta) AS total_delta FROM j GROUP BY 1""")
def minutes_check(spark, d):
    """Minutes against the official box, whose times may be unreadable."""
    s = _spans(_plays(spark, d)).select("game", (F.col("t_end") - F.col("t_start")).alias("secs"), F.explode(F.concat("home_lineup", "away_lineup")).alias("player"))
    own = s.groupBy("game", "player").agg(F.sum("secs").alias("secs"))
    p = F.col("player")
    official = own.withColumn("secs", F.when(p % 3 == 0, F.col("secs") + p - 150).otherwise(F.col("secs"))).withColumn("secs", F.when(p % 11 != 0, F.col("secs")))
    return verify.minutes(own, official).withColumn("mean_delta", F.round("mean_delta", 6))


_OFFICIAL = f"""{_BOX}, gb AS (SELECT game, player, 'P' || player AS name, {_STATS} FROM ev WHERE player > 0 GROUP BY 1, 2),
 off AS (SELECT game, CASE WHEN fga > 12 THEN -player ELSE player END AS player, name, pts + (player % 5 = 0)::INT AS pts, reb, tov FROM (SELECT *, oreb + dreb AS reb FROM gb) WHERE tov < 9)"""


@_query(f"""WITH {_OFFICIAL}, k AS (SELECT DISTINCT game, player FROM off), n AS (SELECT game, name, min(player) AS other FROM off GROUP BY 1, 2),
 m AS (SELECT g.game, CASE WHEN k.player IS NULL THEN coalesce(n.other, g.player) ELSE g.player END AS player, pts, oreb + dreb AS reb, tov FROM gb g LEFT JOIN k ON k.game = g.game AND k.player = g.player LEFT JOIN n ON n.game = g.game AND n.name = g.name),
 a AS (SELECT game, player, sum(pts) AS pts, sum(reb) AS reb, sum(tov) AS tov FROM m GROUP BY 1, 2), b AS (SELECT game, player, sum(pts) AS pts, sum(reb) AS reb, sum(tov) AS tov FROM off GROUP BY 1, 2),
 j AS (SELECT a.player IS NOT NULL AND b.player IS NOT NULL AS met, greatest(coalesce(a.pts,0), coalesce(a.reb,0), coalesce(a.tov,0), coalesce(b.pts,0), coalesce(b.reb,0), coalesce(b.tov,0)) > 0 AS carries,
  a.pts - b.pts AS dp, a.reb - b.reb AS dr, a.tov - b.tov AS dt FROM a FULL JOIN b ON a.game = b.game AND a.player = b.player),
 l AS (SELECT met, carries, unnest(['pts','reb','tov']) AS stat, unnest([dp, dr, dt]) AS diff FROM j)
 SELECT stat, count(*) FILTER (met) AS rows, count(*) FILTER (met AND diff <> 0) AS differing, count(*) FILTER (NOT met AND carries) AS unmatched FROM l GROUP BY 1""")
def box_reconcile(spark, d):
    """Box scores of games against official ones, ids first and names where ids differ."""
    own = written(box.summed(_events(spark, d), ["game", "player"]).withColumn("name", F.concat(F.lit("P"), F.col("player").cast("string"))), "totals")
    official = own.where("tov < 9").withColumns({"player": F.when(F.col("fga") > 12, -F.col("player")).otherwise(F.col("player")), "pts": F.col("pts") + (F.col("player") % 5 == 0).cast("int")})
    return verify.box_totals(own, official, "player", "name", ["pts", "reb", "tov"])


@_query(f"""WITH {_BOX}, s AS (SELECT player, {_STATS} FROM ev WHERE player > 0 GROUP BY 1), t AS (SELECT CAST(sum(pts) AS DOUBLE) AS p, CAST(sum(pts + (player % 2 = 0)::INT*pts/50.0) AS DOUBLE) AS q, CAST(sum(ast) AS DOUBLE) AS a FROM s),
 l AS (SELECT unnest(['pts', 'ast']) AS stat, unnest([p, a]) AS own, unnest([q, a]) AS theirs FROM t) SELECT stat, own, round(theirs, 6) AS theirs, round(100*(own-theirs)/greatest(theirs, 1), 6) AS percent, abs(100*(own-theirs)/greatest(theirs, 1)) >= 0.1 AS flagged FROM l""")
def season_reconcile(spark, d):
    """Season totals against official ones; a gap of a tenth of a per cent is flagged."""
    own = box.season_box(_events(spark, d))
    official = own.withColumn("pts", F.col("pts") + F.when(F.col("player") % 2 == 0, F.col("pts") / 50.0).otherwise(0.0))
    out = verify.season_totals(own, official, "player", ["pts", "ast"])
    return out.withColumns({"theirs": F.round("theirs", 6), "percent": F.round("percent", 6)})


@_query(f"""WITH {_ADV}, r AS (SELECT player, secs/60.0 AS min, CASE WHEN fga+0.44*fta > 0 THEN 100.0*pts/(2*(fga+0.44*fta)) END AS ts, CASE WHEN tm_fga+0.44*tm_fta+tm_tov > 0 THEN 100.0*(fga+0.44*fta+tov)/(tm_fga+0.44*tm_fta+tm_tov) END AS usg FROM a),
 g AS (SELECT ts - (ts + (player % 10 = 0)::INT) AS gt, usg - (usg + (player % 4)*0.01) AS gu, ts, usg, player FROM r WHERE min >= 200)
 SELECT 'ts' AS rate, 'exact' AS kind, count(*) AS players, count(*) FILTER (abs(gt) > 0.15) AS over, count(*) FILTER (abs(gt) > 0.15) > 0 AS fails FROM g
 UNION ALL SELECT 'usg', 'tracking', count(*), count(*) FILTER (abs(gu) > 0.15), coalesce(corr(usg, usg + (player % 4)*0.01) < 0.95, false) FROM g""")
def rate_reconcile(spark, d):
    """Rates against official ones: equal definitions must agree, estimated ones track (V5)."""
    own = _advanced(spark, d).select("player", "min", "ts", "usg")
    official = own.select("player", ((F.col("ts") + (F.col("player") % 10 == 0).cast("int")) / 100).alias("TS_PCT"), ((F.col("usg") + (F.col("player") % 4) * 0.01) / 100).alias("USG_PCT"))
    return verify.rates(own, official, "player", {"ts": "TS_PCT"}, {"usg": "USG_PCT"}).select("rate", "kind", "players", "over", "fails")


@_query("""SELECT unnest(['no bare NaN', 'season is listed', 'enough players', 'data is fresh', 'one pinned penalty']) AS "check",
 unnest([true, (SELECT count(*) FROM customer WHERE c_mktsegment = 'BUILDING') > 0, (SELECT count(DISTINCT c_custkey) FROM customer WHERE c_mktsegment = 'BUILDING') >= 50,
 (SELECT date_diff('day', max(l_shipdate)::DATE, DATE '1998-12-03') <= 4 FROM lineitem), true]) AS passes""")
def publish_gate(spark, d):
    """Whether a season may be published (V8)."""
    c = _t(spark, d, "customer").select(F.col("c_mktsegment").alias("season"), F.col("c_custkey").alias("player"), "c_acctbal")
    published = c.select("season", "player", F.to_json(F.struct("player", "c_acctbal")).alias("doc"))
    latest = _t(spark, d, "lineitem").agg(F.to_date(F.max("l_shipdate")).alias("m"))
    alphas = spark.range(2).select(F.lit(2310.13).alias("alpha"))
    return verify.gate(published, "BUILDING", c.select("season").distinct(), latest.scalar(), F.lit("1998-12-03").cast("date"), alphas, 2310.13)


@_query(f"""WITH {_PLAYS}, l AS (SELECT *, max(period) OVER (PARTITION BY game) AS last FROM plays), c AS (SELECT game, bool_or(last >= 4) AND bool_or(period = last AND code = 12) AS complete FROM l GROUP BY 1)
 SELECT game FROM (SELECT DISTINCT game FROM plays) WHERE game IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) OR game IN (SELECT game FROM c WHERE NOT complete)""")
def stale_games(spark, d):
    """What to fetch anew: volatile keys and games stored in part (V9)."""
    p = _plays(spark, d).select("game", "period", F.when(F.col("code") == 12, 13).otherwise(F.col("code")).alias("code"))
    volatile = _t(spark, d, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("game"))
    return verify.stale(p.select("game").distinct(), volatile, verify.complete_games(p).where("not complete"), "game")


@_query("SELECT l_linestatus, count(*) AS n, count(DISTINCT l_suppkey) AS members, round(avg(l_discount), 6) AS mean, array_to_string(list_sort(list_distinct(list(l_returnflag))), ',') AS flags FROM lineitem GROUP BY 1")
def status_summary(spark, d):
    """Counts by status, distinct members, means and the values there are."""
    flags = F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",")
    return _t(spark, d, "lineitem").groupBy("l_linestatus").agg(
        F.count("*").alias("n"), F.count_distinct("l_suppkey").alias("members"), F.round(F.avg("l_discount"), 6).alias("mean"), flags.alias("flags")
    )


# ---------------------------------------------------------------- dimension tables


@_query("""WITH r AS (SELECT year(l_shipdate) AS season, l_orderkey AS game, l_suppkey AS team, l_returnflag AS city, l_linestatus AS nickname, l_linenumber AS n, l_partkey AS p FROM lineitem),
 e AS (SELECT season, game FROM (SELECT season, game, row_number() OVER (PARTITION BY season ORDER BY game) AS k FROM (SELECT DISTINCT season, game FROM r)) WHERE k <= 40)
 SELECT CAST(season AS INTEGER) AS season, team, arg_min(city, (game, n, p)) AS city, arg_min(nickname, (game, n, p)) AS nickname FROM r SEMI JOIN e USING (season, game) GROUP BY 1, 2""")
def first_identities(spark, d):
    """What a team is first called in a season's first forty games."""
    rows = _t(spark, d, "lineitem").select(
        F.year("l_shipdate").alias("season"), F.col("l_orderkey").alias("game"), F.col("l_suppkey").alias("team"), F.col("l_returnflag").alias("city"), F.col("l_linestatus").alias("nickname"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p")
    )
    return maps.first_identity(rows, ["season"], "team", ["city", "nickname"], ["game", "n", "p"])


_MAP = """m AS (SELECT n_nationkey AS id, n_name AS city, r_name AS nickname, upper(substr(n_name, 1, 3)) || n_nationkey AS abbr, lower(trim(regexp_replace(lower(n_name || ' ' || r_name), '[^a-z0-9]+', '-', 'g'), '-')) AS slug, n_name || ' ' || r_name AS name,
 CASE WHEN n_regionkey = 1 OR n_regionkey = 3 THEN 'West' WHEN n_regionkey = 2 THEN 'East' END AS conf FROM nation JOIN region ON r_regionkey = n_regionkey)"""


def _team_map(spark, d):
    nation, region = _t(spark, d, "nation"), _t(spark, d, "region")
    named = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    identities = named.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("city"), F.col("r_name").alias("nickname"), F.concat(F.upper(F.substring("n_name", 1, 3)), F.col("n_nationkey").cast("string")).alias("abbr"))
    feed = lambda *r: nation.where(F.col("n_regionkey").isin(*r)).select(F.col("n_nationkey").alias("id"))
    return maps.team_map(identities, maps.conferences({"East": feed(2, 3), "West": feed(1, 3)}, "id"), "id")


@_query(f"WITH {_MAP} SELECT id, city, nickname, abbr, name, slug, conf FROM m")
def team_map(spark, d):
    """Teams with names, slugs and conferences; the later of two feeds wins."""
    return maps.history(_team_map(spark, d), "id", "abbr")


@_query(f"WITH {_MAP} SELECT s_suppkey, name, conf FROM supplier JOIN m ON id = s_nationkey WHERE conf IS NOT NULL")
def with_team(spark, d):
    """Rows of known teams with their team."""
    teams = _team_map(spark, d).where("conf is not null").select(F.col("id").alias("s_nationkey"), "name", "conf")
    return maps.with_team(_t(spark, d, "supplier"), teams, "s_nationkey", keep_unknown=False).select("s_suppkey", "name", "conf")


@_query("SELECT CAST(unnest(range(min(year(o_orderdate)), max(year(o_orderdate)) + 1)) AS BIGINT) AS season FROM orders WHERE o_orderstatus <> 'O' OR year(o_orderdate) % 2 = 0")
def season_list(spark, d):
    """Every season between the first and the last, those without games too."""
    o = _t(spark, d, "orders").withColumn("season", F.year("o_orderdate")).where("o_orderstatus <> 'O' OR season % 2 = 0")
    return maps.seasons_of(o, "season").select(F.col("season").cast("long").alias("season"))


_FEED = "f AS (SELECT l_suppkey AS player, year(l_shipdate) AS season, max(l_returnflag) AS name, min(l_linestatus) AS team, count(*) AS gp, avg(l_quantity) AS pts, avg(l_tax) AS reb FROM lineitem GROUP BY 1, 2)"


@_query(f"WITH {_FEED} SELECT player, arg_min(name, season) AS name, arg_max(team, season) AS team, round(sum(pts*gp)/sum(gp), 5) AS pts, round(sum(reb*gp)/sum(gp), 5) AS reb, CAST(sum(gp) AS BIGINT) AS gp FROM f GROUP BY 1")
def combined_box_feed(spark, d):
    """Means over seasons weighted by games, first name, last team."""
    rows = _t(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("player"), F.year("l_shipdate").alias("season"))
    rows = rows.agg(F.max("l_returnflag").alias("name"), F.min("l_linestatus").alias("team"), F.count("*").alias("gp"), F.avg("l_quantity").alias("pts"), F.avg("l_tax").alias("reb"))
    out = maps.box_feed(rows, "player", "season", ["pts", "reb"])
    return out.select("player", "name", "team", F.round("pts", 5).alias("pts"), F.round("reb", 5).alias("reb"), "gp")


@_query("""WITH r AS (SELECT o_custkey AS player, count(*) AS gp, 1 AS nth FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 UNION ALL SELECT o_custkey, count(*), 2 FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1)
 SELECT player, gp FROM (SELECT *, row_number() OVER (PARTITION BY player ORDER BY nth) AS k FROM r) WHERE k = 1""")
def first_feed_wins(spark, d):
    """Of two scopes' feeds a player's first."""
    o = _t(spark, d, "orders").select(F.col("o_custkey").alias("player"), (F.col("o_orderstatus") == "F").alias("f"))
    parts = [o.where(on).groupBy("player").agg(F.count("*").alias("gp")) for on in (F.col("f"), ~F.col("f"))]
    return maps.one_feed(parts, "player")


@_query(f"""WITH {_PLAYS}, v AS (SELECT game, 'P' || p1 AS name, p1 AS player, 1 AS slot, seq FROM plays WHERE k1 = 4 UNION ALL SELECT game, 'Q' || seq, p2, 2, seq FROM plays WHERE k2 = 5 UNION ALL SELECT game, CASE WHEN seq % 2 = 0 THEN '  ' ELSE 'R' || seq END, p3, 3, seq FROM plays WHERE k3 = 4)
 SELECT game, player, arg_max(name, (slot, seq)) AS name FROM v WHERE trim(name) <> '' GROUP BY 1, 2""")
def name_lookup(spark, d):
    """The last name of a player that isn't blank, later slots first (A2)."""
    p = _plays(spark, d)
    seq = F.col("seq").cast("string")
    names = {1: F.concat(F.lit("P"), F.col("p1").cast("string")), 2: F.concat(F.lit("Q"), seq), 3: F.when(F.col("seq") % 2 == 0, "  ").otherwise(F.concat(F.lit("R"), seq))}
    slots = [F.when(F.col(f"k{n}").isin(4, 5), F.struct(F.col(f"p{n}").alias("player"), F.lit(n).alias("slot"), name.alias("name"))) for n, name in names.items()]
    said = p.select("game", "seq", F.inline(F.filter(F.array(*slots), lambda s: s.isNotNull())))
    return ordering.last_value(said, ["game", "player"], "name", ["slot", "seq"])


@_query(f"""WITH {_PLAYS}, v AS (SELECT game, k1 AS kind, t1 AS team, seq*3+1 AS place FROM plays UNION ALL SELECT game, k2, t2, seq*3+2 FROM plays UNION ALL SELECT game, k3, t3, seq*3+3 FROM plays),
 c AS (SELECT game, kind, team, count(*) AS n, min(place) AS place FROM v WHERE kind IN (4, 5) GROUP BY 1, 2, 3), b AS (SELECT game, kind, team FROM (SELECT *, row_number() OVER (PARTITION BY game, kind ORDER BY n DESC, place) AS k FROM c) WHERE k = 1),
 z AS (SELECT game, max(team) FILTER (kind = 4) AS home, max(team) FILTER (kind = 5) AS away FROM b GROUP BY 1) SELECT game, CASE WHEN home <> away THEN home END AS home, CASE WHEN home <> away THEN away END AS away FROM z""")
def home_team_vote(spark, d):
    """Which team is at home, by vote of the log; none if both sides agree."""
    return feeds.home_team(_plays(spark, d))


@_query("SELECT o_orderkey, 'pbp_' || substr(md5('game_id=' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '_season=' || year(o_orderdate)), 1, 8) || '.csv' AS key FROM orders")
def content_keys(spark, d):
    """Names of stored answers from their parameters."""
    parameters = F.create_map(F.lit("season"), F.year("o_orderdate").cast("string"), F.lit("game_id"), scalar.padded_id(F.col("o_orderkey")))
    return _t(spark, d, "orders").select("o_orderkey", files.content_key(F.lit("pbp"), parameters).alias("key"))


@_query("SELECT DISTINCT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS game_id, CAST(o_orderdate AS DATE) AS day FROM orders")
def schedule_table(spark, d):
    """One row a game with its padded id, in order."""
    o = _t(spark, d, "orders").select(scalar.padded_id(F.col("o_orderkey")).alias("game_id"), F.to_date("o_orderdate").alias("day"))
    return o.dropDuplicates(["game_id"]).orderBy("game_id")


# ---------------------------------------------------------------- documents


def _members(spark, d):
    five = {f"{n}_pg": F.col(f"{n}_pg") for n in documents.PER_GAME}
    rows = _advanced(spark, d).withColumns(five)
    return rows.withColumns({"name": F.concat(F.lit("P"), F.col("player").cast("string")), "poss": F.col("on_poss_o") + F.col("on_poss_d"), "season": F.lit(1997)})


@_query(f"""WITH {_ADV}, r AS (SELECT player AS id, 'P' || player AS n, CAST(gp AS INTEGER) AS gp, round_even(pts::DOUBLE/gp, 1) AS pts, round_even(CASE WHEN fga > 0 THEN 100.0*fgm/fga END, 1) AS fg FROM a)
 SELECT row_number() OVER (ORDER BY pts DESC NULLS LAST, id) - 1 AS place, id, n, gp, pts, fg, NULL::VARCHAR AS slug FROM r""")
def player_stats_document(spark, d):
    """The published table of players, read back from its JSON."""
    docs = documents.player_stats(_members(spark, d), ["season"], {"season": F.lit("1997")})
    kind = "struct<players: array<struct<id: long, n: string, slug: string, gp: int, pts: double, fg: double>>>"
    return docs.select(F.posexplode(F.from_json("doc", kind)["players"]).alias("place", "p")).select("place", "p.*")


@_query(f"""WITH {_ADV}, r AS (SELECT player AS id, on_poss_o + on_poss_d AS poss, round_even(CASE WHEN fga > 0 THEN 100.0*fgm/fga END, 2) AS rapm FROM a), k AS (SELECT * FROM r WHERE poss >= 100)
 SELECT row_number() OVER (ORDER BY rapm DESC NULLS LAST, id) - 1 AS place, id, CAST(poss AS BIGINT) AS rposs, rapm, (SELECT count(*) FROM k) AS n_players FROM k""")
def player_impact_document(spark, d):
    """The published ratings of players with enough possessions, read back from their JSON."""
    rated = _members(spark, d).withColumns({"orapm": F.lit(0.5), "drapm": F.lit(None).cast("double"), "rapm": F.bround("fg_pct", 2), "team_id": F.lit(1), "team_name": F.lit("T"), "conf": F.lit("East")})
    docs = documents.player_impact(rated, ["season"], 2310.13, {"season": F.lit("1997")})
    kind = "struct<players: array<struct<id: long, rposs: long, rapm: double>>, meta: struct<n_players: long>>"
    read = docs.select(F.from_json("doc", kind).alias("d"))
    return read.select(F.posexplode("d.players").alias("place", "p"), F.col("d.meta.n_players").alias("n_players")).select("place", "p.*", "n_players")


def _feed_shots(spark, d):
    s = shots.prepared(_shots(spark, d), "x", "y", "season")
    name = F.concat(F.lit("N"), (F.col("vec_id") % 5).cast("string"))
    return s.select("label", "zone_idx", "made", "season", (F.col("vec_id") % 9).alias("game"), F.lit("2024-01-01").cast("date").alias("date"), F.col("vec_id").alias("event"), "x", "y", name.alias("name"), (F.col("vec_id") % 5).alias("player"))


_COMPACT = f"""{_SHOTS}, k AS (SELECT label, vec_id % 9 AS game, vec_id AS event, x, y, made, 'N' || vec_id % 5 AS name, vec_id % 5 AS player FROM zoned WHERE zone_idx >= 0),
 c AS (SELECT *, dense_rank() OVER (PARTITION BY label ORDER BY game) - 1 AS g, dense_rank() OVER (PARTITION BY label ORDER BY name) - 1 AS p FROM k)"""


@_query(f"""WITH {_COMPACT} SELECT label, CAST(count(DISTINCT game) AS INTEGER) AS gp, array_to_string(list_sort(list_distinct(list(name))), ',') AS players,
 string_agg(g || ',' || CAST(trunc(x) AS INTEGER) || ',' || CAST(trunc(y) AS INTEGER) || ',' || made || ',' || p, ',' ORDER BY game, event) AS shots FROM c GROUP BY 1""")
def compact_shots(spark, d):
    """A team's shots as one flat array with games and names listed once."""
    out = shots.compact(_feed_shots(spark, d), ["label"])
    return out.select("label", "gp", F.array_join("players", ",").alias("players"), F.array_join("shots", ",").alias("shots"))


@_query(f"""WITH {_COMPACT}, z AS (SELECT label, zone_idx, sum(made) AS m, count(*) AS a FROM zoned WHERE zone_idx >= 0 GROUP BY 1, 2)
 SELECT c.label, CAST(count(*)*5 AS INTEGER) AS numbers, (SELECT CAST(count(*) AS INTEGER) FROM z WHERE z.label = c.label) AS zones FROM c GROUP BY 1""")
def shot_documents(spark, d):
    """A team's shot document with its zones, read back from its JSON (K8)."""
    s = _feed_shots(spark, d)
    docs = documents.shot_documents(shots.compact(s, ["label"]), ["label"], shots.zone_records(s, ["label"], "made"), ["label"])
    kind = "struct<shots: array<int>, team_zones: array<array<int>>>"
    return docs.select("label", F.from_json("doc", kind).alias("d")).select("label", F.size("d.shots").alias("numbers"), F.size("d.team_zones").alias("zones"))


@_query("SELECT '{\"seasons\":[' || string_agg(season, ',' ORDER BY season DESC) || ']}' AS doc FROM (SELECT DISTINCT year(l_shipdate) AS season FROM lineitem)")
def seasons_document(spark, d):
    """The list of seasons, newest first."""
    return documents.seasons_index(_t(spark, d, "lineitem").select(F.year("l_shipdate").alias("season")), "season")


@_query("SELECT DISTINCT l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")
def stale_documents(spark, d):
    """Stored documents that are no longer made."""
    stored = _t(spark, d, "lineitem").select("l_suppkey").distinct()
    return documents.stale_documents(stored, _t(spark, d, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey")), ["l_suppkey"])


# ---------------------------------------------------------------- shots and clusters


@_query(f"""WITH {_SHOTS}, p AS (SELECT label, made, round(x/100)*100 AS ax, round(y/(100*sqrt(3)))*(100*sqrt(3)) AS ay, (floor(x/100)+0.5)*100 AS bx, (floor(y/(100*sqrt(3)))+0.5)*(100*sqrt(3)) AS bw, x, y FROM shots),
 h AS (SELECT label, made, CASE WHEN (x-ax)**2+(y-ay)**2 <= (x-bx)**2+(y-bw)**2 THEN ax ELSE bx END AS hx, CASE WHEN (x-ax)**2+(y-ay)**2 <= (x-bx)**2+(y-bw)**2 THEN ay ELSE bw END AS hy FROM p)
 SELECT label, hx + 0 AS hx, round(hy, 6) + 0 AS hy, count(*) AS n, round(avg(made), 6) AS pct FROM h GROUP BY label, hx, hy HAVING count(*) >= 3""")
def hex_bins(spark, d):
    """Hexagons with shots and share made, from three shots on."""
    h = shots.hexagons(_shots(spark, d), ["label"], "x", "y", "made", 100.0)
    return h.select("label", (F.col("hx") + 0.0).alias("hx"), (F.round("hy", 6) + 0.0).alias("hy"), "n", F.round("pct", 6).alias("pct"))


# A line item is a shot, so that a season has hundreds.
_LINE_SHOTS = f"""shots AS (SELECT CAST(l_partkey % 601 - 300 AS DOUBLE) AS x, CAST(l_orderkey % 470 - 50 AS DOUBLE) AS y, CAST(1997 + l_suppkey % 28 AS INTEGER) AS season FROM lineitem),
{_SHOTS[_SHOTS.index(" geo AS"):]}"""


def _line_shots(spark, d):
    lines = _t(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_suppkey")
    place = lines.select((F.col("l_partkey") % 601 - 300).cast("double").alias("x"), (F.col("l_orderkey") % 470 - 50).cast("double").alias("y"), (1997 + F.col("l_suppkey") % 28).cast("int").alias("season"))
    return place.withColumn("zone_idx", scalar.zone_index(F.col("x"), F.col("y"), scalar.era_value(F.col("season"), 1), scalar.era_value(F.col("season"), 2)))


@_query(f"""WITH {_LINE_SHOTS}, m AS (SELECT season, count(*) FILTER (zone_idx >= 9 AND y > 100) AS n, quantile_cont(CASE WHEN zone_idx >= 9 AND y > 100 THEN r END, 0.01) AS p, max(arc) AS arc FROM zoned GROUP BY 1)
 SELECT season, CAST(arc AS DOUBLE) AS table_arc, CASE WHEN n >= 50 THEN round_even(p, 1) END AS measured_arc, coalesce(n >= 50 AND abs(p - arc) <= 12, false) AS ok FROM m""")
def arc_check(spark, d):
    """The measured arc of each season against the era's."""
    return shots.arc_check(_line_shots(spark, d), "season", "x", "y", F.col("zone_idx") >= 9)


@_query(f"WITH {_LINE_SHOTS} SELECT DISTINCT season, CAST(zone_idx AS INTEGER) AS zone_idx, CAST(zone_idx AS INTEGER) AS got FROM zoned WHERE zone_idx >= 0")
def zone_labels(spark, d):
    """The label of every zone that a season shot from lies in that zone."""
    used = _line_shots(spark, d).where("zone_idx >= 0").select("season", F.col("zone_idx").cast("int").alias("zone_idx")).distinct()
    began = used.withColumn("era", scalar.era_value(F.col("season"), 0))
    places = began.join(F.broadcast(shots.label_places(spark)), ["era", "zone_idx"])  # a row for each zone and era
    got = scalar.zone_index(F.col("x"), F.col("y"), scalar.era_value(F.col("era"), 1), scalar.era_value(F.col("era"), 2))
    return places.select("season", "zone_idx", got.cast("int").alias("got"))


@_query(f"WITH {_SHOTS} SELECT vec_id, zone_idx, CASE WHEN label % 3 = 0 THEN 3 WHEN label % 3 = 1 THEN 2 WHEN zone_idx >= 9 THEN 3 ELSE 2 END AS shot_value FROM zoned WHERE zone_idx >= 0 AND y BETWEEN 0 AND 420")
def prepared_feed(spark, d):
    """A raw shot feed in its own era, half court only, valued by the feed."""
    kind = F.when(F.col("label") % 3 == 0, "3PT Field Goal").when(F.col("label") % 3 == 1, "2PT Field Goal")
    raw = _shots(spark, d).select("vec_id", "season", F.col("x").alias("LOC_X"), F.col("y").alias("LOC_Y"), F.col("made").alias("SHOT_MADE_FLAG"), kind.alias("SHOT_TYPE"))
    return shots.half_court(shots.prepared_feed(raw, "season"), "LOC_Y").select("vec_id", "zone_idx", "shot_value")


_Z = ", ".join(f"embedding[{i + 1}]::DOUBLE*12 AS {f}" for i, f in enumerate(archetypes.FEATURES))


_NAMES = """CASE WHEN BLK > 2.0 AND USG_PCT > 1.4 THEN 'Dominant Two-Way Big'
  WHEN USG_PCT > 0.7 AND BLK > 0.8 AND OREB_PCT > 0.6 AND TS_PCT > 0.5 THEN 'Versatile Two-Way Forward'
  WHEN BLK > 1.4 AND OREB_PCT > 1.5 THEN 'Traditional Rim Protector'
  WHEN USG_PCT > 0.9 AND DREB_PCT > 1.0 AND TS_PCT < 0 THEN 'High-Usage Frontcourt'
  WHEN OREB_PCT > 1.0 AND FG3A < -1.0 AND USG_PCT < 0 THEN 'Glass Cleaner / Rebounder'
  WHEN E_TOV_PCT > 1.0 AND AST_TO < -0.8 AND DREB_PCT > 0.2 THEN 'Turnover-Prone Frontcourt'
  WHEN greatest(OREB_PCT - 0.7, DREB_PCT - 0.9, BLK - 0.8) > 0 THEN CASE WHEN FG3A < 0 THEN 'Interior Frontcourt' ELSE 'Frontcourt Contributor' END
  WHEN AST_PCT > 1.0 AND AST_TO > 0.8 THEN 'Playmaking Guard'
  WHEN AST_PCT > 0.8 AND E_TOV_PCT > 0.6 THEN 'Combo Guard / Facilitator'
  WHEN FG3A > 0.9 AND USG_PCT > 0.5 AND E_TOV_PCT < 0 THEN 'High-Volume Guard / Shot Creator'
  WHEN USG_PCT > 0.7 AND OREB_PCT > 0 AND FG3A > 0.4 THEN 'Wing Primary Option'
  WHEN USG_PCT > 0.7 AND FG3A < 0 THEN 'High-Usage Athletic Wing'
  WHEN STL > 0.7 AND TS_PCT < -0.4 THEN 'Defensive Perimeter Wing'
  WHEN FG3A > 0.6 AND TS_PCT < -1.0 THEN '3PT Volume Shooter'
  WHEN USG_PCT < -0.8 AND TS_PCT > 0 THEN 'Efficient Role Player'
  WHEN STL < -0.5 AND TS_PCT < -0.2 THEN 'Secondary Wing / Developing'
  WHEN USG_PCT < -0.4 THEN 'Role Wing' ELSE 'Multi-Role Contributor' END"""


@_query(f"WITH z AS (SELECT vec_id, {_Z} FROM embeddings) SELECT vec_id, {_NAMES} AS archetype FROM z")
def archetype_names(spark, d):
    """Names by the first rule that holds."""
    z = [(F.get("embedding", F.lit(i)).cast("double") * 12).alias(f) for i, f in enumerate(archetypes.FEATURES)]
    return _t(spark, d, "embeddings").select("vec_id", *z).select("vec_id", archetypes.archetype().alias("archetype"))


@_query("""WITH w AS (SELECT median(p_size) AS m, stddev_samp(p_size) AS s FROM part) SELECT p_brand AS cluster, count(*) AS n, round((median(p_size) - max(m))/max(s), 6) AS p_size FROM part, w GROUP BY 1""")
def cluster_profiles(spark, d):
    """A cluster's medians against the league's."""
    p = archetypes.profiles(_t(spark, d, "part").select(F.col("p_brand").alias("cluster"), "p_size"), "cluster", ("p_size",))
    return p.select("cluster", "n", F.round("p_size", 6).alias("p_size"))


@_query("""WITH e AS (SELECT vec_id, embedding[1]::DOUBLE**2 AS a, embedding[2]::DOUBLE**2 AS b, embedding[3]::DOUBLE**2 AS c FROM embeddings), l AS (SELECT vec_id, unnest(['Big', 'Wing', 'Guard']) AS n, unnest([a, b, c])/(a+b+c) AS s, unnest([1, 2, 3]) AS i FROM e),
 k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, i) AS r FROM l) SELECT vec_id, string_agg(n || ' (' || CAST(CAST(round_even(s*100, 0) AS INTEGER) AS VARCHAR) || '%)', ' / ' ORDER BY r) AS text FROM k WHERE r = 1 OR s >= 0.2 GROUP BY 1""")
def leading_archetypes(spark, d):
    """A player's largest shares in words."""
    v = [F.pow(F.get("embedding", F.lit(i)).cast("double"), F.lit(2.0)) for i in range(3)]
    share = F.array(*(x / (v[0] + v[1] + v[2]) for x in v))
    return _t(spark, d, "embeddings").select("vec_id", archetypes.leading_shares(F.array(*map(F.lit, ("Big", "Wing", "Guard"))), share).alias("text"))


@_query("SELECT l_suppkey, round(avg(l_discount*l_tax), 8) AS impact FROM lineitem GROUP BY 1")
def player_impact(spark, d):
    """The mean of a product over a player's rows."""
    return maps.impact(_t(spark, d, "lineitem"), "l_suppkey", "l_discount", "l_tax").select("l_suppkey", F.round("impact", 8).alias("impact"))


@_query("SELECT c_custkey, c_name, c_acctbal, n_name FROM customer LEFT JOIN (SELECT n_nationkey AS k, n_name FROM nation WHERE n_regionkey > 1) n ON n.k = c_nationkey")
def season_merge(spark, d):
    """A base table with the columns of others that it lacks."""
    c = _t(spark, d, "customer")
    style = c.select("c_custkey", "c_name", "c_acctbal")
    more = c.join(_t(spark, d, "nation").where("n_regionkey > 1").withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey").select("c_custkey", "c_name", "n_name")
    return archetypes.joined_season(c.select("c_custkey", "c_name"), style, more, "c_custkey").select("c_custkey", "c_name", "c_acctbal", "n_name")


# ---------------------------------------------------------------- row rules


@_query("""SELECT c_custkey, CAST(round_even(c_acctbal, 0) AS BIGINT) AS whole, round_even(c_acctbal/7.3, 1) AS one, CASE WHEN c_acctbal < 0 THEN 1.5 ELSE c_acctbal END AS known,
 CASE c_mktsegment WHEN 'BUILDING' THEN 'player-stats.json' WHEN 'MACHINERY' THEN 'player-stats-playoffs.json' WHEN 'FURNITURE' THEN 'player-stats-all.json' END AS file FROM customer""")
def number_rules(spark, d):
    """Integers, roundings, unknown numbers and file names."""
    v, segment = F.col("c_acctbal"), F.col("c_mktsegment")
    scope = F.when(segment == "BUILDING", "reg").when(segment == "MACHINERY", "playoffs").when(segment == "FURNITURE", "all")
    known = scalar.known_number(F.when(v < 0, F.lit(float("nan"))).otherwise(v), F.lit(1.5))
    return _t(spark, d, "customer").select("c_custkey", scalar.whole_number(v).alias("whole"), scalar.rounded(v / 7.3, 1).alias("one"), known.alias("known"), scalar.scope_file("player-stats", scope).alias("file"))


@_query("SELECT s_suppkey, CASE WHEN s_acctbal > 0 THEN s_acctbal ELSE 221.5 END AS arc, CASE WHEN s_acctbal - 100 > 0 THEN s_acctbal - 100 WHEN s_acctbal > 0 THEN s_acctbal ELSE 221.5 END AS corner FROM supplier")
def drawn_geometry(spark, d):
    """Radii to draw with, whatever is stored."""
    arc, corner = scalar.drawn_geometry(F.col("s_acctbal"), F.col("s_acctbal") - 100)
    return _t(spark, d, "supplier").select("s_suppkey", arc.alias("arc"), corner.alias("corner"))


@_query("""SELECT o_orderkey, upper(concat_ws(' ', o_orderstatus, o_orderpriority, CASE WHEN o_orderkey % 2 = 0 THEN 'n' END)) AS stint, concat_ws(' ', o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN 'n' END, o_orderpriority) AS box,
 CASE WHEN o_orderkey % 4 = 0 THEN (o_orderkey % 48)*60.0 + o_orderkey % 60 WHEN o_orderkey % 4 = 1 THEN (o_orderkey % 48)*60.0 WHEN o_orderkey % 4 = 2 THEN 0 END AS secs, CAST(o_orderkey % 90 + o_custkey % 90 AS INTEGER) AS total FROM orders""")
def text_rules(spark, d):
    """Descriptions in both orders, official minutes and scores."""
    k, n = F.col("o_orderkey"), F.when(F.col("o_orderkey") % 2 == 0, "n")
    whole, part = (k % 48).cast("string"), (k % 60).cast("string")
    minutes = F.when(k % 4 == 0, F.concat(whole, F.lit(".000000:"), part)).when(k % 4 == 1, whole).when(k % 4 == 2, " ").otherwise("DNP")
    score = F.concat_ws("-", (k % 90).cast("string"), (F.col("o_custkey") % 90).cast("string"))
    return _t(spark, d, "orders").select(
        "o_orderkey", scalar.stint_description(F.col("o_orderstatus"), F.col("o_orderpriority"), n).alias("stint"), scalar.box_description(F.col("o_orderstatus"), n, F.col("o_orderpriority")).alias("box"),
        scalar.minutes_seconds(minutes).alias("secs"), scalar.score_total(score).alias("total"),
    )


@_query("SELECT user_id, CAST(max(value) FILTER (event_type = 'purchase') AS DOUBLE) AS best, count(*) FILTER (event_type = 'click') AS clicks FROM events GROUP BY 1")
def pivoted_counts(spark, d):
    """Counts and maxima by kind, one row a key."""
    return _t(spark, d, "events").groupBy("user_id").agg(F.max(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("best"), F.count_if(F.col("event_type") == "click").alias("clicks"))


@_query()
def sampled_games(spark, d):
    """Twenty games drawn by a seed (T5): the hash of seed and game orders them, so a sample can be repeated."""
    return _t(spark, d, "orders").select("o_orderkey").orderBy(F.xxhash64(F.lit(7), "o_orderkey"), "o_orderkey").limit(20)


@_query()
def density_clusters(spark, d):
    """Clusters of all embeddings by density, noise apart (L10); tests hold them against a plain version."""
    points = _t(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("x"))
    return density.clusters(points, "vec_id", "x")


@_query("""WITH s AS (SELECT l_orderkey, l_linenumber, l_linestatus AS scope, CASE WHEN l_suppkey % 3 = 0 THEN NULL WHEN l_suppkey % 7 = 1 THEN l_suppkey + 100000 ELSE l_suppkey END AS player,
  CASE WHEN l_suppkey % 5 = 0 THEN 'other ' || l_suppkey ELSE 'name ' || l_suppkey END AS name FROM lineitem),
 p AS (SELECT s_suppkey AS player, 'name ' || s_suppkey AS name, scope FROM supplier, (SELECT DISTINCT scope FROM s)),
 k AS (SELECT p.*, EXISTS (SELECT 1 FROM s WHERE s.scope = p.scope AND s.player = p.player) AS has FROM p)
 SELECT l_orderkey, l_linenumber, k.player, s.name AS shot_name FROM s JOIN k ON k.scope = s.scope AND ((has AND s.player = k.player) OR (NOT has AND s.name = k.name))""")
def shots_of_players(spark, d):
    """Shots joined by id, and by name for players whose id no shot has."""
    key = F.col("l_suppkey")
    named = F.concat(F.when(key % 5 == 0, "other ").otherwise("name "), key.cast("string"))
    rows = _t(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_linestatus").alias("scope"), F.when(key % 3 == 0, F.lit(None)).when(key % 7 == 1, key + 100000).otherwise(key).alias("player"), named.alias("name")
    )
    players = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("player"), F.concat(F.lit("name "), F.col("s_suppkey").cast("string")).alias("name"))
    players = players.join(F.broadcast(rows.select("scope").distinct()))  # a row for each line status
    return shots.of_players(rows, players, ["scope"]).select("l_orderkey", "l_linenumber", "player", "shot_name")
