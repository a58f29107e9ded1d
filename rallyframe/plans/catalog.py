"""Registered queries: each operator on the driver's tables, with the same in DuckDB SQL.

Stand-ins: ``events`` for an event log (a user's events are a game), orders with their suppliers
for stints with lineups, supplier nations for teams, embedding components for shot places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rallyframe.functions import scalar
from rallyframe.operators import intervals, lineups, models, ordering, ranks, reconcile, shots, solve, state
from rallyframe.sources.stored import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "zone_vs_baseline"


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# ---------------------------------------------------------------- stand-ins


def _shots(spark, d):
    """x, y, made, points, season, label, vec_id from the first embedding components."""
    e = _t(spark, d, "embeddings")
    return e.select(
        "vec_id",
        "label",
        (F.get("embedding", F.lit(0)).cast("double") * 900).alias("x"),
        (F.get("embedding", F.lit(1)).cast("double") * 900).alias("y"),
        (F.get("embedding", F.lit(2)) > 0).cast("int").alias("made"),
        (F.lit(1997) + F.col("vec_id") % 28).cast("int").alias("season"),
    ).withColumn("points", F.col("made") * 2)


_SHOTS = """shots AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE)*900 AS x, CAST(embedding[2] AS DOUBLE)*900 AS y,
 CAST(embedding[3] > 0 AS INTEGER) AS made, CAST(1997 + vec_id % 28 AS INTEGER) AS season, 2*CAST(embedding[3] > 0 AS INTEGER) AS points FROM embeddings),
 geo AS (SELECT *, sqrt(x*x+y*y) AS r, CASE WHEN degrees(atan2(y,x)) < -90 THEN degrees(atan2(y,x))+360 ELSE degrees(atan2(y,x)) END AS a,
  CASE WHEN season >= 2013 THEN 221.5 WHEN season >= 2004 THEN 205.2 ELSE 197.5 END AS arc,
  CASE WHEN season >= 2013 THEN 220.0 WHEN season >= 2004 THEN 205.2 ELSE 197.5 END AS corner FROM shots),
 zoned AS (SELECT *, CASE WHEN r >= 400 THEN -1 WHEN r < 40 THEN 0
  WHEN r >= arc OR (corner < arc AND abs(x) >= corner AND y <= sqrt(greatest(arc*arc-corner*corner,0))) THEN 9 + CAST(least(greatest(floor(a/36),0),4) AS INTEGER)
  WHEN r < 110 THEN 1 + CAST(least(greatest(floor(a/60),0),2) AS INTEGER) ELSE 4 + CAST(least(greatest(floor(a/36),0),4) AS INTEGER) END AS zone_idx FROM geo)"""


def _stints(spark, d):
    """An order as a stint: its suppliers' lineup, team (first supplier's nation), year and sums."""
    li = _t(spark, d, "lineitem")
    s = li.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_set("l_suppkey")).alias("lineup"),
        F.sum("l_quantity").alias("qty"),
        F.count("*").alias("n"),
        F.min("l_suppkey").alias("lead_supp"),
        F.year(F.min("l_shipdate")).alias("season"),
    )
    team = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("lead_supp"), F.col("s_nationkey").alias("team"))
    return s.join(team, "lead_supp")


_STINTS = """stints AS (SELECT l_orderkey, list_sort(list_distinct(list(l_suppkey))) AS lineup, sum(l_quantity) AS qty, count(*) AS n,
 min(l_suppkey) AS lead_supp, year(min(l_shipdate)) AS season FROM lineitem GROUP BY l_orderkey),
 st AS (SELECT s.*, s_nationkey AS team FROM stints s JOIN supplier ON s_suppkey = lead_supp)"""


# ---------------------------------------------------------------- scans, filters, row logic


@_query("SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_discount > 0.05")
def scan_project_filter(spark, d):
    li = _t(spark, d, "lineitem").where((F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz")) & (F.col("l_discount") > 0.05))
    return li.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")


@_query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedup_full_row(spark, d):
    return _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber").dropDuplicates()


@_query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
 ORDER BY l_partkey DESC, l_suppkey DESC) AS r FROM lineitem) WHERE r = 1""")
def dedup_keep_last(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return ordering.keep_first(li, ["l_orderkey", "l_linenumber"], [F.desc("l_partkey"), F.desc("l_suppkey")])


@_query("SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM events")
def chronological_order(spark, d):
    return ordering.chronological(_t(spark, d, "events").select("event_id", "user_id", "ts"), ["user_id"], ["ts", "event_id"]).drop("ts")


@_query("""SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST((event_id % 12)*60 + event_id % 60 AS DOUBLE) END AS remaining,
 CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(least(event_id % 6, 4)*600 + greatest(event_id % 6 - 4, 0)*300 AS DOUBLE)
 + CASE WHEN event_id % 6 + 1 <= 4 THEN 600 ELSE 300 END - CAST((event_id % 12)*60 + event_id % 60 AS DOUBLE) END AS elapsed FROM events""")
def clock_parse(spark, d):
    e = _t(spark, d, "events").select("event_id")
    minute, second = (F.col("event_id") % 12).cast("string"), F.lpad((F.col("event_id") % 60).cast("string"), 2, "0")
    clock = F.when(F.col("event_id") % 7 == 0, "bad").otherwise(F.concat(minute, F.lit(":"), second))
    e = e.withColumn("remaining", scalar.clock_seconds(clock))
    period = (F.col("event_id") % 6 + 1).cast("int")
    return e.withColumn("elapsed", scalar.elapsed(period, F.col("remaining"), F.lit(600.0), F.lit(4)))


@_query("""WITH c AS (SELECT user_id, day(ts) AS p, max(value*20) AS top FROM events GROUP BY 1, 2),
 g AS (SELECT user_id, max(top) FILTER (top > 300) AS most, count(*) FILTER (top > 300) AS n FROM c GROUP BY 1)
 SELECT user_id, coalesce(CASE WHEN most <= 600 THEN 600 WHEN most <= 720 THEN 720 WHEN most <= 1200 THEN 1200 ELSE most END, 600) AS regular,
 CAST(CASE WHEN n > 0 THEN n ELSE 4 END AS INTEGER) AS n_regular FROM g""")
def period_scheme(spark, d):
    clocks = _t(spark, d, "events").select("user_id", F.dayofmonth("ts").alias("p"), (F.col("value") * 20).alias("left"))
    return ordering.period_scheme(clocks, "user_id", "p", "left")


@_query("SELECT p_partkey, lower(trim(regexp_replace(lower(p_name || ' & ' || p_type), '[^a-z0-9]+', '-', 'g'), '-')) AS slug FROM part")
def slugify(spark, d):
    return _t(spark, d, "part").select("p_partkey", scalar.slugify(F.concat_ws(" & ", "p_name", "p_type")).alias("slug"))


@_query("""SELECT event_id, CAST(nullif(regexp_extract(props, '"k": *([0-9]+)', 1), '') AS INTEGER) AS k FROM events""")
def regex_extract_counts(spark, d):
    k = F.regexp_extract("props", '"k": *([0-9]+)', 1).try_cast("int")
    return _t(spark, d, "events").select("event_id", k.alias("k"))


@_query("SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN CAST(c_nationkey AS DOUBLE) / c_acctbal END AS ratio FROM customer")
def safe_ratio(spark, d):
    return _t(spark, d, "customer").select("c_custkey", scalar.safe_ratio(F.col("c_nationkey"), F.col("c_acctbal")).alias("ratio"))


@_query("SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS game_id FROM orders")
def padded_ids(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", scalar.padded_id(F.col("o_orderkey")).alias("game_id"))


@_query("""SELECT o_orderkey, 1990 + o_orderkey % 37 AS season, CAST(CASE WHEN o_orderkey % 37 >= 23 THEN 221.5 WHEN o_orderkey % 37 >= 14 THEN 205.2 ELSE 197.5 END AS DOUBLE) AS arc,
 CAST(CASE WHEN o_orderkey % 37 >= 23 THEN 220.0 WHEN o_orderkey % 37 >= 14 THEN 205.2 ELSE 197.5 END AS DOUBLE) AS corner FROM orders""")
def era_lookup(spark, d):
    """The era's radii of each order's season."""
    o = _t(spark, d, "orders").select("o_orderkey", (1990 + F.col("o_orderkey") % 37).alias("season"))
    return o.withColumns({n: scalar.era_value(F.col("season"), i).cast("double") for i, n in ((1, "arc"), (2, "corner"))})


@_query("""SELECT o_orderkey, CASE WHEN upper(o_orderpriority) LIKE '%URGENT%' THEN 0 WHEN upper(o_orderpriority) LIKE '%HIGH%' THEN 1
 ELSE CAST(trim(CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus END) <> '' AS INTEGER) END AS made FROM orders""")
def free_throw_rule(spark, d):
    text = F.regexp_replace(F.regexp_replace(F.upper("o_orderpriority"), "URGENT", "MISS"), "HIGH", "PTS)")
    score = F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus"))
    return _t(spark, d, "orders").select("o_orderkey", scalar.free_throw_made_by_score(text, score).alias("made"))


# ---------------------------------------------------------------- votes


@_query("""WITH c AS (SELECT user_id, event_type, count(*) AS votes, min(event_id) AS seen FROM events GROUP BY 1, 2)
 SELECT user_id, event_type, votes FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY votes DESC, seen) AS r FROM c) WHERE r = 1""")
def majority_vote(spark, d):
    return ordering.majority_vote(_t(spark, d, "events"), ["user_id"], "event_type", "event_id")


@_query("""SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events
 WHERE trim(event_type) <> '') WHERE r = 1""")
def last_name_lookup(spark, d):
    return ordering.last_value(_t(spark, d, "events"), ["user_id"], "event_type", ["ts", "event_id"])


# ---------------------------------------------------------------- intervals


def _asof(spark, d, clamp):
    e = _t(spark, d, "events")
    clicks = e.where("event_type = 'click'").select("event_id", "user_id", "ts")
    starts = e.where("event_type = 'view'").select("user_id", F.col("ts").alias("start"), F.col("event_id").alias("start_id"))
    return intervals.asof(clicks, starts, ["user_id"], "ts", "start", ["start_id"], clamp=clamp).select("event_id", "start_id")


@_query("""SELECT c.event_id, v.event_id AS start_id FROM (SELECT * FROM events WHERE event_type = 'click') c
 ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON c.user_id = v.user_id AND c.ts >= v.ts""")
def asof_backward(spark, d):
    return _asof(spark, d, False)


@_query("""WITH f AS (SELECT user_id, arg_min(event_id, ts) AS f FROM events WHERE event_type = 'view' GROUP BY 1)
 SELECT c.event_id, coalesce(v.event_id, f.f) AS start_id FROM (SELECT * FROM events WHERE event_type = 'click') c
 ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON c.user_id = v.user_id AND c.ts >= v.ts LEFT JOIN f ON f.user_id = c.user_id""")
def asof_clamped(spark, d):
    return _asof(spark, d, True)


@_query("""SELECT user_id, ts AS t_start, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS t_end FROM (SELECT DISTINCT user_id, ts FROM events WHERE event_type = 'view')""")
def interval_build_lead(spark, d):
    return intervals.intervals_from_changes(_t(spark, d, "events").where("event_type = 'view'"), ["user_id"], "ts")


@_query("""WITH x AS (SELECT *, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 y AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM x) SELECT user_id, CAST(run AS BIGINT) AS run, event_type, count(*) AS n FROM y GROUP BY 1, 2, 3""")
def gaps_islands_runs(spark, d):
    return intervals.value_runs(_t(spark, d, "events"), ["user_id"], ["ts", "event_id"], "event_type")


@_query("""WITH s AS (SELECT l_suppkey, CAST(l_orderkey AS DOUBLE) AS a, CAST(l_orderkey + l_linenumber AS DOUBLE) AS b FROM (SELECT DISTINCT l_suppkey, l_orderkey, max(l_linenumber) AS l_linenumber FROM lineitem GROUP BY 1, 2)),
 n AS (SELECT l_suppkey, b, lead(a) OVER (PARTITION BY l_suppkey ORDER BY a) AS next_start FROM s) SELECT l_suppkey, b, next_start FROM n WHERE abs(next_start - b) > 1e-9""")
def interval_continuity(spark, d):
    s = _t(spark, d, "lineitem").groupBy("l_suppkey", "l_orderkey").agg(F.max("l_linenumber").alias("m"))
    s = s.select("l_suppkey", F.col("l_orderkey").cast("double").alias("a"), (F.col("l_orderkey") + F.col("m")).cast("double").alias("b"))
    return intervals.gaps(s, ["l_suppkey"], "a", "b")


@_query("""WITH s AS (SELECT user_id, event_id, CAST(event_id % 50 AS DOUBLE)+0.5 AS a, CAST(event_id % 50 AS DOUBLE) + 1 + value/10 AS b FROM events),
 g AS (SELECT user_id, event_id, unnest(range(CAST(ceil(a) AS BIGINT), CAST(floor(b) AS BIGINT))) AS second FROM s)
 SELECT user_id, second, list_sort(list_distinct(list(event_id)))[1] AS first_member, len(list_distinct(list(event_id))) AS members FROM g GROUP BY 1, 2""")
def second_grid(spark, d):
    at = (F.col("event_id") % 50).cast("double")
    s = _t(spark, d, "events").select("user_id", "event_id", (at + 0.5).alias("a"), (at + 1 + F.col("value") / 10).alias("b"))
    grid = intervals.occupancy(s, ["user_id"], "a", "b", "event_id")
    return grid.select("user_id", "second", F.get("members", F.lit(0)).alias("first_member"), F.size("members").cast("long").alias("members"))


# ---------------------------------------------------------------- ordered state


@_query("""SELECT event_id, coalesce(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS raw FROM events""".replace(
    "coalesce(sum(value)", "round(coalesce(sum(value)").replace(", 0) AS raw", ", 0), 4) AS before"))
def running_score_before(spark, d):
    e = state.running_before(_t(spark, d, "events"), ["user_id"], ["ts", "event_id"], "value", "before")
    return e.select("event_id", F.round("before", 4).alias("before"))


@_query("""WITH s AS (SELECT *, CASE WHEN event_type = 'view' THEN event_id WHEN event_type IN ('purchase', 'error') THEN -1 END AS st FROM events)
 SELECT event_id, nullif(last_value(st IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS pending FROM s""")
def pending_state_with_clear(spark, d):
    e = _t(spark, d, "events")
    kind = F.col("event_type")
    out = state.pending(e, ["user_id"], ["ts", "event_id"], kind == "view", kind.isin("purchase", "error"), F.col("event_id"), "pending")
    return out.select("event_id", "pending")


@_query("""SELECT event_id, coalesce(value > coalesce(max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), false) AS rose FROM events""")
def running_max_rise(spark, d):
    return state.rises(_t(spark, d, "events"), ["user_id"], ["ts", "event_id"], "value", "rose").select("event_id", "rose")


@_query("""WITH r AS (SELECT event_id, user_id, CAST(nullif(regexp_extract(props, '([0-9]+)', 1), '') AS INTEGER) AS o, CAST(day(ts) AS INTEGER) AS f FROM events),
 m AS (SELECT *, coalesce(max(o) OVER w, 0) AS so, coalesce(max(f) OVER w, 0) AS sf FROM r WINDOW w AS (PARTITION BY user_id ORDER BY o, f, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
 SELECT event_id, CASE WHEN o > so THEN 'off' WHEN f > sf THEN 'def' END AS kind FROM m""")
def rebound_resolution(spark, d):
    e = _t(spark, d, "events").select("event_id", "user_id", F.regexp_extract("props", "([0-9]+)", 1).try_cast("int").alias("o"), F.dayofmonth("ts").alias("f"))
    return state.resolve_rebounds(e, ["user_id"], "o", "f", "event_id").select("event_id", "kind")


@_query("""SELECT o_orderkey, unnest(['order', 'urgent']) AS kind, unnest([o_custkey, o_custkey]) AS who FROM orders WHERE o_orderpriority LIKE '1%'
 UNION ALL SELECT o_orderkey, 'order', o_custkey FROM orders WHERE o_orderpriority NOT LIKE '1%'""")
def emit_multi_rows(spark, d):
    urgent = F.col("o_orderpriority").startswith("1")
    entries = F.array(F.struct(F.lit("order").alias("kind"), F.col("o_custkey").alias("who")), F.struct(F.lit("urgent").alias("kind"), F.when(urgent, F.col("o_custkey")).alias("who")))
    return _t(spark, d, "orders").select("o_orderkey", F.inline(F.filter(entries, lambda x: x["who"].isNotNull())))


# ---------------------------------------------------------------- lineups


@_query(f"WITH {_STINTS}, e AS (SELECT unnest(lineup) AS member, qty, n FROM st) SELECT member, sum(qty) AS qty, count(*) AS stints FROM e GROUP BY 1")
def lineup_explode_agg(spark, d):
    return lineups.exploded(_stints(spark, d), "lineup", "member").groupBy("member").agg(F.sum("qty").alias("qty"), F.count("*").alias("stints"))


@_query(f"""WITH {_STINTS} SELECT l_orderkey, array_to_string(list_sort(list_distinct(list_concat(list_filter(lineup, lambda x: x <> lead_supp), [0]))), ',') AS swapped,
 len(lineup) AS size FROM st""")
def lineup_set_algebra(spark, d):
    swapped = lineups.substituted(F.col("lineup"), F.col("lead_supp"), F.lit(0).cast("long"))
    return _stints(spark, d).select("l_orderkey", F.array_join(swapped, ",").alias("swapped"), F.size("lineup").cast("long").alias("size"))


@_query(f"""WITH {_STINTS}, e AS (SELECT unnest(lineup) AS member, team, qty FROM st), t AS (SELECT team, sum(qty) AS all_qty FROM st GROUP BY 1),
 o AS (SELECT member, team, sum(qty) AS on_qty FROM e GROUP BY 1, 2) SELECT o.member, o.team, on_qty, all_qty - on_qty AS off_qty FROM o JOIN t USING (team)""")
def onoff_split(spark, d):
    return lineups.on_off(_stints(spark, d), "team", "lineup", ["qty"])


@_query(f"""WITH {_STINTS}, r AS (SELECT DISTINCT team, unnest(lineup) AS member FROM st), x AS (SELECT r.member, st.team, sum(qty) AS qty FROM r JOIN st USING (team)
 WHERE NOT list_contains(lineup, member) GROUP BY 1, 2), o AS (SELECT r.member, r.team, coalesce(x.qty, 0) AS off_qty FROM r LEFT JOIN x ON x.member = r.member AND x.team = r.team) SELECT * FROM o""")
def roster_anti_membership(spark, d):
    return lineups.on_off(_stints(spark, d), "team", "lineup", ["qty"]).select("member", "team", F.col("off_qty").alias("off_qty"))


@_query(f"""WITH {_STINTS}, e AS (SELECT unnest(lineup) AS member, team, qty FROM st), s AS (SELECT member, team, sum(qty) AS w FROM e GROUP BY 1, 2)
 SELECT member, team FROM (SELECT *, row_number() OVER (PARTITION BY member ORDER BY w DESC, team) AS r FROM s) WHERE r = 1""")
def primary_team_argmax(spark, d):
    return lineups.primary_group(lineups.exploded(_stints(spark, d), "lineup", "member"), "member", "team", "qty")


@_query("""SELECT l_suppkey, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS discount, sum(l_quantity) AS qty FROM lineitem GROUP BY 1""")
def weighted_multi_period_mean(spark, d):
    rows = _t(spark, d, "lineitem").select("l_suppkey", F.col("l_discount").alias("discount"), F.col("l_quantity").alias("qty"))
    return lineups.weighted_mean(rows, ["l_suppkey"], ["discount"], "qty").select("l_suppkey", F.round("discount", 6).alias("discount"), "qty")


@_query("""WITH s AS (SELECT l_orderkey, s_nationkey AS team, sum(l_quantity) AS own FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2)
 SELECT l_orderkey, team, own AS own_qty, sum(own) OVER (PARTITION BY l_orderkey) - own AS opp_qty FROM s""")
def context_two_sided(spark, d):
    team = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("team"))
    li = _t(spark, d, "lineitem").join(team, "l_suppkey").select("l_orderkey", "team", F.col("l_quantity").alias("qty"))
    return lineups.two_sided(li, "l_orderkey", "team", ["qty"])


@_query("""SELECT l_suppkey, coalesce(l_linestatus, 'all') AS scope, sum(l_quantity) AS qty, count(*) AS n FROM lineitem
 GROUP BY GROUPING SETS ((l_suppkey, l_linestatus), (l_suppkey))""")
def scope_grouping_sets(spark, d):
    rows = _t(spark, d, "lineitem").withColumnRenamed("l_linestatus", "scope")
    return lineups.by_scope(rows, ["l_suppkey"], "scope", {"qty": F.sum("l_quantity"), "n": F.count("*")})


_BOX = """b AS (SELECT l_suppkey AS player, count(DISTINCT l_orderkey) AS gp, sum(l_quantity) AS fga, count(*) FILTER (l_returnflag = 'A') AS fgm,
 count(*) FILTER (l_returnflag = 'R') AS fg3m, count(*) FILTER (l_linestatus = 'O') AS fta, count(*) FILTER (l_linestatus = 'F') AS tov FROM lineitem GROUP BY 1)"""


def _box(spark, d):
    flag = lambda c, v: F.count_if(F.col(c) == v)
    return (
        _t(spark, d, "lineitem")
        .groupBy(F.col("l_suppkey").alias("player"))
        .agg(
            F.count_distinct("l_orderkey").alias("gp"),
            F.sum("l_quantity").alias("fga"),
            flag("l_returnflag", "A").alias("fgm"),
            flag("l_returnflag", "R").alias("fg3m"),
            flag("l_linestatus", "O").alias("fta"),
            flag("l_linestatus", "F").alias("tov"),
        )
    )


@_query(f"""WITH {_BOX} SELECT player, round(fgm/fga*100, 6) AS fg_pct, round((fgm+0.5*fg3m)/fga*100, 6) AS efg, round((2*fgm+fg3m)/(2*(fga+0.44*fta))*100, 6) AS ts,
 round(fga+0.44*fta+tov, 6) AS uses, round(tov/(fga+0.44*fta+tov)*100, 6) AS tov_pct FROM b""")
def rate_table(spark, d):
    fgm, fga, three, fta, tov = (F.col(c) for c in ("fgm", "fga", "fg3m", "fta", "tov"))
    uses = fga + 0.44 * fta + tov
    pct = lambda n, den: F.round(scalar.safe_ratio(n, den) * 100, 6)
    return _box(spark, d).select(
        "player", pct(fgm, fga).alias("fg_pct"), pct(fgm + 0.5 * three, fga).alias("efg"), pct(2 * fgm + three, 2 * (fga + 0.44 * fta)).alias("ts"),
        F.round(uses, 6).alias("uses"), pct(tov, uses).alias("tov_pct"),
    )


@_query(f"WITH {_BOX} SELECT player, round(fgm/(fga-tov+0.44*fta)*100, 6) AS fgm_100, round(CAST(fgm AS DOUBLE)/gp, 6) AS fgm_pg FROM b WHERE fga-tov+0.44*fta > 0")
def per100_rates(spark, d):
    b = _box(spark, d).withColumn("poss", scalar.possessions(F.col("fga"), F.lit(0), -F.col("tov"), F.col("fta")))
    return b.where("poss > 0").select(
        "player", F.round(scalar.safe_ratio(F.col("fgm"), F.col("poss")) * 100, 6).alias("fgm_100"), F.round(scalar.safe_ratio(F.col("fgm"), F.col("gp")), 6).alias("fgm_pg")
    )


# ---------------------------------------------------------------- shots


@_query(f"WITH {_SHOTS} SELECT vec_id, zone_idx FROM zoned WHERE zone_idx >= 0")
def zone_classify(spark, d):
    return shots.prepared(_shots(spark, d), "x", "y", "season").select("vec_id", "zone_idx")


@_query(f"WITH {_SHOTS} SELECT label, zone_idx, CAST(sum(made) AS BIGINT) AS fgm, count(*) AS fga, CAST(sum(points) AS BIGINT) AS pts FROM zoned WHERE zone_idx >= 0 GROUP BY 1, 2")
def zone_rollup(spark, d):
    return shots.zone_table(shots.prepared(_shots(spark, d), "x", "y", "season"), ["label"], "made", "points")


_DENSE = """lg AS (SELECT season, zone_idx, sum(made) AS m, count(*) AS a FROM zoned WHERE zone_idx >= 0 GROUP BY 1, 2),
 dense AS (SELECT s.season, CAST(z.z AS INTEGER) AS zone_idx FROM (SELECT DISTINCT season FROM zoned WHERE zone_idx >= 0) s, (SELECT unnest(range(14)) AS z) z)"""


@_query(f"WITH {_SHOTS}, {_DENSE} SELECT season, zone_idx, coalesce(a, 0) AS lg_fga, CAST(m AS DOUBLE)/a AS lg_pct FROM dense LEFT JOIN lg USING (season, zone_idx)")
def zone_rollup_dense(spark, d):
    return shots.baselines(shots.prepared(_shots(spark, d), "x", "y", "season"), "season", "made")


@_query(f"""WITH {_SHOTS}, {_DENSE}, t AS (SELECT label, season, zone_idx, CAST(sum(made) AS BIGINT) AS fgm, count(*) AS fga FROM zoned WHERE zone_idx >= 0 GROUP BY 1, 2, 3)
 SELECT label, season, zone_idx, fgm, fga, round(CAST(fgm AS DOUBLE)/fga - CAST(m AS DOUBLE)/a, 6) AS vs_lg FROM t JOIN lg USING (season, zone_idx)""")
def zone_vs_baseline(spark, d):
    s = shots.prepared(_shots(spark, d), "x", "y", "season")
    table = shots.zone_table(s, ["label", "season"], "made", "points").join(shots.baselines(s, "season", "made"), ["season", "zone_idx"])
    return table.select("label", "season", "zone_idx", "fgm", "fga", F.round(F.col("fgm") / F.col("fga") - F.col("lg_pct"), 6).alias("vs_lg"))


@_query(f"""WITH {_SHOTS}, t AS (SELECT label, season, count(*) AS fga FROM zoned WHERE zone_idx >= 0 GROUP BY 1, 2), s AS (SELECT *, sum(fga) OVER (PARTITION BY season) AS tot FROM t)
 SELECT label, season, fga, round(fga/tot, 6) AS share FROM s WHERE tot >= 5""")
def group_share_after_floor(spark, d):
    t = shots.prepared(_shots(spark, d), "x", "y", "season").groupBy("label", "season").agg(F.count("*").alias("fga"))
    return ranks.share_after_floor(t, ["season"], "fga", 5, "share").withColumn("share", F.round("share", 6))


@_query(f"""WITH {_SHOTS}, t AS (SELECT season, label, CAST(sum(points) AS BIGINT) AS pts FROM zoned WHERE zone_idx >= 0 GROUP BY 1, 2)
 SELECT season, label, pts FROM (SELECT *, row_number() OVER (PARTITION BY season ORDER BY pts DESC, label) AS r FROM t WHERE pts > 0) WHERE r = 1""")
def territory_top1(spark, d):
    t = shots.prepared(_shots(spark, d), "x", "y", "season").groupBy("season", "label").agg(F.sum("points").alias("pts"))
    return shots.territory(t, ["season"], "label", "pts")


@_query(f"""WITH {_SHOTS}, b AS (SELECT label, floor(x/100) AS bx, floor(y/100) AS bw, count(*) AS n FROM shots GROUP BY 1, 2, 3),
 o AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n, bx, bw) - 1 AS i, count(*) OVER (PARTITION BY label) AS c FROM b)
 SELECT label, n AS ceiling FROM o WHERE i = least(CAST(floor(c*0.98) AS BIGINT), c-1)""")
def hist2d_ceiling(spark, d):
    return shots.density_ceiling(_shots(spark, d), ["label"], "x", "y", 100, 0.98)


@_query(f"WITH {_SHOTS} SELECT label, round(avg(CASE WHEN abs(x) < 20 AND abs(y) < 20 THEN 1.0 ELSE 0.0 END), 6) AS share FROM shots GROUP BY 1")
def sentinel_share(spark, d):
    near = (F.abs("x") < 20) & (F.abs("y") < 20)
    return _shots(spark, d).groupBy("label").agg(F.round(F.avg(F.when(near, 1.0).otherwise(0.0)), 6).alias("share"))


@_query(f"""WITH {_SHOTS}, t AS (SELECT label, zone_idx, CAST(sum(made) AS INTEGER) AS m, CAST(count(*) AS INTEGER) AS a FROM zoned WHERE zone_idx >= 0 GROUP BY 1, 2)
 SELECT label, '[' || string_agg('[' || zone_idx || ',' || m || ',' || a || ']', ',' ORDER BY zone_idx) || ']' AS records FROM t GROUP BY 1""")
def zone_records(spark, d):
    r = shots.zone_records(shots.prepared(_shots(spark, d), "x", "y", "season"), ["label"], "made")
    return r.select("label", F.to_json("records").alias("records"))


# ---------------------------------------------------------------- ranks and statistics


@_query("""WITH p AS (SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'),
 r AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY c_nationkey) > 1 THEN 100*percent_rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal) END AS pct FROM p)
 SELECT c_custkey, round(pct, 6) AS pct FROM r""")
def percentile_rank_pool(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    pool = F.col("c_mktsegment") == "BUILDING"
    out = ranks.pool_percentiles(c, pool, "c_nationkey", "c_acctbal", "pct")
    return out.where(pool).select("c_custkey", F.round("pct", 6).alias("pct"))


@_query("""WITH p AS (SELECT c_nationkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING')
 SELECT c.c_custkey, round(CASE WHEN count(p.c_acctbal) > 1 THEN 100.0*count(*) FILTER (p.c_acctbal > c.c_acctbal)/(count(p.c_acctbal)-1) END, 6) AS pct
 FROM customer c LEFT JOIN p ON p.c_nationkey = c.c_nationkey WHERE c.c_mktsegment <> 'BUILDING' GROUP BY c.c_custkey""")
def percentile_rank_nonmember(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    pool = F.col("c_mktsegment") == "BUILDING"
    out = ranks.pool_percentiles(c, pool, "c_nationkey", "c_acctbal", "pct", low_is_good=True)
    return out.where(~pool).select("c_custkey", F.round("pct", 6).alias("pct"))


@_query("""WITH s AS (SELECT c_nationkey, median(c_acctbal) AS m, stddev_samp(c_acctbal) AS sd FROM customer GROUP BY 1)
 SELECT c_custkey, round(CASE WHEN sd > 0 THEN (c_acctbal - m)/sd ELSE 0 END, 5) AS z FROM customer JOIN s USING (c_nationkey)""")
def zscore_within_group(spark, d):
    return ranks.zscores(_t(spark, d, "customer"), "c_nationkey", "c_acctbal", "z").select("c_custkey", F.round("z", 5).alias("z"))


@_query("""SELECT event_type, round(quantile_cont(value, 0.01), 6) AS p01, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90 FROM events GROUP BY 1""")
def exact_quantiles(spark, d):
    """Quantiles by selection."""
    q = ranks.quantiles(_t(spark, d, "events"), ["event_type"], "value", {"p01": 0.01, "p50": 0.5, "p90": 0.9})
    return q.select("event_type", *(F.round(c, 6).alias(c) for c in ("p01", "p50", "p90")))


@_query("""SELECT event_id, dense_rank() OVER (ORDER BY value) - 1 AS code, round(CASE WHEN count(*) FILTER (user_id % 3 = 0) OVER () > 1
  THEN 100.0 * (rank() OVER (ORDER BY value) - 1 - count(*) FILTER (user_id % 3 <> 0) OVER (ORDER BY value RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP)) / (count(*) FILTER (user_id % 3 = 0) OVER () - 1) END, 6) AS pct FROM events""")
def ranks_of_one_group(spark, d):
    """Dense codes and percentile ranks in one group that holds the whole table; no task sorts it."""
    e = _t(spark, d, "events").select("event_id", "value", "user_id", F.lit(1).alias("g"))
    coded = ranks.dense_codes(e, [], "value", "code")
    out = ranks.spread_percentiles(coded, F.col("user_id") % 3 == 0, "g", "value", "pct")
    return out.select("event_id", "code", F.round("pct", 6).alias("pct"))


@_query("SELECT p_brand, round(corr(p_size, p_retailprice), 5) AS r, count(*) AS n FROM part GROUP BY 1")
def corr_pairs(spark, d):
    return _t(spark, d, "part").groupBy("p_brand").agg(F.round(F.corr("p_size", "p_retailprice"), 5).alias("r"), F.count("*").alias("n"))


@_query("SELECT s_nationkey, s_suppkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS rank FROM supplier) WHERE rank <= 3")
def topk_per_group(spark, d):
    s = _t(spark, d, "supplier").select("s_nationkey", "s_suppkey", "s_acctbal")
    return ordering.top_per_group(s, ["s_nationkey"], [F.desc("s_acctbal"), F.col("s_suppkey")], 3).drop("s_acctbal")


@_query("SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY nullif(c_acctbal, greatest(c_acctbal, 0)) DESC NULLS LAST, c_custkey) AS place FROM customer")
def ranked_nulls_last(spark, d):
    c = _t(spark, d, "customer").withColumn("v", F.when(F.col("c_acctbal") < 0, F.col("c_acctbal")))
    return ordering.chronological(c, ["c_nationkey"], [F.desc_nulls_last("v"), F.col("c_custkey")], "place").select("c_custkey", "place")


# ---------------------------------------------------------------- reconciliation


@_query("""WITH a AS (SELECT l_orderkey AS k, round(sum(l_extendedprice), 2) AS v FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1), b AS (SELECT o_orderkey AS k, o_totalprice AS v FROM orders WHERE o_orderstatus <> 'F')
 SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'ours' WHEN a.k IS NULL THEN 'theirs' ELSE 'both' END AS side, round(a.v - b.v, 2) AS diff_v FROM a FULL JOIN b ON a.k = b.k""")
def full_outer_reconcile(spark, d):
    """Orders with returned items against orders that are open: each side has some that the other lacks."""
    a = _t(spark, d, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("k")).agg(F.round(F.sum("l_extendedprice"), 2).alias("v"))
    b = _t(spark, d, "orders").where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    return reconcile.full_compare(a, b, ["k"], ["v"]).withColumn("diff_v", F.round("diff_v", 2))


@_query("""WITH ours AS (SELECT CASE WHEN c_acctbal < 0 THEN -c_custkey ELSE c_custkey END AS id, c_name AS name FROM customer), theirs AS (SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_mktsegment <> 'BUILDING'),
 n AS (SELECT name, min(id) AS other FROM theirs GROUP BY 1) SELECT o.name, CASE WHEN t.id IS NULL THEN coalesce(n.other, o.id) ELSE o.id END AS id FROM ours o LEFT JOIN theirs t ON t.id = o.id LEFT JOIN n ON n.name = o.name""")
def name_fallback_join(spark, d):
    c = _t(spark, d, "customer")
    ours = c.select(F.when(F.col("c_acctbal") < 0, -F.col("c_custkey")).otherwise(F.col("c_custkey")).alias("id"), F.col("c_name").alias("name"))
    theirs = c.where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return reconcile.with_name_fallback(ours, theirs, "id", "name").select("name", "id")


@_query("""WITH y AS (SELECT l_suppkey, year(l_shipdate) AS season, sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2)
 SELECT a.l_suppkey, a.season, a.qty AS qty, b.qty AS next_qty FROM y a JOIN y b ON a.l_suppkey = b.l_suppkey AND b.season = a.season + 1""")
def season_pair_selfjoin(spark, d):
    y = _t(spark, d, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("season")).agg(F.sum("l_quantity").alias("qty"))
    b = y.select("l_suppkey", (F.col("season") - 1).alias("season"), F.col("qty").alias("next_qty"))
    return y.join(b, ["l_suppkey", "season"])


@_query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def left_anti_missing(spark, d):
    o = _t(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return _t(spark, d, "customer").join(o, "c_custkey", "left_anti").select("c_custkey")


@_query("SELECT p_partkey FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R') AND EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_linestatus = 'O')")
def left_semi_both_cached(spark, d):
    li = _t(spark, d, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    part = _t(spark, d, "part").select("p_partkey")
    return part.join(li.where("l_returnflag = 'R'"), "p_partkey", "left_semi").join(li.where("l_linestatus = 'O'"), "p_partkey", "left_semi")


@_query("SELECT (SELECT max(n) FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey)) * (SELECT count(*) FROM nation) / 2.0 / (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS ratio")
def feed_alignment_ratio(spark, d):
    most = _t(spark, d, "orders").groupBy("o_custkey").count().agg(F.max("count").alias("m"))
    teams = _t(spark, d, "nation").agg(F.count("*").alias("t"))
    games = _t(spark, d, "lineitem").agg(F.count_distinct("l_orderkey").alias("g"))
    return games.select((most.scalar() * teams.scalar() / F.lit(2.0) / F.col("g")).alias("ratio"))


@_query("SELECT strftime(coalesce(max(l_shipdate), TIMESTAMP '1998-05-01'), '%Y-%m-%d') AS stamp FROM lineitem")
def data_freshness(spark, d):
    return _t(spark, d, "lineitem").agg(F.date_format(F.coalesce(F.max("l_shipdate"), F.lit("1998-05-01").cast("timestamp_ntz")), "yyyy-MM-dd").alias("stamp"))


@_query("SELECT s_suppkey AS id, s_name AS name, 'supplier' AS kind, NULL::VARCHAR AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, 'customer', c_mktsegment FROM customer")
def union_by_name(spark, d):
    a = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("supplier").alias("kind"))
    b = _t(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("customer").alias("kind"), F.col("c_mktsegment").alias("segment"))
    return a.unionByName(b, allowMissingColumns=True)


@_query("""SELECT n_regionkey, '[' || string_agg('{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}', ',' ORDER BY n_name) || ']' AS doc FROM nation GROUP BY 1""")
def json_document(spark, d):
    return reconcile.document(_t(spark, d, "nation"), ["n_regionkey"], ["n_nationkey", "n_name"], ["n_name"])


@_query("SELECT c_custkey, dense_rank() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment) - 1 AS code FROM customer")
def dictionary_encode(spark, d):
    code = F.dense_rank().over(Window.partitionBy("c_nationkey").orderBy("c_mktsegment")) - 1
    return _t(spark, d, "customer").select("c_custkey", code.cast("long").alias("code"))


# ---------------------------------------------------------------- models


def _design(spark, d):
    """Long design rows of orders by supplier nation: row, col, w, y, fold; and the rows alone."""
    li = _t(spark, d, "lineitem")
    rows = li.groupBy(F.col("l_orderkey").alias("row")).agg(F.sum("l_quantity").alias("w"), F.avg("l_discount").alias("y"), F.collect_set("l_suppkey").alias("s"))
    nation = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("supp"), F.col("s_nationkey").alias("col"))
    rows = rows.withColumns({"fold": F.pmod(F.col("row"), F.lit(5)).cast("int")})
    long = rows.select("row", "w", "y", "fold", F.explode("s").alias("supp")).join(nation, "supp").select("row", "col", "w", "y", "fold").distinct()
    return long, rows.drop("s")


@_query("""WITH r AS (SELECT l_orderkey AS row, sum(l_quantity) AS w FROM lineitem GROUP BY 1), x AS (SELECT DISTINCT l_orderkey AS row, s_nationkey AS col FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)
 SELECT a.col AS i, b.col AS j, sum(w) AS w FROM x a JOIN x b ON a.row = b.row AND a.col <= b.col JOIN r ON r.row = a.row GROUP BY 1, 2""")
def gram_matrix(spark, d):
    return models.gram(_design(spark, d)[0], "row", "col", "w")


def _packed(spark, d):
    """Orders by supplier nation as ``solve`` reads them, stored: row, w, y, fold, mask, cols."""
    nation = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("col"))
    lines = _t(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity", "l_discount").join(nation, "l_suppkey", "left")
    rows = lines.groupBy(F.col("l_orderkey").alias("row")).agg(F.sum("l_quantity").cast("double").alias("w"), F.avg("l_discount").alias("y"), F.collect_set("col").alias("cols"))
    return written(rows.withColumns({"fold": F.pmod(F.col("row"), F.lit(5)).cast("int"), "mask": F.lit(0).cast("long")}), "design")


def _residuals(spark, rows, alpha):
    problems = [solve.Problem(alpha)]
    fits = solve.ridges(rows, problems)
    left = solve.frame(spark, solve.Fits(fits.columns, solve.residuals(problems, fits), fits.means, fits.iterations, fits.blocks))
    return left.select("col", (F.round("beta", 7) + 0.0).alias("residual"))


@_query("SELECT DISTINCT s_nationkey AS col, 0.0::DOUBLE AS residual FROM supplier JOIN lineitem ON l_suppkey = s_suppkey")
def ridge_fit(spark, d):
    """What the fit leaves over of its normal equations, worked out from the rows: nothing (L2)."""
    return _residuals(spark, _packed(spark, d), 2310.13)


@_query("SELECT DISTINCT unnest([l_suppkey, -l_partkey]) AS col, 0.0::DOUBLE AS residual FROM lineitem")
def ridge_many_columns(spark, d):
    """The same with a column for each supplier and each part, without a Gram matrix (L2)."""
    lines = _t(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey", "l_quantity", "l_discount")
    cols = F.array_union(F.collect_set("l_suppkey"), F.collect_set(-F.col("l_partkey")))
    rows = lines.groupBy(F.col("l_orderkey").alias("row")).agg(F.sum("l_quantity").cast("double").alias("w"), F.avg("l_discount").alias("y"), cols.alias("cols"))
    return _residuals(spark, written(rows.withColumn("mask", F.lit(0).cast("long")), "design"), 300.0)


@_query()
def ridge_cv_folds(spark, d):
    """Errors of twelve penalties over five folds, all sixty fits together (L3); tests hold them against numpy."""
    alphas = [10 ** (2 + 2.5 * i / 11) for i in range(12)]
    scores = solve.cross_validated(_packed(spark, d), 5, alphas)
    best = models.best_alpha(scores)
    return spark.createDataFrame([(a, e, a == best) for a, e in scores], "alpha double, rmse double, best boolean")


@_query("""WITH c AS (SELECT label, avg(embedding[1]::DOUBLE) AS cx, avg(embedding[2]::DOUBLE) AS cy FROM embeddings WHERE label IS NOT NULL GROUP BY 1),
 dd AS (SELECT vec_id, c.label AS cluster, sqrt((embedding[1]::DOUBLE-cx)**2 + (embedding[2]::DOUBLE-cy)**2) AS d FROM embeddings, c), e AS (SELECT *, exp((min(d) OVER (PARTITION BY vec_id) - d)/0.3) AS e FROM dd)
 SELECT vec_id, cluster, round(e / sum(e) OVER (PARTITION BY vec_id), 6) AS share FROM e""")
def softmax_assign(spark, d):
    e = _t(spark, d, "embeddings").select("vec_id", "label", F.get("embedding", F.lit(0)).cast("double").alias("x"), F.get("embedding", F.lit(1)).cast("double").alias("y"))
    centres = e.where("label is not null").groupBy("label").agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    packed = centres.agg(F.array_sort(F.collect_list(F.struct("label", "cx", "cy"))))  # a row for each cluster
    e = e.withColumn("c", packed.scalar())
    far = F.transform("c", lambda c: F.sqrt(F.pow(F.col("x") - c["cx"], 2) + F.pow(F.col("y") - c["cy"], 2)))
    e = e.withColumn("share", models.softmax(far))
    pairs = F.zip_with("c", "share", lambda c, s: F.struct(c["label"].cast("int").alias("cluster"), F.round(s, 6).alias("share")))
    return e.select("vec_id", F.inline(pairs))


@_query("""SELECT p_partkey, CASE WHEN p_size >= 40 AND p_retailprice > 1500 THEN 'large premium' WHEN p_size >= 40 THEN 'large' WHEN p_type LIKE '%STEEL%' THEN 'steel'
 WHEN p_retailprice > 1500 THEN 'premium' ELSE 'common' END AS kind FROM part""")
def rule_cascade(spark, d):
    large, dear = F.col("p_size") >= 40, F.col("p_retailprice") > 1500
    kind = F.when(large & dear, "large premium").when(large, "large").when(F.col("p_type").contains("STEEL"), "steel").when(dear, "premium").otherwise("common")
    return _t(spark, d, "part").select("p_partkey", kind.alias("kind"))
