"""Checks of our tables against official ones, and gates before publishing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rallyframe.operators import evaluate, intervals, reconcile

# Tolerances of the checks.
SECONDS_EXACT, SECONDS_CLOSE, SEASON_SHARE, RATE_GAP, RATE_R, RATE_MINUTES = 1.0, 30.0, 0.1, 0.15, 0.95, 200.0
LEAST_PLAYERS, MOST_DAYS = 50, 4


def compare_seconds(ours: DataFrame, official: DataFrame) -> DataFrame:
    """game, covered, matched, mismatched, first_mismatch: seconds whose lineups agree on every team.

    Only seconds count at which the official source has five players of each of the game's teams: a
    gap in it is no error of ours. A sweep over the times at which a set changes: a running digest of each
    side's set tells whether they agree until the next change, so no second is a row.
    """
    keys = ["game", "team"]
    sides = {"a": official, "b": ours}
    changes = [
        intervals.presence_changes(rows, keys, "t_start", "t_end", "player").select(*keys, "at", *(F.when(F.lit(s == side), F.col(c)).alias(f"{c}_{s}") for s in sides for c in ("joined", "digest")))
        for side, rows in sides.items()
    ]
    none = F.lit(0).cast("long")
    met = changes[0].unionByName(changes[1]).groupBy(*keys, "at").agg(
        *(F.coalesce(F.sum(f"joined_{s}"), none).alias(f"joined_{s}") for s in sides), *(F.coalesce(F.bit_xor(f"digest_{s}"), none).alias(f"digest_{s}") for s in sides)
    )
    own = Window.partitionBy(*keys).orderBy("at")
    held = own.rowsBetween(Window.unboundedPreceding, 0)
    here = met.withColumns({f"n_{s}": F.sum(f"joined_{s}").over(held) for s in sides} | {f"x_{s}": F.bit_xor(f"digest_{s}").over(held) for s in sides})
    here = here.select(*keys, "at", (F.col("n_a") == 5).cast("int").alias("full"), ((F.col("n_a") != F.col("n_b")) | (F.col("x_a") != F.col("x_b"))).cast("int").alias("differs"))
    step = lambda c: (F.col(c) - F.lag(c, 1, 0).over(own)).alias(c)
    teams = here.groupBy("game").agg(F.count_distinct("team").alias("teams"))
    whole = here.select(*keys, "at", step("full"), step("differs")).groupBy("game", "at").agg(F.sum("full").alias("full"), F.sum("differs").alias("differs"))
    order = Window.partitionBy("game").orderBy("at")
    until = order.rowsBetween(Window.unboundedPreceding, 0)
    spans = whole.select("game", "at", F.sum("full").over(until).alias("full"), F.sum("differs").over(until).alias("differs"), (F.lead("at").over(order) - F.col("at")).alias("secs"))
    covered = spans.join(teams, "game").where("full = teams AND secs > 0")
    total = lambda on: F.coalesce(F.sum(F.when(on, F.col("secs"))), none)
    return covered.groupBy("game").agg(
        F.sum("secs").alias("covered"), total(F.col("differs") == 0).alias("matched"), total(F.col("differs") > 0).alias("mismatched"), F.min(F.when(F.col("differs") > 0, F.col("at"))).alias("first_mismatch")
    )


def player_seconds(ours: DataFrame, official: DataFrame) -> DataFrame:
    """game, team, player, delta: whole seconds that we give a player more than the official source does."""

    def counted(spans: DataFrame, name: str) -> DataFrame:
        first, last = F.ceil("t_start"), F.floor("t_end")
        return spans.where(last > first).groupBy("game", "team", "player").agg(F.sum(last - first).alias(name))

    both = counted(ours, "a").join(counted(official, "b"), ["game", "team", "player"], "full")
    return both.select("game", "team", "player", (F.coalesce("a", F.lit(0)) - F.coalesce("b", F.lit(0))).alias("delta"))


def minutes(ours: DataFrame, official: DataFrame) -> DataFrame:
    """game, players, exact, close, mean_delta, max_delta, total_delta in seconds.

    ours, official: game, player, secs. Players of the official table whom neither side has on the
    floor are left out; so are rows whose official time can't be read (null).
    """
    both = official.where("secs is not null").select("game", "player", F.col("secs").alias("theirs"))
    both = both.join(ours.select("game", "player", F.col("secs").alias("own")), ["game", "player"], "left")
    delta = F.coalesce("own", F.lit(0.0)) - F.col("theirs")
    played = both.where((F.col("theirs") > 0) | (F.col("own") > 0)).withColumn("delta", delta)
    off = F.abs("delta")
    return played.groupBy("game").agg(
        F.count("*").alias("players"),
        F.count_if(off < SECONDS_EXACT).alias("exact"),
        F.count_if(off <= SECONDS_CLOSE).alias("close"),
        F.avg(off).alias("mean_delta"),
        F.max(off).alias("max_delta"),
        F.sum("delta").alias("total_delta"),
    )


def worst(rows: DataFrame, value: str, k: int, *ties: str) -> DataFrame:
    """The ``k`` rows of largest ``value`` in absolute terms (a report, not a filter)."""
    return rows.orderBy(F.abs(value).desc(), *ties).limit(k)


def box_totals(ours: DataFrame, official: DataFrame, key: str, name: str, stats: list[str]) -> DataFrame:
    """stat, rows, differing, unmatched: per stat, players of both sides whose values differ.

    Players unknown to the other side by id are tried by name and their rows added up anew. Rows on
    one side only that carry any stat count as unmatched. Both tables have game, key, name, stats.
    """
    sums = [F.sum(s).alias(s) for s in stats]
    known = official.select("game", key).distinct().withColumn("__known", F.lit(True))
    by_name = official.groupBy("game", name).agg(F.min(key).alias("__other"))
    joined = ours.join(known, ["game", key], "left").join(by_name, ["game", name], "left")
    mapped = joined.withColumn(key, F.when(F.col("__known").isNull(), F.coalesce("__other", key)).otherwise(F.col(key)))
    a, b = mapped.groupBy("game", key).agg(*sums), official.groupBy("game", key).agg(*sums)
    both = reconcile.full_compare(a.na.fill(0, stats), b.na.fill(0, stats), ["game", key], stats, carry=True)
    entries = F.array(*(F.struct(F.lit(s).alias("stat"), F.col(f"diff_{s}").alias("diff")) for s in stats))
    carries = F.greatest(*(F.coalesce(F.abs(f"{side}_{s}"), F.lit(0)) for side in ("a", "b") for s in stats)) > 0
    long = both.select("side", carries.alias("carries"), F.inline(entries))
    met = F.col("side") == "both"
    return long.groupBy("stat").agg(
        F.count_if(met).alias("rows"), F.count_if(met & (F.col("diff") != 0)).alias("differing"), F.count_if(~met & F.col("carries")).alias("unmatched")
    )


def season_totals(ours: DataFrame, official: DataFrame, key: str, stats: list[str]) -> DataFrame:
    """stat, own, theirs, percent, flagged: totals over players of both sides; flagged from a tenth of a per cent."""
    a = ours.select(key, *(F.col(s).alias(f"a_{s}") for s in stats))
    both = a.join(official.select(key, *(F.col(s).alias(f"b_{s}") for s in stats)), key)
    one = both.agg(*(F.coalesce(F.sum(f"{side}_{s}"), F.lit(0)).alias(f"{side}_{s}") for side in ("a", "b") for s in stats))
    entries = F.array(*(F.struct(F.lit(s).alias("stat"), F.col(f"a_{s}").cast("double").alias("own"), F.col(f"b_{s}").cast("double").alias("theirs")) for s in stats))
    percent = 100 * (F.col("own") - F.col("theirs")) / F.greatest("theirs", F.lit(1.0))
    return one.select(F.inline(entries)).withColumn("percent", percent).withColumn("flagged", F.abs("percent") >= SEASON_SHARE)


def rates(ours: DataFrame, official: DataFrame, key: str, exact: dict[str, str], tracking: dict[str, str]) -> DataFrame:
    """rate, kind, players, over, r, median_gap, p90_gap, fails, over players of ``RATE_MINUTES`` or more.

    Rates of one definition must agree within ``RATE_GAP``; those whose denominators the official
    source estimates need only track ours. Maps give the official column of each rate, a share of one.
    """
    both = ours.where(F.col("min") >= RATE_MINUTES).join(official, key)
    parts = None
    for kind, names in (("exact", exact), ("tracking", tracking)):
        for rate, column in names.items():
            gap = F.col(rate) - F.col(column) * 100
            one = both.agg(
                F.count("*").alias("players"),
                F.count_if(F.abs(gap) > RATE_GAP).alias("over"),
                evaluate.correlation(F.col(rate), F.col(column) * 100).alias("r"),
                F.percentile(gap, 0.5).alias("median_gap"),
                F.percentile(F.abs(gap), 0.9).alias("p90_gap"),
            ).select(F.lit(rate).alias("rate"), F.lit(kind).alias("kind"), "*")
            parts = one if parts is None else parts.unionByName(one)
    fails = F.when(F.col("kind") == "exact", F.col("over") > 0).otherwise(F.coalesce(F.col("r") < RATE_R, F.lit(False)))
    return parts.withColumn("fails", fails)


def structure(stints: DataFrame) -> DataFrame:
    """game, on_floor, n_gaps, odd_sizes: mean players on the floor (ten), gaps and lineups not of five."""
    secs = F.col("t_end") - F.col("t_start")
    size = F.size("home_lineup") + F.size("away_lineup")
    after = F.lead("t_start").over(Window.partitionBy("game").orderBy("t_start"))
    rows = stints.select("game", secs.alias("secs"), size.alias("size"), (F.abs(after - F.col("t_end")) > 1e-9).alias("gap"), "home_lineup", "away_lineup")
    return rows.groupBy("game").agg(
        (F.sum(F.col("secs") * F.col("size")) / F.sum("secs")).alias("on_floor"),
        F.count_if("gap").alias("n_gaps"),
        F.count_if((F.size("home_lineup") != 5) | (F.size("away_lineup") != 5)).alias("odd_sizes"),
    )


def complete_games(plays: DataFrame, least_periods: int = 4) -> DataFrame:
    """game, complete: whether the last period is the fourth or later and its end is in the log."""
    last = F.max("period").over(Window.partitionBy("game"))
    rows = plays.select("game", "period", "code", last.alias("last"))
    ended = F.max((F.col("period") == F.col("last")) & (F.col("code") == 13))
    return rows.groupBy("game").agg(((F.max("last") >= least_periods) & ended).alias("complete"))


def stale(stored: DataFrame, volatile: DataFrame, partial: DataFrame, key: str) -> DataFrame:
    """Keys to fetch anew: volatile ones, and games stored in part; nothing is removed here."""
    return stored.select(key).join(volatile.select(key).unionByName(partial.select(key)).distinct(), key, "left_semi")


def gate(published: DataFrame, season: str, index: DataFrame, stamp: Column, today: Column, alphas: DataFrame, pinned: float) -> DataFrame:
    """check, passes: whether a season may be published.

    ``published`` has season, player and doc (JSON); ``index`` the seasons listed; ``alphas`` the
    penalty of each fitted scope. ``stamp`` and ``today`` are dates.
    """
    own = published.where(F.col("season") == season)
    bare = F.col("doc").rlike(r"(?<![A-Za-z\"])(NaN|-?Infinity)(?![A-Za-z\"])")
    one = own.agg(F.count_if(bare).alias("bad"), F.count_distinct("player").alias("players"))
    listed = index.agg(F.count_if(F.col("season") == season).alias("n"))
    fits = alphas.agg(F.count_distinct("alpha").alias("n"), F.max(F.abs(F.col("alpha") - pinned)).alias("off"))
    checks = {
        "no bare NaN": F.col("bad") == 0,
        "season is listed": listed.scalar() > 0,
        "enough players": F.col("players") >= LEAST_PLAYERS,
        "data is fresh": F.coalesce(F.datediff(today, stamp) <= MOST_DAYS, F.lit(False)),
        "one pinned penalty": (fits.select("n").scalar() == 1) & (fits.select("off").scalar() < 1e-9),
    }
    return one.select(F.inline(F.array(*(F.struct(F.lit(n).alias("check"), F.coalesce(c, F.lit(False)).alias("passes")) for n, c in checks.items()))))


def require(checks: DataFrame) -> None:
    """Raises if any check failed, naming them."""
    failed = [r["check"] for r in checks.where(~F.col("passes")).collect()]  # a row for each check
    if failed:
        raise ValueError("not fit to publish: " + ", ".join(failed))
