"""As-of joins, runs and interval checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof(events: DataFrame, starts: DataFrame, keys: list[str], time: str, start: str, carry: list[str], *, clamp: bool = False) -> DataFrame:
    """Each event with ``carry`` of the last start at or before it, within ``keys``.

    Both inputs are sorted once per key, as a union; nothing is compared pairwise. Events before
    the first start get nulls, or with ``clamp`` the first start's values. Of equal starts the one
    with the greatest ``carry`` counts.
    """
    payload = F.struct(F.col(start).alias("__start"), *carry)
    left = events.withColumns({"__t": F.col(time), "__kind": F.lit(1), "__payload": F.lit(None).cast(starts.select(payload.alias("p")).schema["p"].dataType)})
    right = starts.select(*keys, F.col(start).alias("__t"), F.lit(0).alias("__kind"), payload.alias("__payload"))
    both = left.unionByName(right, allowMissingColumns=True)
    order = Window.partitionBy(*keys).orderBy("__t", "__kind", "__payload")
    found = F.last("__payload", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    if clamp:
        found = F.coalesce(found, F.min("__payload").over(Window.partitionBy(*keys)))
    both = both.withColumn("__found", found).where("__kind = 1")
    return both.select(*events.columns, F.col("__found.__start").alias(start if start not in events.columns else f"{start}_found"), *(f"__found.{c}" for c in carry))


def intervals_from_changes(changes: DataFrame, keys: list[str], time: str) -> DataFrame:
    """keys, t_start, t_end: spans between distinct change times; the last has no end."""
    times = changes.select(*keys, F.col(time).alias("t_start")).distinct()
    return times.withColumn("t_end", F.lead("t_start").over(Window.partitionBy(*keys).orderBy("t_start")))


def runs(rows: DataFrame, keys: list[str], start: str, end: str, tolerance: float = 1e-9) -> DataFrame:
    """keys, run, start, end, n: touching spans of a key joined to maximal runs."""
    order = Window.partitionBy(*keys).orderBy(start, end)
    broken = F.coalesce(F.abs(F.lag(end).over(order) - F.col(start)) > tolerance, F.lit(True))
    numbered = rows.withColumn("run", F.sum(broken.cast("int")).over(order))
    return numbered.groupBy(*keys, "run").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n"))


def value_runs(rows: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """keys, run, value, n: maximal runs of equal neighbours."""
    w = Window.partitionBy(*keys).orderBy(*order)
    change = F.coalesce(F.lag(value).over(w) != F.col(value), F.lit(True))
    numbered = rows.withColumn("run", F.sum(change.cast("int")).over(w))
    return numbered.groupBy(*keys, "run", value).agg(F.count("*").alias("n"))


def gaps(spans: DataFrame, keys: list[str], start: str, end: str, tolerance: float = 1e-9) -> DataFrame:
    """keys, end, next_start: places where a span doesn't end where the next begins."""
    nxt = spans.withColumn("next_start", F.lead(start).over(Window.partitionBy(*keys).orderBy(start)))
    return nxt.where(F.abs(F.col("next_start") - F.col(end)) > tolerance).select(*keys, end, "next_start")


def occupancy(spans: DataFrame, keys: list[str], start: str, end: str, member: str) -> DataFrame:
    """keys, second, members: who is present in each whole second from ceil(start) to floor(end)."""
    first, last = F.ceil(start), F.floor(end)
    seconds = spans.where(last > first).withColumn("second", F.explode(F.sequence(first, last - 1)))
    return seconds.groupBy(*keys, "second").agg(F.array_sort(F.collect_set(member)).alias("members"))


def presence_changes(spans: DataFrame, keys: list[str], start: str, end: str, member: str) -> DataFrame:
    """keys, at, joined, digest: how the set of members present changes, in whole seconds from ceil(start) to floor(end).

    joined is how many more there are from then on, digest the xor of the hashes of those who come or go, so
    the running xor tells sets apart. Spans of one member that overlap or touch are one. Rows grow with the spans
    and not with their lengths.
    """
    whole = spans.select(*keys, member, F.ceil(start).alias("first"), F.floor(end).alias("last")).where("last > first")
    order = Window.partitionBy(*keys, member).orderBy("first", "last")
    until = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = whole.withColumn("opens", F.coalesce(F.col("first") > until, F.lit(True)).cast("int")).withColumn("island", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs_ = islands.groupBy(*keys, member, "island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    ends = F.array(F.struct(F.col("first").alias("at"), F.lit(1).alias("d")), F.struct(F.col("last").alias("at"), F.lit(-1).alias("d")))
    events = runs_.select(*keys, F.xxhash64(member).alias("h"), F.inline(ends))
    return events.groupBy(*keys, "at").agg(F.sum("d").alias("joined"), F.bit_xor("h").alias("digest"))
