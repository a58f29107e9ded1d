"""Groups of participants as sorted arrays: membership, attribution, with and without."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exploded(stints: DataFrame, lineup: str, member: str) -> DataFrame:
    """A row for each member of ``lineup``."""
    return stints.withColumn(member, F.explode(lineup)).drop(lineup)


def swapped(lineup: Column, leaves: Column, enters: Column) -> Column:
    """(lineup without ``leaves``) with ``enters``, in no order."""
    return F.array_union(F.array_remove(lineup, leaves), F.array(enters))


def substituted(lineup: Column, leaves: Column, enters: Column) -> Column:
    """(lineup without ``leaves``) with ``enters``, sorted."""
    return F.array_sort(swapped(lineup, leaves, enters))


def primary_group(rows: DataFrame, member: str, group: str, weight: str) -> DataFrame:
    """member, group: where a member's weight is largest; ties go to the least group."""
    sums = rows.groupBy(member, group).agg(F.sum(weight).alias("__w"))
    return sums.groupBy(member).agg(F.max_by(group, F.struct("__w", -F.col(group))).alias(group))


def on_off(stints: DataFrame, group: str, lineup: str, values: list[str]) -> DataFrame:
    """member, group, on_*, off_*: sums with a member present and absent, within a group.

    Absence is the group's total less presence, so no member meets the stints it sat out. Each stint
    is read once: besides its members it adds to an entry without one, the group's total.
    """
    everyone = F.array_append(F.transform(lineup, lambda m: F.struct(m.alias("member"))), F.lit(None))
    rows = stints.select(group, *values, F.explode(everyone).alias("who")).select(group, *values, "who.member", F.col("who").isNull().alias("total"))
    sums = rows.groupBy(group, "member", "total").agg(*(F.sum(v).alias(f"on_{v}") for v in values))
    whole = Window.partitionBy(group)
    sums = sums.withColumns({f"off_{v}": F.max(F.when(F.col("total"), F.col(f"on_{v}"))).over(whole) - F.col(f"on_{v}") for v in values})
    return sums.where(~F.col("total")).select("member", group, *(f"on_{v}" for v in values), *(f"off_{v}" for v in values))


def two_sided(sides: DataFrame, stint: str, team: str, values: list[str]) -> DataFrame:
    """Each (stint, team) with its own and the other teams' sums, as own_* and opp_*."""
    sums = sides.groupBy(stint, team).agg(*(F.sum(v).alias(f"own_{v}") for v in values))
    whole = Window.partitionBy(stint)
    return sums.withColumns({f"opp_{v}": F.sum(f"own_{v}").over(whole) - F.col(f"own_{v}") for v in values})


def by_scope(rows: DataFrame, keys: list[str], scope: str, sums: dict[str, Column]) -> DataFrame:
    """Sums for each scope and, as scope ``all``, over all of them; ratios come after this."""
    sets = [[*keys, scope], keys]
    out = rows.groupingSets([[F.col(c) for c in s] for s in sets], *keys, scope).agg(F.grouping(scope).alias("__all"), *(c.alias(n) for n, c in sums.items()))
    return out.withColumn(scope, F.when(F.col("__all") == 1, "all").otherwise(F.col(scope))).drop("__all")


def weighted_mean(rows: DataFrame, keys: list[str], values: list[str], weight: str) -> DataFrame:
    """Means of ``values`` weighted by ``weight``; a null value adds nothing but its weight counts."""
    total = F.sum(weight)
    means = [F.when(total > 0, F.coalesce(F.sum(F.col(v) * F.col(weight)), F.lit(0.0)) / total).alias(v) for v in values]
    return rows.groupBy(*keys).agg(*means, total.alias(weight))
