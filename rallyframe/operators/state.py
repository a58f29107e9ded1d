"""Ordered state without loops: running values, states that clear, counters that rise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_before(rows: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over earlier rows of the key; 0 at the first."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)))


def pending(rows: DataFrame, keys: list[str], order: list[str], sets: Column, clears: Column, value: Column, out: str) -> DataFrame:
    """The state before each row: ``value`` of the last setting row unless one cleared it since.

    A clearing row holds a struct with a null, so that skipping nulls doesn't skip it. A row that
    does neither leaves the state.
    """
    state = F.when(sets, F.struct(value.alias("v"))).when(clears, F.struct(F.lit(None).alias("v")))
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(out, F.last(state, ignorenulls=True).over(w)["v"])


def rises(rows: DataFrame, keys: list[str], order: list[str], counter: str, out: str) -> DataFrame:
    """Whether ``counter`` is above all earlier ones of the key (above 0 at the first)."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(out, F.coalesce(F.col(counter) > F.coalesce(F.max(counter).over(w), F.lit(0)), F.lit(False)))


def resolve_rebounds(rebounds: DataFrame, keys: list[str], off: str, deff: str, position: str) -> DataFrame:
    """Adds kind, ``off`` or ``def``: which counter rose, with rows put in order of the counters.

    The log's own order is not trusted. If neither rose, the kind is null.
    """
    w = Window.partitionBy(*keys).orderBy(off, deff, position).rowsBetween(Window.unboundedPreceding, -1)
    seen_off, seen_def = (F.coalesce(F.max(c).over(w), F.lit(0)) for c in (off, deff))
    return rebounds.withColumn("kind", F.when(F.col(off) > seen_off, "off").when(F.col(deff) > seen_def, "def"))
