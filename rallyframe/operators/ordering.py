"""Order, dedup and votes over event logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chronological(events: DataFrame, keys: list[str], order: list[Column | str], out: str = "seq") -> DataFrame:
    """Numbers rows from 1 within ``keys``; ``order`` must end in a unique column to be stable."""
    return events.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def keep_first(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key."""
    return chronological(rows, keys, order, "__nth").where("__nth = 1").drop("__nth")


def period_scheme(clocks: DataFrame, game: str, period: str, remaining: str) -> DataFrame:
    """game, regular, n_regular: a game's regulation period length and count, from its clocks.

    Periods whose clock passes 300 s are regulation. The length is the smallest of 600, 720 and
    1200 s that covers the largest clock, else that clock; without such periods it is 4 of 600 s.
    """
    tops = clocks.groupBy(game, period).agg(F.max(remaining).alias("top"))
    most = F.max(F.when(F.col("top") > 300, F.col("top")))
    found = tops.groupBy(game).agg(most.alias("most"), F.count_if(F.col("top") > 300).alias("n"))
    length = F.when(F.col("most") <= 600, 600.0).when(F.col("most") <= 720, 720.0).when(F.col("most") <= 1200, 1200.0).otherwise(F.col("most"))
    return found.select(game, F.coalesce(length, F.lit(600.0)).alias("regular"), F.when(F.col("n") > 0, F.col("n")).otherwise(4).cast("int").alias("n_regular"))


def majority_vote(votes: DataFrame, keys: list[str], value: str, position: str) -> DataFrame:
    """keys, value, votes: the most frequent value of each key; ties go to the one seen first."""
    counts = votes.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("votes"), F.min(position).alias("__at"))
    best = F.max_by(F.struct(value, "votes"), F.struct("votes", -F.col("__at")))
    return counts.groupBy(*keys).agg(best.alias("__best")).select(*keys, f"__best.{value}", "__best.votes")


def last_value(rows: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """keys, value: the last non-blank value in order."""
    kept = rows.where(F.trim(F.col(value)) != "")
    return kept.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))


def top_per_group(rows: DataFrame, keys: list[str], order: list[Column], k: int, out: str = "rank") -> DataFrame:
    """The first ``k`` rows of each key."""
    return chronological(rows, keys, order, out).where(F.col(out) <= k)
