"""Comparing two sources, and gates on what is to be published."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def full_compare(ours: DataFrame, theirs: DataFrame, keys: list[str], values: list[str], *, carry: bool = False) -> DataFrame:
    """keys, side (both, ours, theirs), diff_*: a full outer join that says where rows are missing.

    With ``carry`` also the values of both sides, a_* and b_*.
    """
    a = ours.select(*keys, *(F.col(v).alias(f"a_{v}") for v in values), F.lit(True).alias("__a"))
    b = theirs.select(*keys, *(F.col(v).alias(f"b_{v}") for v in values), F.lit(True).alias("__b"))
    side = F.when(F.col("__b").isNull(), "ours").when(F.col("__a").isNull(), "theirs").otherwise("both")
    own = [f"{s}_{v}" for s in "ab" for v in values] if carry else []
    return a.join(b, keys, "full").select(*keys, side.alias("side"), *((F.col(f"a_{v}") - F.col(f"b_{v}")).alias(f"diff_{v}") for v in values), *own)


def with_name_fallback(ours: DataFrame, theirs: DataFrame, key: str, name: str) -> DataFrame:
    """``ours`` with unknown keys replaced by the key of the same name in ``theirs``, if it has one."""
    known = theirs.select(key).distinct().withColumn("__known", F.lit(True))
    by_name = theirs.groupBy(name).agg(F.min(key).alias("__other"))
    joined = ours.join(known, key, "left").join(by_name, name, "left")
    return joined.withColumn(key, F.when(F.col("__known").isNull(), F.coalesce("__other", key)).otherwise(F.col(key))).drop("__known", "__other")


def document(rows: DataFrame, keys: list[str], fields: list[str], order: list) -> DataFrame:
    """keys, doc: a compact JSON array of the rows of each key in order, nulls written out."""
    entry = F.struct(*order, F.struct(*fields).alias("__e"))
    docs = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("__r"))
    return docs.select(*keys, F.to_json(F.transform("__r", lambda r: r["__e"]), {"ignoreNullFields": "false"}).alias("doc"))
