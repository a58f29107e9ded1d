"""Sharding by fixed virtual slots (DataFrame functions only).

Each record hashes into one of a few thousand slots that never change. A versioned table maps
slots to shards; only this small table is edited when shards fill unevenly or their number
changes, so records move by whole slots. The law that holds is ``bytes``: the map is planned on
the bytes measured in each slot, so that shards get near-equal sizes.

Everything per record is hash partitioned by slot. The slot table has ``n_slots`` rows whatever
the input, which bounds the one-row planning step and the broadcast of the map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rallyframe.llm.scratch import scratch_path, write_scratch

N_SLOTS = 4096
N_SHARDS = 16


def slotted(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, vslot of each document.

    A null text counts as empty. A null doc_id takes its slot from the text instead, so many
    of them don't share one slot. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text_crc32", "size")).otherwise(F.xxhash64("doc_id"))
    return rows.withColumn("vslot", F.pmod(key, F.lit(n_slots)).cast("int"))


def slot_totals(rows: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """vslot, slot_bytes, slot_rows for every slot, empty ones too."""
    used = rows.groupBy("vslot").agg(F.sum("size").alias("slot_bytes"), F.count("*").alias("slot_rows"))
    every = rows.sparkSession.range(n_slots).select(F.col("id").cast("int").alias("vslot"))
    return every.join(F.broadcast(used), "vslot", "left").na.fill(0, ["slot_bytes", "slot_rows"])


def edit_map(totals: DataFrame, n_shards: int, prior: DataFrame | None = None, n_slots: int = N_SLOTS) -> DataFrame:
    """The next version of the map: version, vslot, shard, slot_bytes, slot_rows.

    A shard keeps its slots of the ``prior`` version (vslot, shard, version), largest first, up to
    an equal share of the weight; each of the others goes, largest first, to the shard with the
    least weight so far. Slots of shards beyond ``n_shards`` all move. Without ``prior`` all
    slots are dealt that way, as version 1. The weight is the bytes, and by a trifle the slot
    itself, so that empty slots are spread too.
    """
    weight = F.col("slot_bytes") * n_slots + 1
    if prior is None:
        had = totals.withColumns({"old": F.lit(None).cast("int"), "was": F.lit(0)})
    else:
        old = prior.select("vslot", F.when(F.col("shard") < n_shards, F.col("shard")).alias("old"), F.col("version").alias("was"))
        had = totals.join(F.broadcast(old), "vslot", "left")
    had = had.withColumn("weight", weight)
    share = had.select(F.ceil(F.sum("weight") / n_shards).cast("long").alias("share"))
    kept_first = Window.partitionBy("old").orderBy(F.desc("weight"), "vslot")
    had = had.withColumn("share", share.scalar())
    had = had.withColumn("keeps", F.col("old").isNotNull() & (F.sum("weight").over(kept_first) <= F.col("share")))
    one = had.agg(
        (F.max("was") + 1).alias("version"),
        F.collect_list(F.when(F.col("keeps"), F.struct("weight", "vslot", "slot_bytes", "slot_rows", "old"))).alias("kept"),
        F.array_sort(
            F.collect_list(F.when(~F.col("keeps"), F.struct((-F.col("weight")).alias("less"), "weight", "vslot", "slot_bytes", "slot_rows")))
        ).alias("moved"),
    )
    loads = F.transform(
        F.sequence(F.lit(0), F.lit(n_shards - 1)),
        lambda i: F.aggregate("kept", F.lit(0).cast("long"), lambda a, s: a + F.when(s["old"] == i, s["weight"]).otherwise(F.lit(0))),
    )

    def place(acc: Column, slot: Column) -> Column:
        at = F.array_position(acc["loads"], F.array_min(acc["loads"])) - 1
        return F.struct(
            F.transform(acc["loads"], lambda x, i: x + F.when(i == at, slot["weight"]).otherwise(F.lit(0))).alias("loads"),
            F.concat(acc["owner"], F.array(at.cast("int"))).alias("owner"),
        )

    start = F.struct(loads.alias("loads"), F.array().cast("array<int>").alias("owner"))
    dealt = one.withColumn("owner", F.aggregate("moved", start, place, lambda acc: acc["owner"]))
    entries = F.concat(
        F.transform("kept", lambda s: F.struct(s["vslot"].alias("vslot"), s["old"].alias("shard"), s["slot_bytes"].alias("slot_bytes"), s["slot_rows"].alias("slot_rows"))),
        F.transform(
            "moved",
            lambda s, i: F.struct(s["vslot"].alias("vslot"), F.get("owner", i).alias("shard"), s["slot_bytes"].alias("slot_bytes"), s["slot_rows"].alias("slot_rows")),
        ),
    )
    return dealt.select("version", F.inline(entries))


def store_map(slot_map: DataFrame, path: str) -> None:
    """Add a version to the stored map; versions are folders, so older ones stay readable."""
    slot_map.write.mode("append").partitionBy("version").parquet(path)


def load_map(spark, path: str, version: int | None = None) -> DataFrame:
    """One version of a stored map, the latest by default."""
    stored = spark.read.schema("vslot int, shard int, slot_bytes long, slot_rows long, version int").parquet(path)
    if version is None:
        return stored.where(F.col("version") == stored.agg(F.max("version")).scalar())
    return stored.where(F.col("version") == version)


def placed(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Adds shard and slot, the position in the shard, to ``slotted`` rows.

    Rows are numbered within their virtual slot, and each virtual slot starts after those before
    it in its shard; ties (equal doc_id) are numbered by crc and size.
    """
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.select("vslot", "shard", F.coalesce(F.sum("slot_rows").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("at", F.row_number().over(within).cast("long") - 1)
    return numbered.join(F.broadcast(starts), "vslot").withColumn("slot", F.col("base") + F.col("at")).drop("base", "at")


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS, n_slots: int = N_SLOTS, map_path: str | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, vslot, shard, slot.

    size is the text's UTF-8 bytes plus 1 (null: 1). Shards have near-equal sizes. A map stored
    at ``map_path`` gets a further version, edited from its latest; without a path the map goes
    to the shared scratch folder. An empty table gives no rows. Repeated rows are placed each. A very
    long text is measured where it is read and never shuffled; its slot is as heavy as it is.
    """
    spark = docs.sparkSession
    rows = write_scratch(slotted(docs, n_slots), "slotted")
    prior = None
    if map_path is not None and _exists(spark, map_path):
        prior = load_map(spark, map_path)
    path = map_path or scratch_path(spark, "slot-map")
    store_map(edit_map(slot_totals(rows, n_slots), n_shards, prior, n_slots), path)
    return placed(rows, load_map(spark, path))


def _exists(spark, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def query(spark, sf_dir: str) -> DataFrame:
    """op9: every document's shard under the ``bytes`` law."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return shard_documents(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "vslot"
    )
