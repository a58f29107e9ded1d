"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint of 64 bits is cut into three segments. Two fingerprints that differ in at most four
bits have a segment in which they differ in at most one. So each segment is indexed under all its
variants with one bit wiped out: fingerprints whose segments differ in that bit alone, or not at
all, meet under an equal key. The join is on these keys; the whole distance is tested inside the
join, together with a rule that lets each pair through under one key only, so nothing but links
leaves it.

Only distinct fingerprints take part; documents with the same one are a class. Texts are read once, to make the fingerprints.

Fingerprints tell texts that are nearly equal. Where near-duplicates are defined by the similarity
of their shingles (``similar``), links of fingerprints are proposals, which the shingles of both
texts confirm; pairs that are alike but whose fingerprints lie further apart are found by an index
of shingles and confirmed likewise, so none is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rallyframe.llm import shingles
from rallyframe.llm.components import components, merged
from rallyframe.llm.scratch import discard, release, write_scratch

WORDS = 4
MAX_BITS = 4
#: First bit and width of each segment. Fingerprints up to 2 * len(SEGMENTS) - 1 bits apart have
#: one in which they differ in at most one bit.
SEGMENTS = ((0, 22), (22, 21), (43, 21))

#: Rounds in which classes meet leading ones, before all pairs left over are looked at.
TURNS = 1
#: Hashes turned into bits at a time, which bounds the memory a very long text takes.
_CHUNK = 1 << 15


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The 64-bit SimHash of a text, unsigned; 0 without words.

    A bit is set if it is set in over half of the hashes of all word shingles, repeats included.
    """
    return of_hashes(shingles.digests(text, words))


def of_hashes(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at : at + _CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprinted(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """The columns of ``docs`` without ``text``, and fp, the fingerprint as a signed long."""
    rest = [c for c in docs.columns if c != "text"]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest)

    def batches(them):
        for batch in them:
            fps = np.array([fingerprint(t, words) for t in batch.column(0).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(fps.view(np.int64))], names=[*rest, "fp"])

    return docs.select("text", *rest).mapInArrow(batches, f"{kinds}, fp long")


def _segment_bits(expr: str, start: int, width: int) -> str:
    return f"(shiftrightunsigned({expr}, {start}) & {(1 << width) - 1}L)"


def near_pairs(classes: DataFrame, bits_apart: int = MAX_BITS) -> DataFrame:
    """a, b: fingerprints of ``classes`` (distinct, column fp) that differ in 1 to ``bits_apart`` bits."""
    if bits_apart >= 2 * len(SEGMENTS):
        raise ValueError(f"{len(SEGMENTS)} segments find pairs up to {2 * len(SEGMENTS) - 1} bits apart")
    variants = []
    for n, (start, width) in enumerate(SEGMENTS):
        bits = _segment_bits("fp", start, width)
        variants.append(
            f"transform(sequence(0, {width - 1}), i -> named_struct('wiped', cast(i + {start} as byte), "
            f"'rest', cast({bits} & ~shiftleft(1L, i) as int)))"
        )
    index = classes.select("fp", F.expr(f"inline(concat({', '.join(variants)}))"))
    a = index.select(F.col("fp").alias("a"), "wiped", "rest")
    b = index.select(F.col("fp").alias("b"), "wiped", "rest")
    # The key that a pair may use: of the first segment with at most one differing bit, that bit,
    # or the segment's first one if none differs.
    rule = "case"
    for start, width in SEGMENTS:
        bits = _segment_bits("(a ^ b)", start, width)
        rule += f" when {bits} = 0 then {start} when bit_count({bits}) = 1 then {start} + bit_count({bits} - 1)"
    rule += " end"
    # The index has 64 rows a fingerprint, which Spark's estimate of its size leaves out: without the hint it is broadcast.
    found = a.join(b.hint("merge"), ["wiped", "rest"]).where(F.expr(f"a < b and bit_count(a ^ b) <= {bits_apart} and wiped = {rule}"))
    return found.select("a", "b")


def near_duplicates(keyed: DataFrame, words: int = WORDS, bits_apart: int = MAX_BITS) -> DataFrame:
    """The columns of ``keyed`` but text, with fp, group and component, for rows of (key, text, ...).

    ``component`` is the least key of the near-duplicate group, ``group`` its least fingerprint.
    Null and empty texts have fingerprint 0 and link like any other. Repeated rows are returned
    each. Null keys don't count for the least key; a group of none but those has component null.
    An empty table gives no rows. A very long text is fingerprinted whole, by one task.
    """
    prints = write_scratch(fingerprinted(keyed, words), "fingerprints")
    classes = write_scratch(prints.groupBy("fp").agg(F.min("key").alias("first")), "classes")
    stars = components(near_pairs(classes.select("fp"), bits_apart))
    joined = classes.join(stars, classes["fp"] == stars["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("group")
    )
    least = joined.groupBy("group").agg(F.min("first").alias("component"))
    return prints.join(joined.join(least, "group").select("fp", "group", "component"), "fp")


def _prepared(keyed: DataFrame, words: int, like: float) -> DataFrame:
    """The columns of ``keyed`` but text, with class, fp, n, prefix, set and sketch of each text (see ``shingles``)."""
    rest = [c for c in keyed.columns if c != "text"]
    kinds = ", ".join(f"`{c}` {keyed.schema[c].dataType.simpleString()}" for c in rest)
    known = keyed.sparkSession.sparkContext.broadcast(shingles.common(keyed, words))

    def batches(them):
        for some in shingles.sliced(them):
            found = [shingles.parted(t, words, known.value, like) for t in some.column(0).to_pylist()]
            of = np.array([f[1] for f in found], dtype=np.uint64).view(np.int64)
            prints = np.array([of_hashes(f[0]) for f in found], dtype=np.uint64).view(np.int64)
            many = pa.array([f[2] for f in found], pa.int32())
            columns = [pa.array(of), pa.array(prints), many, shingles.lists([f[3] for f in found], np.int64), shingles.lists([f[4] for f in found], np.int32)]
            columns.append(shingles.lists([shingles.sketch(f[4]) for f in found], np.int64))
            yield pa.RecordBatch.from_arrays([*some.columns[1:], *columns], names=[*rest, "class", "fp", "n", "prefix", "set", "sketch"])

    return keyed.select("text", *rest).mapInArrow(batches, f"{kinds}, class long, fp long, n int, prefix array<long>, set array<int>, sketch array<long>")


def _proposed(classes: DataFrame, bits_apart: int) -> DataFrame:
    """a, b: classes (class, fp) to compare: those of one fingerprint with its least, and its least with the least near one."""
    least = write_scratch(classes.groupBy("fp").agg(F.min("class").alias("least")), "prints")
    same = classes.join(least, "fp").where("class <> least").select(F.col("least").alias("a"), F.col("class").alias("b"))
    near = near_pairs(least.select("fp"), bits_apart).groupBy(F.col("b").alias("fp")).agg(F.min("a").alias("near"))
    of = least.select(F.col("fp").alias("near"), F.col("least").alias("a"))
    return same.unionByName(near.join(least, "fp").join(of, "near").select("a", F.col("least").alias("b")))


def similar(keyed: DataFrame, words: int = shingles.WORDS, like: float = shingles.LIKE, bits_apart: int = 2 * len(SEGMENTS) - 1) -> DataFrame:
    """The columns of ``keyed`` but text, with class and group, for rows of (key, text, h).

    Texts are linked whose sets of word shingles have a Jaccard similarity of ``like`` or more;
    ``group`` is the least class that links reach. Texts without words are one class. Repeated rows
    are returned each; an empty table gives no rows. h is a hash of the text.

    Pairs are confirmed in rounds: first what fingerprints propose, then in ``TURNS`` turns each class
    with one that its indexed shingles point to, and last all pairs that are not in one group by then
    and share enough of the index. So large groups don't cost the square of their size.
    """
    whole = write_scratch(_prepared(keyed, words, like), "prepared")
    release(keyed.sparkSession)
    own = write_scratch(whole.drop("fp", "n", "prefix", "set", "sketch"), "keys")
    index = write_scratch(shingles.shared(whole.select("class", "n", "prefix")), "index")
    release(keyed.sparkSession)
    first = _proposed(whole.select("class", "fp").distinct(), bits_apart)
    first = write_scratch(first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "proposed")
    needed = index.select("class").unionByName(first.select(F.col("a").alias("class"))).unionByName(first.select(F.col("b").alias("class"))).distinct()
    sets = write_scratch(whole.select("class", "set", "sketch").join(needed, "class", "left_semi").dropDuplicates(["class"]), "sets")
    discard(whole)
    release(keyed.sparkSession)
    links = write_scratch(shingles.alike(first, sets, like), "links")
    groups = write_scratch(components(links), "groups")
    for turn in range(TURNS):
        more = write_scratch(shingles.alike(shingles.stars(index, groups, turn, like), sets, like), "links")
        if more.isEmpty():
            continue
        groups = write_scratch(merged(groups, more), "groups")
    release(keyed.sparkSession)
    rest = write_scratch(shingles.across(index, groups, like, sets), "rest")
    found = merged(groups, write_scratch(shingles.alike(rest, sets, like), "links"))
    return own.join(found, own["class"] == found["node"], "left").withColumn("group", F.coalesce("component", "class")).drop("node", "component")


def one_of_each(docs: DataFrame, grouped) -> DataFrame:
    """One row of each group of ``docs``, with the columns of ``docs``.

    ``grouped`` takes (key, text, h) and returns them without text, with the column group. The row
    is the one with the least doc_id, then the least hash of its text; a null doc_id comes last,
    and of rows that repeat it one stays.
    """
    h = F.xxhash64(F.coalesce("text", F.lit("")))
    found = grouped(docs.select(F.col("doc_id").alias("key"), "text", h.alias("h")))
    first = found.groupBy("group").agg(F.min(F.struct(F.col("key").isNull().alias("no"), "key", "h")).alias("first"))
    keys = ["__rf_no", "__rf_id", "__rf_h"]
    winners = first.select(F.col("first.no").alias(keys[0]), F.coalesce(F.col("first.key").cast("string"), F.lit("")).alias(keys[1]), F.col("first.h").alias(keys[2]))
    own = docs.withColumns({keys[0]: F.col("doc_id").isNull(), keys[1]: F.coalesce(F.col("doc_id").cast("string"), F.lit("")), keys[2]: h})
    kept = own.join(winners, keys, "left_semi")
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(keys[1]))
    return kept.withColumn("__rf_nth", nth).where("__rf_nth = 1").select(*(F.col(f"`{c}`") for c in docs.columns))


def deduplicated(docs: DataFrame, words: int = WORDS, bits_apart: int = MAX_BITS) -> DataFrame:
    """One row of each near-duplicate group of ``docs``, as ``one_of_each`` takes it."""
    return one_of_each(docs, lambda keyed: near_duplicates(keyed, words, bits_apart))


def deduplicated_similar(docs: DataFrame, words: int = shingles.WORDS, like: float = shingles.LIKE) -> DataFrame:
    """One row of each group of texts that ``similar`` links, as ``one_of_each`` takes it."""
    return one_of_each(docs, lambda keyed: similar(keyed, words, like))


def query(spark, sf_dir: str) -> DataFrame:
    """op8: fingerprint and near-duplicate component of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = near_duplicates(docs.select(F.col("doc_id").alias("key"), "text"))
    return out.select(
        F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )
