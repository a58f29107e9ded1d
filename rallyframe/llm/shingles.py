"""Sets of word shingles: their similarity, and an index in which no similar pair is missed.

Two texts are alike if the Jaccard similarity of their sets of word shingles is ``LIKE`` or more.
In any one order of all shingles, two sets that are alike share one among the first
n - ceil(LIKE * n) + 1 of each. So only these are indexed and joined. The order puts shingles that
are common in a sample last, which keeps lines that many texts repeat out of the index; it changes
no result.

Texts with the same shingles are a class, and only classes take part. Shingles stand for
themselves by 64-bit hashes; sets that are compared hold 32 bits of each, so that of two texts of
20,000 words one shingle in ten such pairs may be counted that only the low half agrees in.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rallyframe.llm.words import slices

WORDS = 5
LIKE = 0.8
SEED = 42
#: Share of the distinct texts in the sample that tells common shingles; one is common in so many of them.
SAMPLE, COMMON = 1 / 8, 2
#: Common shingles that are told from others, the most common first: what is broadcast is bounded by it.
MOST_COMMON = 1_000_000
#: 64-bit words of a set's sketch; a power of two.
SKETCH = 8

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def digests(text: str | None, words: int) -> np.ndarray:
    """Hashes of a text's word shingles, repeats included; of all its words if it has fewer; none without words."""
    found = _WORD.findall((text or "").encode().translate(_LOWER))
    k = min(words, len(found))
    if not k:
        return np.zeros(0, dtype="<u8")
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(s, SEED) for s in map(b" ".join, zip(*(found[i:] for i in range(k))))), dtype="<u8", count=len(found) - k + 1)


def indexed(n: int, like: float = LIKE) -> int:
    """How many of ``n`` shingles are indexed."""
    return n - math.ceil(like * n - 1e-9) + 1 if n else 0


def lists(parts: list[np.ndarray], kind) -> pa.Array:
    """Arrays of integers as a column of lists."""
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, kind), *parts])))


def common(keyed: DataFrame, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles that are common in a sample of distinct texts, and in how many of them each is.

    keyed: (text, h), with h a hash of the text.
    """
    some = keyed.where(F.pmod("h", F.lit(1 << 20)) < SAMPLE * (1 << 20)).groupBy("h").agg(F.min("text").alias("text"))

    def each(batches):
        for batch in batches:
            sets = [np.unique(digests(t, words)).view(np.int64) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *sets]))], names=["shingle"])

    seen = some.select("text").mapInArrow(each, "shingle long").groupBy("shingle").agg(F.count("*").alias("times"))
    found = seen.where(F.col("times") >= COMMON).orderBy(F.desc("times"), "shingle").limit(MOST_COMMON).toArrow()
    at, times = found["shingle"].to_numpy().view(np.uint64), found["times"].to_numpy()
    order = np.argsort(at)
    return at[order], times[order]


def first_of(own: np.ndarray, known: tuple[np.ndarray, np.ndarray], like: float = LIKE) -> np.ndarray:
    """Those of a text's sorted distinct shingles that are indexed."""
    many, (at, times) = indexed(len(own), like), known
    if not len(at) or not len(own):
        return own[:many]
    place = np.minimum(np.searchsorted(at, own), len(at) - 1)
    rank = np.where(at[place] == own, times[place], 0)
    return own[np.lexsort((own, rank))[:many]]


def shared(sets: DataFrame) -> DataFrame:
    """shingle, class, n, at, p1, p2 of indexed shingles that more than one class has, each once; sets: class, n, prefix.

    at is the shingle's place in the class's order, which is the same for all; p1 and p2 are the two before it.

    Which shingles these are is found by partial aggregates; a shingle of very many classes is then
    a skewed key of a join, which adaptive execution splits. Only shingles and classes take part in that join,
    as most shingles are of one class; the rest of a row is taken from the class's list after it.
    """
    # One struct, so that all three uses are of one shuffle.
    once = sets.groupBy("class").agg(F.first(F.struct("n", "prefix")).alias("of"))
    rows = once.select(F.explode("of.prefix").alias("shingle"), "class")
    several = rows.groupBy("shingle").agg(F.count("*").alias("times")).where("times > 1").select("shingle")
    held = rows.join(several, "shingle", "left_semi").join(once, "class")
    held = held.withColumn("at", (F.array_position("of.prefix", F.col("shingle")) - 1).cast("int"))
    return held.select("shingle", "class", "of.n", "at", *(F.get("of.prefix", F.col("at") - i).alias(f"p{i}") for i in (1, 2)))


def _grouped(index: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``index`` with their group, of shingles that more than one of ``groups`` (node, component) has."""
    left = index.join(groups, index["class"] == groups["node"], "left").select(
        "shingle", "class", "n", "at", "p1", "p2", F.coalesce("component", "class").alias("group")
    )
    several = left.groupBy("shingle").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low <> high").select("shingle")
    return left.join(several, "shingle", "left_semi")


def _may_be_alike(common: Column, n_a: Column, n_b: Column, like: float) -> Column:
    """Whether sets of two sizes with so many common indexed shingles may be alike.

    What two sets share is indexed in both, or lies beyond the indexed part of the one whose part
    ends first; so they share no more than that count and the longer of the two rests.
    """
    rest = F.ceil(like * F.greatest(n_a, n_b) - 1e-9) - 1
    lengths = F.least(n_a, n_b) >= like * F.greatest(n_a, n_b) - 1e-6
    return lengths & ((common + rest) * (1 + like) >= like * (n_a + n_b) - 1e-6)


def stars(index: DataFrame, groups: DataFrame, turn: int, like: float = LIKE) -> DataFrame:
    """a, b: classes with one of another group, the one that leads most of their shingles, if that may be alike.

    Each shingle is led by one of its classes, another in each ``turn``. So a shingle of very many
    classes gives one pair for each and not one for each two.
    """
    left = _grouped(index, groups)
    leads = left.groupBy("shingle").agg(F.min_by(F.struct("class", "n", "group"), F.xxhash64(F.lit(turn), "class")).alias("led"))
    leads = leads.select("shingle", F.col("led.class").alias("a"), F.col("led.n").alias("n_a"), F.col("led.group").alias("g_a"))
    met = left.join(leads, "shingle").where("group <> g_a").groupBy("class", "n", "a", "n_a").agg(F.count("*").alias("common"))
    met = met.where(_may_be_alike(F.col("common"), F.col("n"), F.col("n_a"), like))
    return met.groupBy(F.col("class").alias("b")).agg(F.max_by("a", F.struct("common", "a")).alias("a")).select("a", "b")


def sketch(low: np.ndarray) -> np.ndarray:
    """SKETCH words of parities of a set of 32-bit hashes: a bit tells whether an odd number of them fall on it.

    Two sets differ in as many members at least as their sketches do in bits.
    """
    odd = np.bincount(low.view(np.uint32) & np.uint32(64 * SKETCH - 1), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def across(index: DataFrame, groups: DataFrame, like: float = LIKE, sketches: DataFrame | None = None) -> DataFrame:
    """a, b: all classes that ``groups`` (node, component) hasn't in one group, and that may be alike by where they meet.

    The first shingle in the common order that two sets share has all their others behind it, in both. So two
    that are alike meet where enough of either set is left, and only such meetings leave the join. As rare shingles
    come first, sets that are not quite alike have used up what they may lack before they meet. Where one of the two
    shingles before is shared too, it isn't the first, so pairs that share long passages don't leave once for each shingle.
    With ``sketches`` (class, sketch) those don't leave either whose sketches say that they differ in more than alike sets may.
    """
    left = _grouped(index, groups)
    if sketches is not None:
        left = left.join(sketches.select("class", *(F.get("sketch", F.lit(i)).alias(f"w{i}") for i in range(SKETCH))), "class")
    return meetings(left, like).select("a", "b").distinct()


def meetings(left: DataFrame, like: float = LIKE) -> DataFrame:
    """a, b of the rows (shingle, class, n, at, p1, p2, group) of two groups that meet where they may be alike; a pair may several times.

    Rows may also have w0 and so on, the words of their class's sketch.
    """
    words = [c for c in (f"w{i}" for i in range(SKETCH)) if c in left.columns]
    of = lambda c: left.select("shingle", F.col("class").alias(c), *(F.col(k).alias(f"{k}_{c}") for k in ("n", "at", "p1", "p2", *words)), F.col("group").alias(f"g_{c}"))
    lengths = F.least("n_a", "n_b") >= like * F.greatest("n_a", "n_b") - 1e-6
    enough = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) * (1 + like) >= like * (F.col("n_a") + F.col("n_b")) - 1e-6
    met_before = F.coalesce(F.expr("p1_a = p1_b"), F.lit(False))
    for one, two in (("p1_a", "p2_b"), ("p2_a", "p1_b"), ("p2_a", "p2_b")):
        met_before = met_before | F.coalesce(F.col(one) == F.col(two), F.lit(False))
    may = F.expr("a < b and g_a <> g_b") & lengths & enough & ~met_before
    if words:
        differ = sum((F.bit_count(F.col(f"{w}_a").bitwiseXOR(F.col(f"{w}_b"))) for w in words), F.lit(0))
        may = may & (differ * (1 + like) <= (1 - like) * (F.col("n_a") + F.col("n_b")) + 1e-5)
    return of("a").join(of("b"), "shingle").where(may).select("a", "b")


def alike(pairs: DataFrame, sets: DataFrame, like: float = LIKE) -> DataFrame:
    """The pairs (a, b) of classes whose whole sets (class, set) are alike."""
    one = sets.select(F.col("class").alias("a"), F.col("set").alias("of_a"))
    two = sets.select(F.col("class").alias("b"), F.col("set").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    enough = both * (1 + like) >= like * (F.size("of_a") + F.size("of_b")) - 1e-6
    return pairs.join(one, "a").join(two, "b").where(enough).select("a", "b")


def parted(text: str | None, words: int, known: tuple[np.ndarray, np.ndarray], like: float) -> tuple[np.ndarray, int, int, np.ndarray, np.ndarray]:
    """A text's shingles with repeats, its class, how many distinct ones it has, those indexed, and its set."""
    every = digests(text, words)
    own = np.unique(every)
    low = np.unique((own & np.uint64(0xFFFFFFFF)).astype(np.uint32)).view(np.int32)
    return every, xxhash.xxh64_intdigest(own.tobytes(), SEED), len(own), first_of(own, known, like).view(np.int64), low


def sliced(batches):
    """The batches in slices of bounded bytes of their first column."""
    for batch in batches:
        yield from slices(batch, 0)
