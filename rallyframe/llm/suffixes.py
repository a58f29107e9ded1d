"""Removal of repeated byte strings by a distributed difference-cover suffix array.

A byte goes if it lies in a string of ``Rule.length`` bytes that also starts anywhere else. The
suffixes of all distinct texts are brought into order and neighbours compared, in steps of Spark jobs:

1. *Cuts.* A position is a cut if a hash of the few bytes from it says so. Where none follows for long, as
   in lines that repeat, one whose hash is least among the next is a cut too, and where none of those
   follows within ``Rule.gap`` bytes, every position is. That depends on the text to its right alone, so
   equal strings are cut alike, and every start of a string has a cut within the gap. The string runs on
   for ``Rule.right`` bytes at least after that cut. Cuts whose next ``right`` bytes are found nowhere else can't serve
   a repeat and are left out; the others, with the text around them, are the *zones*.
2. *Names.* The phrase of a cut reaches to the end of the bytes that decide on the next cut, so no phrase
   begins another. Distinct phrases are sorted, their places are the names, and a zone is a string of names.
3. *Difference cover* (``suffix_ranks``). The triples of names at places 1 and 2 modulo 3 are sorted and
   named; strings that hold a name which suffixes share that may differ within ``length`` bytes are ranked
   by recursion on the names (by one task, once there are few enough), and the suffixes at places 0 modulo 3 are merged in: ranks count the smaller
   suffixes, which two sorts give, one with the suffixes at places 1 and one with those at places 2.
4. *Adjacent prefixes.* Neighbours in that order are compared; cuts with equal ``length`` bytes form a
   class. Places of a class with equal bytes before the cut repeat with all their starts.
5. *Remaining suffixes*, those that start between cuts near the edge of a repeat, are merged by what
   lies before their cut and its rank, and neighbours compared again.

Every order is a range partitioning with offsets for its parts (``below``), never one task's sort, and
ties are grouped before they are sorted. What a task holds is one text or one zone at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rallyframe.llm.scratch import discard, release, write_scratch


@dataclass(frozen=True)
class Rule:
    """length: bytes of a repeat. gram: bytes hashed for a cut, a power of two. every: one position in so many is a cut. gap: bytes without a cut before every position is one."""

    length: int = 400
    gram: int = 16
    every: int = 48
    gap: int = 240

    def __post_init__(self):
        if self.gap + self.lonely + self.gram > self.length or self.gap < 4 or self.gram & (self.gram - 1):
            raise ValueError("one and a half gaps and gram must fit into length, and gram be a power of two")

    @property
    def lonely(self) -> int:
        return self.gap // 2

    @property
    def least_of(self) -> int:
        """The hash of a lonely cut is the least of so many that follow; a power of two below ``lonely``."""
        return 1 << ((self.gap // 3).bit_length() - 1)

    @property
    def right(self) -> int:
        return self.length - self.gap

    @property
    def ladder(self) -> list[int]:
        """Lengths at which the prefixes of neighbours are compared, the last one being ``length``."""
        return [self.right + self.gap * i // 4 for i in range(5)]


#: Bytes of a text that are searched for cuts at a time.
BLOCK = 1 << 20
#: Names of all strings of a round that one task may rank. It changes no result.
TOGETHER = 1_000_000
#: Digests a task remembers, so that copies it meets again are not searched again. It changes no result.
REMEMBERED = 1_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(32)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _SHIFT)) * _ODD
    return h ^ (h >> _SHIFT)


def hits(buf: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose next ``gram`` bytes hash to a cut, and those whose hash no other of the next ``least_of`` is below; ascending."""
    found, low, wide = [], [], rule.least_of
    for start in range(0, max(len(buf) - rule.gram + 1, 0), BLOCK):
        h = _mixed(buf[start : start + BLOCK + wide + rule.gram - 1].astype(np.uint64) + np.uint64(1))
        size = 1
        while size < rule.gram:
            h = _mixed(h[: len(h) - size] * _ODD + h[size:])
            size *= 2
        found.append(np.flatnonzero(h[:BLOCK] < np.uint64(2**64 // rule.every)) + start)
        least, size = h[1:], 1
        while size < wide:
            least = np.minimum(least[: max(len(least) - size, 0)], least[size:])
            size *= 2
        low.append(np.flatnonzero(h[: len(least)] <= least) + start)
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found), np.concatenate(low)


def cuts(buf: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Cuts of a text, ascending, and how many bytes from each decided that it is one."""
    at, low = hits(buf, rule)
    last = len(buf) - rule.gram + 1
    following = np.append(at, last)[np.searchsorted(at, low)] if len(low) else low
    second = low[following - low >= rule.lonely]
    some = np.concatenate([at, second])
    decided = np.concatenate([np.full(len(at), rule.gram), np.full(len(second), rule.lonely + rule.gram)])
    order = np.argsort(some, kind="stable")
    some, decided = some[order], decided[order]
    last -= rule.lonely
    edges = np.concatenate([[-1], some[some < last], [max(last, -1)]])
    wide = np.flatnonzero(np.diff(edges) > rule.gap)
    others = np.concatenate([np.empty(0, np.int64), *[np.arange(edges[i] + 1, edges[i + 1] - rule.gap + 1) for i in wide]])
    if not len(others):
        return some, decided
    every = np.concatenate([some, others])
    decided = np.concatenate([decided, np.full(len(others), rule.gap + rule.lonely + rule.gram)])
    order = np.argsort(every, kind="stable")
    return every[order], decided[order]


def serving(buf: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Cuts that some start of a whole string has as its next one, and how many positions up to them do."""
    at, _ = cuts(buf, rule)
    before = np.concatenate([[-1], at])[: len(at)]
    width = np.minimum(at - before, rule.gap)
    keep = at - width + 1 <= len(buf) - rule.length
    return at[keep], width[keep]


def _texts(docs: DataFrame) -> DataFrame:
    """Adds bytes, sha (SHA-256, hex) and t, the key of a distinct text, to docs (doc_id, text)."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    sha = F.sha2(text, 256)
    return docs.select("doc_id", text.alias("bytes"), sha.alias("sha"), F.unhex(F.substring(sha, 1, 32)).alias("t"))


def cut_digests(texts: DataFrame, rule: Rule, whole: bool) -> DataFrame:
    """digest of the ``right`` bytes after each serving cut, with mark, which tells places apart, or (t, at, width)."""
    ten = np.uint64(1 << 40)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[bytes] = set()
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                key, view = key.as_py(), memoryview(text.as_buffer())
                if key in known:
                    continue
                if len(known) < REMEMBERED:
                    known.add(key)
                at, width = serving(np.frombuffer(view, np.uint8), rule)
                if not len(at):
                    continue
                digest = np.array([xxhash.xxh3_64_intdigest(view[p : p + rule.right]) for p in at.tolist()], np.uint64).view(np.int64)
                if whole:
                    yield pa.RecordBatch.from_arrays([pa.array(digest), pa.array([key] * len(at), pa.binary()), pa.array(at.astype(np.int32)), pa.array(width.astype(np.int32))], ["digest", "t", "at", "width"])
                else:
                    mark = _mixed(np.frombuffer(key[:8], np.uint64) + _mixed(at.astype(np.uint64) + ten)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(digest), pa.array(mark)], ["digest", "mark"])

    schema = "digest long, t binary, at int, width int" if whole else "digest long, mark long"
    return texts.select("t", "bytes").mapInArrow(run, schema)


def zones(texts: DataFrame, rule: Rule) -> DataFrame:
    """zone, t, zone_start, bytes, served (at, width) of the stretches that may hold repeats; written, so zone is fixed.

    Overlapping stretches of a text are one zone. served is relative to the zone.
    """
    long = texts.where(F.octet_length("bytes") >= rule.length)
    places = cut_digests(long, rule, whole=False).groupBy("digest").agg(F.min("mark").alias("a"), F.max("mark").alias("b"))
    again = write_scratch(places.where("a <> b").select("digest"), "digests")
    served = cut_digests(long, rule, whole=True).join(again, "digest", "left_semi")
    served = write_scratch(served.groupBy("t").agg(F.sort_array(F.collect_set(F.struct("at", "width"))).alias("served")), "served")
    one = long.select("t", "bytes").dropDuplicates(["t"]).join(served, "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, places in zip(batch.column(0), batch.column(1), batch.column(2)):
                view = memoryview(text.as_buffer())
                at, width = (places.values.field(i).to_numpy() for i in (0, 1))
                start, end = at - width + 1, np.minimum(at + rule.length, len(view))
                first = np.flatnonzero(np.concatenate([[True], start[1:] > np.maximum.accumulate(end)[:-1]]))
                rows = []
                for i, j in zip(first.tolist(), [*first[1:].tolist(), len(at)]):
                    a = int(start[i])
                    rows.append((key.as_py(), a, bytes(view[a : int(end[i:j].max())]), [(int(p) - a, int(w), int(min(p + rule.length, len(view)) - p)) for p, w in zip(at[i:j], width[i:j])]))
                columns = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate((pa.binary(), pa.int32(), pa.binary()))]
                served = pa.array([[dict(zip(("at", "width", "room"), x)) for x in r[3]] for r in rows], pa.list_(pa.struct([("at", pa.int32()), ("width", pa.int32()), ("room", pa.int32())])))
                yield pa.RecordBatch.from_arrays([*columns, served], ["t", "zone_start", "bytes", "served"])

    found = one.mapInArrow(run, "t binary, zone_start int, bytes binary, served array<struct<at: int, width: int, room: int>>")
    out = write_scratch(found.select(F.monotonically_increasing_id().alias("zone"), "*"), "zones")
    discard(again)
    discard(served)
    release(texts.sparkSession)
    return out


def _phrases(view: memoryview, rule: Rule) -> Iterator[tuple[int, bytes]]:
    """(cut, phrase) of each cut of a zone."""
    at, decided = (x.tolist() for x in cuts(np.frombuffer(view, np.uint8), rule))
    for i, p in enumerate(at):
        if i + 1 == len(at):
            end = p + rule.length
        else:
            end = at[i + 1] + decided[i + 1]
        yield p, bytes(view[p : min(end, len(view))])


def phrase_rows(zoned: DataFrame, rule: Rule, text: bool) -> DataFrame:
    """The phrase of each cut of the zones, or (zone, place, at, key): which cut of the zone has which phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for zone, held in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = list(_phrases(memoryview(held.as_buffer()), rule))
                if text:
                    yield pa.RecordBatch.from_arrays([pa.array(sorted({p for _, p in found}), pa.binary())], ["phrase"])
                else:
                    keys = [hashlib.sha256(p).digest()[:16] for _, p in found]
                    columns = [pa.array([zone] * len(found), pa.int64()), pa.array(range(len(found)), pa.int32()), pa.array([p for p, _ in found], pa.int32()), pa.array(keys, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["zone", "place", "at", "key"])

    return zoned.select("zone", "bytes").mapInArrow(run, "phrase binary" if text else "zone long, place int, at int, key binary")


def ranged(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` range partitioned by ``keys`` and written, with its part."""
    return write_scratch(df.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), "ranged")


def below(df: DataFrame, keys: list[str], counts: list[str]) -> DataFrame:
    """Adds ``<c>_below``, the sum of c over all rows with smaller keys, for each of ``counts``. Keys are distinct."""
    held = ranged(df, keys)
    totals = held.groupBy("part").agg(*[F.sum(c).alias(c) for c in counts])
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    offsets = totals.select("part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_base") for c in counts])
    within = Window.partitionBy("part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    sums = held.withColumns({f"{c}_below": F.coalesce(F.sum(c).over(within), F.lit(0)) for c in counts})
    out = sums.join(F.broadcast(offsets), "part").select(*df.columns, *[(F.col(f"{c}_below") + F.col(f"{c}_base")).alias(f"{c}_below") for c in counts])
    out = write_scratch(out, "below")
    discard(held)
    return out


def beside(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """Adds before and after, ``value`` of the rows next to each in the order of ``keys``. Keys are distinct."""
    held = ranged(df.withColumn("value", value), keys)
    order, part = F.struct(*keys), Window.orderBy("part")  # a row per part
    ends = held.groupBy("part").agg(F.min_by("value", order).alias("first"), F.max_by("value", order).alias("last"))
    ends = ends.select("part", F.lag("last").over(part).alias("left"), F.lead("first").over(part).alias("right"))
    within = Window.partitionBy("part").orderBy(*keys)
    rows = held.withColumns({"before": F.lag("value").over(within), "after": F.lead("value").over(within)}).join(F.broadcast(ends), "part")
    out = write_scratch(rows.withColumns({"before": F.coalesce("before", "left"), "after": F.coalesce("after", "right")}).drop("left", "right", "value", "part"), "beside")
    discard(held)
    return out


def ranked_together(strings: DataFrame) -> DataFrame:
    """zone, branch, place, rank of the suffixes of ``strings``, in one task: by doubled prefixes. For at most TOGETHER names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        names = table["names"].combine_chunks()
        sizes = np.diff(names.offsets.to_numpy())
        rank = names.flatten().to_numpy().astype(np.int64)
        place = np.arange(len(rank)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        left = np.repeat(sizes, sizes) - place
        many, step = 0, 1
        while True:
            after = np.where(left > step, np.append(rank[step:], np.zeros(min(step, len(rank)), np.int64))[: len(rank)], 0)
            order = np.lexsort((after, rank))
            fresh = np.concatenate([[True], (np.diff(rank[order]) != 0) | (np.diff(after[order]) != 0)])
            rank = np.empty_like(rank)
            rank[order] = np.cumsum(fresh)
            if rank.max() == many:
                break
            many, step = int(rank.max()), step * 2
        zone, branch = (np.repeat(table[c].to_numpy(), sizes) for c in ("zone", "branch"))
        for at in range(0, len(rank), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(zone[part]), pa.array(branch[part]), pa.array(place[part].astype(np.int32)), pa.array(rank[part])], ["zone", "branch", "place", "rank"])

    return strings.select("zone", "branch", "names").coalesce(1).mapInArrow(run, "zone long, branch long, place int, rank long")


def _told_apart(coded: DataFrame, rule: Rule) -> DataFrame:
    """zone, branch, place, rank of the places whose name is open, that is shared by suffixes that may differ.

    Only strings of names with an open one are ranked; a suffix goes by its name, then by that rank. If they
    hold no more than TOGETHER names, one task ranks them, else they are the next round's strings.
    """
    place = F.struct("place", "name", "at")
    inner = coded.groupBy("zone", (F.col("branch") * 2 + F.col("place") % 3 - 1).alias("branch")).agg(F.sort_array(F.collect_list(place)).alias("s"), F.max("open").alias("open"))
    inner = write_scratch(inner.where("open").select("zone", "branch", F.col("s.name").alias("names"), F.col("s.at").alias("ats")), "inner")
    few = inner.agg(F.sum(F.size("names"))).first()[0] <= TOGETHER
    inner = ranked_together(inner) if few else suffix_ranks(inner, rule)
    half = F.pmod(F.col("branch"), F.lit(2))
    inner = inner.select("zone", ((F.col("branch") - half) / 2).cast("long").alias("branch"), (F.col("place") * 3 + half + 1).cast("int").alias("place"), F.col("rank").alias("next"))
    opened = write_scratch(coded.where("open").join(inner, ["zone", "branch", "place"]).select("zone", "branch", "place", "name", "next"), "opened")
    counted = below(opened.groupBy("name", "next").agg(F.count("*").alias("n")), ["name", "next"], ["n"])
    least = counted.groupBy("name").agg(F.min("n_below").alias("least"))
    rank = (F.col("name") + F.col("n_below") - F.col("least")).alias("rank")
    return opened.join(counted.join(least, "name").select("name", "next", rank), ["name", "next"]).select("zone", "branch", "place", "rank")


def suffix_ranks(strings: DataFrame, rule: Rule) -> DataFrame:
    """zone, branch, place, rank of every suffix of ``strings`` (zone, branch, names, ats), by a difference cover modulo 3.

    Ranks of suffixes that differ within ``length`` bytes are in their order; others may tie or stand in
    any order next to each other. names are positive and order phrases; ats are their positions, by which
    the bytes that a triple spans are known. ``strings`` is a table that was written.
    """
    name = lambda i: F.coalesce(F.get("names", i), F.lit(0).cast("long"))
    places = F.sequence(F.lit(0), F.size("names") - 1)
    span = lambda i: F.coalesce(F.get("ats", i + 3) - F.get("ats", i), F.lit(2**31 - 1))
    triple = lambda i: F.struct(i.alias("place"), name(i).alias("t1"), name(i + 1).alias("t2"), name(i + 2).alias("t3"), span(i).alias("span"), F.get("ats", i).alias("at"))
    sampled = strings.select("zone", "branch", F.inline(F.transform(F.filter(places, lambda i: i % 3 != 0), triple)))
    key = ["t1", "t2", "t3"]
    named = below(sampled.groupBy(*key).agg(F.count("*").alias("n"), F.min("span").alias("span")), key, ["n"])
    tied = (F.col("n") > 1) & (F.col("span") < rule.length)
    coded = sampled.drop("span").join(named.select(*key, (F.col("n_below") + 1).alias("name"), tied.alias("open")), key)
    coded = write_scratch(coded.select("zone", "branch", "place", "at", "name", "open"), "coded")
    discard(named)
    ranks = coded.where("NOT open").select("zone", "branch", "place", F.col("name").alias("rank"))
    if not coded.where("open").isEmpty():
        ranks = ranks.unionByName(_told_apart(coded, rule))
    ranks = write_scratch(ranks, "ranks")
    discard(coded)
    release(strings.sparkSession)

    # Places 1 and 2 of a zone are held as one array: place 3m + r has the index 2m + r - 1.
    held = ranks.groupBy("zone", "branch").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "rank"))), lambda s: s["rank"]).alias("ranks"))
    rank = lambda i: F.coalesce(F.get("ranks", (F.floor(i / 3) * 2 + i % 3 - 1).cast("int")), F.lit(0).cast("long"))
    suffix = lambda i: F.struct(
        i.alias("place"), (i % 3).alias("r"), name(i).alias("t1"), name(i + 1).alias("t2"),
        F.when(i % 3 != 2, rank(i + 1)).alias("r1"), F.when(i % 3 != 1, rank(i + 2)).alias("r2"), F.when(i % 3 != 0, rank(i)).alias("own"),
    )
    every = write_scratch(strings.join(held, ["zone", "branch"], "left").select("zone", "branch", F.inline(F.transform(places, suffix))), "suffixes")
    of = lambda r, c: F.sum((F.col("r") == r).cast("long")).alias(c)
    with1 = below(every.where("r <> 2").groupBy("t1", "r1").agg(of(0, "zero"), of(1, "one")), ["t1", "r1"], ["zero", "one"])
    with2 = below(every.where("r <> 1").groupBy("t1", "t2", "r2").agg(of(0, "zero"), of(2, "two")), ["t1", "t2", "r2"], ["zero", "two"])
    both = below(every.where("r <> 0").groupBy("own").agg(of(1, "one"), of(2, "two")), ["own"], ["one", "two"])
    with1 = with1.select("t1", "r1", (F.col("zero_below") + F.col("one_below")).alias("x"))
    with2 = with2.select("t1", "t2", "r2", (F.col("zero_below") + F.col("two_below")).alias("y"), "two_below")
    both = both.select("own", F.col("one_below").alias("ones"), F.col("two_below").alias("twos"))
    zero = every.where("r = 0").join(with1, ["t1", "r1"]).join(with2, ["t1", "t2", "r2"]).withColumn("rank", F.col("x") + F.col("two_below") + 1)
    one = every.where("r = 1").join(with1, ["t1", "r1"]).join(both, "own").withColumn("rank", F.col("x") + F.col("twos") + 1)
    two = every.where("r = 2").join(with2, ["t1", "t2", "r2"]).join(both, "own").withColumn("rank", F.col("y") + F.col("ones") + 1)
    out = [part.select("zone", "branch", "place", "rank") for part in (zero, one, two)]
    ranked = write_scratch(out[0].unionByName(out[1]).unionByName(out[2]), "ranks")
    for used in (strings, ranks, every, with1, with2, both):
        discard(used)
    release(strings.sparkSession)
    return ranked


def zone_strings(zoned: DataFrame, rule: Rule) -> DataFrame:
    """zone, branch (1), names, ats of each zone."""
    named = below(phrase_rows(zoned, rule, text=True).groupBy("phrase").agg(F.count("*").alias("n")), ["phrase"], ["n"])
    codes = named.select(F.unhex(F.substring(F.sha2("phrase", 256), 1, 32)).alias("key"), (F.col("n_below") + 1).alias("name"))
    rows = phrase_rows(zoned, rule, text=False).join(codes, "key")
    held = rows.groupBy("zone").agg(F.sort_array(F.collect_list(F.struct("place", "name", "at"))).alias("s"))
    return held.select("zone", F.lit(1).cast("long").alias("branch"), F.col("s.name").alias("names"), F.col("s.at").alias("ats"))


def cut_facts(zoned: DataFrame, rule: Rule) -> DataFrame:
    """zone, place, at, width, least, head, prefixes of the serving cuts of the zones.

    Their starts lie least to width - 1 bytes before the cut. head is a digest of the width - 1 bytes
    before it, prefixes one of each length of the ladder.
    """
    ladder = rule.ladder

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = lambda b: xxhash.xxh3_64_intdigest(b) - 2**63
        for batch in batches:
            for zone, held, served in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                view = memoryview(held.as_buffer())
                at, _ = cuts(np.frombuffer(view, np.uint8), rule)
                place = np.searchsorted(at, [s["at"] for s in served]).tolist()
                rows = [(zone, j, s["at"], s["width"], max(0, rule.length - s["room"]), digest(view[s["at"] - s["width"] + 1 : s["at"]]), [digest(view[s["at"] : s["at"] + n]) for n in ladder]) for j, s in zip(place, served)]
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["zone", "place", "at", "width", "least", "head", "prefixes"])

    return zoned.select("zone", "bytes", "served").mapInArrow(run, "zone long, place int, at int, width int, least int, head long, prefixes array<long>")


def classes(facts: DataFrame, rule: Rule) -> DataFrame:
    """rank, class, near of each rank of ``facts`` (rank, prefixes): neighbours with equal ``length`` bytes are one class.

    near is how many lengths of the ladder the class shares with the nearest suffix of another class.
    """
    steps = len(rule.ladder)
    rows = beside(facts.groupBy("rank").agg(F.min("prefixes").alias("prefixes")), ["rank"], F.col("prefixes"))
    shared = lambda other: F.coalesce(F.size(F.filter(F.zip_with("prefixes", other, lambda a, b: a == b), lambda same: same)), F.lit(0))
    rows = rows.select("rank", shared("before").alias("left"), shared("after").alias("right"))
    other = lambda c: F.when(F.col(c) < steps, F.col(c)).otherwise(F.lit(0))
    rows = rows.select("rank", F.greatest(other("left"), other("right")).alias("near"), (F.col("left") < steps).cast("long").alias("opens"))
    rows = below(rows, ["rank"], ["opens"])
    return rows.select("rank", "near", (F.col("opens_below") + F.col("opens")).alias("class"))


def tails(zoned: DataFrame, asked: DataFrame, rule: Rule) -> DataFrame:
    """lot, back, head, rank, digest of the suffixes that start ``low`` to width - 1 bytes before the asked cuts (zone, at, width, low, lot, rank)."""
    wanted = asked.groupBy("zone").agg(F.collect_list(F.struct("at", "width", "low", "lot", "rank")).alias("wanted"))
    held = zoned.select("zone", "bytes").join(wanted, "zone").select("bytes", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for text, wanted in zip(batch.column(0), batch.column(1).to_pylist()):
                view = memoryview(text.as_buffer())
                rows = []
                for w in wanted:
                    at = w["at"]
                    for back in range(w["low"], w["width"]):
                        rows.append((w["lot"], back, digest(view[at - back : at], back) - 2**63, w["rank"], digest(view[at - back : at - back + rule.length]) - 2**63))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["lot", "back", "head", "rank", "digest"])

    return held.mapInArrow(run, "lot long, back int, head long, rank long, digest long")


def repeated_starts(zoned: DataFrame, rule: Rule) -> DataFrame:
    """t, starts: where repeated strings start in each distinct text, as runs (low, high)."""
    ranks = suffix_ranks(write_scratch(zone_strings(zoned, rule), "strings"), rule).select("zone", "place", "rank")
    facts = write_scratch(cut_facts(zoned, rule).join(ranks, ["zone", "place"]), "facts")
    classed = classes(facts, rule)
    members = write_scratch(facts.drop("prefixes").join(classed, "rank"), "members")
    discard(facts)
    discard(classed)
    release(zoned.sparkSession)
    lot = ["class", "width", "least", "head"]
    many = members.groupBy("class").agg(F.max("near").alias("near"), F.min(F.struct(*lot)).alias("a"), F.max(F.struct(*lot)).alias("b"))
    grouped = members.groupBy(*lot).agg(F.count("*").alias("n"), F.min(F.struct("zone", "at", "rank")).alias("one"))
    lots = write_scratch(grouped.select(F.monotonically_increasing_id().alias("lot"), "*"), "lots")
    ladder = F.array(*[F.lit(n) for n in rule.ladder])
    low = F.when(F.col("a") != F.col("b"), F.lit(0)).otherwise(F.lit(rule.length + 1) - F.get(ladder, F.col("near")))
    asked = lots.join(many, "class").select("one.*", "width", "lot", F.greatest(low, F.col("least")).alias("low")).where("low < width")
    release(zoned.sparkSession)
    suffixes = write_scratch(tails(zoned, asked, rule), "tails")
    release(zoned.sparkSession)
    same = beside(suffixes.groupBy("head", "rank", "digest").agg(F.count("*").alias("n")), ["head", "rank", "digest"], F.struct("head", "digest"))
    me = F.struct("head", "digest")
    again = same.where((F.col("n") > 1) | F.coalesce(F.col("before") == me, F.lit(False)) | F.coalesce(F.col("after") == me, F.lit(False)))
    found = suffixes.join(again.select("head", "rank", "digest"), ["head", "rank", "digest"]).groupBy("lot").agg(F.collect_set("back").alias("backs"))
    lots = lots.join(found, "lot", "left").where("n > 1 OR backs IS NOT NULL").select(*lot, "n", "backs")
    rows = members.join(lots, lot)
    whole = F.array(F.struct((F.col("at") - F.col("width") + 1).alias("low"), (F.col("at") - F.col("least")).alias("high")))
    single = F.transform("backs", lambda x: F.struct((F.col("at") - x).alias("low"), (F.col("at") - x).alias("high")))
    runs = rows.select("zone", F.when(F.col("n") > 1, whole).otherwise(single).alias("runs")).groupBy("zone").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    placed = runs.join(zoned.select("zone", "t", "zone_start"), "zone")
    moved = F.transform("runs", lambda x: F.struct((x["low"] + F.col("zone_start")).alias("low"), (x["high"] + F.col("zone_start")).alias("high")))
    return placed.select("t", moved.alias("runs")).groupBy("t").agg(F.flatten(F.collect_list("runs")).alias("starts"))


def cut_out(texts: DataFrame, rule: Rule) -> DataFrame:
    """t, n_removed, n_spans, kept_sha256 of texts (t, bytes, starts) without the strings that start there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text, starts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                view = memoryview(text.as_buffer())
                low, high = (starts.values.field(i).to_numpy().astype(np.int64) for i in (0, 1))
                steps = np.zeros(len(view) + 1, np.int32)
                np.add.at(steps, low, 1)
                np.add.at(steps, high + rule.length, -1)
                gone = np.cumsum(steps[:-1]) > 0
                spans = int(gone[0]) + int(np.count_nonzero(~gone[:-1] & gone[1:]))
                rows.append((key, int(gone.sum()), spans, hashlib.sha256(np.frombuffer(view, np.uint8)[~gone].tobytes()).hexdigest()))
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["t", "n_removed", "n_spans", "kept_sha256"])

    return texts.select("t", "bytes", "starts").mapInArrow(run, "t binary, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row of ``docs`` (doc_id, text).

    Texts are UTF-8 bytes; null is empty. A byte is removed if a string of ``rule.length`` bytes over it
    starts anywhere else too, in the same text (overlaps count) or another; strings don't cross texts.
    So a text that several rows have goes whole if it is long enough; a shorter one stays. Repeated
    rows, equal and null doc_ids are rows of their own. Empty tables give no rows. Very long texts are
    searched in blocks. Other columns are ignored.
    """
    base = _texts(docs)
    zoned = zones(base.select("t", "bytes"), rule)
    starts = write_scratch(repeated_starts(zoned, rule), "starts")
    copied = base.where(F.octet_length("bytes") >= rule.length).groupBy("t").agg(F.count("*").alias("n")).where("n > 1").select("t")
    copied = write_scratch(copied, "copied")
    part = starts.join(copied, "t", "left_anti")
    edited = cut_out(base.select("t", "bytes").join(part.select("t"), "t", "left_semi").dropDuplicates(["t"]).join(part, "t"), rule)
    whole = copied.select("t", F.lit(-1).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(hashlib.sha256(b"").hexdigest()).alias("kept_sha256"))
    changed = write_scratch(edited.unionByName(whole), "changed")
    rows = base.select("doc_id", F.octet_length("bytes").cast("long").alias("n_bytes"), "sha", "t").join(changed, "t", "left")
    removed = F.when(F.col("n_removed") < 0, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long")))
    return rows.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256")
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op13: all documents without their repeated strings of 400 bytes."""
    return without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
