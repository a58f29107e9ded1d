"""I-Match document fingerprints with randomised lexicons (DataFrame functions only).

The lexicon is the terms whose document frequency lies in a band. Of it there are fixed random
subsets: for each of ``SEEDS`` seeds one that keeps a quarter of all terms, a quarter of that, and so
on for ``RATES`` steps, whatever a document holds. A document's component for a subset is the hash of
all its sorted distinct terms that the subset keeps; besides there is one for the whole lexicon, which
is the plain I-Match fingerprint. Large subsets tell short texts apart and small ones long texts: the
likeness of two fingerprints is the share of equal components among those for which either text has a
term.

A term stands for itself by its 64-bit hash, its code. Texts are shuffled once, into ranges of
doc_id, where each row sees the next one. A range also gets a copy of the next range's first row, so
no window spans more than a range. Codes meet the lexicon, which is broadcast, while the rows stay
where they are.

Size of the lexicon: a term in it is in ``LOW_SHARE`` of the documents or more, and in so many that
no more than ``LEXICON`` terms can be (document frequencies add up to the distinct terms of all
documents). That bounds what is broadcast at every size of the input.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rallyframe.llm.scratch import write_scratch

#: The band: inverse document frequencies from log(1 / HIGH_SHARE) to log(1 / LOW_SHARE).
HIGH_SHARE = 0.05
LOW_SHARE = 0.0005
#: Terms in the lexicon, at most.
LEXICON = 2_000_000
SEEDS, RATES = 8, 5
#: Components are printed with so many bits.
_BITS = 32


def terms_of(text: Column) -> Column:
    """Distinct runs of letters and digits of a text in lower case, in order of appearance."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != ""))


def codes_of(text: Column) -> Column:
    """The codes of a text's distinct terms."""
    return F.transform(terms_of(text), lambda t: F.xxhash64(t))


def lexicon(docs: DataFrame, low: float = LOW_SHARE, high: float = HIGH_SHARE, most: int = LEXICON) -> DataFrame:
    """code of the terms in the band: in two documents or more, in ``low`` of all or more, and in ``high`` of them or less."""
    seen = docs.select(F.explode(codes_of(F.coalesce("text", F.lit("")))).alias("code")).groupBy("code").agg(F.count("*").alias("df"))
    seen = write_scratch(seen.where("df > 1"), "frequencies")
    n = docs.count()
    whole = seen.agg(F.sum("df")).first()[0] or 0
    return seen.where((F.col("df") >= max(2, low * n, whole / most)) & (F.col("df") <= max(2, high * n))).select("code")


def _bounds(docs: DataFrame, n: int) -> list[int]:
    """About ``n`` - 1 doc_ids that part the rows evenly."""
    steps = [i / n for i in range(1, n)]
    found = docs.agg(F.percentile_approx("doc_id", steps, 20 * n)).first()[0] if steps else None
    return sorted(set(found or []))


def _bucket(doc_id: Column, bounds: list[int]) -> Column:
    """How many bounds are less than doc_id (null: none), by steps of about sqrt(len(bounds))."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    coarse = F.lit(bounds[step - 1 :: step]) if bounds[step - 1 :: step] else F.array().cast("array<bigint>")
    at = F.size(F.filter(coarse, lambda b: b < doc_id))
    fine = F.slice(F.lit(bounds), at * step + 1, F.lit(step))
    return F.coalesce(at * step + F.size(F.filter(fine, lambda b: b < doc_id)), F.lit(0))


def in_order(docs: DataFrame, buckets: int) -> DataFrame:
    """bucket, guest, doc_id, h, text, next: each row with the next one's text by (doc_id, h).

    ``guest`` marks the copies of the following bucket's first row. The last row's next is the
    first row. Null doc_ids come first; h, a hash of the text, orders repeated doc_ids.
    """
    text = F.coalesce("text", F.lit(""))
    bounds = _bounds(docs, buckets)
    rows = docs.select(_bucket(F.col("doc_id"), bounds).alias("bucket"), "doc_id", F.xxhash64(text).alias("h"), text.alias("text"))
    # A row for each bucket from here on, up to the join that fetches their texts.
    heads = write_scratch(rows.groupBy("bucket").agg(F.min(F.struct("doc_id", "h")).alias("head")), "heads")
    every = Window.orderBy(F.col("head.doc_id").asc_nulls_first(), "head.h")
    before = F.coalesce(F.lag("bucket").over(every), F.max("bucket").over(Window.partitionBy()))
    hosts = heads.select(before.alias("host"), F.col("head.doc_id").alias("id"), F.col("head.h").alias("hh"))
    guests = rows.join(F.broadcast(hosts), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("hh")))
    guests = guests.select(F.col("host").alias("bucket"), F.lit(True).alias("guest"), "doc_id", "h", "text").dropDuplicates(["bucket"])
    both = rows.withColumn("guest", F.lit(False)).unionByName(guests)
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_first(), "h")
    return both.withColumns({"next": F.lead("text").over(order), "nth": F.row_number().over(order)})


def _retained(rows: DataFrame, words: DataFrame, carried: list[str]) -> DataFrame:
    """bucket, nth, carried, own, changed: the sorted codes of both texts' terms in the lexicon; of all their terms if none is.

    ``rows`` has bucket, nth, the columns ``carried`` and the codes of both texts, own and changed.
    """
    tag = lambda codes, on: F.transform(codes, lambda c: F.struct(c.alias("code"), F.lit(on).alias("on")))
    own, changed = F.col("own"), F.col("changed")
    # An entry without a code makes sure that every row stays, and brings what is known of it.
    none = F.array(F.struct(F.lit(None).cast("long").alias("code"), F.lit(0).alias("on")))
    each = F.concat(none, tag(F.array_except(own, changed), 1), tag(F.array_except(changed, own), 2), tag(F.array_intersect(own, changed), 3))
    exploded = rows.select("bucket", "nth", F.struct(*carried).alias("__said"), F.explode(each).alias("e"))
    exploded = exploded.select("bucket", "nth", F.when(F.col("e.on") == 0, F.col("__said")).alias("said"), "e.code", "e.on")
    met = exploded.join(F.broadcast(words.withColumn("known", F.lit(True))), "code", "left")
    lists = {
        f"{name}_{kind}": F.collect_list(F.when(F.col("on").bitwiseAND(bit) > 0, F.when(known, F.col("code"))))
        for name, bit in (("own", 1), ("changed", 2))
        for kind, known in (("in", F.col("known")), ("out", F.col("known").isNull()))
    }
    found = met.groupBy("bucket", "nth").agg(F.first("said", ignorenulls=True).alias("said"), *(c.alias(n) for n, c in lists.items()))
    kept = [F.array_sort(F.when(F.size(f"{n}_in") > 0, F.col(f"{n}_in")).otherwise(F.col(f"{n}_out"))).alias(n) for n in ("own", "changed")]
    return found.select("bucket", "nth", "said.*", *kept)


def in_subset(code: Column, seed: int, step: int) -> Column:
    """Whether the subset of a seed and step, 1 or more, keeps a term."""
    return F.xxhash64(code, F.lit(seed)).bitwiseAND(F.lit((1 << 2 * step) - 1)) == 0


def _subset(codes: str, seed: int, step: int) -> Column:
    return F.filter(codes, lambda c: in_subset(c, seed, step))


def _with_components(rows: DataFrame, names: list[str], seeds: int, rates: int) -> DataFrame:
    """Replaces each of ``names``, sorted codes, by the array of its components; null for a subset without terms."""
    parts = {n: [n] for n in names}
    last = {(n, s): n for n in names for s in range(seeds)}
    for step in range(1, rates + 1):
        # A step's subsets lie within those of the step before.
        made = {f"{n}_{s}_{step}": _subset(last[n, s], s, step) for n in names for s in range(seeds)}
        rows = rows.withColumns(made)
        for n in names:
            for s in range(seeds):
                last[n, s] = f"{n}_{s}_{step}"
                parts[n].append(last[n, s])
    one = lambda c: F.when(F.size(c) > 0, F.xxhash64(F.col(c)).bitwiseAND(F.lit((1 << _BITS) - 1)))
    spare = [c for n in names for c in parts[n][1:]]
    return rows.withColumns({n: F.array(*map(one, parts[n])) for n in names}).drop(*spare)


def likeness(a: Column, b: Column) -> Column:
    """The share of equal components among those that either has; 1 if neither has any."""
    pairs = F.zip_with(a, b, lambda x, y: F.when(x.isNotNull() | y.isNotNull(), F.coalesce(x == y, F.lit(False)).cast("int")))
    known = F.filter(pairs, lambda p: p.isNotNull())
    equal = F.aggregate(known, F.lit(0), lambda total, p: total + p)
    return F.when(a.isNotNull() & b.isNotNull(), F.when(F.size(known) > 0, equal / F.size(known)).otherwise(F.lit(1.0)))


def fingerprints(docs: DataFrame, low: float = LOW_SHARE, high: float = HIGH_SHARE, seeds: int = SEEDS, rates: int = RATES, buckets: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the document's with its last quarter replaced by the start of the next
    document. A document without terms in the band keeps all its terms. A null text counts as empty
    and has no component; a text of any length is taken whole. Repeated rows are taken each, next
    to each other; other columns are ignored; an empty table gives no rows. The next document of
    the last is the first, a single one's is itself.
    """
    spark = docs.sparkSession
    ranges = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = write_scratch(lexicon(docs, low, high), "lexicon")
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    rows = in_order(docs, ranges).withColumn("edited", F.concat(F.left("text", n - cut), F.left(F.coalesce("next", F.lit("")), cut)))
    rows = rows.select(
        "bucket", "nth", "guest", "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        codes_of(F.col("text")).alias("own"), codes_of(F.col("edited")).alias("changed"),
    )
    rows = _retained(rows, words, ["guest", "doc_id", "n_chars", "edited_sha256"])
    rows = _with_components(rows, ["own", "changed"], seeds, rates)
    after = Window.partitionBy("bucket").orderBy("nth")
    printed = rows.withColumn("following", F.lead("own").over(after)).where(~F.col("guest"))

    def text(hashes: str) -> Column:
        return F.array_join(F.transform(hashes, lambda h: F.coalesce(F.lower(F.lpad(F.hex(h), _BITS // 4, "0")), F.lit(""))), "-")

    return printed.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        text("own").alias("fingerprint"),
        text("changed").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: fingerprints of every document and of its edited text."""
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
