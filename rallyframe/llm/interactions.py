"""How filters interact: direct replay of every order of five document filters (DataFrame functions only).

Each document's five failure flags meet all 120 orders of the filters, a table of fixed size that is
broadcast; each order's five steps are exploded, the first failing step says where the document goes,
and all counts of a part, an order and a step are one aggregation, which combines before it shuffles.
A hot source is therefore a few partial rows per task, however many documents it holds.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The filters, by letter; a document's flags hold bit i where it fails the filter FILTERS[i].
FILTERS = "ABCDE"
_WORD = r"[^\x20\x09-\x0D]+"


def failures(text: Column) -> dict[str, Column]:
    """Whether a text (not null) fails A to D: too short, repetitive, upper-case or with odd characters."""
    words = F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))
    return {
        "A": F.size(words) < 50,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 65,
        "C": F.length(F.regexp_replace(text, "[^A-Z]", "")) * 100 > F.length(text) * 5,
        "D": text.rlike("[#$%&*|]"),
    }


def flagged(docs: DataFrame) -> DataFrame:
    """doc_id, part, flags of each document; part is its source, an empty string for null.

    E fails a document whose whole text some document with a smaller doc_id has; a null doc_id is
    neither smaller nor larger than any. Null texts are empty texts. Other columns are ignored.
    Texts are told apart by SHA-256, so only digests are shuffled; those of one document alone are
    dropped before they meet the documents.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", F.coalesce(F.col("source"), F.lit("")).alias("part"), text.alias("text"))
    digest = F.unhex(F.sha2("text", 256))
    bits = sum((F.when(fails, F.lit(1 << FILTERS.index(f))).otherwise(F.lit(0)) for f, fails in failures(F.col("text")).items()), F.lit(0))
    rows = base.select("doc_id", "part", digest.alias("digest"), bits.alias("bits"))
    first = base.select("doc_id", digest.alias("digest")).groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    first = first.where("first < last").drop("last")
    repeat = F.when(F.col("doc_id") > F.col("first"), F.lit(1 << FILTERS.index("E"))).otherwise(F.lit(0))
    return rows.join(first, "digest", "left").select("doc_id", "part", (F.col("bits") + repeat).cast("int").alias("flags"))


def orders(spark) -> DataFrame:
    """filter_order and its steps (step, bit): 120 rows, whatever the input."""
    every = ["".join(p) for p in permutations(FILTERS)]
    rows = [(o, [(i + 1, 1 << FILTERS.index(f)) for i, f in enumerate(o)]) for o in every]
    return spark.createDataFrame(rows, "filter_order string, steps array<struct<step: int, bit: int>>")


def replay(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter_order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``flags`` has doc_id, part and flags; ``labels`` doc_id, quality and toxic, where a label counts
    as 1 if any row of the doc_id says so, and documents without labels count as 0. Every part of
    ``flags`` gets all 600 rows; no documents give no rows. Repeated rows count each.
    """
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    good, toxic = (F.coalesce(F.col(c) == 1, F.lit(False)).alias(c) for c in ("quality", "toxic"))
    rows = flags.select("doc_id", "part", "flags").join(known, "doc_id", "left").select("part", "flags", good, toxic)
    crossed = rows.crossJoin(F.broadcast(orders(flags.sparkSession)))
    fails = lambda bit: F.col("flags").bitwiseAND(bit) != 0
    first = F.lit(len(FILTERS) + 1)
    for i in reversed(range(len(FILTERS))):
        first = F.when(fails(F.col("steps")[i]["bit"]), F.lit(i + 1)).otherwise(first)
    steps = crossed.withColumn("first", first).select("part", "filter_order", "flags", "quality", "toxic", "first", F.explode("steps").alias("s"))
    removed, failing = F.col("first") == F.col("s.step"), fails(F.col("s.bit"))
    count = lambda which: F.sum(which.cast("long"))
    counts = steps.groupBy("part", "filter_order", F.col("s.step").alias("step")).agg(
        count(F.col("first") > F.col("s.step")).alias("kept"),
        count(removed).alias("removed"),
        count(failing & (F.col("first") < F.col("s.step"))).alias("redundant"),
        count(F.col("flags") == F.col("s.bit")).alias("unique_fails"),
        count(removed & F.col("quality")).alias("good_lost"),
        count(removed & F.col("toxic")).alias("toxic_lost"),
    )
    everywhere = Window.partitionBy("part", F.substring("filter_order", F.col("step"), F.lit(1)))
    return counts.withColumn("shapley", F.sum("removed").over(everywhere))


def query(spark, sf_dir: str) -> DataFrame:
    """op11: the five filters replayed in all orders over all documents, by source."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return replay(flagged(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"))


ORACLE = r"""WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
 w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
 f AS (SELECT doc_id, part, [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t),
   regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > least, FALSE)] AS fails FROM w),
 l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY 1),
 g AS (SELECT part, fails[1] AS a, fails[2] AS b, fails[3] AS c, fails[4] AS d, fails[5] AS e, coalesce(quality, 0) = 1 AS good, coalesce(toxic, 0) = 1 AS toxic, count(*) AS n
   FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
 one AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
 o AS (SELECT p.x || q.x || r.x || s.x || u.x AS filter_order FROM one p, one q, one r, one s, one u WHERE len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5),
 z AS (SELECT filter_order, step, filter_order[step] AS letter, filter_order[1:step - 1] AS before FROM o, range(1, 6) t(step)),
 h AS (SELECT *, CASE letter WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS this,
   (a AND contains(before, 'A')) OR (b AND contains(before, 'B')) OR (c AND contains(before, 'C')) OR (d AND contains(before, 'D')) OR (e AND contains(before, 'E')) AS gone,
   a::INT + b::INT + c::INT + d::INT + e::INT AS many FROM g, z),
 k AS (SELECT part, filter_order, step::INTEGER AS step, letter, sum(CASE WHEN this OR gone THEN 0 ELSE n END)::BIGINT AS kept, sum(CASE WHEN this AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
   sum(CASE WHEN this AND gone THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN this AND many = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
   sum(CASE WHEN this AND NOT gone AND good THEN n ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN this AND NOT gone AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost FROM h GROUP BY 1, 2, 3, 4)
 SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM k"""
