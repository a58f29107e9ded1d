"""Secret scanning with multipart credential linking (DataFrame functions only).

Three base kinds are reported wherever they stand. Weak candidates (identifiers, bare keys and
endpoints, each common in clean text) are reported only where complementary parts of a credential
stand together: candidates are interval-joined within a scope, which is a document's text within
``SCOPE`` code points, and a candidate needs a partner of the other role there.

Regular expressions run once over each text, in the scan. What leaves the scan is narrow: lengths
of gaps and hits, from which window sums give the spans. The interval join is an equality join on
(row, block of text), so it is partitioned by document and block; spans of a kind don't overlap,
so a block holds a bounded number of their ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rallyframe.llm.scratch import write_scratch

# Fixed values of the contract: the base kinds in order, their patterns and least lengths.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
LEAST = {"assign": 12, "access": 18, "hex": 16}

IDENT = r"""(?i:access_?key_?id|client_?id|account_?id|user_?name|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
KEY = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{24,}={0,2}(?![A-Za-z0-9+/_=-])"
ENDPOINT = r"""https?://[A-Za-z0-9][^\s"'<>]*|(?i:endpoint|host_?name|bucket|region)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.:/_-]{3,}"""

#: Kind, pattern and role. A hex run takes part as a secret: it is one half of most key pairs.
KINDS = (
    ("assign", ASSIGN, "secret"),
    ("access", ACCESS, "identifier"),
    ("hex", HEX, "secret"),
    ("ident", IDENT, "identifier"),
    ("key", KEY, "secret"),
    ("endpoint", ENDPOINT, "endpoint"),
)
BASE = 3
#: Code points between two spans of one scope, at most.
SCOPE = 256


def _passes(kind: str, hit: Column) -> Column:
    if kind == "assign":
        return F.char_length(F.regexp_extract(hit, ASSIGN, 2)) >= LEAST["assign"]
    if kind in LEAST:
        return F.char_length(hit) >= LEAST[kind]
    if kind == "key":
        return hit.rlike("[a-z]") & hit.rlike("[A-Z]") & hit.rlike("[0-9]")
    return F.lit(True)


def _hits(text: Column, kind: str, pattern: str) -> Column:
    """array<struct<gap, width, passes>>: code points between hits and in them, in order."""
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = F.zip_with(
        hits,
        F.slice(gaps, 1, F.size(hits)),
        lambda h, g: F.struct(F.char_length(g).alias("gap"), F.char_length(h).alias("width"), _passes(kind, h).alias("passes")),
    )
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast("array<struct<gap:int,width:int,passes:boolean>>"))


def scanned(docs: DataFrame) -> DataFrame:
    """row, doc_id, h and one array of hits per kind.

    ``row`` tells repeated doc_ids apart; h is a hash of the text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    one = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("row"))
    return one.select("row", "doc_id", "h", *(_hits(F.col("text"), k, p).alias(k) for k, p, _ in KINDS))


def spans_of(scan: DataFrame) -> DataFrame:
    """row, kind_no, kind, role, start, end of every passing hit."""
    each = scan.select(
        "row",
        F.explode(
            F.array(*(F.struct(F.lit(n).alias("kind_no"), F.lit(k).alias("kind"), F.lit(role).alias("role"), F.col(k).alias("hits")) for n, (k, _, role) in enumerate(KINDS)))
        ).alias("found"),
    ).where(F.size("found.hits") > 0)
    each = each.select("row", "found.kind_no", "found.kind", "found.role", F.posexplode("found.hits").alias("i", "hit"))
    so_far = Window.partitionBy("row", "kind_no").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("hit.gap") + F.col("hit.width")).over(so_far)
    return (
        each.withColumn("end", end)
        .where("hit.passes")
        .select("row", "kind_no", "kind", "role", (F.col("end") - F.col("hit.width")).alias("start"), "end")
    )


def linked(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak candidates among ``spans`` that complementary parts stand beside.

    An identifier needs a secret within the scope, a secret an identifier, an endpoint both.
    Overlapping spans say the same thing twice and don't link.
    """
    weak = spans.where(F.col("kind_no") >= BASE)
    near = weak.withColumn(
        "block", F.explode(F.sequence(F.floor((F.col("start") - scope) / scope), F.floor((F.col("end") + scope) / scope)))
    )
    # A part ends within the scope before a candidate or starts within it after, so its ends suffice.
    ends = F.array_distinct(F.array(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope)))
    parts = spans.where(F.col("role") != "endpoint").select(
        "row", F.col("role").alias("other"), F.col("start").alias("p_start"), F.col("end").alias("p_end"), F.explode(ends).alias("block")
    )
    beside = (
        (F.col("other") != F.col("role"))
        & (F.greatest(F.col("p_start") - F.col("end"), F.col("start") - F.col("p_end")) <= scope)
        & ((F.col("p_start") >= F.col("end")) | (F.col("start") >= F.col("p_end")))
    )
    # A candidate has a row for each block it reaches, which Spark's estimate of its size leaves out: merged, not broadcast.
    met = near.join(parts.hint("merge"), ["row", "block"]).where(beside)
    roles = met.groupBy("row", "kind_no", "kind", "role", "start", "end").agg(
        F.bool_or(F.col("other") == "secret").alias("secret"), F.bool_or(F.col("other") == "identifier").alias("identifier")
    )
    whole = (
        F.when(F.col("role") == "identifier", F.col("secret"))
        .when(F.col("role") == "secret", F.col("identifier"))
        .otherwise(F.col("secret") & F.col("identifier"))
    )
    return roles.where(whole).select("row", "kind_no", "kind", "role", "start", "end")


def found_in(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """row, doc_id, h, all: every document's spans, array<struct<start, kind_no, kind, end>> in order."""
    scan = write_scratch(scanned(docs), "secret-scan")
    spans = spans_of(scan)
    kept = spans.where(F.col("kind_no") < BASE).unionByName(linked(spans, scope))
    ordered = F.array_sort(F.collect_list(F.struct("start", "kind_no", "kind", "end")))
    said = kept.groupBy("row").agg(ordered.alias("all"))
    nothing = F.array().cast("array<struct<start:bigint,kind_no:int,kind:string,end:bigint>>")
    return scan.select("row", "doc_id", "h").join(said, "row", "left").withColumn("all", F.coalesce("all", nothing))


def scan_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """row, doc_id, n_assign, n_access, n_hex, n_linked, base_sha256, spans of each document.

    Spans are kind:start:end in code points, the end exclusive, by start and then kind. A null
    text counts as empty and gives empty spans; an empty table gives no rows; repeated rows are
    scanned each, and null or equal doc_ids are rows of their own. A very long text is scanned whole,
    in one task. Other columns are ignored.
    """
    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(test) -> Column:
        return F.size(F.filter("all", test)).cast("long")

    def count_of(number: int) -> Column:
        return count(lambda s: s["kind_no"] == number)

    out = found_in(docs, scope)
    return out.select(
        "row",
        "doc_id",
        *(count_of(n).alias(f"n_{k}") for n, (k, _, _) in enumerate(KINDS[:BASE])),
        count(lambda s: s["kind_no"] >= BASE).alias("n_linked"),
        F.sha2(joined(F.filter("all", lambda s: s["kind_no"] < BASE)).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("all")).alias("spans"),
    )


def redacted(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets; overlapping spans become one.

    doc_id may be of any kind that casts to text. Null and empty texts stay, rows that repeat are redacted
    each, an empty table stays empty. A text's time grows faster than its spans: each is cut from the start.
    Where a text changes, n_chars (if there is such a column) is its new length.
    """
    marks = found_in(docs, scope).where(F.size("all") > 0)
    keys = ["__rf_no", "__rf_id", "__rf_h"]
    marks = marks.select(
        F.col("doc_id").isNull().alias(keys[0]), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(keys[1]), F.col("h").alias(keys[2]), F.col("all").alias("__rf_all")
    ).dropDuplicates(keys)
    text = F.col("text")
    own = docs.withColumns(
        {keys[0]: F.col("doc_id").isNull(), keys[1]: F.coalesce(F.col("doc_id").cast("string"), F.lit("")), keys[2]: F.xxhash64(F.coalesce("text", F.lit("")))}
    )
    both = own.join(marks, keys, "left")

    def step(done: Column, span: Column) -> Column:
        gap = F.substring(text, (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        apart = span["start"] >= done["at"]
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"),
            F.when(apart, F.concat(done["out"], gap, F.lit("["), span["kind"], F.lit("]"))).otherwise(done["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    rest = F.char_length(text)
    clean = F.aggregate(
        "__rf_all", start, step, lambda done: F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), rest))
    )
    both = both.withColumn("text", F.when(F.col("__rf_all").isNotNull(), clean).otherwise(text))
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        both = both.withColumn("n_chars", F.when(F.col("__rf_all").isNotNull(), length).otherwise(F.col("n_chars")))
    return both.select(*(F.col(f"`{c}`") for c in docs.columns))


def query(spark, sf_dir: str) -> DataFrame:
    """op1: secrets in every document."""
    return scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("row")
