"""Corpus pipeline: drop toxic documents, keep one of near-duplicates, redact secrets, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of documents.

All stages take null and empty texts, null, equal and repeated doc_ids, very long texts (whole, one task a
text), empty tables and extra columns, whose names may be any but those that begin with ``__rf_``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rallyframe.llm import packing, secrets, simhash, toxicity
from rallyframe.llm.scratch import write_scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold, by a model of the labels.

    A null or empty text has a score like any other. Rows that repeat are kept or dropped alike.
    """
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.kept(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of near-duplicates.

    Documents are linked whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.
    Fingerprints can't tell that: such pairs lie about ten bits apart on average, so the similarity
    itself is joined on. Of documents with the least doc_id and one text one stays; null doc_ids come
    last. Null and empty texts are one group.
    """
    return simhash.deduplicated_similar(docs, words=5, like=0.8)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kinds. Rows that repeat stay as many."""
    return secrets.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences. Null and empty texts are their end id alone."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_duplicates", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]

#: SQL can't express the classifier or the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_scratch(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
