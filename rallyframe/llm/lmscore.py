"""Language-model scores by cross-entropy difference.

A target model (documents labelled as good) and a background model (all documents) are bigram
models over the ids of one public tokenizer, so they share one vocabulary and one smoothing. A
token's loss under each is its negative log-probability after the token before it; the difference,
averaged over a document, says how much better the target explains it than the corpus at large.

Counts cover every token of every document and are exact, for single ids and for pairs of ids.
Texts are encoded once, where they are read, into blocks of documents, written as a table
bucketed by block, so that neither texts nor ids are shuffled: what is known of a block (which of
its documents are target, what the corpus has of its pairs) comes to it. Each block's distinct
pairs are counted, the counts are summed by pair into a table that grows with the corpus, and
every block gets back the rows of that table for its own pairs by a join. Only counts of single
ids are broadcast; their number is that of the vocabulary. The background's counts are scaled to
the target's size, so that the two are smoothed alike.

A document is scored by what all others say: its own counts are taken off the background, and
off the target if it is one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rallyframe.llm.scratch import write_bucketed, write_scratch
from rallyframe.llm.words import PieceCodec, slices

#: Tokens of a block, unless one slice of texts has more.
BLOCK = 2_000_000
#: Tokens scored at a time, unless one text has more.
PART = 200_000
#: Weight of the single-id distribution in a pair's probability, in tokens.
PRIOR = 10.0


def cells(before: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """A number for each (id before, id), its own for each pair."""
    return before.astype(np.int64) << 32 | ids.astype(np.int64)


def _before(ids: np.ndarray, ends: np.ndarray, start: int) -> np.ndarray:
    """The id before each; ``start`` at the beginning of a text."""
    out = np.empty(len(ids), dtype=np.int64)
    out[1:] = ids[:-1]
    out[ends[:-1][np.diff(ends) > 0]] = start
    return out


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """block, doc_id, ids (binary, see ``width``) of each (doc_id, text)."""

    def encode(batches):
        codec = PieceCodec(tokenizer, keep_space=True)
        kind = width(codec.tokenizer.get_vocab_size())
        block, filled = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for piece in slices(batch, 1):
                ids, ends = codec.encode(piece.column(1))
                ids = ids.astype(kind)
                each = pa.array([ids[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary())
                number = pa.array(np.full(len(piece), block, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([number, piece.column(0), each], names=["block", "doc_id", "ids"])
                filled += len(ids)
                if filled >= BLOCK:
                    block, filled = block + 1, 0

    return docs.select("doc_id", "text").mapInArrow(encode, "block long, doc_id long, ids binary")


def width(vocabulary: int) -> str:
    """How an id is stored: in two bytes if all fit, else in four."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def _flat(ids, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column together, and the bounds of each row's."""
    kind = np.dtype(width(vocabulary))
    each = ids.to_pylist()
    ends = np.concatenate([[0], np.cumsum([len(x) for x in each], dtype=np.int64)]) // kind.itemsize
    return np.frombuffer(b"".join(each), kind).astype(np.int64), ends


def _column(told: pa.Table, name: str) -> pa.Array:
    """A column of longs without its nulls; the side of a group that has no rows comes without columns."""
    return told[name].combine_chunks().drop_null() if told.num_rows else pa.array([], pa.int64())


def counted(texts: DataFrame, targets: DataFrame, vocabulary: int) -> DataFrame:
    """block, pair, background, target: counts of each block's pairs.

    texts: block, doc_id, ids; targets: block, doc_id of the documents that are target.
    """

    def count(docs: pa.Table, good: pa.Table) -> pa.Table:
        ids, ends = _flat(docs["ids"], vocabulary)
        own = np.repeat(np.asarray(pc.is_in(docs["doc_id"], _column(good, "doc_id"))), np.diff(ends))
        pairs, at, times = np.unique(cells(_before(ids, ends, vocabulary), ids), return_inverse=True, return_counts=True)
        block = docs["block"][0].as_py() if len(pairs) else 0
        sums = np.bincount(at[own], minlength=len(pairs)).astype(np.int64)
        return pa.table(
            [pa.array(np.full(len(pairs), block, dtype=np.int64)), pa.array(pairs), pa.array(times.astype(np.int64)), pa.array(sums)],
            names=["block", "pair", "background", "target"],
        )

    both = texts.select("block", "doc_id", "ids").groupBy("block").cogroup(targets.select("block", "doc_id").groupBy("block"))
    return both.applyInArrow(count, "block long, pair long, background long, target long")


def _run_lengths(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    """How often each key occurs, given the keys in order and the order."""
    run = np.cumsum(np.diff(keys, prepend=keys[:1] - 1) != 0) - 1
    out = np.empty(len(keys), dtype=np.int64)
    out[order] = np.bincount(run)[run]
    return out


def own_counts(text: np.ndarray, before: np.ndarray, ids: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How often each token's pair, id before and id occur in its own text (a number of each token)."""
    if not len(ids):
        return (np.zeros(0, dtype=np.int64),) * 3
    bits = vocabulary.bit_length()
    keys = text << 2 * bits | before << bits | ids
    order = np.argsort(keys)
    keys = keys[order]
    alone = text << bits | ids
    by_id = np.argsort(alone)
    return _run_lengths(keys, order), _run_lengths(keys >> bits, order), _run_lengths(alone[by_id], by_id)


class Pair:
    """The two models but for their pairs: counts of ids and of ids before, as rows background and target."""

    def __init__(self, counts: pa.Table, vocabulary: int):
        """counts: of kind 0 those of ids, of kind 1 those of ids before (``vocabulary`` at a text's start)."""
        self.vocabulary = vocabulary
        sums = [np.zeros((2, n)) for n in (vocabulary, vocabulary + 1)]
        kind, cell = counts["kind"].to_numpy(), counts["cell"].to_numpy()
        for k, total in enumerate(sums):
            on = kind == k
            total[:, cell[on]] = counts["background"].to_numpy()[on], counts["target"].to_numpy()[on]
        n_all, n_target = sums[0].sum(axis=1)
        self.scale = np.array([[n_target / n_all if n_target else 1.0], [1.0]])
        #: Without a target the two models are the same.
        self.rows = [0, 1] if n_target else [0, 0]
        self.single, self.before = (s[self.rows] for s in sums)
        self.total = self.single.sum(axis=1, keepdims=True)

    def losses(self, ids: np.ndarray, ends: np.ndarray, target: np.ndarray, pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Loss of each token (columns) under the background and the target (rows), its own text left out.

        target: whether each text is one; pairs, counts: the pairs of these ids, sorted, and how
        often the corpus has each (rows).
        """
        lengths = np.diff(ends)
        text = np.repeat(np.arange(len(lengths)), lengths)
        # A text is part of the background, and of the target if it is one.
        part = np.stack([np.ones(len(text)), np.repeat(target, lengths).astype(float)])[self.rows]
        before = _before(ids, ends, self.vocabulary)
        own_pair, own_before, own_id = own_counts(text, before, ids, self.vocabulary)
        scale = self.scale[self.rows]

        def rest(known: np.ndarray, own: np.ndarray) -> np.ndarray:
            return np.maximum(known - part * own, 0) * scale

        seen = rest(counts[self.rows][:, np.searchsorted(pairs, cells(before, ids))], own_pair)
        single = rest(self.single[:, ids], own_id) + 1
        of = rest(np.broadcast_to(self.total, part.shape), np.repeat(lengths, lengths)) + self.vocabulary
        return -np.log((seen + PRIOR * single / of) / (rest(self.before[:, before], own_before) + PRIOR))

    def means(self, ids: np.ndarray, ends: np.ndarray, target: np.ndarray, pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The mean loss of each text (columns) under both models (rows), some texts at a time; 0 without tokens."""
        out = np.zeros((2, len(ends) - 1))
        parts = np.flatnonzero(np.diff(ends[1:] // PART, prepend=-1))
        for a, b in zip(parts, [*parts[1:], len(ends) - 1]):
            bounds = ends[a : b + 1] - ends[a]
            loss = self.losses(ids[ends[a] : ends[b]], bounds, target[a:b], pairs, counts)
            sums = np.concatenate([np.zeros((2, 1)), np.cumsum(loss, axis=1)], axis=1)
            out[:, a:b] = (sums[:, bounds[1:]] - sums[:, bounds[:-1]]) / np.maximum(np.diff(bounds), 1)
        return out


def models(table: DataFrame, vocabulary: int) -> Pair:
    """The models of a table of pairs, background and target."""
    kinds = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("cell")),
        F.struct(F.lit(1).alias("kind"), F.shiftright("pair", 32).alias("cell")),
    )
    each = table.select(F.explode(kinds).alias("of"), "background", "target").groupBy("of.kind", "of.cell")
    sums = each.agg(F.sum("background").alias("background"), F.sum("target").alias("target"))
    return Pair(sums.toArrow(), vocabulary)  # at most 2 * vocabulary + 1 rows


def scored(texts: DataFrame, known: DataFrame, pair: Pair) -> DataFrame:
    """doc_id, n_tokens, background_loss, target_loss, score of each (block, doc_id, ids).

    ``known`` has block and either pair, background, target (the corpus's counts of each block's
    pairs) or doc_id (a block's documents that are target), the others null. Losses are means over
    a document's tokens, in nats; score is background_loss - target_loss, higher the more the
    document is like the target.
    """
    model = texts.sparkSession.sparkContext.broadcast(pair)

    def score(docs: pa.Table, told: pa.Table) -> pa.Table:
        ids, ends = _flat(docs["ids"], model.value.vocabulary)
        n = np.diff(ends)
        pairs, first = np.unique(_column(told, "pair").to_numpy(), return_index=True)
        times = np.stack([_column(told, c).to_numpy()[first] for c in ("background", "target")])
        target = np.asarray(pc.is_in(docs["doc_id"], _column(told, "doc_id")))
        mean = model.value.means(ids, ends, target, pairs, times)
        return pa.table(
            [docs["doc_id"], pa.array(n.astype(np.int64)), pa.array(mean[0]), pa.array(mean[1]), pa.array(mean[0] - mean[1])],
            names=["doc_id", "n_tokens", "background_loss", "target_loss", "score"],
        )

    kinds = "doc_id long, n_tokens long, background_loss double, target_loss double, score double"
    both = texts.select("block", "doc_id", "ids").groupBy("block").cogroup(known.groupBy("block"))
    return both.applyInArrow(score, kinds)


def cross_entropy_difference(docs: DataFrame, good: DataFrame, tokenizer: str) -> DataFrame:
    """Scores of all ``docs`` against the target documents, those whose doc_id is in ``good``.

    Null and empty texts have losses and score 0; a null doc_id is no target. Repeated rows count
    and are scored each, with only the row itself left out. Without a target all scores are 0.
    Texts are encoded whole, whatever their length; other columns are ignored; an empty table
    gives no rows.
    """
    vocabulary = PieceCodec(tokenizer, keep_space=True).tokenizer.get_vocab_size()
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = write_bucketed(encoded(docs, tokenizer), "ids", "block", buckets)
    wanted = good.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    targets = write_scratch(texts.select("block", "doc_id").join(wanted, "doc_id", "left_semi").select("block", "doc_id").distinct(), "targets")
    parts = write_scratch(counted(texts, targets, vocabulary), "block-pairs")
    table = write_scratch(parts.groupBy("pair").agg(F.sum("background").alias("background"), F.sum("target").alias("target")), "pairs")
    known = parts.select("block", "pair").join(table, "pair").select("block", "pair", "background", "target")
    return scored(texts, known.unionByName(targets, allowMissingColumns=True), models(table, vocabulary))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: score of every document, with the documents of good quality as the target."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1")
    return cross_entropy_difference(docs, good, public_tokenizers.path("byte_bpe_50k.json"))
