"""Toxicity by subword-bag embeddings and a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams and itself, hashed into a fixed number of vectors; a
window of a few words is the mean of its bag, and a linear softmax of that mean says whether the
window is toxic. Misspellings unseen in training share most n-grams with what they misspell. A
document is judged by the mean and the worst of its windows: a logistic curve of the two, fitted
on documents that the softmax was not trained on, gives the score.

Training is on a bounded sample (``SAMPLE`` labelled documents) and reads their whole texts. All
windows of clean documents are clean. Those of a toxic document are used if they hold a bucket
that tells: one in many toxic and hardly any clean documents. N-grams seen in too few documents
keep a zero vector. The trainer holds a number for each word of the sample and the n-grams of each
distinct word once. Scoring covers every whole text; a worker remembers what the words it met add
up to.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rallyframe.llm.words import slices

#: Labelled documents in the training sample, the ones with the least hashes of doc_id.
SAMPLE = 4000
WINDOW = 8
BUCKETS = 1 << 17
DIM = 8
GRAMS = (3, 4, 5)
STEPS = 30
RATE = 0.1
DECAY = 1e-6
#: A bucket tells if it is in this share of toxic documents, and in clean ones so many times rarer.
TELLING_SHARE, TELLING_RATIO = 0.02, 30
#: Documents a bucket must be in to be trained, at most (fewer in samples below 400 documents).
LEAST_DOCS = 5
THRESHOLD = 0.3
#: Words remembered by a worker; further ones are worked out each time. It changes no result.
CACHE = 600_000
_WORD = re.compile(r"[^\W_]+")


def grams(word: str) -> np.ndarray:
    """Buckets of a lower-case word and of its n-grams."""
    w = f"<{word}>"
    parts = [w, *(w[i : i + n] for n in GRAMS for i in range(len(w) - n + 1) if n < len(w))]
    return np.fromiter((zlib.crc32(p.encode()) & (BUCKETS - 1) for p in parts), dtype=np.int64, count=len(parts))


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from training; false without a doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


class Model:
    """Embeddings, softmax weights and biases of two classes, and the documents' curve."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.embeddings = rng.normal(0, 0.1, (BUCKETS, DIM))
        self.weights = rng.normal(0, 0.1, (2, DIM))
        self.bias = np.zeros(2)
        self.curve = np.array([0.0, 0.5, 0.5])

    def fit(self, bags: Bags, y: np.ndarray) -> None:
        """Full-batch Adam on the mean cross-entropy of windows with labels ``y``."""
        n, many = len(y), len(bags.lengths)
        of = np.repeat(np.arange(many, dtype=np.int32), bags.lengths)
        share = 1.0 / np.maximum(np.bincount(bags.window, weights=bags.lengths[bags.word], minlength=n), 1)
        params = [self.embeddings, self.weights, self.bias]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        for step in range(1, STEPS + 1):
            per_word = np.bincount(of, weights=self.per_bucket()[bags.grams], minlength=many)
            logit = np.bincount(bags.window, weights=per_word[bags.word], minlength=n) * share + self.lean()
            wrong = (_sigmoid(logit) - y) / n  # gradient of the second class's logit; the first has its negative
            of_words = np.bincount(bags.word, weights=(wrong * share)[bags.window], minlength=many)
            per_gram = np.bincount(bags.grams, weights=of_words[of], minlength=BUCKETS)
            toward = self.embeddings.T @ per_gram
            grads = [
                per_gram[:, None] * (self.weights[1] - self.weights[0]) + DECAY * self.embeddings,
                np.stack([-toward, toward]) + DECAY * self.weights,
                np.array([-wrong.sum(), wrong.sum()]),
            ]
            for p, g, (m, v) in zip(params, grads, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        self.embeddings[np.bincount(bags.grams, minlength=BUCKETS) == 0] = 0

    def fit_curve(self, mean: np.ndarray, worst: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 1e-3) -> None:
        """Logistic regression of documents' labels on their two figures, by Newton's method."""
        x = _figures(mean, worst)
        w = np.zeros(3)
        for _ in range(steps):
            p = _sigmoid(x @ w)
            slope = x.T @ (p - y) / len(y) + ridge * w
            bend = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(3)
            w = w - np.clip(np.linalg.solve(bend, slope), -2, 2)
        self.curve = w

    def lean(self) -> float:
        return float(self.bias[1] - self.bias[0])

    def per_bucket(self) -> np.ndarray:
        """What each bucket adds to the difference of the two logits, before averaging."""
        return self.embeddings @ (self.weights[1] - self.weights[0])

    def scoring(self) -> tuple[np.ndarray, float, np.ndarray]:
        """All that scoring needs of the model: BUCKETS numbers and a few more, whatever the input."""
        return self.per_bucket(), self.lean(), self.curve


def _figures(mean: np.ndarray, worst: np.ndarray) -> np.ndarray:
    def logit(p):
        p = np.clip(p, 1e-6, 1 - 1e-6)
        return np.log(p / (1 - p))

    return np.stack([np.ones(len(mean)), logit(mean), logit(worst)], axis=1)


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """doc_id, toxic, text of the training sample; held-out documents are not in it.

    Of rows that repeat a doc_id the least text is taken, and the greatest label.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))


@dataclass
class Bags:
    """Windows of words: ``word`` and ``window`` of each word in order, the n-grams of all words of
    the vocabulary one after the other, and how many each has."""

    word: np.ndarray
    window: np.ndarray
    grams: np.ndarray
    lengths: np.ndarray

    def of(self, kept: np.ndarray, buckets: np.ndarray) -> Bags:
        """The windows marked in ``kept``, numbered anew, with only those n-grams that ``buckets`` marks."""
        on, here = kept[self.window], buckets[self.grams]
        of = np.repeat(np.arange(len(self.lengths)), self.lengths)
        number = (np.cumsum(kept) - 1).astype(np.int32)
        return Bags(self.word[on], number[self.window[on]], self.grams[here], np.bincount(of[here], minlength=len(self.lengths)))


def bagged(texts: list[str]) -> tuple[Bags, np.ndarray, np.ndarray]:
    """The bags of all texts' windows, each window's text, and how many windows each text has."""
    numbers: dict[str, int] = {}
    word, per_text = [], []
    for text in texts:
        found = _WORD.findall(text.lower())
        word.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in found), dtype=np.int32, count=len(found)))
        per_text.append(-(-len(found) // WINDOW))
    first = np.cumsum([0, *per_text])
    window = [f + np.arange(len(w), dtype=np.int32) // WINDOW for f, w in zip(first, word)]
    parts = [grams(w).astype(np.int32) for w in numbers] or [np.zeros(0, np.int32)]
    none = np.zeros(0, np.int32)
    bags = Bags(
        np.concatenate([none, *word]), np.concatenate([none, *window]).astype(np.int32), np.concatenate(parts), np.array([len(p) for p in parts], np.int32)
    )
    return bags, np.repeat(np.arange(len(texts)), per_text), np.array(per_text)


def _holding(bags: Bags, of_window: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In how many clean and toxic texts each bucket is."""
    counts = np.zeros((2, BUCKETS), dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(bags.lengths)])
    ends = np.searchsorted(of_window[bags.window], np.arange(len(toxic) + 1))
    for i, t in enumerate(toxic):
        words = np.unique(bags.word[ends[i] : ends[i + 1]])
        if len(words):
            counts[int(t), np.unique(np.concatenate([bags.grams[starts[w] : starts[w + 1]] for w in words]))] += 1
    return counts[0], counts[1]


def train(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Model | None:
    """The model of the bounded sample; None if it lacks either class, as with empty tables."""
    rows = sample(docs, labels, size).toArrow().sort_by("doc_id")  # at most ``size`` texts
    toxic = np.array([bool(t) for t in rows["toxic"].to_pylist()])
    if toxic.all() or not toxic.any():
        return None
    curve = np.array([zlib.crc32(str(d).encode()) % 4 == 1 for d in rows["doc_id"].to_pylist()])
    own = ~curve if len(set(toxic[~curve])) == 2 else np.ones(len(toxic), dtype=bool)
    bags, of_window, _ = bagged(rows["text"].filter(pa.array(own)).to_pylist())
    y = toxic[own][of_window].astype(float)
    n_toxic, n_clean = toxic[own].sum(), (~toxic[own]).sum()
    in_clean, in_toxic = _holding(bags, of_window, toxic[own])
    tells = (in_toxic >= max(2, TELLING_SHARE * n_toxic)) & (in_clean / n_clean <= in_toxic / n_toxic / TELLING_RATIO)
    telling = bags.of(np.ones(len(y), dtype=bool), tells).lengths > 0
    used = (y == 0) | (np.bincount(bags.window, weights=telling[bags.word], minlength=len(y)) > 0)
    if not y[used].any():
        used[:] = True
    model = Model()
    model.fit(bags.of(used, in_toxic + in_clean >= min(LEAST_DOCS, 1 + (n_toxic + n_clean) / 100)), y[used])
    rest = curve if len(set(toxic[curve])) == 2 else np.ones(len(toxic), dtype=bool)
    mean, worst = Scorer(*model.scoring()).figures(rows["text"].filter(pa.array(rest)).combine_chunks())[:2]
    model.fit_curve(mean, worst, toxic[rest].astype(float))
    return model


class Scorer:
    """Scores arrays of texts."""

    def __init__(self, per_bucket: np.ndarray, lean: float, curve: np.ndarray):
        self.per_bucket, self.lean, self.curve = per_bucket, lean, curve
        self.known: dict[str, tuple[float, int]] = {}

    def word(self, word: str) -> tuple[float, int]:
        if word in self.known:
            return self.known[word]
        ids = grams(word)
        found = (float(self.per_bucket[ids].sum()), len(ids))
        if len(self.known) < CACHE and len(word) <= 64:
            self.known[word] = found
        return found

    def figures(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Mean and worst probability of each text's windows, and whether it has any."""
        lower = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
        cut = pc.ascii_split_whitespace(pc.replace_substring_regex(lower, r"[^\pL\pN]+", " "))
        bounds = np.asarray(cut.offsets) - cut.offsets[0].as_py()
        coded = cut.flatten().dictionary_encode()
        which = np.asarray(coded.indices, dtype=np.int64)
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        told = np.array([self.word(w) if w else (0.0, 0) for w in distinct] or np.zeros((0, 2)))
        # Splitting leaves empty words at the ends of a text; they are not words.
        real = np.flatnonzero(told[which, 1] > 0)
        counts = np.diff(np.searchsorted(real, bounds))
        which = which[real]
        at = np.concatenate([[0], np.cumsum(counts)])
        mean, worst = np.zeros(len(counts)), np.zeros(len(counts))
        some = np.flatnonzero(counts)
        if len(some):
            per = -(-counts[some] // WINDOW)
            first = np.concatenate([[0], np.cumsum(per)[:-1]])
            starts = np.repeat(at[some], per) + WINDOW * (np.arange(per.sum()) - np.repeat(first, per))
            logits = np.add.reduceat(told[which, 0], starts) / np.add.reduceat(told[which, 1], starts)
            each = _sigmoid(logits + self.lean)
            mean[some] = np.add.reduceat(each, first) / per
            worst[some] = np.maximum.reduceat(each, first)
        return mean, worst, counts > 0

    def scores(self, texts: pa.Array) -> np.ndarray:
        """A score from 0 to 1 for each text; 0 without words."""
        mean, worst, some = self.figures(texts)
        return np.where(some, _sigmoid(_figures(mean, worst) @ self.curve), 0.0)


def scored(docs: DataFrame, model: Model | None, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted (and the columns ``extra``) of every document.

    Null and empty texts score 0, and so does everything without a model. Repeated rows are scored
    each; an empty table gives no rows. ``extra`` may not hold a name of the result or ``text``.
    """
    if set(extra) & {"doc_id", "text", "held_out", "score", "predicted"}:
        raise ValueError(f"columns clash with those of the result: {extra}")
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(model.scoring() if model else None)

    def score(batches):
        scorer = Scorer(*known.value) if known.value else None
        for batch in batches:
            for piece in slices(batch, 1):
                texts = piece.column(1)
                values = scorer.scores(texts) if scorer else np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays([piece.column(0), *piece.columns[2:], pa.array(values)], names=["doc_id", *extra, "score"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in extra)
    rows = docs.select("doc_id", "text", *extra).mapInArrow(score, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {kinds}{', ' * bool(kinds)}score double")
    return rows.withColumns({"held_out": held_out(F.col("doc_id")), "predicted": (F.col("score") >= THRESHOLD).cast("int")})


def kept(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` that score below THRESHOLD, unchanged; all rows without a model."""
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(model.scoring() if model else None)
    at = docs.columns.index("text")

    def keep(batches):
        scorer = Scorer(*known.value) if known.value else None
        for batch in batches:
            for piece in slices(batch, at):
                yield piece.filter(pa.array(scorer.scores(piece.column(at)) < THRESHOLD)) if scorer else piece

    return docs.mapInArrow(keep, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: toxicity of every document, learnt from the labels that aren't held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(docs, model).select("doc_id", "held_out", "score", "predicted")
