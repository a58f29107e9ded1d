"""op7's pair counts are those of the corpus itself, however many pairs there are."""

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from rallyframe.llm import lmscore
from rallyframe.llm.scratch import write_bucketed, write_scratch


def test_pairs_have_numbers_of_their_own():
    rnd = np.random.default_rng(3)
    pairs = np.unique(rnd.integers(0, 50_000, (200_000, 2)), axis=0)
    assert len(np.unique(lmscore.cells(pairs[:, 0], pairs[:, 1]))) == len(pairs)


def test_counts_of_blocks_add_up(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rnd = np.random.default_rng(4)
    texts = [" ".join(str(x) for x in rnd.integers(0, 99_999, 60)) for _ in range(400)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    codec = lmscore.PieceCodec(path, keep_space=True)
    size = codec.tokenizer.get_vocab_size()
    want = {}
    for i, t in enumerate(texts):
        ids = codec.encode_whole(t or "").tolist()
        for a, b in zip([size] + ids, ids):
            row = want.setdefault((a << 32) | b, [0, 0])
            row[0] += 1
            row[1] += i % 3 == 0
    coded = write_bucketed(lmscore.encoded(docs, path), "ids", "block", 4)
    targets = write_scratch(coded.select("block", "doc_id").where("doc_id % 3 = 0"), "targets")
    rows = lmscore.counted(coded, targets, size).groupBy("pair").agg(F.sum("background").alias("b"), F.sum("target").alias("t")).collect()
    assert {r.pair: [r.b, r.t] for r in rows} == want
