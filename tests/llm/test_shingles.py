"""Near-duplicates of the pipeline against brute force over all pairs."""

import random

import corpus_pipeline
import numpy as np

from pyspark.sql import functions as F

from rallyframe.llm import shingles, simhash
from rallyframe.llm.components import components, merged
from rallyframe.llm.scratch import write_scratch


def sets_of(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def alike(a, b):
    return a == b or (bool(a | b) and len(a & b) >= 0.8 * len(a | b) - 1e-9)


def corpus():
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    line = " ".join(word() for _ in range(30))
    out = []
    for _ in range(40):
        base = [word() for _ in range(rnd.randint(5, 300))]
        out.append(" ".join(base))
        for _ in range(4):
            copy = base[:]
            for _ in range(rnd.randint(1, max(1, len(base) // 25))):
                copy[rnd.randrange(len(copy))] = word()
            out.append(" ".join(copy))
    # Far apart but for a line that is repeated in both, most of all they hold.
    out += [" ".join([line] * 20 + [word() for _ in range(60)]) for _ in range(15)]
    return out + [None, "", " ", "one two", "One  two", "one three"]


def test_all_pairs_at_the_similarity_link_and_no_others(spark):
    texts = corpus()
    sets = [sets_of(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if alike(sets[i], sets[j]):
                s, t = find(i), find(j)
                parent[max(s, t)] = min(s, t)
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in range(len(texts)) if find(i) == i}
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), "").count() == 0


def test_shingles_that_are_indexed_suffice():
    assert [shingles.indexed(n) for n in (0, 1, 4, 5, 10, 11)] == [0, 1, 1, 2, 3, 3]
    assert len(shingles.digests("a b c d e f a b c d e f", 5)) == 8 and len(shingles.digests("A b", 5)) == 1


def test_fingerprints_propose_most_near_copies(spark):
    """What deletion variants alone find, before the index of shingles adds the rest."""
    texts = corpus()
    keyed = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "key long, text string")
    whole = simhash._prepared(keyed.withColumn("h", F.xxhash64("text")), 5, 0.8).select("class", "fp").distinct()
    assert simhash._proposed(whole, 5).count() > 0


def test_the_index_alone_misses_no_pair(spark):
    texts = corpus()
    keyed = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "key long, text string").withColumn("h", F.xxhash64("text"))
    whole = write_scratch(simhash._prepared(keyed, 5, 0.8), "prepared")
    of = {r["key"]: r["class"] for r in whole.select("key", "class").collect()}
    alone = spark.createDataFrame([], "node long, component long")
    sets = whole.select("class", "set").dropDuplicates(["class"])
    found = shingles.alike(shingles.across(shingles.shared(whole), alone), sets)
    got = {(r.a, r.b) for r in found.collect()}
    own = {}
    for i, t in enumerate(texts):
        own.setdefault(of[i], sets_of(t))
    want = {(a, b) for a in own for b in own if a < b and alike(own[a], own[b])}
    assert len(want) > 30 and got == want


def test_classes_whose_32_bit_hashes_agree_share_shingles(spark):
    rows = [(-3965417102674106237, 5, [7, 8]), (-6054336684747022631, 5, [8, 9]), (1, 5, [10]), (1, 5, [10])]
    got = shingles.shared(spark.createDataFrame(rows, "class long, n int, prefix array<long>")).collect()
    assert sorted((r.shingle, r["class"]) for r in got) == [(8, -6054336684747022631), (8, -3965417102674106237)]


def test_a_group_not_quite_alike_makes_no_pairs(spark, monkeypatch):
    """150 texts, any two of them at 0.78, meet on a hundred shingles and leave the join as no pair; at 0.81 all do."""
    monkeypatch.setattr(shingles, "SAMPLE", 1.0)
    base = " ".join(f"base{i}" for i in range(104))
    for own, pairs in ((14, 0), (12, 150 * 149 // 2)):
        texts = [" ".join(f"own{t}x{i}" for i in range(own)) + " " + base for t in range(150)]
        keyed = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "key long, text string").withColumn("h", F.xxhash64("text"))
        whole = write_scratch(simhash._prepared(keyed, 5, 0.8), "prepared")
        alone = spark.createDataFrame([], "node long, component long")
        assert shingles.across(shingles.shared(whole), alone).count() == pairs


def test_pairs_that_share_a_passage_leave_the_join_about_once(spark):
    """40 texts, any two of them alike in 190 of 200 words: every pair leaves the join, and not once for each shingle."""
    base = [f"base{i}" for i in range(190)]
    texts = [" ".join(base + [f"own{t}x{i}" for i in range(10)]) for t in range(40)]
    keyed = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "key long, text string").withColumn("h", F.xxhash64("text"))
    index = shingles.shared(write_scratch(simhash._prepared(keyed, 5, 0.8), "prepared").select("class", "n", "prefix"))
    left = write_scratch(shingles._grouped(index, spark.createDataFrame([], "node long, component long")), "left")
    met, pairs = shingles.meetings(left), 40 * 39 // 2
    assert met.distinct().count() == pairs and met.count() <= 2 * pairs


def test_links_are_merged_between_groups_and_give_the_components_of_all(spark):
    rnd = random.Random(3)
    first, more = ([(rnd.randrange(300), rnd.randrange(300)) for _ in range(n)] for n in (120, 160))
    frame = lambda rows: write_scratch(spark.createDataFrame(rows, "a long, b long"), "rows")
    want = {tuple(r) for r in components(frame(first + more)).collect()}
    groups = write_scratch(components(frame(first)), "groups")
    assert {tuple(r) for r in merged(groups, frame(more)).collect()} == want


def test_a_family_whose_shingles_all_pass_for_rare_makes_no_pairs(spark, monkeypatch):
    """150 texts, any two of them at 0.68: they meet early in the order, but their sketches differ in too many bits."""
    monkeypatch.setattr(shingles, "COMMON", 10**9)
    base = " ".join(f"base{i}" for i in range(104))
    for own, least, most in ((24, 0, 0), (6, 150 * 149 // 2, 150 * 149 // 2)):
        texts = [" ".join(f"own{t}x{i}" for i in range(own)) + " " + base for t in range(150)]
        keyed = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "key long, text string").withColumn("h", F.xxhash64("text"))
        whole = write_scratch(simhash._prepared(keyed, 5, 0.8), "prepared")
        alone = spark.createDataFrame([], "node long, component long")
        assert least <= shingles.across(shingles.shared(whole), alone, 0.8, whole.select("class", "sketch")).count() <= most


def test_sketches_differ_in_no_more_bits_than_sets():
    rnd = random.Random(5)
    for size in (0, 1, 40, 400, 5000):
        a = {rnd.randrange(1 << 32) for _ in range(size)}
        b = {x for x in a if rnd.random() < 0.9} | {rnd.randrange(1 << 32) for _ in range(size // 10)}
        of = lambda s: shingles.sketch(np.array(sorted(s), dtype=np.uint32).view(np.int32))
        assert sum(int(x).bit_count() for x in (of(a) ^ of(b)).view(np.uint64)) <= len(a ^ b)
