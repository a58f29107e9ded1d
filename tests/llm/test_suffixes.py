"""Removal of repeated strings against brute force, and the suffix order against sorting."""

import hashlib
import random

import numpy as np
import pytest

from rallyframe.llm import suffixes as S
from rallyframe.llm.scratch import write_scratch

DOCS = "doc_id long, text string, t string, zone long, bytes long"
SMALL = S.Rule(length=24, gram=2, every=5, gap=15)


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], DOCS)


def plain(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    places = {}
    for d, text in enumerate(texts):
        for i in range(len(text) - length + 1):
            places.setdefault(text[i : i + length], []).append((d, i))
    gone = [np.zeros(len(t), bool) for t in texts]
    for found in places.values():
        if len(found) > 1:
            for d, i in found:
                gone[d][i : i + length] = True
    out = []
    for (doc, _), text, g in zip(rows, texts, gone):
        spans = sum(1 for i in range(len(g)) if g[i] and (i == 0 or not g[i - 1]))
        kept = bytes(b for b, x in zip(text, g) if not x)
        out.append((doc, len(text), int(g.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 5)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rnd.randint(4, 40)) for _ in range(12)]
    rows = []
    for i in range(70):
        parts = [prose(rnd.randint(0, 12)) for _ in range(rnd.randint(1, 5))]
        parts.insert(rnd.randrange(len(parts) + 1), rnd.choice(passages))
        if rnd.random() < 0.4:
            p = rnd.choice(passages)
            a = rnd.randrange(len(p))
            parts.insert(rnd.randrange(len(parts) + 1), p[a : a + rnd.randint(10, 60)])
        rows.append((i, rnd.choice(["", "-", " "]).join(parts)))
    rows += [(100, "z" * 300), (101, "y" + "z" * 60), (102, "ab" * 100), (103, "abc" * 40 + "d"), (104, None), (105, ""), (106, "short"), (107, "short")]
    rows += [(108, rows[0][1]), (0, rows[0][1]), (None, rows[1][1]), (None, None), (109, passages[0]), (110, passages[0][:24]), (111, passages[1][-24:])]
    rows += [(112, prose(2000)), (113, "0123456789" * 2 + "012" + "q"), (114, "0123456789" * 2 + "012" + "p"), (115, "1" + "0123456789" * 2 + "0123")]
    return rows


@pytest.mark.parametrize(("seed", "together"), [(1, 0), (2, S.TOGETHER)])
def test_removal_equals_brute_force(spark, monkeypatch, seed, together):
    monkeypatch.setattr(S, "TOGETHER", together)
    rows = corpus(seed)
    got = sorted((tuple(r) for r in S.without_repeats(docs_of(spark, rows), SMALL).collect()), key=str)
    assert got == plain(rows, SMALL.length)


@pytest.mark.parametrize("together", [0, S.TOGETHER])
def test_ranks_are_the_order_of_suffixes(spark, monkeypatch, together):
    monkeypatch.setattr(S, "TOGETHER", together)
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("ab") for _ in range(rnd.randint(1, 60))) for _ in range(30)]
    texts += [texts[0] + "b", texts[0], "a" * 50, "a" * 49 + "b"]
    rows = [(z, 1, [ord(c) for c in t], list(range(len(t)))) for z, t in enumerate(texts)]
    strings = spark.createDataFrame(rows, "zone long, branch long, names array<long>, ats array<int>")
    got = S.suffix_ranks(write_scratch(strings, "strings"), S.Rule(length=1000, gram=2, every=5, gap=15)).collect()
    assert len(got) == sum(map(len, texts))
    order = sorted((r["rank"], texts[r["zone"]][r["place"] :]) for r in got)
    assert [s for _, s in order] == sorted(s for _, s in order)
    assert len({r for r, _ in order}) == len({s for _, s in order})


def test_cuts_depend_on_what_follows_only():
    rnd = random.Random(6)
    rule = S.Rule()
    shared = bytes(rnd.randrange(97, 123) for _ in range(5000))
    first, second = b"x" * 37 + shared, bytes(rnd.randrange(256) for _ in range(700)) + shared
    a, b = ({int(p) + len(shared) - len(t) for p in S.cuts(np.frombuffer(t, np.uint8), rule)[0]} for t in (first, second))
    assert {p for p in a if p >= 0} == {p for p in b if p >= 0}
    at, _ = S.cuts(np.frombuffer(b"q" * 5000, np.uint8), rule)
    assert np.diff(at).max() <= rule.gap


def test_blocks_make_no_difference(monkeypatch):
    text = np.frombuffer(bytes(random.Random(7).randrange(97, 101) for _ in range(9000)), np.uint8)
    whole = S.cuts(text, S.Rule())[0].tolist()
    monkeypatch.setattr(S, "BLOCK", 700)
    assert S.cuts(text, S.Rule())[0].tolist() == whole


def test_sums_below(spark):
    rows = write_scratch(spark.range(500).selectExpr("(id * 37) % 500 AS k", "id % 7 AS n").repartition(3), "rows")
    values = {r.k: r.n for r in rows.collect()}
    for r in S.below(rows, ["k"], ["n"]).collect():
        assert r.n_below == sum(n for k, n in values.items() if k < r.k)


def test_no_rows(spark):
    assert S.without_repeats(docs_of(spark, [])).count() == 0


def test_the_length_itself(spark):
    rnd = random.Random(9)
    some = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    exact, near = some(400), some(399)
    rows = [(i, some(300) + exact + some(200)) for i in range(3)] + [(9, near + some(300)), (10, some(5) + near), (11, "x" * 100_000)]
    got = sorted((tuple(r) for r in S.without_repeats(docs_of(spark, rows)).collect()), key=str)
    assert got == plain(rows, 400)
