"""Replay of filter orders against plain Python, and odd inputs."""

import re
from collections import Counter
from itertools import permutations

from rallyframe.llm import interactions as I

DOCS = "doc_id long, text string, source string, flags string, step int, part string"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], DOCS)


def plain(rows, labels):
    texts = [(d, t or "") for d, t, _ in rows]
    out = Counter()
    shapley = Counter()
    parts = {s or "" for _, _, s in rows}
    for d, text, source in rows:
        text, part = text or "", source or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search("[#$%&*|]", text)), "E": d is not None and any(o is not None and o < d and t == text for o, t in texts),
        }
        quality, toxic = labels.get(d, (0, 0))
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, f in enumerate(order, 1):
                key = (part, order, step)
                removed = fails[f] and not gone
                out[key, "redundant"] += fails[f] and gone
                gone = gone or fails[f]
                out[key, "kept"] += not gone
                out[key, "removed"] += removed
                out[key, "unique_fails"] += fails[f] and sum(fails.values()) == 1
                out[key, "good_lost"] += removed and quality == 1
                out[key, "toxic_lost"] += removed and toxic == 1
                shapley[part, f] += removed
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return {
        (p, o, s): (*(out[(p, o, s), n] for n in names), shapley[p, o[s - 1]]) for p in parts for o in map("".join, permutations("ABCDE")) for s in range(1, 6)
    }


def test_replay_equals_plain_python(spark):
    long = " ".join(f"w{i}" for i in range(30000))
    rows = [(i, f"word{i} " * (i * 9), ("a", "b", None, "")[i % 4]) for i in range(12)]
    rows += [(20, long, "a"), (21, long, "b"), (22, None, None), (23, "", "c"), (23, "", "c"), (None, long, "a"), (None, "LOUD #", None), (24, " ".join(f"x{i}" for i in range(60)), "a")]
    labels = {1: (1, 0), 20: (1, 1), 21: (0, 1), 23: (1, 0)}
    known = spark.createDataFrame([(d, q, t) for d, (q, t) in labels.items()] + [(1, 0, 0), (None, 1, 1), (999, 1, 1)], "doc_id long, quality long, toxic long")
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in I.replay(I.flagged(docs_of(spark, rows)), known).collect()}
    assert got == plain(rows, labels)


def test_no_documents(spark):
    known = spark.createDataFrame([], "doc_id long, quality long, toxic long")
    assert I.replay(I.flagged(docs_of(spark, [])), known).count() == 0
