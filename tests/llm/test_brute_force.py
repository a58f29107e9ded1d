"""Linked secrets, packing and shard placement against plain Python."""

import collections
import random
import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from rallyframe.llm import packing, secrets, sharding


def kind_spans(text):
    """(kind number, kind, role, start, end) of every candidate, by Python's regular expressions."""
    out = []
    for n, (kind, pattern, role) in enumerate(secrets.KINDS):
        for m in re.finditer(pattern, text):
            hit = m[0]
            passes = {
                "assign": lambda: len(re.fullmatch(secrets.ASSIGN, hit)[2]) >= 12,
                "access": lambda: len(hit) >= 18,
                "hex": lambda: len(hit) >= 16,
                "key": lambda: all(re.search(c, hit) for c in ("[a-z]", "[A-Z]", "[0-9]")),
            }.get(kind, lambda: True)
            if passes():
                out.append((n, kind, role, m.start(), m.end()))
    return out


def linked_spans(text, scope):
    """All spans in order: base kinds, and weak ones beside complementary parts."""
    spans = kind_spans(text)
    kept = []
    for n, kind, role, a, b in spans:
        roles = set()
        for _, _, other, c, d in spans:
            apart = c >= b or a >= d
            if other != "endpoint" and other != role and apart and max(c - b, a - d) <= scope:
                roles.add(other)
        need = {"identifier": {"secret"}, "secret": {"identifier"}, "endpoint": {"secret", "identifier"}}[role]
        if n < secrets.BASE or need <= roles:
            kept.append((a, n, kind, b))
    return ",".join(f"{kind}:{a}:{b}" for a, n, kind, b in sorted(kept))


def test_linked_spans_match_brute_force(spark):
    rnd = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"

    def part():
        name = rnd.choice(["ident", "key", "endpoint", "assign", "access", "hex", "words", "long"])
        run = lambda n: "".join(rnd.choice(letters) for _ in range(n))
        return {
            "ident": f"client_id={run(rnd.randint(3, 90))}", "key": "aB3" + run(rnd.randint(21, 60)), "endpoint": f"https://{run(8).lower()}.example/{run(5)}",
            "assign": f"secret: {run(rnd.randint(8, 30))}", "access": "AKIA" + run(16).upper(), "hex": "".join(rnd.choice("0123456789abcdef") for _ in range(rnd.randint(14, 40))),
            "words": " ".join(run(4).lower() for _ in range(rnd.randint(1, 80))), "long": "token=" + run(rnd.randint(400, 1500)),
        }[name]

    texts = [" ".join(part() for _ in range(rnd.randint(1, 12))) for _ in range(150)] + ["", "é " * 300 + "login=bob " + "aB3" + "x" * 30]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.spans, r.n_linked) for r in secrets.scan_secrets(docs, scope=64).collect()}
    want = {i: linked_spans(t, 64) for i, t in enumerate(texts)}
    assert {i: s for i, (s, _) in got.items()} == want
    assert sum(n for _, n in got.values()) > 100


def test_packing_follows_its_plan(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice(["alpha", "beta", "gamma", "12", "é"]) for _ in range(rnd.choice((0, 3, 40, 300, 2500)))) for _ in range(120)] + [None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = packing.pack_documents(docs, path).collect()
    want = {}
    for i, t in enumerate(texts):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [packing.END_ID], dtype="<u4")
        for at in range(0, len(ids), packing.WINDOW):
            own = ids[at : at + packing.WINDOW]
            want[i, at] = (len(own), zlib.crc32(own.tobytes()), len(ids))
    assert {(r.doc_id, r.start): (r.length, r.ids_crc32, r.doc_tokens) for r in got} == want and len(got) == len(want)
    bins = lambda n: -(-n // packing.GRAIN)
    histogram = np.bincount([bins(n) - 1 for n, _, _ in want.values()], minlength=packing.WINDOW // packing.GRAIN)
    patterns = collections.Counter()
    for pattern, times in packing.plan(histogram):
        patterns[tuple(sorted(pattern.items()))] += times
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r)
    found = collections.Counter(tuple(sorted(collections.Counter(bins(r.length) for r in rows).items())) for rows in sequences.values())
    assert found == patterns
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.WINDOW


def test_shards_match_brute_force(spark):
    rnd = random.Random(9)
    docs = [(i, "x" * rnd.choice((0, 3, 50, 4000))) for i in range(700)] + [(5, "again"), (5, "again"), (None, "no id"), (None, None)]
    n_slots, n_shards = 64, 5
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = sharding.shard_documents(frame, n_shards, n_slots).collect()
    totals = [[0, 0] for _ in range(n_slots)]
    for r in got:
        totals[r.vslot][0] += r.size
        totals[r.vslot][1] += 1
    loads, owner = [0] * n_shards, {}
    for weight, slot in sorted(((-(b * n_slots + 1), s) for s, (b, _) in enumerate(totals))):
        at = loads.index(min(loads))
        loads[at] -= weight
        owner[slot] = at
    assert all(r.shard == owner[r.vslot] for r in got)
    for shard in range(n_shards):
        own = sorted((r for r in got if r.shard == shard), key=lambda r: (r.vslot, r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.size))
        assert [r.slot for r in own] == list(range(len(own)))
    known = {(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs}
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == known and len(got) == len(docs)
