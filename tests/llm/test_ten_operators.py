"""The ten operators against brute force, and on nulls, ties, repeats, empties and odd columns."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rallyframe.llm import dropout, embeddings, imatch, lmscore, packing, planes, secrets, sharding, simhash, toxicity, words
from rallyframe.llm.components import components

# Extra columns whose names clash with those that operators make.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row long, shard int, h long, score double, `fp` string"
EXTRA = (None, None, None, 7, 8, 9, 1.0, "x")
KEY = "AKIA" + "ABCDEFGH12345678"
HEX = "0123456789abcdef0123"


def texts():
    rnd = random.Random(3)
    syllables = ["the", "ra", "mo", "lin", "ter", "é", "ñu", "ko", "sta"]
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    long = prose(3000)
    out = [prose(rnd.randint(1, 120)) for _ in range(40)]
    out += [out[0], out[1] + " coda", None, "", " \n\t ", long, long[:-9], out[2].upper(), "x" * 5000]
    out += [f"é token = '{HEX}{HEX}' {KEY} tail", f"password: short secret={HEX}", "token=secret: abcdefghijklmnop", "AKIA" * 6]
    return out


def frame(spark, extra=True):
    rows = [(i, t) for i, t in enumerate(texts())]
    rows += [(3, texts()[3]), (3, texts()[3]), (None, "no id"), (None, None)]
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], DOCS), rows


def empty(spark):
    return spark.createDataFrame([], DOCS)


# 1 ---------------------------------------------------------------------------------------------


def base_spans(text):
    t = text or ""
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(t) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(found)


def test_secrets_match_brute_force(spark):
    docs, rows = frame(spark)
    got = secrets.scan_secrets(docs).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), *(sum(s[1] == k for s in base_spans(t)) for k in range(3)), hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in base_spans(t)).encode()).hexdigest()) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == want
    assert secrets.scan_secrets(empty(spark)).count() == 0


def test_weak_candidates_need_complementary_parts(spark):
    key = "Ab1" + "xYz9Qw8Er7Ty6Ui5Op4As3Df"
    texts = [f"{KEY} and {key} at https://example.org/x", key, f"https://example.org {key}", f"{KEY} " + "- " * 200 + key, f"login=bob {key}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kinds = {r.doc_id: [s.split(":")[0] for s in r.spans.split(",") if s] for r in secrets.scan_secrets(docs).collect()}
    assert kinds[0] == ["access", "key", "endpoint"]
    assert kinds[1] == [] and kinds[2] == [] and kinds[3] == ["access"]
    assert kinds[4] == ["ident", "key"]


def test_redaction_keeps_rows_and_columns(spark):
    docs, rows = frame(spark)
    got = secrets.redacted(docs)
    assert got.columns == docs.columns and got.count() == len(rows)
    out = {r.doc_id: r for r in got.collect()}
    marked = [i for i, t in rows if t and "tail" in t][0]
    assert HEX not in out[marked].text and KEY not in out[marked].text and out[marked].text.endswith(" tail")
    assert out[marked].n_chars == len(out[marked].text)
    assert out[0].text == rows[0][1] and out[0].n_chars is None


# 2, 3, 10: tokenizing ---------------------------------------------------------------------------


@pytest.mark.parametrize("name, spaces", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_piecewise_encoding_equals_whole(name, spaces):
    codec = words.PieceCodec(public_tokenizers.path(name), spaces)
    rnd = random.Random(5)
    parts = [" ", "\n", "  ", "\t", "a", "B", "'s", "é", "é", "\x1c", "\x85", "word", "!!", "12", "<|endoftext|>", "漢字", "　", " ", "\r\n", "x" * 70, "\x00", "Σ"]
    some = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(3000)] + texts()
    ids, ends = codec.encode(pa.array(some))
    for i, t in enumerate(some):
        assert np.array_equal(codec.encode_whole(t or ""), ids[ends[i] : ends[i + 1]]), repr(t)


def test_dropout_equals_library_without_and_decodes_with():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), dropout.Vocabulary(path)
    some = [t or "" for t in texts()] + ["a  b", "   ", " lead", "漢字  x", "nul\x00"]
    codecs = lambda p: dropout.DropoutCodec(own, p, 0)
    numbers = list(range(len(some)))
    plain = dropout.encode_array(codecs(0.0), numbers, pa.array(some))
    assert [p.tolist() for p in plain] == [library.encode(t) for t in some]
    varied = dropout.encode_array(codecs(0.3), numbers, pa.array(some))
    again = dropout.encode_array(codecs(0.3), numbers, pa.array(some))
    assert all(np.array_equal(a, b) for a, b in zip(varied, again))
    assert [own.decode(v.tolist()) for v in varied] == some
    assert sum(map(len, varied)) > 1.05 * sum(map(len, plain))
    low = "a▁b"
    assert own.decode(dropout.encode_array(codecs(0.1), [1], pa.array([low]))[0].tolist()) == low
    keys = [dropout.DropoutCodec(own, 0.3, k).encode(pa.array([" " + some[5]]))[0].tolist() for k in range(6)]
    assert len({tuple(k) for k in keys}) > 3


def test_dropout_operator(spark):
    docs, rows = frame(spark)
    got = dropout.encoded(docs, public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert len(got) == len(rows) and all(r.lossless and len(r.ids) == r.n_tokens for r in got)
    want = sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t in rows)
    assert sorted(r.decoded_sha256 for r in got) == want
    assert dropout.encoded(empty(spark), public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_packing_is_whole_and_tight(spark):
    docs, rows = frame(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = packing.pack_documents(docs, path).collect()
    tokenizer = Tokenizer.from_file(path)
    left = sorted((str(i), zlib.crc32(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes())) for i, t in rows if len(t or "") < 500)
    assert left == sorted((str(r.doc_id), r.ids_crc32) for r in got if r.doc_tokens <= 1024 and len(dict((str(i), t or "") for i, t in rows)[str(r.doc_id)]) < 500)
    assert sum(r.length for r in got) == sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(by) == list(range(len(by)))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack_documents(empty(spark), path).count() == 0


def test_packing_plan_uses_every_piece_once():
    rnd = np.random.default_rng(1)
    for case in range(20):
        histogram = rnd.integers(0, 200, 128) * (rnd.random(128) < 0.3)
        made = packing.plan(histogram)
        used = np.zeros(128, dtype=int)
        for pattern, times in made:
            assert times > 0 and sum(p * k for p, k in pattern.items()) <= 128
            for p, k in pattern.items():
                used[p - 1] += k * times
        assert (used == histogram).all()
    assert packing.plan(np.zeros(128, dtype=int)) == []


def test_least_squares_is_nonnegative_and_optimal():
    rnd = np.random.default_rng(2)
    a, b = rnd.random((20, 30)), rnd.random(20) * 10
    x = packing.nonnegative_least_squares(a, b)
    gradient = a.T @ (b - a @ x)
    assert (x >= 0).all() and gradient.max() < 1e-6 and np.abs(gradient[x > 1e-9]).max() < 1e-6


def test_planes_round_trip():
    rnd = np.random.default_rng(3)
    for n, top in ((0, 1), (1, 2), (5, 200), (70_000, 49_408), (40_000, 1 << 31)):
        ids = rnd.integers(0, top, n).astype(np.uint32)
        assert np.array_equal(planes.unpack_ids(planes.pack_ids(ids)), ids)
    assert np.array_equal(planes.unpack_ids(planes.pack_ids(np.zeros(10, np.uint32))), np.zeros(10))
    with pytest.raises(ValueError):
        planes.unpack_ids(b"nope" + b"\0" * 12)


def test_ids_written_and_read_back(spark, tmp_path):
    docs, rows = frame(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    planes.write_ids(docs, str(tmp_path / "ids"), path)
    got = planes.read_ids(spark, str(tmp_path / "ids"), with_ids=True).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(path)
    own = {(i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])) for i, t in rows}
    assert {(r.doc_id, tuple(r.ids)) for r in got} == own and len(got) == len(rows)
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got])[:-1])
    ids = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids)
    planes.write_ids(empty(spark), str(tmp_path / "none"), path)
    assert planes.read_ids(spark, str(tmp_path / "none")).count() == 0


# 4 ---------------------------------------------------------------------------------------------


def toxic_tables(spark, n=2000):
    rnd = random.Random(9)
    plain = ["".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(300)]
    bad = [f"vexor{x}" for x in ("a", "en", "ist", "um", "ly", "ous", "ing", "ed")]
    docs, labels = [], []
    for i in range(n):
        out, toxic = [rnd.choice(plain) for _ in range(rnd.randint(5, 200))], i % 6 == 0
        if toxic:
            unseen = zlib.crc32(str(i).encode()) % 4 == 2
            for _ in range(max(2, len(out) // 60)):
                out.insert(rnd.randrange(len(out)), "vexorish" if unseen else rnd.choice(bad))
        docs.append((i, " ".join(out)))
        labels.append((i, 1, int(toxic)))
    docs += [(n, None), (n + 1, ""), (None, "plain"), (n + 2, "..."), (n + 3, plain[0] * 2000)]
    labels += [(5, None, None), (0, 1, 1), (None, 1, 1)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_finds_unseen_spellings(spark):
    docs, labels = toxic_tables(spark)
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.scored(docs, model).collect()}
    assert len(got) == docs.count()
    held = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i in got if got[i].held_out} - {2000, 2001, 2002, 2003} == set(held)
    caught = [got[i].predicted == 1 for i in held if i % 6 == 0]
    wrong = [got[i].predicted == 1 for i in held if i % 6]
    assert np.mean(caught) > 0.9 and np.mean(wrong) < 0.05
    assert got[2000].score == got[2001].score == got[2002].score == 0.0 and all(0 <= r.score <= 1 for r in got.values())
    kept = toxicity.kept(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got.values())


def test_toxicity_without_labels(spark):
    docs, labels = toxic_tables(spark, 30)
    assert toxicity.train(docs, labels.where("toxic = 0")) is None
    assert toxicity.train(docs, labels.limit(0)) is None
    assert {r.score for r in toxicity.scored(docs, None).collect()} == {0.0}
    assert toxicity.kept(docs, None).count() == docs.count()
    assert toxicity.scored(docs.limit(0), None).count() == 0


# 5 ---------------------------------------------------------------------------------------------


def test_embedding_links_match_brute_force(spark):
    rnd = np.random.default_rng(4)
    centres = rnd.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + rnd.normal(size=16) * rnd.choice([0.05, 0.3, 0.6])).tolist(), int(i % 3)) for i in range(400)]
    rows += [(1000 + i, rows[7][1], rows[7][2]) for i in range(30)]
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [None] + [1.0] * 15, 1), (2003, [float("nan")] * 16, 1), (2004, rows[7][1], None), (2005, [float("inf")] * 16, 2), (2006, [], 1), (2007, [1.0, 0.0], 1), (2008, [2.0, 0.0], 1), (2009, [1e200] * 16, 1), (2010, [2e200] * 16, 1)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, vector string")
    usable = {}
    for i, v, label in rows:
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable.setdefault((label, len(v)), []).append((i, np.array(v) / np.abs(v).max()))
    n, parent = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for group in usable.values():
        for a, (i, x) in enumerate(group):
            for j, y in group[:a]:
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                    n[i] += 1
                    n[j] += 1
                    s, t = find(i), find(j)
                    parent[max(s, t)] = min(s, t)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(frame).collect()}
    assert got == {i: (n[i], find(i), find(i) == i) for i in n}
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def test_embeddings_without_or_with_repeated_vec_ids(spark):
    rows = [(None, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (None, [0.0, 1.0], 1), (None, [0.0, 1.0], None)]
    rows += [(5, [1.0, 0.01], 1), (6, [1.0, 0.02], 1), (7, [0.0, -1.0], 1), (7, [1.0, 0.0], 1), (8, [1.0, 0.0], 1)]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert len(got) == len(rows)
    assert all((r.n_links, r.component_id, r.kept) == (0, None, False) for r in got if r.vec_id is None)
    assert {r.component_id for r in got if r.vec_id is not None} == {5}  # 7 is one node here, by either of its vectors


# 6 ---------------------------------------------------------------------------------------------


def test_fingerprints_and_edited_texts(spark):
    docs, rows = frame(spark)
    got = imatch.fingerprints(docs, low=0.0, high=1.0, buckets=5).collect()
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    ids = [r for r in order if r[0] is not None and r[0] != 3]
    by = {r.doc_id: r for r in got if r.doc_id is not None and r.doc_id != 3}
    for a, b in zip(ids, ids[1:]):
        if b[0] == a[0] + 1:
            t, nxt = a[1] or "", b[1] or ""
            cut = len(t) // 4
            assert by[a[0]].n_chars == len(t)
            assert by[a[0]].edited_sha256 == hashlib.sha256((t[: len(t) - cut] + nxt[:cut]).encode()).hexdigest()
    assert by[0].fingerprint == by[40].fingerprint and by[0].fingerprint != by[2].fingerprint
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert imatch.fingerprints(empty(spark), buckets=3).count() == 0
    one = imatch.fingerprints(docs.where("doc_id = 2"), buckets=3).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_lexicon_keeps_the_band(spark):
    docs = spark.createDataFrame([(i, "all " + ("half " if i % 2 else "") + f"one{i}") for i in range(20)], "doc_id long, text string")
    assert {r.code for r in imatch.lexicon(docs, 0.1, 0.6).collect()} == {signed(xxhash.xxh64_intdigest(b"half", 42))}
    # Two documents at least, and no more terms than the bound allows.
    assert {r.code for r in imatch.lexicon(docs, 0.0, 1.0).collect()} == {signed(xxhash.xxh64_intdigest(w, 42)) for w in (b"all", b"half")}
    assert {r.code for r in imatch.lexicon(docs, 0.0, 1.0, most=2).collect()} == {signed(xxhash.xxh64_intdigest(b"all", 42))}


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def chained(values, seed=42):
    """Spark's hash of longs and ints one after the other."""
    for v, size in values:
        seed = xxhash.xxh64_intdigest((v % (1 << 8 * size)).to_bytes(size, "little"), seed)
    return seed


def test_fingerprints_match_brute_force(spark):
    rnd = random.Random(12)
    vocabulary = ["".join(rnd.choice("abcdefgh") for _ in range(4)) for _ in range(400)]
    texts = [" ".join(rnd.choice(vocabulary[:200] if i % 2 else vocabulary) for _ in range(rnd.choice((3, 30, 300, 2000)))) for i in range(40)]
    texts += ["", None, "only these", "...", texts[1], texts[1] + " Extra"]
    low, high, seeds, rates = 0.1, 0.6, 3, 4
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in imatch.fingerprints(docs, low, high, seeds, rates, buckets=4).collect()}
    terms = lambda t: set(re.findall(r"[^\W_]+", (t or "").lower()))
    df = collections.Counter(w for t in texts for w in terms(t))
    band = {w for w, n in df.items() if n >= max(2, low * len(texts)) and n <= max(2, high * len(texts))}
    assert 10 < len(band) < len(df)

    def components(t):
        kept = (terms(t) & band) or terms(t)
        codes = sorted(signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in kept)
        subsets = [codes] + [[c for c in codes if chained([(c, 8), (s, 4)]) & ((1 << 2 * r) - 1) == 0] for s in range(seeds) for r in range(1, rates + 1)]
        return [chained([(c, 8) for c in sub]) & 0xFFFFFFFF if sub else None for sub in subsets]

    def near(a, b):
        known = [(x, y) for x, y in zip(a, b) if x is not None or y is not None]
        return sum(x == y for x, y in known) / len(known) if known else 1.0

    named = lambda t: sorted(components(t), key=str)
    for i, t in enumerate(texts):
        t, nxt = t or "", texts[(i + 1) % len(texts)] or ""
        cut = len(t) // 4
        edited = t[: len(t) - cut] + nxt[:cut]
        for text, print_ in ((t, got[i].fingerprint), (edited, got[i].edited_fingerprint)):
            assert sorted((int(x, 16) if x else None for x in print_.split("-")), key=str) == named(text)
        assert got[i].near_edited == pytest.approx(near(components(t), components(edited)))
        assert got[i].near_next == pytest.approx(near(components(t), components(nxt)))


# 7 ---------------------------------------------------------------------------------------------


def test_losses_match_brute_force(spark):
    docs, rows = frame(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    good = spark.createDataFrame([(i,) for i in range(0, 20)] + [(None,), (3,)], "doc_id long")
    got = lmscore.cross_entropy_difference(docs, good, path).collect()
    assert len(got) == len(rows)
    tokenizer = Tokenizer.from_file(path)
    size = tokenizer.get_vocab_size()
    single, before, pair = ([{}, {}] for _ in range(3))

    def walk(t):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        return [(a, b, int(lmscore.cells(np.array([a]), np.array([b]))[0])) for a, b in zip([size] + ids, ids)]

    for i, t in rows:
        for a, b, c in walk(t):
            for k in (0, 1) if i is not None and i < 20 else (0,):
                for table, key in ((single, b), (before, a), (pair, c)):
                    table[k][key] = table[k].get(key, 0) + 1
    total = [sum(s.values()) for s in single]
    scale = [total[1] / total[0], 1.0]

    def loss(i, t, k):
        """The mean loss by all other documents."""
        steps = walk(t)
        part = 1 if k == 0 or i < 20 else 0
        counts = [collections.Counter(step[n] for step in steps) for n in range(3)]
        own = lambda n, key: part * counts[n][key]
        out = 0.0
        for a, b, c in steps:
            uni = ((single[k].get(b, 0) - own(1, b)) * scale[k] + 1) / ((total[k] - part * len(steps)) * scale[k] + size)
            p = (pair[k].get(c, 0) - own(2, c)) * scale[k]
            out -= np.log((p + lmscore.PRIOR * uni) / ((before[k].get(a, 0) - own(0, a)) * scale[k] + lmscore.PRIOR))
        return out / max(1, len(steps))

    want = {i: (loss(i, t, 0), loss(i, t, 1)) for i, t in rows if i is not None}
    assert any(len(t or "") > 900 for i, t in rows if i in want)
    for r in got:
        if r.doc_id in want:
            assert r.background_loss == pytest.approx(want[r.doc_id][0], rel=1e-9, abs=1e-9)
            assert r.target_loss == pytest.approx(want[r.doc_id][1], rel=1e-9, abs=1e-9)
    none = lmscore.cross_entropy_difference(docs, good.limit(0), path).collect()
    assert {r.score for r in none} == {0.0}
    assert lmscore.cross_entropy_difference(empty(spark), good, path).count() == 0


# 8 ---------------------------------------------------------------------------------------------


def slow_print(text, words=4):
    found = re.findall(rb"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode())
    if not found:
        return 0
    k = min(words, len(found))
    hashes = [xxhash.xxh64_intdigest(b" ".join(found[i : i + k]), 42) for i in range(len(found) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("bits", [4, 5])
def test_near_pairs_are_all_found(spark, bits):
    rnd = random.Random(6)
    prints = [rnd.getrandbits(64) for _ in range(60)] + [0, (1 << 64) - 1]
    for p in prints[:]:
        for k in range(7):
            q = p
            for b in rnd.sample(range(64), k):
                q ^= 1 << b
            prints.append(q)
    prints = sorted(set(prints))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    got = simhash.near_pairs(spark.createDataFrame([(signed(p),) for p in prints], "fp long"), bits).collect()
    want = {(min(signed(a), signed(b)), max(signed(a), signed(b))) for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= bits}
    assert len(got) == len(want) and {(r.a, r.b) for r in got} == want


def test_simhash_groups(spark):
    docs, rows = frame(spark)
    got = simhash.near_duplicates(docs.select(F.col("doc_id").alias("key"), "text")).collect()
    assert len(got) == len(rows)
    prints = {i: slow_print(t) for i, t in rows if i is not None}
    assert all(r.fp % (1 << 64) == prints[r.key] for r in got if r.key is not None)
    parent = {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in prints:
        for j in prints:
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                s, t = find(i), find(j)
                parent[max(s, t)] = min(s, t)
    assert all(r.component == find(r.key) for r in got if r.key is not None)
    assert simhash.near_duplicates(empty(spark).select(F.col("doc_id").alias("key"), "text")).count() == 0


def test_one_of_each_group_stays(spark):
    docs, rows = frame(spark)
    kept = simhash.deduplicated(docs)
    groups = {r.group for r in simhash.near_duplicates(docs.select(F.col("doc_id").alias("key"), "text"), 4).collect()}
    assert kept.columns == docs.columns and kept.count() == len(groups)
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(3) == 1 and 0 in ids and 40 not in ids
    assert simhash.deduplicated(empty(spark)).count() == 0


def test_components(spark):
    rnd = random.Random(8)
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(40)] + [(7, 7), (None, 3), (5, 4)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            s, t = find(a), find(b)
            parent[max(s, t)] = min(s, t)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {(r.node, r.component) for r in got} == {(x, find(x)) for x in parent} and len(got) == len(parent)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# 9 ---------------------------------------------------------------------------------------------


def test_shards_are_even_and_numbered(spark):
    docs, rows = frame(spark)
    got = sharding.shard_documents(docs, n_shards=4).collect()
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert set(by) <= set(range(4)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sharding.shard_documents(empty(spark), n_shards=4).count() == 0


def test_map_versions_move_few_slots(spark, tmp_path):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("text"))
    path = str(tmp_path / "map")
    first = sharding.shard_documents(docs, 4, 256, path).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    assert max(r.b for r in first) < 1.02 * min(r.b for r in first)
    second = sharding.shard_documents(docs, 5, 256, path).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    assert len(second) == 5 and max(r.b for r in second) < 1.1 * min(r.b for r in second)
    one, two = (sharding.load_map(spark, path, v).select("vslot", "shard") for v in (1, 2))
    moved = one.join(two.withColumnRenamed("shard", "now"), "vslot").where("shard <> now").count()
    assert 0 < moved < 0.35 * 256
