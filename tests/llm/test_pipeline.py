"""The pipeline's stages on a small corpus, each held against what its operator decides."""

import random

import corpus_pipeline

from rallyframe.llm import toxicity


def shingles_of(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_stages(spark, tmp_path):
    rnd = random.Random(1)
    plain = ["".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(240):
        words = [rnd.choice(plain) for _ in range(rnd.randint(20, 60))]
        if i % 6 == 0:
            words[3:3] = ["vexing", "vexor"]
        if i % 10 == 1:
            words.append("token=0123456789abcdef0123")
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, int(i % 6 == 0)))
    rows += [(300, rows[1][1], "en", "s", 1), (301, None, None, None, None), (302, "", "en", "s", 0)]
    names = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, names).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    d = str(tmp_path)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    steps = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, d)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        steps.append(docs)
    assert all(s.columns == names.replace(" long", "").replace(" string", "").split(", ") for s in steps[:-1])

    start = spark.read.parquet(f"{d}/documents.parquet")
    model = toxicity.train(start, spark.read.parquet(f"{d}/labels.parquet"))
    bad = {r.doc_id for r in toxicity.scored(start, model).collect() if r.predicted}
    assert {r.doc_id for r in steps[0].collect()} == {r[0] for r in rows} - bad
    own = {r.doc_id: shingles_of(r.text) for r in steps[0].collect()}
    kept = {r.doc_id for r in steps[1].collect()}
    assert kept <= set(own) and 300 not in kept and 1 in kept and len(kept & {301, 302}) == 1
    near = lambda a, b: own[a] == own[b] or len(own[a] & own[b]) >= 0.8 * len(own[a] | own[b]) - 1e-9
    assert all(not near(a, b) for a in kept for b in kept if a != b)
    assert all(any(near(a, b) for b in own if b < a) for a in set(own) - kept)
    redacted = {r.doc_id: r.text or "" for r in steps[2].collect()}
    assert set(redacted) == kept and not any("0123456789abcdef0123" in t for t in redacted.values())
    source = {r[0]: r[1] or "" for r in rows}
    assert all(redacted[i] == source[i] for i in kept if "token" not in source[i])
    packed = steps[3].collect()
    assert {r.doc_id for r in packed} == kept and all(r.offset + r.length <= 1024 for r in packed)
    assert len({(r.doc_id, r.start) for r in packed}) == len(packed)
    assert sum(r.length for r in packed) == sum({r.doc_id: r.doc_tokens for r in packed}.values())
    again = {(r.doc_id, r.start, r.ids_crc32) for r in corpus_pipeline.run(spark, d).collect()}
    assert again == {(r.doc_id, r.start, r.ids_crc32) for r in packed}
