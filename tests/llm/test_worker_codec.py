"""Tasks of one Python worker share what they know of pieces; ids are those of whole texts."""

import public_tokenizers
import pyarrow as pa
import pytest

from rallyframe.llm.words import worker_codec


@pytest.mark.parametrize(("name", "keep_space"), [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_a_codec_is_shared_and_what_it_knows_changes_no_id(name, keep_space, monkeypatch):
    codec = worker_codec(public_tokenizers.path(name), keep_space)
    assert worker_codec(public_tokenizers.path(name), keep_space) is codec
    texts = ["Größe, asíez. don't 12,5 €%%", "", None, "a  b\n\n c", "größe Größe,"]
    want = [codec.encode_whole(t or "").tolist() for t in texts]
    for cache in (codec.cache, 0, codec.cache):
        monkeypatch.setattr(codec, "cache", cache)
        ids, ends = codec.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == want


def test_tasks_of_a_worker_load_the_tokenizer_once(spark):
    path = public_tokenizers.path("word_bpe_49k.json")

    def loaded(batches):
        import os

        for _ in batches:
            before = worker_codec.cache_info().misses
            worker_codec(path, False)
            yield pa.RecordBatch.from_arrays([pa.array([os.getpid()]), pa.array([worker_codec.cache_info().misses - before])], names=["pid", "loads"])

    seen = spark.range(64).repartition(32, "id").mapInArrow(loaded, "pid long, loads long").collect()
    assert len(seen) > len({r.pid for r in seen}) >= sum(r.loads for r in seen)
