"""Credentials whose parts are long link and are redacted whole."""

from rallyframe.llm import secrets


def test_long_parts_link_and_go(spark):
    long = "Ab1xYz9Qw8" * 60
    name = "client_id=" + "n" * 200
    texts = [f"secret={long} client_id=bob", f"{'0123456789abcdef' * 60} login=bob", f"login=bob {long[:200]} end", f"{name} {long[:30]} end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kinds = {r.doc_id: [s.split(":")[0] for s in r.spans.split(",") if s] for r in secrets.scan_secrets(docs).collect()}
    assert "ident" in kinds[0] and "ident" in kinds[1]
    assert kinds[2] == ["ident", "key"] and kinds[3] == ["ident", "key"]
    clean = {r.doc_id: r.text for r in secrets.redacted(docs).collect()}
    assert clean[2] == "[ident] [key] end" and clean[3] == "[ident] [key] end"


def test_ids_of_any_kind(spark):
    from rallyframe.llm import simhash

    secret = "token = 0123456789abcdefABCDEF"
    docs = spark.createDataFrame([("a", f"x {secret}"), ("b", "plain"), (None, f"y {secret} z"), ("c", "plain")], "doc_id string, text string")
    clean = {r.doc_id: r.text for r in secrets.redacted(docs).collect()}
    assert clean["b"] == "plain" and "0123456789" not in clean["a"] + clean[None]
    assert {r.doc_id for r in simhash.deduplicated(docs).collect()} >= {"a", "b"}
