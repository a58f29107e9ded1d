"""Sources, sinks, incremental ingest and box ratings."""

import glob
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rallyframe.operators import bpm
from rallyframe.sources import files
from rallyframe.streaming import ingest


def test_content_key(spark):
    params = F.create_map(F.lit("season"), F.lit("2024"), F.lit("game"), F.lit("7"))
    want = "x_" + hashlib.md5(b"game=7_season=2024").hexdigest()[:8] + ".csv"
    assert spark.range(1).select(files.content_key(F.lit("x"), params)).first()[0] == want


def test_partitions_are_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_partitions(spark.createDataFrame([(1, 2020, 1.0), (2, 2021, 2.0)], "id int, season int, v double"), path, ["season"])
    files.write_partitions(spark.createDataFrame([(3, 2021, 3.0)], "id int, season int, v double"), path, ["season"])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 3]
    assert [r.season for r in files.partitions(spark, path, ["season"]).collect()] == [2020, 2021]
    assert files.scan(spark, str(tmp_path / "none"), "a int", may_be_absent=True).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.scan(spark, str(tmp_path / "none"), "a int").count()


def test_nan_is_null_and_documents_are_stable(spark, tmp_path):
    rows = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, 1.5)], "k int, v double")
    assert [r.v for r in files.no_nan(rows).orderBy("k").collect()] == [None, None, 1.5]
    docs = spark.createDataFrame([(1, "[]"), (2, "[1]")], "k int, doc string")
    for _ in range(2):
        files.write_documents(docs, str(tmp_path / "d"), ["k"])
        assert [open(p).read() for p in sorted(glob.glob(f"{tmp_path}/d/k=*/*.txt"))] == ["[]\n", "[1]\n"]


def test_schedule_pads_and_dedups(spark, tmp_path):
    (tmp_path / "a.csv").write_text("GAME_ID,GAME_DATE,MATCHUP\n1049700021,1997-08-30,B @ A\n0049700002,1997-07-01,C @ D\n")
    (tmp_path / "b.csv").write_text("GAME_ID,GAME_DATE,MATCHUP\n49700002,1997-07-01,C @ D\n")
    got = files.schedule(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]).collect()
    assert [r.GAME_ID for r in got] == ["0049700002", "1049700021"]


def test_ingest_equals_batch(spark, tmp_path):
    source, target, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    kinds = "id int, season int, version int, v string"
    batches = [[(1, 2020, 1, "a"), (2, 2021, 1, "b"), (1, 2020, 2, "c")], [(2, 2021, 0, "late"), (3, 2021, 1, "d")], [(1, 2020, 5, "e")]]
    for rows in batches:
        spark.createDataFrame(rows, kinds).coalesce(1).write.mode("append").parquet(source)
        for _ in range(2):
            ingest.ingest(spark, source, kinds, target, state, ["id"], ["version"], ["season"])
    got = {(r.id, r.v) for r in spark.read.parquet(target).collect()}
    assert got == {(1, "e"), (2, "b"), (3, "d")}


def test_ratings_match_closed_form(spark):
    rnd = np.random.default_rng(7)
    n = 60
    x, y, w = rnd.normal(size=(n, 4)) * [3, 1, 5, 0.1] + [1, 2, 3, 0.5], rnd.normal(size=n), rnd.integers(500, 3000, n)
    rows = spark.createDataFrame([(*map(float, x[i]), float(y[i]), int(w[i])) for i in range(n)] + [(None, 1.0, 1.0, 1.0, 9.0, 900), (1.0, 1.0, 1.0, 1.0, 99.0, 3)], "AST_100 double, TOV_100 double, USG_PCT double, TS_PCT double, y double, POSS int")
    z = np.c_[(x - x.mean(0)) / x.std(0), np.ones(n)]
    beta = np.linalg.solve((z * w[:, None]).T @ z + 10 * np.diag([1, 1, 1, 1, 0]), (z * w[:, None]).T @ y)
    model = bpm.fit(rows, bpm.OFFENSE, "y", "POSS")
    got = [r.p for r in rows.withColumn("p", bpm.predicted(model)).collect()]
    assert np.allclose(got[:n], z @ beta, atol=0.00501) and got[n] is None
    assert bpm.fit(rows.limit(5), bpm.OFFENSE, "y", "POSS") is None
