"""Scopes over stored stints, their readers, and feeds that keep what they declare."""

import pytest
from pyspark.sql import functions as F

from rallyframe.sources import feeds, files, scopes, seasons

ROW = ("g", 0.0, 60.0, 1, 2, [1, 2, 3, 4, 5], [6, 7, 8, 9, 10], 5.0, 2.0, 3.0, 2.0, 0.0)


def test_scopes_read_their_partitions(spark, tmp_path):
    out = str(tmp_path)
    assert scopes.scope_table(spark, out, "2010", "all").count() == 0
    kinds = [("2010", "Regular Season"), ("2010", "Playoffs"), ("2011", "Regular Season")]
    files.write_partitions(spark.createDataFrame([(*ROW, *k) for k in kinds] + [(*ROW[:9], 0.1, 0.1, 0.0, *kinds[0])], seasons.STINTS), f"{out}/stints", ["season", "season_type"])
    spark.createDataFrame([(1, "One")], scopes.NAMES).write.parquet(f"{out}/names")
    for scope, poss in (("reg", 5.0), ("playoffs", 5.0), ("all", 10.0)):
        got = {r.player: r for r in scopes.scope_table(spark, out, "2010", scope).collect()}
        assert len(got) == 10 and got[1].poss == poss and got[1].name == "One" and got[2].name == "2" and got[1].season == "2010"
        assert got[1].on_ortg == pytest.approx(166.7) and got[6].on_ortg == 100.0
    box = spark.createDataFrame([(1, 2, 1.0, 0.0, 0.5)], "player long, gp long, fga double, fta double, tov double")
    got = {r.player: r for r in scopes.scope_table(spark, out, "2010", "reg", box).collect()}
    assert got[1].usg == 100.0 and got[2].usg is None


def test_rates_that_are_not_there(spark, tmp_path):
    read = lambda: scopes.advanced(spark, str(tmp_path), "2010", "reg", "player long")
    assert read() is None
    (tmp_path / "advanced_2010_reg.parquet").write_text("cut off")
    assert read() is None
    spark.range(3).select(F.col("id").alias("player")).write.mode("overwrite").parquet(str(tmp_path / "advanced_2010_reg.parquet"))
    assert read().count() == 3


def test_every_declared_feed_is_read(spark, tmp_path):
    for name, feed in feeds.FEEDS.items():
        parameters = {k: f"{k}7" for k in feed.keys}
        columns = [c.split()[0] for c in feed.schema.split(", ")] if feed.schema else ["PLAYER_ID", "GP"]
        with open(feeds.path_of(spark, str(tmp_path), name, **parameters), "w") as f:
            f.write(",".join([*columns, "EXTRA"]) + "\n" + ",".join(["1"] * (len(columns) + 1)) + "\n")
        one = feeds.read(spark, str(tmp_path), name, **parameters)
        assert one.count() == 1 and one.columns == columns + ([] if feed.schema else ["EXTRA"])
        many = feeds.read_many(spark, str(tmp_path), name, [parameters])
        assert {c.upper() for c in many.columns} == {c.upper() for c in [*one.columns, *feed.keys]} and many.count() == 1
