"""A refreshed store equals one built anew, after inserts, changes and removals."""

import os

import test_season as league
from pyspark.sql import functions as F

from rallyframe.sources import feeds, files, refresh

GAMES = [f"102100000{n}" for n in range(1, 6)]


def plays_of(spark, folder, logs):
    folder.mkdir()
    league.stored(spark, folder, logs)
    raw = feeds.read_many(spark, str(folder), "pbp", [{"game_id": g} for g in logs])
    games = spark.createDataFrame([(g, "2010", "Playoffs" if g == GAMES[4] else "Regular Season") for g in logs], "game string, season string, season_type string")
    return feeds.plays(raw), games


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect())


def test_refresh_equals_rebuild(spark, tmp_path):
    logs = {g: league.simulated(g, n)[0] for n, g in enumerate(GAMES)}
    first = {g: logs[g] for g in GAMES[:4]} | {GAMES[1]: [r for r in logs[GAMES[1]] if r["PERIOD"] < 3]}
    then = {g: logs[g] for g in (GAMES[0], GAMES[1], GAMES[3], GAMES[4])}  # one changed, one removed, one inserted
    store, anew = str(tmp_path / "store"), str(tmp_path / "anew")
    before, after = plays_of(spark, tmp_path / "a", first), plays_of(spark, tmp_path / "b", then)
    assert refresh.refresh(spark, store, *before) == 1
    assert refresh.refresh(spark, store, *after) == 2
    assert refresh.refresh(spark, anew, *after) == 1
    assert rows(refresh.sums(spark, store)) == rows(refresh.sums(spark, anew))
    assert rows(refresh.stints(spark, store)) == rows(refresh.stints(spark, anew))
    built = {r.game: r.version for r in refresh.manifest(spark, store).collect()}
    assert built == {GAMES[0]: 1, GAMES[1]: 2, GAMES[3]: 1, GAMES[4]: 2}  # only what changed was built
    # Nothing changed, in whatever order the rows come: no version. A version without its manifest doesn't count.
    assert refresh.refresh(spark, store, after[0].orderBy(F.desc("seq")), after[1]) == 2
    os.remove(f"{store}/manifest/as_of=2/_SUCCESS")
    assert refresh.version(spark, store) == 1
    assert refresh.refresh(spark, store, *after) == 2
    assert rows(refresh.sums(spark, store)) == rows(refresh.sums(spark, anew))


def test_stale_answers_are_forgotten(spark, tmp_path):
    whole, half = league.simulated(GAMES[0], 0)[0], [r for r in league.simulated(GAMES[1], 1)[0] if r["PERIOD"] < 3]
    league.stored(spark, tmp_path, {GAMES[0]: whole, GAMES[1]: half})
    stale = {feeds.file_of("game_ids", season="2010", season_type=t) for t in ("Regular Season", "Playoffs")} | {feeds.file_of("pbp", game_id=GAMES[1])}
    assert set(refresh.forget(spark, str(tmp_path), "2010", dry_run=True)) == stale
    assert all(files.exists(spark, f"{tmp_path}/{n}") for n in stale)
    assert set(refresh.forget(spark, str(tmp_path), "2010")) == stale
    assert not any(files.exists(spark, f"{tmp_path}/{n}") for n in stale) and files.exists(spark, f"{tmp_path}/{feeds.file_of('pbp', game_id=GAMES[0])}")
    assert refresh.forget(spark, str(tmp_path), "2010") == []
