"""Landed gzip CSV files through all layers, twice, and then a second delivery."""

import csv
import gzip
import os

import pytest

from arenalake import schemas
from arenalake.operators.joins import current
from arenalake.plans import gold
from arenalake.plans.medallion import by_match, run_medallion, silver_table
from arenalake.sources import csv as csv_source
from arenalake.sources import tables, versions
from arenalake.streaming.history import read_history
from arenalake.workspace import new_dir


def write_gz(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt", newline="") as f:
        csv.writer(f).writerows([header, *rows])


def land(root, table, rows, name="part1"):
    header = schemas.RAW_COLUMNS[table]
    lines = [[row.get(c, "") for c in header] for row in rows]
    write_gz(f"{root}/{schemas.RAW_FOLDERS[table]}/{name}.csv.gz", header, lines)


def interval(i, match, player, minute, **values):
    numbers = {c: "1" for c in schemas.RAW_COLUMNS["intervals"][4:]}
    return {"id": str(i), "match_id": match, "player_id": str(player), "minute": str(minute)} | numbers | values


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    landing, root = str(tmp_path_factory.mktemp("landing")), str(tmp_path_factory.mktemp("lake"))
    land(landing, "items_ref", [{"item_id": "1", "item_name": "long sword", "item_category": "basic"},
                                {"item_id": "2.0", "item_name": "infinity edge", "item_category": "LEGENDARY"},
                                {"item_id": "bad", "item_name": "x", "item_category": "x"}])
    land(landing, "champions_ref", [{"champion_id": "1", "champion_name": "Ahri"}, {"champion_id": "2", "champion_name": "Zed"}])
    land(landing, "matches", [
        {"match_id": "na1_1", "game_duration": "1800", "winning_team": "100", "game_date": "2024-05-01 10:00:00",
         "game_version": "14.1.2.3", "average_rank": "gold", "blue_bans": "1,-1", "red_bans": "2"},
        {"match_id": "na1_2", "game_duration": "x", "winning_team": "300"}])
    land(landing, "players", [
        {"id": "1", "match_id": "na1_1", "participant_id": "1", "team_id": "100", "champion": "ahri", "role": "middle"},
        {"id": "2", "match_id": "na1_1", "participant_id": "6.0", "team_id": "200", "champion": "ghost", "role": "utility"},
        {"id": "3", "match_id": "na1_1", "participant_id": "11", "team_id": "200", "champion": "zed", "role": "top"}])
    land(landing, "intervals", [
        interval(1, "na1_1", 1, 25, item_0="1", item_1="2", item_2="0", item_3="0", item_4="0", item_5="0", item_6="0"),
        interval(2, "na1_1", 1, 30, item_0="1", item_1="2", item_2="0", item_3="0", item_4="0", item_5="0", item_6="0"),
        interval(3, "na1_1", 6, 30), interval(4, "na1_1", 0, 30), interval(5, "na1_1", 6, "7.2")])
    counts = [run_medallion(spark, landing, root), run_medallion(spark, landing, root)]
    return landing, root, counts


def test_rerun_adds_nothing(spark, lake):
    _, root, counts = lake
    assert counts[0]["matches"] == {
        "rows": 2, "valid_match_id": 0, "valid_winning_team": 1, "ok_game_duration": 1, "ok_game_date": 1, "ok_game_version": 1}
    assert counts[0]["players"]["valid_participant_pos_id"] == 1
    assert counts[0]["intervals"]["valid_team"] == 1 and counts[0]["intervals"]["ok_interval_of_5"] == 1
    assert counts[1]["players"].get("rows", 0) == 0
    assert set(counts[0]["champion_overviews"]) == {"ok_balance_winrate", "ok_balance_banrate", "ok_balance_pickrate"}
    assert counts[0]["item_recommendations"].keys() == {"valid_champion_name", "valid_item_name"}
    assert counts[0]["duplicate_keys"]["silver.matches"] == 0 and "gold.matchend_player_stats" in counts[0]["duplicate_keys"]
    sizes = {t: silver_table(spark, root, t).count() for t in ("matches", "players", "intervals")}
    assert sizes == {"matches": 1, "players": 2, "intervals": 4}
    assert tables.read_table(spark, root, "bronze", "players").count() == 3


def test_gold_tables(spark, lake):
    _, root, _ = lake
    read = lambda name: tables.read_table(spark, root, "gold", name)
    stats = {r["participant_pos_id"]: r for r in read("matchend_player_stats").collect()}
    assert stats[1]["item_build"] == ["Infinity Edge", "Long Sword"] and stats[1]["win"] is True
    assert stats[6]["item_build"] == ["Long Sword"] * 7 and stats[6]["champion_role"] == "SUPPORT"
    assert stats[1]["unlogged_duration"] == 0
    overview = {r["champion_name"]: r for r in read("champion_overviews").collect()}
    assert overview["AHRI"]["global_games_played"] == 1 and overview["ZED"]["global_ban_rate"] == 1.0
    assert read("matchend_pivot_teamstats").count() == 1 and read("diff_intervals").count() == 4
    assert read("item_recommendations").filter("champion_name = 'AHRI' AND item_name = 'Long Sword'").first()["top_item_1"] == "Infinity Edge"
    ghosts = spark.table("noref_champion_name").collect()
    assert [(r[0], r[2], r[3]) for r in ghosts] == [("GHOST", "part1.csv.gz", csv_source.RECORD_SOURCE)]
    assert read("matchend_player_stats").schema["item_build"].metadata["comment"]


def test_second_delivery_versions_the_items(spark, lake):
    landing, root, _ = lake
    land(landing, "items_ref", [{"item_id": "1", "item_name": "broad sword", "item_category": "basic"},
                                {"item_id": "2", "item_name": "infinity edge", "item_category": "legendary"}], "part2")
    run_medallion(spark, landing, root)
    history = read_history(spark, root, "items_ref")
    assert history.count() == 3
    assert sorted(r["item_name"] for r in current(history).collect()) == ["Broad Sword", "Infinity Edge"]
    builds = tables.read_table(spark, root, "gold", "matchend_player_stats").filter("participant_pos_id = 1")
    assert builds.first()["item_build"] == ["Broad Sword", "Infinity Edge"]


def read(spark, path, **kwargs):
    schema = schemas.raw_schema("items_ref")
    return csv_source.read_batch(spark, path, schema, "t", **kwargs).select("item_id", "item_name", "item_category")


def test_csv_shapes(spark, tmp_path):
    path = str(tmp_path / "a.csv.gz")
    with gzip.open(path, "wt") as f:
        f.write('item_id,item_name,item_category\n1,short\n2, spaced ,Basic,extra\n3,"a, b",Epic\n4, "x y",Epic\n')
    rows = {r[0]: (r[1], r[2]) for r in read(spark, path).collect()}
    assert rows == {"1": ("short", None), "2": ("spaced", "Basic"), "3": ("a, b", "Epic"), "4": ("x y", "Epic")}


def test_reordered_header_fails_loudly(spark, tmp_path):
    path = str(tmp_path / "b.csv.gz")
    write_gz(path, ["item_name", "item_id", "item_category"], [["n", "1", "c"]])
    with pytest.raises(Exception, match="(?i)header"):
        read(spark, path).collect()
    assert read(spark, path, strict_header=False).first()[0] == "n"


def test_doubled_quote_needs_the_escape_option(spark, tmp_path):
    path = str(tmp_path / "c.csv.gz")
    with gzip.open(path, "wt") as f:
        f.write('item_id,item_name,item_category\n1,"the ""big"" one",Epic\n')
    assert read(spark, path, options={"escape": '"'}).first()[1] == 'the "big" one'


def test_inferred_types(spark, tmp_path):
    path = str(tmp_path / "d.csv")
    with open(path, "w") as f:
        f.write("a,b\n1,x\n2,y\n")
    assert [f.dataType.simpleString() for f in csv_source.read_inferred(spark, path).schema] == ["int", "string"]
    assert csv_source.read_inferred(spark, path, header=False).count() == 3


def test_bucketed_tables_join_without_shuffle(spark):
    rows = spark.range(200).selectExpr("CAST(id AS STRING) AS match_id", "id AS v")
    left = tables.save_bucketed(rows, "bucket_left", ["match_id"], 4)
    right = tables.save_bucketed(rows, "bucket_right", ["match_id"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.join(right, "match_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucket_left")
        spark.sql("DROP TABLE bucket_right")


def test_refresh_replaces(spark):
    root = new_dir(spark, "refresh")
    for n in (5, 3):
        tables.refresh_table(spark.range(n).toDF("k"), root, "gold", "t", ["k"])
    assert tables.read_table(spark, root, "gold", "t").count() == 3


def test_failed_refresh_leaves_the_old_version(spark):
    root = new_dir(spark, "refresh")
    tables.refresh_table(spark.range(5).toDF("k"), root, "gold", "t")
    begun = tables.read_table(spark, root, "gold", "t")
    # The last rows fail after others have been written.
    broken = spark.range(0, 100, 1, 4).selectExpr("if(id = 99, raise_error('stop'), id) AS k")
    with pytest.raises(Exception, match="stop"):
        tables.refresh_table(broken, root, "gold", "t")
    assert tables.read_table(spark, root, "gold", "t").count() == 5
    tables.refresh_table(spark.range(7).toDF("k"), root, "gold", "t")
    assert begun.count() == 5 and tables.read_table(spark, root, "gold", "t").count() == 7
    for n in (1, 2):
        tables.refresh_table(spark.range(n).toDF("k"), root, "gold", "t")
    # Two versions stay on disk, beside what the failed write left.
    folders = [f for f in os.listdir(f"{root}/gold/t") if f.startswith("part-")]
    assert len(folders) == 3 and tables.read_table(spark, root, "gold", "t").count() == 2


def test_two_writers_do_not_overwrite_each_other(spark):
    path = f"{new_dir(spark, 'refresh')}/t"
    first = versions.commit(spark, path, None, [versions.new_part(spark.range(1).toDF("k"), path)])
    versions.commit(spark, path, first, [versions.new_part(spark.range(2).toDF("k"), path)])
    with pytest.raises(RuntimeError, match="another writer"):
        versions.commit(spark, path, first, [versions.new_part(spark.range(3).toDF("k"), path)])
    assert versions.read_part(spark, path, versions.newest(spark, path).parts[-1]).count() == 2


def test_gold_reads_telemetry_where_it_lies(spark, lake):
    """Bucketed by match, intervals are read once and never exchanged, and joins keep the layout."""
    _, root, _ = lake
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        matches, players, intervals = by_match(spark, root, 4)
        items = current(silver_table(spark, root, "items_ref"))
        plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
        for rows in (
            gold.matchend_player_stats(intervals, matches, players, items, with_build=False),
            gold.diff_intervals(intervals, players), gold.matchend_pivot_teamstats(intervals, matches),
            gold.player_states(intervals, matches, players),
        ):
            assert "Exchange" not in plan(rows) and plan(rows).count("intervals_by_match") <= 1
        first = plan(gold.first_purchases(intervals, players, items, seated=True))
        # Only counts by champion and the reference table travel.
        assert "hashpartitioning(match_id" not in first
        stats = gold.matchend_player_stats(intervals, matches, players, items).drop("item_build")
        plain = [silver_table(spark, root, t) for t in ("intervals", "matches", "players")]
        assert stats.exceptAll(gold.matchend_player_stats(*plain, items).drop("item_build")).count() == 0 and stats.count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_spread_ingest_takes_bounded_batches(spark, tmp_path, monkeypatch):
    """Few writing tasks get a bounded micro-batch each time, so their input does not grow with what landed."""
    from arenalake.streaming import ingest as streams

    landing, root = str(tmp_path / "landing"), str(tmp_path / "lake")
    for part in range(5):
        rows = [{"id": f"{part}-{i}", "match_id": "m", "participant_id": "1.0"} for i in range(20)]
        land(landing, "players", rows, f"part{part}")
    monkeypatch.setattr(streams, "SPREAD_BYTES", 1)
    run = streams.ingest(spark, landing, root, "players", partitions=2)
    batches = [p.numInputRows for p in run.recentProgress if p.numInputRows]
    assert batches == [20] * 5
    bronze = tables.read_table(spark, root, "bronze", "players", schemas.bronze_schema("players"))
    assert sorted(r.id for r in bronze.collect()) == sorted(f"{p}-{i}" for p in range(5) for i in range(20))
    assert not [p for p in streams.ingest(spark, landing, root, "players", partitions=2).recentProgress if p.numInputRows]
