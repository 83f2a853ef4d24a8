"""Gold products on small hand-made frames, and against a row-by-row computation."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from arenalake import schemas
from arenalake.plans import gold, silver
from arenalake.plans.contracts import EXPECTATIONS
from arenalake.operators import quality

MATCH = "match_id string, winning_team string, game_duration int, blue_bans array<int>, red_bans array<int>"
PLAYERS = "match_id string, participant_pos_id int, team string, champion_name string, champion_role string"
ITEMS = "item_id int, item_name string, item_category string, __START_AT timestamp, __END_AT timestamp"
CHAMPIONS = "champion_id int, champion_name string, __START_AT timestamp, __END_AT timestamp"


def intervals(spark, rows):
    """Rows of (match, seat, minute, {column: value}); missing counters are 0 and slots NULL."""
    names = schemas.SILVER["intervals"].fieldNames()
    data = []
    for match, seat, minute, values in rows:
        base = {n: (None if n.startswith("item_") else 0) for n in names}
        base |= {"match_id": match, "participant_pos_id": seat, "minute": minute, "team": "BLUE" if seat <= 5 else "RED"}
        data.append(tuple((base | values)[n] for n in names))
    return spark.createDataFrame(data, schemas.SILVER["intervals"])


def items(spark, rows):
    return spark.createDataFrame([(i, n, c, None, None) for i, n, c in rows], ITEMS)


def matches(spark, rows):
    return spark.createDataFrame([r + ([], []) if len(r) == 3 else r for r in rows], MATCH)


def as_dict(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


def test_builds_missing_empty_and_closed_versions(spark):
    rows = intervals(spark, [
        ("m", 1, 5, {"item_0": 1, "item_3": 2, "cs": 3, "jungle_cs": 4}),
        ("m", 2, 5, {"item_0": 99}),
        ("m", 3, 5, {}),
        ("m", 1, 0, {"item_0": 3}),
    ])
    refs = items(spark, [(1, "Sword", "Basic"), (2, "Axe", "Basic")]).unionByName(
        items(spark, [(99, "Gone", "Basic")]).withColumn("__END_AT", F.lit("2024-01-01").cast("timestamp"))
    )
    players = spark.createDataFrame([("m", s, "BLUE", "X", "TOP") for s in (1, 2, 3)], PLAYERS)
    got = as_dict(gold.matchend_player_stats(rows, matches(spark, [("m", "BLUE", 400)]), players, refs), "participant_pos_id")
    assert got[(1,)]["item_build"] == ["Axe", "Sword"] and got[(1,)]["cs"] == 7
    assert got[(2,)]["item_build"] == [] and got[(3,)]["item_build"] is None
    assert got[(1,)]["unlogged_duration"] == 100 and got[(1,)]["win"] is True


def test_unknown_duration_is_not_stale(spark):
    rows = intervals(spark, [("m", 1, 20, {})])
    players = spark.createDataFrame([("m", 1, "RED", "X", "TOP")], PLAYERS)
    refs = items(spark, [(1, "Sword", "Basic")])
    row = gold.matchend_player_stats(rows, matches(spark, [("m", "BLUE", None)]), players, refs).first()
    assert row["unlogged_duration"] == 0 and row["win"] is False


def test_champion_rates(spark):
    facts = matches(spark, [
        ("a", "BLUE", 299, [1, 0], [1]), ("b", "BLUE", 300, [2], None), ("c", "RED", 301, [2, None], [0]),
        ("d", None, None, None, None),
    ])
    players = spark.createDataFrame(
        [("a", 1, "BLUE", "X", "TOP"), ("b", 1, "BLUE", "X", "MIDDLE"), ("c", 1, "BLUE", "X", "TOP"), ("c", 6, "RED", "Y", None),
         ("d", 1, "BLUE", "X", "MIDDLE"), ("z", 1, "BLUE", "X", "TOP"), ("a", 2, "BLUE", "UNKNOWN", "TOP")], PLAYERS)
    champs = spark.createDataFrame(
        [(1, "X", None, None), (2, "Y", None, None), (3, "NEVER", None, None), (0, "NONE", None, None)], CHAMPIONS)
    got = as_dict(gold.champion_overviews(facts, players, champs), "champion_id")
    assert set(got) == {(1,), (2,), (3,)}
    x, y, never = got[(1,)], got[(2,)], got[(3,)]
    assert (x["global_games_played"], x["global_pick_rate"], x["global_win_rate"], x["global_ban_rate"]) == (4, 1.0, 0.5, 0.25)
    # Tie between MIDDLE and TOP goes to the first name.
    assert (x["most_picked_lane"], x["primary_lane_share"]) == ("MIDDLE", 0.5)
    assert (y["global_win_rate"], y["global_ban_rate"], y["most_picked_lane"]) == (1.0, 0.5, None)
    assert (never["global_games_played"], never["global_win_rate"], never["most_picked_lane"]) == (0, None, None)


def test_empty_matches_give_null_rates(spark):
    champs = spark.createDataFrame([(1, "X", None, None)], CHAMPIONS)
    row = gold.champion_overviews(matches(spark, []), spark.createDataFrame([], PLAYERS), champs).first()
    assert row["global_pick_rate"] is None and row["global_games_played"] == 0


def test_copies_multiply_like_plain_joins(spark):
    facts = matches(spark, [("a", "BLUE", 400), ("a", "RED", 400), ("a", "BLUE", 100)])
    players = spark.createDataFrame([("a", 1, "BLUE", "X", "TOP")] * 2, PLAYERS)
    champs = spark.createDataFrame([(1, "X", None, None)], CHAMPIONS)
    row = gold.champion_overviews(facts, players, champs).first()
    assert (row["global_games_played"], row["global_pick_rate"], row["global_win_rate"]) == (6, 2.0, 0.5)


def test_pivot_uses_latest_row_of_each_team(spark):
    facts = matches(spark, [("m", "RED", 1000)]).select(
        "*", F.lit(None).cast("timestamp").alias("game_date"), F.lit("1").alias("game_version"), F.lit("Gold").alias("average_rank"))
    rows = intervals(spark, [
        ("m", 1, 10, {"team_kills": 3, "team_gold_diff": 50}), ("m", 2, 10, {"team_kills": 4, "team_gold_diff": 10}),
        ("m", 6, 15, {"team_kills": 1, "team_gold_diff": -70}), ("m", 7, 5, {"team_kills": 9}),
    ])
    got = gold.matchend_pivot_teamstats(rows, facts).collect()
    assert len(got) == 1
    row = got[0]
    assert (row["blue_kills"], row["red_kills"], row["winning_gold_diff"], row["unlogged_duration"]) == (4, 1, -70, 100)
    assert set(got[0].asDict()) == set(schemas.GOLD["matchend_pivot_teamstats"].fieldNames())


def test_same_item_twice_counts_twice(spark):
    rows = intervals(spark, [("m", 1, 5, {"item_0": 1, "item_1": 1, "item_2": 2, "kills": 4, "deaths": 1, "assists": 1})])
    players = spark.createDataFrame([("m", 1, "BLUE", "X", "TOP")], PLAYERS)
    refs = items(spark, [(1, "A", "Basic"), (2, "B", "Epic")])
    facts = matches(spark, [("m", "BLUE", 400)])
    counted = gold.champion_item_counts(gold.player_states(rows, facts, players))
    assert counted.filter("hi IS NOT NULL").select("lo", "hi", "together").collect() == [(1, 2, 2)]
    got = as_dict(gold.item_recommendations(rows, facts, players, refs), "item_name")
    a, b = got[("A",)], got[("B",)]
    assert (a["player_purchase_rate"], a["win_rate"], a["avg_kda"], a["top_item_1"]) == (2.0, 1.0, 2.5, "B")
    assert b["top_item_1"] is None  # only the same or a higher tier is recommended
    assert a["most_common_first_purchase_minute"] == 5


def brute_recommendations(rows, facts, players, refs):
    """Row-by-row item statistics, built from plain loops."""
    ref = {i: (n, c) for i, n, c in refs}
    tiers = {c: t for t, c in enumerate(["Trinket", "Consumable", "Starter", "Basic", "Boots", "Epic", "Legendary"], 1)}
    last = {}
    for match, seat, minute, values in rows:
        if (match, seat) not in last or minute > last[match, seat][0]:
            last[match, seat] = (minute, values)
    held = lambda values: [values[f"item_{k}"] for k in range(7) if values.get(f"item_{k}") is not None]
    seats = defaultdict(list)
    for match, seat, team, champ, _ in players:
        seats[match, seat].append((team, champ))
    totals, stats, lists = Counter(), defaultdict(list), defaultdict(list)
    for (match, seat), (_, values) in last.items():
        for m, winner, _ in facts:
            for team, champ in seats[match, seat] if m == match else []:
                totals[champ] += 1
                for item in held(values):
                    ratio = (values["kills"] + values["assists"]) / (values["deaths"] + 1)
                    stats[champ, item].append((team == winner, ratio))
                    if item in ref and ref[item][1] in tiers:
                        lists[champ, match, seat].append(item)
    pairs = Counter()
    for (champ, _, _), bag in lists.items():
        for a in bag:
            for b in bag:
                if a != b and tiers[ref[a][1]] <= tiers[ref[b][1]]:
                    pairs[champ, a, b] += 1
    first = {}
    for match, seat, minute, values in rows:
        for item in held(values):
            # NOT IN is not true for a missing category.
            if item in ref and ref[item][1] not in (None, "Other", "Legacy", "Distributed"):
                key = (match, seat, item)
                first[key] = min(minute, first.get(key, minute))
    firsts = defaultdict(Counter)
    for (match, seat, item), minute in first.items():
        for _, champ in seats[match, seat]:
            firsts[champ, item][minute] += 1
    out = set()
    for (champ, item), seen in stats.items():
        if item not in ref:
            continue
        top = sorted(((-n, ref[b][0]) for (c, a, b), n in pairs.items() if (c, a) == (champ, item)))[:3]
        names = [name for _, name in top] + [None] * (3 - len(top))
        counts = firsts.get((champ, item))
        out.add((
            champ, ref[item][0], ref[item][1], round(len(seen) / totals[champ] + 1e-9, 4),
            round(sum(w for w, _ in seen) / len(seen) + 1e-9, 4), round(sum(k for _, k in seen) / len(seen) + 1e-9, 2),
            min(counts, key=lambda m: (-counts[m], m)) if counts else None, *names,
        ))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_recommendations_match_brute_force_with_copies(spark, seed):
    rng = random.Random(seed)
    categories = ["Trinket", "Consumable", "Starter", "Basic", "Boots", "Epic", "Legendary", "Other", None]
    refs = [(i, f"item{i:02d}", categories[i % 9]) for i in range(1, 15)]
    rows, players, facts = [], [], []
    for m in range(12):
        facts += [(f"m{m}", rng.choice(["BLUE", "RED", None]), 400)] * (2 if m == 0 else 1)
        for seat in range(1, 5):
            champ = rng.choice("XYZ")
            # The first match is a hot one: several copies of its player rows.
            players += [(f"m{m}", seat, "BLUE" if seat < 3 else "RED", champ, "TOP")] * (3 if m == 0 else 1)
            for minute in (0, 5, 10):
                values = {f"item_{k}": rng.choice([None] + list(range(1, 17))) for k in range(7)}
                rows.append((f"m{m}", seat, minute, values | {"kills": rng.randrange(9), "deaths": rng.randrange(4), "assists": rng.randrange(9)}))
    got = gold.item_recommendations(
        intervals(spark, rows), matches(spark, facts), spark.createDataFrame(players, PLAYERS), items(spark, refs))
    assert {tuple(r) for r in got.collect()} == brute_recommendations(rows, facts, players, refs)


def test_two_ids_with_one_name_give_two_rows(spark):
    rows = intervals(spark, [("m", 1, 5, {"item_0": 1, "item_1": 2})])
    players = spark.createDataFrame([("m", 1, "BLUE", "X", "TOP")], PLAYERS)
    refs = items(spark, [(1, "Twin", "Basic"), (2, "Twin", "Basic")])
    got = gold.item_recommendations(rows, matches(spark, [("m", "BLUE", 400)]), players, refs)
    assert quality.duplicate_keys(got, schemas.KEYS["gold.item_recommendations"]).collect()[0]["cnt"] == 2


def test_trace_back_cleans_raw_keys(spark):
    players = spark.createDataFrame(
        [("M1", 1, "BLUE", "GHOST", "TOP"), ("M1", 2, "BLUE", None, "TOP"), ("M1", 3, "BLUE", "X", "TOP")], PLAYERS)
    champs = spark.createDataFrame([(1, "X", None, None), (2, "GHOST", None, None)], CHAMPIONS).withColumn(
        "__END_AT", F.when(F.col("champion_id") == 2, F.lit("2024-01-01").cast("timestamp")))
    raw = spark.createDataFrame(
        [("1", "m1", "1.0", "100", "ghost", "top", "x", None, "f1", "r"), ("2", "m1", "2", "100", None, "top", "x", None, "f2", "r"),
         ("3", "m1", "bad", "100", "x", "top", "x", None, "f3", "r")], schemas.bronze_schema("players"))
    got = gold.noref_champion_name(players, champs, raw)
    assert sorted((r[0] or "", r[2]) for r in got.collect()) == [("", "f2"), ("GHOST", "f1")]


def test_interval_cleaning_rules(spark):
    names = schemas.RAW_COLUMNS["intervals"]
    row = lambda **values: tuple(({n: "1" for n in names} | values)[n] for n in names)
    raw = spark.createDataFrame(
        [row(player_id="3210", minute="7", item_3="0"), row(player_id="0"), row(player_id="-5"), row(minute="x"), row(match_id=None)],
        schemas.raw_schema("intervals"))
    kept = quality.keep_valid(silver.clean_intervals(raw), EXPECTATIONS["silver.intervals"]).collect()
    assert len(kept) == 1
    assert (kept[0]["participant_pos_id"], kept[0]["team"], kept[0]["minute"], kept[0]["item_3"]) == (10, "RED", 7, None)
    counts = {r["rule"]: r["violations"] for r in quality.audit(silver.clean_intervals(raw), EXPECTATIONS["silver.intervals"]).collect()}
    assert counts["ok_interval_of_5"] == 5 and counts["valid_minute"] == 1


def test_match_cleaning_rules(spark):
    names = schemas.RAW_COLUMNS["matches"]
    row = lambda **values: tuple(({n: None for n in names} | {"match_id": "m", "winning_team": "100"} | values)[n] for n in names)
    raw = spark.createDataFrame(
        [row(game_version="14.1.2.3", game_duration="1800.5", game_date="2024-05-01 10:00:00", average_rank="gold IV"),
         row(game_version="1a2b3c4", game_date="soon"), row(winning_team="300")], schemas.raw_schema("matches"))
    clean = silver.clean_matches(raw)
    kept = quality.keep_valid(clean, EXPECTATIONS["silver.matches"]).collect()
    assert [r["winning_team"] for r in kept] == ["BLUE", "BLUE"]
    assert (kept[0]["match_id"], kept[0]["game_duration"], kept[0]["average_rank"]) == ("M", 1801, "Gold Iv")
    counts = {r["rule"]: r["violations"] for r in quality.audit(clean, EXPECTATIONS["silver.matches"]).collect()}
    assert counts["ok_game_version"] == 2 and counts["ok_game_date"] == 2 and counts["valid_winning_team"] == 1
