"""The gold tables as DataFrame functions over silver frames.

Shared ideas: keep one candidate row per key on the map side, aggregate on integer ids and
resolve names last, and weight rows by how often they repeat instead of multiplying copies.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arenalake.functions import scalars as S
from arenalake.operators.joins import current, lookup, trace_back, unresolved
from arenalake.operators.quality import keep_valid
from arenalake.operators.ranking import (
    distinct_members, mode_by, ranks_to_columns, top_k,
)
from arenalake.operators.snapshots import last_per_side, last_snapshot
from arenalake.plans.contracts import EXPECTATIONS
from arenalake.plans.silver import player_keys
from arenalake.schemas import ITEM_SLOTS, PIVOT_MEASURES
from arenalake.workspace import written

PLAYER = ["match_id", "participant_pos_id"]
SIDES = ["BLUE", "RED"]

# Categories left out of first-purchase statistics, and the remake limit in seconds.
NO_FIRST_PURCHASE = ["Other", "Legacy", "Distributed"]
REMAKE_SECONDS = 300

# Players of one champion that one task counts; and the bits of an item id (never negative) in a cell.
CHAMPION_ROWS = 1_000_000
_ITEM_BITS = 31

# Player columns a match-end snapshot carries besides key and minute. They also settle ties,
# in this order, when two rows share the last minute.
_SNAPSHOT = ["level", "kills", "deaths", "assists", "cs", "jungle_cs", "total_gold"] + ITEM_SLOTS


def final_snapshot(intervals: DataFrame) -> DataFrame:
    """Last logged row of every player in every match."""
    return last_snapshot(intervals, PLAYER, "minute", _SNAPSHOT)


def held_by(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per filled slot; empty slots leave the array before it is exploded."""
    return rows.select(*keys, F.explode(F.array_compact(F.array(*ITEM_SLOTS))).alias("item_id"))


def named_builds(snapshot: DataFrame, items: DataFrame) -> DataFrame:
    """Snapshot with `item_build`, the sorted names of its resolved items.

    A player without items gets NULL, one with only unresolved items an empty array. Only filled slots
    go through the lookup, so no NULL ids meet in one task; the names come back by player, by which
    the snapshot is partitioned already.
    """
    builds = (
        lookup(held_by(snapshot, PLAYER), items.drop("item_category"), "item_id")
        .groupBy(*PLAYER).agg(F.sort_array(F.collect_list("item_name")).alias("item_build"))
    )
    return player_measures(snapshot).join(builds, PLAYER, "left")


def player_measures(snapshot: DataFrame) -> DataFrame:
    """The snapshot's measures without its items."""
    cs = (F.col("cs") + F.col("jungle_cs")).alias("cs")
    return snapshot.select(*PLAYER, "minute", "level", "kills", "deaths", "assists", cs, "total_gold")


def tiered_builds(snapshot: DataFrame, items: DataFrame) -> DataFrame:
    """Per player, the ranked items held as `(tier, id)` in that order; at most one per slot."""
    ranked = current(items).select("item_id", S.tier_rank("item_category").alias("tier")).filter("tier IS NOT NULL")
    return (
        held_by(snapshot, PLAYER)
        .join(ranked, "item_id")
        .groupBy(*PLAYER)
        .agg(F.array_sort(F.collect_list(F.struct("tier", F.col("item_id").alias("id")))).alias("items"))
    )


def matchend_player_stats(
    intervals: DataFrame, matches: DataFrame, players: DataFrame, items: DataFrame, with_build: bool = True
) -> DataFrame:
    """One row per player and match at the last logged snapshot; without `item_build` no slot is exploded."""
    snapshot = final_snapshot(intervals)
    ends = named_builds(snapshot, items) if with_build else player_measures(snapshot)
    context = players.select(*PLAYER, "team", "champion_name", "champion_role").join(
        matches.select("match_id", "winning_team", "game_duration"), "match_id"
    )
    return context.join(ends, PLAYER).select(
        *PLAYER,
        "game_duration",
        "team",
        (F.col("team") == F.col("winning_team")).alias("win"),
        "champion_name",
        "champion_role",
        "level", "kills", "deaths", "assists", "cs", "total_gold",
        *(["item_build"] if with_build else []),
        S.unlogged_duration(F.col("game_duration"), F.col("minute")).alias("unlogged_duration"),
    )


def match_tallies(matches: DataFrame, remake_seconds: int = REMAKE_SECONDS) -> DataFrame:
    """One row per match id: how often it occurs, is no remake, and is won by each side.

    Copies of a match collapse on the map side, so later joins stay linear in the players.
    """
    eligible = F.col("game_duration") >= remake_seconds
    decided = F.col("winning_team").isNotNull()
    won_by = lambda side: F.col("winning_team") == side
    return matches.groupBy("match_id").agg(
        F.count(F.lit(1)).alias("copies"),
        *[F.count_if(won_by(side)).alias(f"won_{side.lower()}") for side in SIDES],
        F.count_if(eligible & decided).alias("eligible"),
        *[F.count_if(eligible & won_by(side)).alias(f"eligible_{side.lower()}") for side in SIDES],
    )


def _for_team(prefix: str) -> Column:
    """Count of the row's own side."""
    return F.when(F.col("team") == "BLUE", F.col(f"{prefix}_blue")).when(
        F.col("team") == "RED", F.col(f"{prefix}_red")
    )


def player_tallies(players: DataFrame, keys: list[str]) -> DataFrame:
    """Players per key; bounds every match to its distinct key values before any join."""
    return players.groupBy(*keys).agg(F.count(F.lit(1)).alias("seats"))


def champion_overviews(matches: DataFrame, players: DataFrame, champions: DataFrame) -> DataFrame:
    """Pick, win and ban rates and the primary lane of every current champion.

    One join and one aggregate by (champion, role) feed picks, wins and lanes; everything
    after that is the size of the reference table.
    """
    known_team = F.col("team").isNotNull()
    by_role = (
        players.select("match_id", "champion_name", "champion_role", "team").join(match_tallies(matches), "match_id")
        .groupBy("champion_name", "champion_role")
        .agg(
            F.sum("copies").alias("cnt"),
            F.sum(F.when(known_team, F.col("eligible"))).alias("eligible"),
            F.sum(_for_team("eligible")).alias("wins"),
        )
    )
    played = mode_by(
        by_role, ["champion_name"], "champion_role",
        extra=[F.sum("cnt").alias("games"), F.sum("eligible").alias("eligible"), F.sum("wins").alias("wins")],
    )
    bans = (
        distinct_members(matches, "match_id", ["blue_bans", "red_bans"], "champion_id")
        .filter("champion_id != 0")
        .groupBy("champion_id")
        .agg(F.count(F.lit(1)).alias("games_banned"))
    )
    total = matches.agg(F.count(F.lit(1)).alias("n")).scalar()
    games = F.coalesce(F.col("games"), F.lit(0))
    return (
        current(champions)
        .filter("champion_id != 0")
        .select("champion_id", "champion_name")
        .join(played, "champion_name", "left")
        .join(bans, "champion_id", "left")
        .select(
            "champion_id",
            "champion_name",
            F.col("champion_role").alias("most_picked_lane"),
            F.col("share").alias("primary_lane_share"),
            games.cast("int").alias("global_games_played"),
            S.rate(games, total).alias("global_pick_rate"),
            S.rate(F.col("wins"), F.col("eligible")).alias("global_win_rate"),
            S.rate(F.coalesce(F.col("games_banned"), F.lit(0)), total).alias("global_ban_rate"),
        )
    )


def matchend_pivot_teamstats(intervals: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per match with both teams' last counters side by side."""
    counters = list(PIVOT_MEASURES.values()) + ["team_gold_diff"]
    ends = last_per_side(intervals, "match_id", "team", SIDES, "minute", counters)
    facts = matches.select(
        "match_id", "game_duration", "game_date", "game_version", "winning_team", "average_rank"
    )
    cells = [
        F.col(f"{side.lower()}.{source}").alias(f"{side.lower()}_{name}")
        for name, source in PIVOT_MEASURES.items()
        for side in SIDES
    ]
    lead = F.when(F.col("winning_team") == "BLUE", F.col("blue.team_gold_diff")).when(
        F.col("winning_team") == "RED", F.col("red.team_gold_diff")
    )
    return facts.join(ends, "match_id").select(
        "match_id", "game_duration", "game_date", "game_version", "winning_team", "average_rank",
        *cells,
        lead.alias("winning_gold_diff"),
        S.unlogged_duration(F.col("game_duration"), F.col("last_minute")).alias("unlogged_duration"),
    )


def diff_intervals(intervals: DataFrame, players: DataFrame) -> DataFrame:
    """Gold and experience differences of every snapshot with the player's identity."""
    states = intervals.select(*PLAYER, "minute", "gold_diff", "xp_diff")
    identity = players.select(*PLAYER, "team", "champion_role", "champion_name")
    return states.join(identity, PLAYER).select(
        *PLAYER, "minute", "team", "champion_role", "champion_name", "gold_diff", "xp_diff"
    )


def noref_champion_name(players: DataFrame, champions: DataFrame, raw_players: DataFrame) -> DataFrame:
    """Player rows whose champion has no current reference row, with their raw-layer origin."""
    raw = player_keys(raw_players).select(*PLAYER, "ldts", "file_name", "rsrc")
    missing = unresolved(players.select(*PLAYER, "champion_name"), current(champions), "champion_name")
    return trace_back(missing, raw, PLAYER).select(
        F.col("champion_name").alias("noref_src_champion_name"), "ldts", "file_name", "rsrc"
    )


def player_states(intervals: DataFrame, matches: DataFrame, players: DataFrame) -> DataFrame:
    """One row per seat and champion: how often it counts (`picks`, `wins`) and its last snapshot's score and items."""
    seats = player_tallies(players, PLAYER + ["champion_name", "team"])
    picks = (
        seats.join(match_tallies(matches), "match_id")
        .groupBy(*PLAYER, "champion_name")
        .agg(
            F.sum(F.col("seats") * F.col("copies")).alias("picks"),
            F.sum(F.col("seats") * F.coalesce(_for_team("won"), F.lit(0))).alias("wins"),
        )
    )
    ends = final_snapshot(intervals).select(
        *PLAYER, (F.col("kills") + F.col("assists")).alias("points"), (F.col("deaths") + 1).alias("lives"), *ITEM_SLOTS
    )
    return picks.join(ends, PLAYER).drop(*PLAYER)


def champion_item_counts(states: DataFrame, task_rows: int = CHAMPION_ROWS) -> DataFrame:
    """Final builds counted per (champion, lo, hi, lives) in one pass.

    `hi` NULL: one item; both NULL: the player; otherwise an unordered pair of items held
    together. A build repeated by duplicate player rows counts once per copy for items and
    once per pair of copies for pairs. `lives` (deaths + 1) splits the single items so that the
    average KDA comes from whole-number sums, the same in whatever order rows arrive.

    A player makes up to 29 cells. Players of one champion go to one task before their cells are made, so the cells
    never travel. A champion with more than `task_rows` players is left where it is: there a task has many players
    of few champions, and adding up its cells before they travel is what shrinks them.
    """
    per_champion = states.groupBy("champion_name").agg(F.count(F.lit(1)).alias("n"))
    frequent = written(per_champion.filter(F.col("n") > task_rows).select(F.col("champion_name").alias("of")), "frequent")
    is_it = F.col("champion_name").eqNullSafe(F.col("of"))
    few = states.join(frequent, is_it, "left_anti").repartition("champion_name")
    many = states.join(frequent, is_it, "left_semi")
    return _cell_counts(few).union(_cell_counts(many))


def _cell_counts(states: DataFrame) -> DataFrame:
    """Cells are whole numbers: -1 the player, an item its id, a pair the smaller id + 1 beside the larger one.

    Two explodes of short arrays, for 29 columns side by side make a method too long to be compiled: `own` is
    the player and its items in order, `hi` what stands behind one of them, and NULL for itself. Players of a
    champion lie together, so that the sums being added to are few at a time.
    """
    items = F.sort_array(F.array_compact(F.array(*ITEM_SLOTS)))
    measures = ["champion_name", "picks", "wins", "points", "lives"]
    players = states.sortWithinPartitions("champion_name").select(*measures, F.concat(F.array(F.lit(-1)), items).alias("own"))
    rest = F.slice("own", F.col("i") + 2, F.size("own") - F.col("i") - 1)
    behind = F.when(F.col("i") == 0, F.array(F.lit(None).cast("int"))).otherwise(F.concat(F.array(F.lit(None).cast("int")), rest))
    cells = players.select(*measures, "own", F.posexplode("own").alias("i", "lo")).select(*measures, "lo", F.explode(behind).alias("hi"))
    pair = F.shiftleft(F.col("lo").cast("long") + 1, _ITEM_BITS).bitwiseOR(F.col("hi").cast("long"))
    cell = F.when(F.col("hi").isNull(), F.col("lo").cast("long")).otherwise(pair)
    is_single = (F.col("cell") >= 0) & (F.col("cell") < F.lit(1 << _ITEM_BITS))
    scored = F.col("points").isNotNull() & (F.col("lives") != 0)
    first, second = F.shiftright("cell", _ITEM_BITS), F.col("cell").bitwiseAND(F.lit((1 << _ITEM_BITS) - 1))
    counted = (
        cells.filter("hi IS NULL OR lo <> hi").select(*measures, cell.alias("cell"))
        .groupBy("champion_name", "cell", F.when(is_single, F.col("lives")).alias("lives"))
        .agg(
            F.sum("picks").alias("picks"),
            F.sum(F.col("picks") * F.col("picks")).alias("together"),
            F.sum("wins").alias("wins"),
            F.sum(F.col("points") * F.col("picks")).alias("points"),
            F.sum(F.when(scored, F.col("picks"))).alias("scored"),
        )
    )
    return counted.select(
        "champion_name",
        F.when(first > 0, first - 1).when(first == 0, second).cast("int").alias("lo"),
        F.when(first > 0, second).cast("int").alias("hi"),
        "lives", "picks", "together", "wins", "points", "scored",
    )


def item_totals(counted: DataFrame) -> DataFrame:
    """Per (champion, item): copies held, wins, average KDA, and the champion's players."""
    everyone = F.max(F.when(F.col("lo").isNull(), F.col("players"))).over(Window.partitionBy("champion_name"))
    kda = F.try_divide(F.col("points").cast("decimal(20,0)"), F.col("lives").cast("decimal(12,0)"))
    mean_kda = F.try_divide(F.sum(kda).cast("double"), F.sum("scored"))
    return (
        counted.filter("hi IS NULL")
        .groupBy("champion_name", "lo")
        .agg(
            F.sum("picks").alias("players"),
            F.sum("wins").alias("wins"),
            # The inner rounding clears binary noise below the 13 exact decimals.
            F.round(F.round(mean_kda, 12), 2).alias("avg_kda"),
        )
        .withColumn("everyone", everyone)
        .filter("lo IS NOT NULL")
        .select(
            "champion_name",
            F.col("lo").alias("item_id"),
            S.rate(F.col("players"), F.col("everyone")).alias("player_purchase_rate"),
            S.rate(F.col("wins"), F.col("players")).alias("win_rate"),
            "avg_kda",
        )
    )


def co_purchases(counted: DataFrame, items: DataFrame, k: int = 3) -> DataFrame:
    """Top k items held together with an item, only of the same or a higher tier."""
    ranked_items = current(items).select(
        "item_id", "item_name", S.tier_rank("item_category").alias("tier")
    ).filter("tier IS NOT NULL")
    both_ways = counted.filter("hi IS NOT NULL").select(
        "champion_name",
        "together",
        F.explode(F.array(
            F.struct(F.col("lo").alias("item_id"), F.col("hi").alias("co_item_id")),
            F.struct(F.col("hi").alias("item_id"), F.col("lo").alias("co_item_id")),
        )).alias("pair"),
    ).select("champion_name", "pair.*", "together")
    allowed = (
        both_ways
        .join(ranked_items.select("item_id", F.col("tier").alias("own_tier")), "item_id")
        .join(
            ranked_items.select(
                F.col("item_id").alias("co_item_id"), F.col("item_name").alias("co_item"), "tier"
            ),
            "co_item_id",
        )
        .filter("own_tier <= tier")
    )
    keys = ["champion_name", "item_id"]
    best = top_k(allowed, keys, [F.desc("together"), F.asc("co_item")], k)
    return ranks_to_columns(best, keys, "co_item", k, "top_item_")


def first_purchases(intervals: DataFrame, players: DataFrame, items: DataFrame, seated: bool = False) -> DataFrame:
    """Most common first minute of each (champion, item). `seated`: the frames are laid out by seat or match already."""
    # Repeats within a row leave before the explode; the minimum is taken on the map side.
    slots = F.array_distinct(F.array_compact(F.array(*ITEM_SLOTS)))
    # Snapshots go to their seat before slots are laid out; grouping by item and the join with the seat stay there.
    held = intervals.select(*PLAYER, "minute", slots.alias("slots"))
    held = held if seated else held.repartition(*PLAYER)
    first_seen = (
        held.select(*PLAYER, "minute", F.explode("slots").alias("item_id"))
        .groupBy(*PLAYER, "item_id")
        .agg(F.min("minute").alias("minute"))
    )
    seats = player_tallies(players, PLAYER + ["champion_name"])
    counted = (
        first_seen.join(seats, PLAYER)
        .groupBy("champion_name", "item_id", "minute")
        .agg(F.sum("seats").alias("cnt"))
    )
    # NOT IN also leaves out items without a category.
    tracked = current(items).filter(~F.col("item_category").isin(*NO_FIRST_PURCHASE)).select("item_id")
    return mode_by(counted.join(tracked, "item_id", "left_semi"), ["champion_name", "item_id"], "minute").select(
        "champion_name", "item_id", F.col("minute").alias("most_common_first_purchase_minute")
    )


def unchecked_recommendations(
    intervals: DataFrame, matches: DataFrame, players: DataFrame, items: DataFrame, seated: bool = False
) -> DataFrame:
    """Item statistics and companions per champion, before the table's rules are applied."""
    states = written(player_states(intervals, matches, players), "player-states")
    # Read twice below, so written once; its size follows champions x items, not the telemetry.
    counted = written(champion_item_counts(states), "item-counts")
    keys = ["champion_name", "item_id"]
    return (
        item_totals(counted)
        .join(current(items).select("item_id", "item_name", "item_category"), "item_id")
        .join(co_purchases(counted, items), keys, "left")
        .join(first_purchases(intervals, players, items, seated), keys, "left")
        .select(
            "champion_name", "item_name", "item_category", "player_purchase_rate", "win_rate", "avg_kda",
            "most_common_first_purchase_minute", "top_item_1", "top_item_2", "top_item_3",
        )
    )


def item_recommendations(
    intervals: DataFrame, matches: DataFrame, players: DataFrame, items: DataFrame
) -> DataFrame:
    """Recommendations that satisfy the table's rules."""
    return keep_valid(
        unchecked_recommendations(intervals, matches, players, items), EXPECTATIONS["gold.item_recommendations"]
    )
