"""Column contracts of the bronze, silver and gold tables.

Bronze source columns are all strings so that ingest cannot fail on a type; silver and gold
are typed. Descriptions travel as field metadata, which Parquet keeps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names and order of the raw CSV files.
RAW_COLUMNS: dict[str, list[str]] = {
    "items_ref": ["item_id", "item_name", "item_category"],
    "champions_ref": ["champion_id", "champion_name"],
    "matches": [
        "match_id", "game_duration", "patch_version", "winning_team", "game_date", "game_version",
        "game_mode", "queue_id", "region", "average_rank", "blue_bans", "red_bans",
    ],
    "players": ["id", "match_id", "participant_id", "team_id", "champion", "role", "individual_position"],
    "intervals": [
        "id", "match_id", "player_id", "minute", "current_gold", "total_gold", "cs", "jungle_cs", "xp", "level",
        "kills", "deaths", "assists", "item_0", "item_1", "item_2", "item_3", "item_4", "item_5", "item_6",
        "team_kills", "team_inhibitors", "team_towers", "team_dragons_fire", "team_dragons_water",
        "team_dragons_earth", "team_dragons_air", "team_dragons_chemtech", "team_dragons_hextech", "team_dragons",
        "team_barons", "team_void_grubs", "team_heralds", "gold_diff", "xp_diff", "team_gold_diff",
    ],
}

# Landing sub-folder of each source.
RAW_FOLDERS = {
    "items_ref": "items",
    "champions_ref": "champions",
    "matches": "matches",
    "players": "players",
    "intervals": "intervals",
}

AUDIT_COLUMNS = ["ldts", "file_name", "rsrc"]

ITEM_SLOTS = [f"item_{slot}" for slot in range(7)]

# Plain integer measures of an interval row, in published order, around the item slots.
PLAYER_MEASURES = ["current_gold", "total_gold", "cs", "jungle_cs", "xp", "level", "kills", "deaths", "assists"]
PLAYER_DIFFS = ["gold_diff", "xp_diff"]
TEAM_MEASURES = [
    "team_kills", "team_inhibitors", "team_towers", "team_dragons_fire", "team_dragons_water", "team_dragons_earth",
    "team_dragons_air", "team_dragons_chemtech", "team_dragons_hextech", "team_dragons", "team_barons",
    "team_void_grubs", "team_heralds", "team_gold_diff",
]


def raw_schema(table: str) -> T.StructType:
    """All-string read schema of one raw source."""
    return T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS[table]])


def bronze_schema(table: str) -> T.StructType:
    """Raw columns plus load time, file and record source."""
    audit = [
        T.StructField("ldts", T.TimestampType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("rsrc", T.StringType()),
    ]
    return T.StructType(raw_schema(table).fields + audit)


def _field(name: str, dtype: T.DataType, note: str | None = None) -> T.StructField:
    return T.StructField(name, dtype, True, {"comment": note} if note else {})


_INT, _STR, _DBL, _TS = T.IntegerType(), T.StringType(), T.DoubleType(), T.TimestampType()
_VERSION = [
    _field("__START_AT", _TS, "When this version took effect."),
    _field("__END_AT", _TS, "When a newer version replaced it; NULL while current."),
]
_POSITION = _field("participant_pos_id", _INT, "Seat in the lobby: 1-5 blue, 6-10 red.")

SILVER: dict[str, T.StructType] = {
    "items_ref": T.StructType(
        [_field("item_id", _INT), _field("item_name", _STR, "Item name in this version."),
         _field("item_category", _STR, "Item category in this version.")] + _VERSION
    ),
    "champions_ref": T.StructType(
        [_field("champion_id", _INT), _field("champion_name", _STR, "Upper-case name in this version.")] + _VERSION
    ),
    "matches": T.StructType([
        _field("match_id", _STR),
        _field("winning_team", _STR, "BLUE or RED."),
        _field("game_duration", _INT, "Seconds."),
        _field("game_date", _TS, "End of the match."),
        _field("game_version", _STR, "Four-part client version."),
        _field("average_rank", _STR, "Average rank, title case."),
        _field("blue_bans", T.ArrayType(_INT), "Champion ids banned by blue, in order."),
        _field("red_bans", T.ArrayType(_INT), "Champion ids banned by red, in order."),
    ]),
    "players": T.StructType([
        _field("match_id", _STR), _POSITION, _field("team", _STR, "BLUE or RED."),
        _field("champion_name", _STR, "Upper-case name as logged."),
        _field("champion_role", _STR, "Role played."),
    ]),
    "intervals": T.StructType(
        [_field("match_id", _STR), _POSITION, _field("team", _STR, "BLUE or RED."),
         _field("minute", _INT, "Snapshot minute, every five minutes.")]
        + [_field(name, _INT) for name in PLAYER_MEASURES]
        + [_field(name, _INT, "Item held in this slot; NULL when empty.") for name in ITEM_SLOTS]
        + [_field(name, _INT, "Lead over the lane opponent.") for name in PLAYER_DIFFS]
        + [_field(name, _INT, "Team counter, repeated on every player of the team.") for name in TEAM_MEASURES]
    ),
}

# Team counters published by the match pivot: published suffix -> interval column.
PIVOT_MEASURES = {
    "kills": "team_kills",
    "towers": "team_towers",
    "inhibitors": "team_inhibitors",
    "dragons": "team_dragons",
    "void_grubs": "team_void_grubs",
    "heralds": "team_heralds",
    "barons": "team_barons",
}

GOLD: dict[str, T.StructType] = {
    "matchend_player_stats": T.StructType([
        _field("match_id", _STR), _POSITION, _field("game_duration", _INT, "Seconds."), _field("team", _STR),
        _field("win", T.BooleanType(), "Whether the player's team won."), _field("champion_name", _STR),
        _field("champion_role", _STR)]
        + [_field(name, _INT, "At the last logged snapshot.")
           for name in ["level", "kills", "deaths", "assists", "cs", "total_gold"]]
        + [_field("item_build", T.ArrayType(_STR), "Sorted item names at the last snapshot."),
           _field("unlogged_duration", _INT, "Seconds between last snapshot and match end.")]
    ),
    "champion_overviews": T.StructType([
        _field("champion_id", _INT), _field("champion_name", _STR),
        _field("most_picked_lane", _STR, "Most frequent role."),
        _field("primary_lane_share", _DBL, "Share of picks in that role."),
        _field("global_games_played", _INT, "Picks over all matches."),
        _field("global_pick_rate", _DBL, "Picks per match."),
        _field("global_win_rate", _DBL, "Wins per game that was not a remake."),
        _field("global_ban_rate", _DBL, "Share of matches with a ban."),
    ]),
    "matchend_pivot_teamstats": T.StructType(
        [_field("match_id", _STR), _field("game_duration", _INT, "Seconds."),
         _field("game_date", _TS, "End of the match."), _field("game_version", _STR, "Client version."),
         _field("winning_team", _STR, "BLUE or RED."), _field("average_rank", _STR, "Title case.")]
        + [_field(f"{side}_{name}", _INT, "At the team's last snapshot.")
           for name in PIVOT_MEASURES for side in ("blue", "red")]
        + [_field("winning_gold_diff", _INT, "Gold lead of the winner; negative if behind."),
           _field("unlogged_duration", _INT, "Seconds between last snapshot and match end.")]
    ),
    "item_recommendations": T.StructType([
        _field("champion_name", _STR), _field("item_name", _STR), _field("item_category", _STR),
        _field("player_purchase_rate", _DBL, "Item copies per player of the champion."),
        _field("win_rate", _DBL), _field("avg_kda", _DBL),
        _field("most_common_first_purchase_minute", _INT),
        _field("top_item_1", _STR), _field("top_item_2", _STR), _field("top_item_3", _STR),
    ]),
    "diff_intervals": T.StructType([
        _field("match_id", _STR), _POSITION, _field("minute", _INT), _field("team", _STR),
        _field("champion_role", _STR), _field("champion_name", _STR), _field("gold_diff", _INT),
        _field("xp_diff", _INT),
    ]),
    "noref_champion_name": T.StructType([
        _field("noref_src_champion_name", _STR, "Name without a current reference row."),
        _field("ldts", _TS), _field("file_name", _STR), _field("rsrc", _STR),
    ]),
}

# Declared keys, checked by the duplicate-key report.
KEYS: dict[str, list[str]] = {
    "bronze.items_ref": ["item_id"],
    "bronze.champions_ref": ["champion_id"],
    "bronze.matches": ["match_id"],
    "bronze.players": ["id"],
    "bronze.intervals": ["id"],
    "silver.items_ref": ["item_id", "__START_AT"],
    "silver.champions_ref": ["champion_id", "__START_AT"],
    "silver.matches": ["match_id"],
    "silver.players": ["match_id", "participant_pos_id"],
    "silver.intervals": ["match_id", "participant_pos_id", "minute"],
    "gold.matchend_player_stats": ["match_id", "participant_pos_id"],
    "gold.champion_overviews": ["champion_id"],
    "gold.matchend_pivot_teamstats": ["match_id"],
    "gold.item_recommendations": ["champion_name", "item_name"],
    "gold.diff_intervals": ["match_id", "participant_pos_id", "minute"],
}

# Columns each table is clustered by on disk.
CLUSTER_BY: dict[str, list[str]] = {
    "silver.matches": ["match_id"],
    "silver.players": ["match_id", "participant_pos_id"],
    "silver.intervals": ["match_id", "participant_pos_id", "minute"],
    "gold.matchend_player_stats": ["match_id", "participant_pos_id"],
    "gold.matchend_pivot_teamstats": ["match_id"],
    "gold.diff_intervals": ["match_id", "participant_pos_id", "minute"],
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select `schema`'s columns in order, cast to its types, carrying its comments."""
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema.fields]
    )
