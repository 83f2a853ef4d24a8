"""Cleaning steps from raw strings to typed rows.

Every step is stateless and row-local, so the same function serves a batch frame and a stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenalake import schemas
from arenalake.functions import scalars as S


def clean_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        S.safecast_to_int("item_id").alias("item_id"),
        F.initcap("item_name").alias("item_name"),
        F.initcap("item_category").alias("item_category"),
        "ldts",
    )


def clean_champions(raw: DataFrame) -> DataFrame:
    return raw.select(
        S.safecast_to_int("champion_id").alias("champion_id"),
        F.upper("champion_name").alias("champion_name"),
        "ldts",
    )


def clean_matches(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.upper("match_id").alias("match_id"),
        S.team_from_code("winning_team").alias("winning_team"),
        S.safecast_to_int("game_duration").alias("game_duration"),
        F.col("game_date").try_cast("timestamp").alias("game_date"),
        "game_version",
        F.initcap("average_rank").alias("average_rank"),
        S.ban_list("blue_bans").alias("blue_bans"),
        S.ban_list("red_bans").alias("red_bans"),
    )


def player_keys(raw: DataFrame) -> DataFrame:
    """Raw player rows with cleaned keys added; used by cleaning and by lineage trace-back."""
    seat = S.valid_num_range(S.safecast_to_int("participant_id"), 1, 10).cast("int")
    return raw.withColumns({"match_id": F.upper("match_id"), "participant_pos_id": seat})


def clean_players(raw: DataFrame) -> DataFrame:
    return player_keys(raw).select(
        "match_id",
        "participant_pos_id",
        S.team_from_code("team_id").alias("team"),
        F.upper("champion").alias("champion_name"),
        S.normalise_role("role").alias("champion_role"),
    )


def clean_intervals(raw: DataFrame) -> DataFrame:
    numbers = ["minute"] + schemas.PLAYER_MEASURES + schemas.PLAYER_DIFFS + schemas.TEAM_MEASURES
    typed = raw.select(
        F.upper("match_id").alias("match_id"),
        S.cyclic_position(S.safecast_to_int("player_id")).alias("participant_pos_id"),
        *[S.safecast_to_int(name).alias(name) for name in numbers],
        # Slot value 0 means an empty slot.
        *[F.nullif(S.safecast_to_int(slot), F.lit(0)).alias(slot) for slot in schemas.ITEM_SLOTS],
    )
    return typed.withColumn("team", S.team_from_position("participant_pos_id")).select(
        *schemas.SILVER["intervals"].fieldNames()
    )


CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "items_ref": clean_items,
    "champions_ref": clean_champions,
    "matches": clean_matches,
    "players": clean_players,
    "intervals": clean_intervals,
}

# Reference tables kept as type 2 history: key and tracked columns; `ldts` orders the changes.
HISTORIES: dict[str, tuple[str, list[str]]] = {
    "items_ref": ("item_id", ["item_name", "item_category"]),
    "champions_ref": ("champion_id", ["champion_name"]),
}
