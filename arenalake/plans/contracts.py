"""The expectations of every table."""

from __future__ import annotations

from arenalake.operators.quality import DROP, WARN, Expectation

# The rule names, limits and allowed values below decide which rows survive.
_MATCH_ID = Expectation("valid_match_id", "match_id IS NOT NULL", DROP)
_POSITION = Expectation("valid_participant_pos_id", "participant_pos_id BETWEEN 1 AND 10", DROP)
_TEAM = Expectation("valid_team", "team IN ('BLUE', 'RED')", DROP)

EXPECTATIONS: dict[str, list[Expectation]] = {
    "silver.items_ref": [Expectation("valid_item_id", "item_id IS NOT NULL", DROP)],
    "silver.champions_ref": [Expectation("valid_champion_id", "champion_id IS NOT NULL", DROP)],
    "silver.matches": [
        _MATCH_ID,
        Expectation("valid_winning_team", "winning_team IN ('BLUE', 'RED')", DROP),
        Expectation("ok_game_duration", "game_duration BETWEEN 0 AND 10800", WARN),
        Expectation("ok_game_date", "game_date BETWEEN TIMESTAMP '2009-10-27 00:00:00' AND current_timestamp()", WARN),
        # Dots are literal: four numbers separated by dots.
        Expectation("ok_game_version", "game_version RLIKE '^[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+$'", WARN),
    ],
    "silver.players": [
        _MATCH_ID,
        _POSITION,
        _TEAM,
        Expectation("ok_champion_role", "champion_role IN ('TOP', 'JUNGLE', 'MIDDLE', 'BOTTOM', 'SUPPORT')", WARN),
    ],
    "silver.intervals": [
        _MATCH_ID,
        _POSITION,
        _TEAM,
        Expectation("valid_minute", "minute IS NOT NULL", DROP),
        Expectation("ok_interval_of_5", "minute % 5 = 0", WARN),
    ],
    "gold.champion_overviews": [
        Expectation("ok_balance_winrate", "global_win_rate BETWEEN 0.40 AND 0.60", WARN),
        Expectation("ok_balance_banrate", "global_ban_rate <= 0.50", WARN),
        Expectation("ok_balance_pickrate", "global_pick_rate <= 0.20", WARN),
    ],
    "gold.item_recommendations": [
        Expectation("valid_champion_name", "champion_name IS NOT NULL", DROP),
        Expectation("valid_item_name", "item_name IS NOT NULL", DROP),
    ],
}
