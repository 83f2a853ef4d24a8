"""Match-shaped silver frames derived from the supplied order tables.

Whole tables are used: orders become matches, order lines become players and snapshots, part
sizes become items and suppliers become champions. Some items and champion names fall outside
the reference tables on purpose, and order lines repeat keys, so the unresolved and duplicate
cases occur. `SQL` holds the same definitions for the comparison engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arenalake.functions import scalars as S
from arenalake.schemas import ITEM_SLOTS, RAW_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _match_id(order_key: str):
    return F.concat(F.lit("PX_"), F.col(order_key).cast("string"))


def px_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    as_int = lambda c: c.cast("int")
    return table(spark, sf_dir, "orders").select(
        _match_id("o_orderkey").alias("match_id"),
        S.code_map("o_orderstatus", {"F": "BLUE", "O": "RED"}).alias("winning_team"),
        as_int(F.floor(F.col("o_totalprice") / 100)).alias("game_duration"),
        F.col("o_orderdate").alias("game_date"),
        F.concat((key % 15).cast("string"), F.lit(".1.2.3")).alias("game_version"),
        F.col("o_orderpriority").alias("average_rank"),
        F.array(as_int(key * 7 % 100), as_int((key * 11 + 3) % 100), F.lit(0)).alias("blue_bans"),
        F.array(as_int((key * 13 + 5) % 100), as_int(key * 7 % 100), F.lit(None).cast("int")).alias("red_bans"),
    )


def px_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    seats = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_suppkey").alias("supp")
    )
    # The last seat names champions beyond the reference table.
    number = F.col("supp") + F.when(F.col("l_linenumber") == 7, 10).otherwise(0)
    return seats.select(
        _match_id("l_orderkey").alias("match_id"),
        F.col("l_linenumber").alias("participant_pos_id"),
        F.when(F.col("l_linenumber") <= 3, "BLUE").otherwise("RED").alias("team"),
        F.concat(F.lit("SUPPLIER#"), F.lpad(number.cast("string"), 9, "0")).alias("champion_name"),
        S.code_map(
            F.col("l_linenumber") % 5, {1: "TOP", 2: "JUNGLE", 3: "MIDDLE", 4: "BOTTOM", 0: "SUPPORT"}
        ).alias("champion_role"),
    )


def px_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, part, supp = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    quantity = F.col("l_quantity").cast("int")
    columns = {
        "match_id": _match_id("l_orderkey"),
        "participant_pos_id": F.col("l_linenumber"),
        "team": F.when(F.col("l_linenumber") <= 3, "BLUE").otherwise("RED"),
        "minute": 5 * ((order + part + supp) % 8),
        "current_gold": part % 2500,
        "total_gold": F.floor("l_extendedprice"),
        "cs": quantity,
        "jungle_cs": part % 20,
        "xp": part * 3 + supp,
        "level": order % 18 + 1,
        "kills": quantity % 13,
        "deaths": part % 9,
        "assists": supp % 17,
        **{slot: F.nullif((part + k * supp) % 55, F.lit(0)) for k, slot in enumerate(ITEM_SLOTS)},
        "gold_diff": supp * 10 - part,
        "xp_diff": part - supp * 10,
        "team_kills": part % 40,
        "team_inhibitors": part % 3,
        "team_towers": supp % 11,
        "team_dragons_fire": part % 2,
        "team_dragons_water": supp % 2,
        "team_dragons_earth": part % 3,
        "team_dragons_air": supp % 3,
        "team_dragons_chemtech": part % 2,
        "team_dragons_hextech": supp % 2,
        "team_dragons": (part + supp) % 6,
        "team_barons": part % 4,
        "team_void_grubs": supp % 7,
        "team_heralds": (part + supp) % 3,
        "team_gold_diff": part % 3000 - 1500,
    }
    text = {"match_id", "team"}
    return table(spark, sf_dir, "lineitem").select(
        *[(c if name in text else c.cast("int")).alias(name) for name, c in columns.items()]
    )


_CATEGORIES = ["Trinket", "Consumable", "Starter", "Basic", "Boots", "Epic", "Legendary", "Other"]


def px_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One item per part size, each with a closed first version and an open second one."""
    items = table(spark, sf_dir, "part").groupBy("p_size").agg(F.min("p_name").alias("name"))
    category = S.code_map(F.col("p_size") % 8, dict(enumerate(_CATEGORIES)))
    version = lambda name, cat, start, end: F.struct(
        name.alias("item_name"), cat.alias("item_category"),
        F.lit(start).cast("timestamp").alias("__START_AT"), F.lit(end).cast("timestamp").alias("__END_AT"),
    )
    return items.select(
        F.col("p_size").alias("item_id"),
        F.inline(F.array(
            version(F.concat(F.lit("old "), "name"), F.lit("Basic"), "2024-01-01 00:00:00", "2024-01-02 00:00:00"),
            version(F.col("name"), category, "2024-01-02 00:00:00", None),
        )),
    )


def px_champions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("champion_id"),
        F.upper("s_name").alias("champion_name"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("__START_AT"),
        F.lit(None).cast("timestamp").alias("__END_AT"),
    )


def px_raw_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players as they would arrive: lower-case match ids and decimal seat numbers."""
    rows = px_players(spark, sf_dir)
    return rows.select(
        F.concat_ws("-", "match_id", F.col("participant_pos_id").cast("string")).alias("id"),
        F.lower("match_id").alias("match_id"),
        F.concat(F.col("participant_pos_id").cast("string"), F.lit(".0")).alias("participant_id"),
        S.code_map("team", {"BLUE": "100", "RED": "200"}).alias("team_id"),
        F.lower("champion_name").alias("champion"),
        F.when(F.col("champion_role") == "SUPPORT", "utility").otherwise(F.lower("champion_role")).alias("role"),
        F.lit("x").alias("individual_position"),
        F.lit("2024-01-03 00:00:00").cast("timestamp").alias("ldts"),
        F.concat(F.lit("part-"), F.col("participant_pos_id").cast("string")).alias("file_name"),
        F.lit("feed").alias("rsrc"),
    )


def px_raw_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches as they would arrive: text only, team codes, fractional durations, messy bans."""
    rows = px_matches(spark, sf_dir)
    number = F.expr("substring(match_id, 4)")
    return rows.select(
        F.lower("match_id").alias("match_id"),
        F.concat(F.col("game_duration").cast("string"), F.lit(".4")).alias("game_duration"),
        F.lit("14.1").alias("patch_version"),
        F.when(F.col("winning_team") == "BLUE", "100").when(F.col("winning_team") == "RED", "200")
        .otherwise("300").alias("winning_team"),
        F.date_format("game_date", "yyyy-MM-dd HH:mm:ss").alias("game_date"),
        "game_version",
        F.lit("CLASSIC").alias("game_mode"),
        F.lit("420").alias("queue_id"),
        F.lit("R1").alias("region"),
        F.translate(F.lower("average_rank"), "-", " ").alias("average_rank"),
        F.concat(F.col("blue_bans")[0].cast("string"), F.lit(",-1, "), F.col("blue_bans")[1].cast("string")).alias("blue_bans"),
        F.concat(number, F.lit(",x")).alias("red_bans"),
    )


def px_raw_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots as text; player numbers run over matches and empty slots are '0'."""
    rows = px_intervals(spark, sf_dir)
    numbers = [c for c in RAW_COLUMNS["intervals"] if c not in ("id", "match_id", "player_id")]
    texts = {c: F.coalesce(F.col(c).cast("string"), F.lit("0")) for c in numbers}
    return rows.select(
        F.concat_ws("-", "match_id", F.col("participant_pos_id").cast("string"), F.col("minute").cast("string")).alias("id"),
        F.lower("match_id").alias("match_id"),
        (F.col("participant_pos_id") + 10 * F.col("level")).cast("string").alias("player_id"),
        *[text.alias(name) for name, text in texts.items()],
    )


def px_raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item deliveries: every version as a change row stamped with its start."""
    return px_items(spark, sf_dir).select(
        F.concat(F.col("item_id").cast("string"), F.lit(".0")).alias("item_id"),
        F.upper("item_name").alias("item_name"),
        F.lower("item_category").alias("item_category"),
        F.col("__START_AT").alias("ldts"),
    )


def px_raw_champions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return px_champions(spark, sf_dir).select(
        F.col("champion_id").cast("string").alias("champion_id"),
        F.lower("champion_name").alias("champion_name"),
        F.col("__START_AT").alias("ldts"),
    )


SQL: dict[str, str] = {
    "px_matches": """
        SELECT 'PX_' || o_orderkey AS match_id,
               CASE o_orderstatus WHEN 'F' THEN 'BLUE' WHEN 'O' THEN 'RED' END AS winning_team,
               CAST(floor(o_totalprice / 100) AS INTEGER) AS game_duration,
               o_orderdate AS game_date,
               (o_orderkey % 15) || '.1.2.3' AS game_version,
               o_orderpriority AS average_rank,
               [CAST(o_orderkey * 7 % 100 AS INTEGER), CAST((o_orderkey * 11 + 3) % 100 AS INTEGER), 0] AS blue_bans,
               [CAST((o_orderkey * 13 + 5) % 100 AS INTEGER), CAST(o_orderkey * 7 % 100 AS INTEGER), NULL] AS red_bans
        FROM orders""",
    "px_players": """
        SELECT 'PX_' || l_orderkey AS match_id,
               l_linenumber AS participant_pos_id,
               CASE WHEN l_linenumber <= 3 THEN 'BLUE' ELSE 'RED' END AS team,
               'SUPPLIER#' || lpad(CAST(min(l_suppkey) + CASE WHEN l_linenumber = 7 THEN 10 ELSE 0 END AS VARCHAR),
                                   9, '0') AS champion_name,
               CASE l_linenumber % 5 WHEN 1 THEN 'TOP' WHEN 2 THEN 'JUNGLE' WHEN 3 THEN 'MIDDLE'
                    WHEN 4 THEN 'BOTTOM' ELSE 'SUPPORT' END AS champion_role
        FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "px_intervals": """
        SELECT 'PX_' || l_orderkey AS match_id,
               l_linenumber AS participant_pos_id,
               CASE WHEN l_linenumber <= 3 THEN 'BLUE' ELSE 'RED' END AS team,
               CAST(5 * ((l_orderkey + l_partkey + l_suppkey) % 8) AS INTEGER) AS minute,
               CAST(l_partkey % 2500 AS INTEGER) AS current_gold,
               CAST(floor(l_extendedprice) AS INTEGER) AS total_gold,
               CAST(floor(l_quantity) AS INTEGER) AS cs,
               CAST(l_partkey % 20 AS INTEGER) AS jungle_cs,
               CAST(l_partkey * 3 + l_suppkey AS INTEGER) AS xp,
               CAST(l_orderkey % 18 + 1 AS INTEGER) AS level,
               CAST(floor(l_quantity) AS INTEGER) % 13 AS kills,
               CAST(l_partkey % 9 AS INTEGER) AS deaths,
               CAST(l_suppkey % 17 AS INTEGER) AS assists,
               """ + "".join(
        f"CAST(nullif((l_partkey + {k} * l_suppkey) % 55, 0) AS INTEGER) AS item_{k},\n               "
        for k in range(7)
    ) + """CAST(l_suppkey * 10 - l_partkey AS INTEGER) AS gold_diff,
               CAST(l_partkey - l_suppkey * 10 AS INTEGER) AS xp_diff,
               CAST(l_partkey % 40 AS INTEGER) AS team_kills,
               CAST(l_partkey % 3 AS INTEGER) AS team_inhibitors,
               CAST(l_suppkey % 11 AS INTEGER) AS team_towers,
               CAST(l_partkey % 2 AS INTEGER) AS team_dragons_fire,
               CAST(l_suppkey % 2 AS INTEGER) AS team_dragons_water,
               CAST(l_partkey % 3 AS INTEGER) AS team_dragons_earth,
               CAST(l_suppkey % 3 AS INTEGER) AS team_dragons_air,
               CAST(l_partkey % 2 AS INTEGER) AS team_dragons_chemtech,
               CAST(l_suppkey % 2 AS INTEGER) AS team_dragons_hextech,
               CAST((l_partkey + l_suppkey) % 6 AS INTEGER) AS team_dragons,
               CAST(l_partkey % 4 AS INTEGER) AS team_barons,
               CAST(l_suppkey % 7 AS INTEGER) AS team_void_grubs,
               CAST((l_partkey + l_suppkey) % 3 AS INTEGER) AS team_heralds,
               CAST(l_partkey % 3000 - 1500 AS INTEGER) AS team_gold_diff
        FROM lineitem""",
    "px_items": """
        SELECT p_size AS item_id, 'old ' || min(p_name) AS item_name, 'Basic' AS item_category,
               TIMESTAMP '2024-01-01 00:00:00' AS __START_AT, TIMESTAMP '2024-01-02 00:00:00' AS __END_AT
        FROM part GROUP BY p_size
        UNION ALL
        SELECT p_size, min(p_name),
               CASE p_size % 8 WHEN 0 THEN 'Trinket' WHEN 1 THEN 'Consumable' WHEN 2 THEN 'Starter' WHEN 3 THEN 'Basic'
                    WHEN 4 THEN 'Boots' WHEN 5 THEN 'Epic' WHEN 6 THEN 'Legendary' ELSE 'Other' END,
               TIMESTAMP '2024-01-02 00:00:00', NULL
        FROM part GROUP BY p_size""",
    "px_champions": """
        SELECT CAST(s_suppkey AS INTEGER) AS champion_id, upper(s_name) AS champion_name,
               TIMESTAMP '2024-01-01 00:00:00' AS __START_AT, CAST(NULL AS TIMESTAMP) AS __END_AT
        FROM supplier""",
    "px_raw_players": """
        SELECT match_id || '-' || participant_pos_id AS id, lower(match_id) AS match_id,
               participant_pos_id || '.0' AS participant_id,
               CASE team WHEN 'BLUE' THEN '100' ELSE '200' END AS team_id,
               lower(champion_name) AS champion,
               CASE champion_role WHEN 'SUPPORT' THEN 'utility' ELSE lower(champion_role) END AS role,
               'x' AS individual_position,
               TIMESTAMP '2024-01-03 00:00:00' AS ldts,
               'part-' || participant_pos_id AS file_name, 'feed' AS rsrc
        FROM px_players""",
    "px_raw_matches": """
        SELECT lower(match_id) AS match_id, game_duration || '.4' AS game_duration, '14.1' AS patch_version,
               CASE winning_team WHEN 'BLUE' THEN '100' WHEN 'RED' THEN '200' ELSE '300' END AS winning_team,
               strftime(game_date, '%Y-%m-%d %H:%M:%S') AS game_date, game_version, 'CLASSIC' AS game_mode,
               '420' AS queue_id, 'R1' AS region, replace(lower(average_rank), '-', ' ') AS average_rank,
               blue_bans[1] || ',-1, ' || blue_bans[2] AS blue_bans, substr(match_id, 4) || ',x' AS red_bans
        FROM px_matches""",
    "px_raw_intervals": """
        SELECT match_id || '-' || participant_pos_id || '-' || minute AS id, lower(match_id) AS match_id,
               CAST(participant_pos_id + 10 * level AS VARCHAR) AS player_id,
               """ + ", ".join(
        f"coalesce(CAST({c} AS VARCHAR), '0') AS {c}"
        for c in RAW_COLUMNS["intervals"] if c not in ("id", "match_id", "player_id")
    ) + """
        FROM px_intervals""",
}


def with_px(body: str, *names: str) -> str:
    """Prefix `body` with the definitions of the named proxy tables."""
    sources = {"px_raw_players": "px_players", "px_raw_matches": "px_matches", "px_raw_intervals": "px_intervals"}
    names += tuple(sources[name] for name in names if name in sources)
    ctes = ",\n".join(f"{name} AS ({SQL[name]})" for name in SQL if name in names)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
