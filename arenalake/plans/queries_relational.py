"""Projection, filter, join, aggregate, window, sort, set, scalar and array operators on whole tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from arenalake.functions import scalars as S
from arenalake.functions.registry import register_sql_functions
from arenalake.operators import joins, ranking, sampling, snapshots
from arenalake.plans import gold
from arenalake.plans.catalog import TIER_SQL, Catalog, ratio_sql, round_sql
from arenalake.plans.proxy import (
    px_champions, px_intervals, px_items, px_matches, px_players, px_raw_players, table, with_px,
)
from arenalake.plans.silver import player_keys
from arenalake.plans.queries_gold import PLAYER_STATS_CTE, SNAPSHOT_CTE, player_stats
from arenalake.schemas import ITEM_SLOTS

CATALOG = Catalog()
query = CATALOG.query

_SLOTS = ", ".join(ITEM_SLOTS)
PLAYER = gold.PLAYER
_PX_STATS = ("px_matches", "px_players", "px_intervals", "px_items")


def _text(array):
    """Array as text, so that both engines hash the same value."""
    return F.array_join(array.cast("array<string>"), ",", "null")


def _text_sql(array: str) -> str:
    return f"array_to_string(list_transform({array}, lambda e: coalesce(CAST(e AS VARCHAR), 'null')), ',')"


# Projections -----------------------------------------------------------------------------


@query("prj01_prune_rename", "SELECT o_orderkey AS match_key, o_totalprice AS total FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("match_key"), F.col("o_totalprice").alias("total"))


@query("prj02_star", "SELECT * FROM customer")
def _(spark, d):
    return table(spark, d, "customer").select("*")


@query("prj03_star_except", "SELECT * EXCLUDE (c_name, c_acctbal) FROM customer")
def _(spark, d):
    return table(spark, d, "customer").drop("c_name", "c_acctbal")


@query("prj04_boolean_win", with_px(
    """SELECT p.match_id, p.participant_pos_id, p.team = m.winning_team AS win
       FROM px_players p JOIN px_matches m ON m.match_id = p.match_id""", "px_players", "px_matches"))
def _(spark, d):
    both = px_players(spark, d).select(*PLAYER, "team").join(px_matches(spark, d).select("match_id", "winning_team"), "match_id")
    return both.select(*PLAYER, (F.col("team") == F.col("winning_team")).alias("win"))


@query("prj05_code_map", """
    SELECT o_orderkey, CASE CASE o_orderstatus WHEN 'F' THEN '100' WHEN 'O' THEN '200' ELSE '300' END
           WHEN '100' THEN 'BLUE' WHEN '200' THEN 'RED' END AS team FROM orders""")
def _(spark, d):
    code = F.when(F.col("o_orderstatus") == "F", "100").when(F.col("o_orderstatus") == "O", "200").otherwise("300")
    return table(spark, d, "orders").select("o_orderkey", S.team_from_code(code).alias("team"))


@query("prj06_role_synonym", with_px(
    """SELECT id, CASE WHEN upper(role) = 'UTILITY' THEN 'SUPPORT' ELSE upper(role) END AS champion_role
       FROM px_raw_players""", "px_raw_players"))
def _(spark, d):
    return px_raw_players(spark, d).select("id", S.normalise_role("role").alias("champion_role"))


@query("prj07_range_bucket", """
    SELECT l_orderkey, l_linenumber, (l_partkey - 1) % 10 + 1 AS seat,
           CASE WHEN (l_partkey - 1) % 10 + 1 BETWEEN 1 AND 5 THEN 'BLUE'
                WHEN (l_partkey - 1) % 10 + 1 BETWEEN 6 AND 10 THEN 'RED' END AS team
    FROM lineitem""")
def _(spark, d):
    seat = S.cyclic_position(F.col("l_partkey"))
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", seat.alias("seat"), S.team_from_position(seat).alias("team")
    )


@query("prj08_tier_rank", with_px(
    f"""SELECT item_id, item_category,
              {TIER_SQL}[item_category] AS tier
       FROM px_items""", "px_items"))
def _(spark, d):
    return px_items(spark, d).select("item_id", "item_category", S.tier_rank("item_category").alias("tier"))


@query("prj09_winner_value", with_px(
    """SELECT match_id, CASE winning_team WHEN 'BLUE' THEN blue_bans[1] WHEN 'RED' THEN red_bans[1] END AS first_ban
       FROM px_matches""", "px_matches"))
def _(spark, d):
    first = F.when(F.col("winning_team") == "BLUE", F.col("blue_bans")[0]).when(
        F.col("winning_team") == "RED", F.col("red_bans")[0]
    )
    return px_matches(spark, d).select("match_id", first.alias("first_ban"))


@query("prj10_slots_to_array", with_px(
    f"SELECT match_id, participant_pos_id, minute, {_text_sql(f'[{_SLOTS}]')} AS slots FROM px_intervals", "px_intervals"))
def _(spark, d):
    return px_intervals(spark, d).select(*PLAYER, "minute", _text(F.array(*ITEM_SLOTS)).alias("slots"))


@query("prj11_bool_to_int", "SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'R' AS INTEGER) AS flag FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_returnflag") == "R").cast("int").alias("flag")
    )


# Filters ---------------------------------------------------------------------------------


@query("flt01_comparison", with_px(
    "SELECT match_id, game_duration FROM px_matches WHERE game_duration >= 300", "px_matches"))
def _(spark, d):
    return px_matches(spark, d).filter("game_duration >= 300").select("match_id", "game_duration")


@query("flt02_null_test", with_px(
    "SELECT match_id, participant_pos_id, minute, item_1 FROM px_intervals WHERE item_0 IS NULL AND item_1 IS NOT NULL",
    "px_intervals"))
def _(spark, d):
    return px_intervals(spark, d).filter(F.col("item_0").isNull() & F.col("item_1").isNotNull()).select(
        *PLAYER, "minute", "item_1"
    )


@query("flt03_between", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity BETWEEN 1 AND 10")
def _(spark, d):
    return table(spark, d, "lineitem").filter(F.col("l_quantity").between(1, 10)).select("l_orderkey", "l_quantity")


@query("flt04_in_not_in", with_px(
    """SELECT item_id, item_name, item_category IN ('Epic', 'Legendary') AS upper_tier FROM px_items
       WHERE item_category NOT IN ('Other', 'Legacy', 'Distributed')""", "px_items"))
def _(spark, d):
    category = F.col("item_category")
    return px_items(spark, d).filter(~category.isin(*gold.NO_FIRST_PURCHASE)).select(
        "item_id", "item_name", category.isin("Epic", "Legendary").alias("upper_tier")
    )


@query("flt05_regex", with_px(
    """SELECT match_id, game_version FROM px_matches
       WHERE regexp_matches(game_version, '^[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+$')""", "px_matches"))
def _(spark, d):
    return px_matches(spark, d).filter(F.col("game_version").rlike("^[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+$")).select(
        "match_id", "game_version"
    )


@query("flt06_modulo_predicate", with_px(
    "SELECT minute % 5 = 0 AS on_grid, cs % 5 = 0 AS cs_on_grid, count(*) AS n FROM px_intervals GROUP BY ALL",
    "px_intervals"))
def _(spark, d):
    return px_intervals(spark, d).groupBy(
        (F.col("minute") % 5 == 0).alias("on_grid"), (F.col("cs") % 5 == 0).alias("cs_on_grid")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("flt07_current_version", with_px(
    "SELECT item_id, item_name, item_category FROM px_items WHERE __END_AT IS NULL", "px_items"))
def _(spark, d):
    return joins.current(px_items(spark, d)).select("item_id", "item_name", "item_category")


@query("flt08_fresh_full_matches", with_px(
    f"""WITH {PLAYER_STATS_CTE}
    SELECT match_id, participant_pos_id, total_gold FROM player_stats
    WHERE unlogged_duration = 0 AND game_duration > 300""", *_PX_STATS))
def _(spark, d):
    return player_stats(spark, d).filter("unlogged_duration = 0 AND game_duration > 300").select(*PLAYER, "total_gold")


# Joins -----------------------------------------------------------------------------------


@query("jn01_inner_one_key", with_px(
    """SELECT p.match_id, p.participant_pos_id, m.game_duration
       FROM px_players p JOIN px_matches m ON m.match_id = p.match_id""", "px_players", "px_matches"))
def _(spark, d):
    return px_players(spark, d).select(*PLAYER).join(px_matches(spark, d).select("match_id", "game_duration"), "match_id")


@query("jn02_inner_composite_key", with_px(
    """SELECT s.match_id, s.participant_pos_id, s.minute, p.champion_name FROM px_intervals s
       JOIN px_players p ON p.match_id = s.match_id AND p.participant_pos_id = s.participant_pos_id""",
    "px_intervals", "px_players"))
def _(spark, d):
    return px_intervals(spark, d).select(*PLAYER, "minute").join(px_players(spark, d).select(*PLAYER, "champion_name"), PLAYER)


_HELD = f"(SELECT match_id, participant_pos_id, minute, unnest([{_SLOTS}]) AS item_id FROM px_intervals)"


def _held(spark, d):
    return gold.held_by(px_intervals(spark, d), PLAYER + ["minute"])


@query("jn03_left_versioned_dimension", with_px(
    f"""SELECT h.match_id, h.participant_pos_id, h.minute, h.item_id, i.item_name
        FROM {_HELD} h LEFT JOIN px_items i ON i.item_id = h.item_id AND i.__END_AT IS NULL
        WHERE h.item_id IS NOT NULL""", "px_intervals", "px_items"))
def _(spark, d):
    held, items = _held(spark, d), px_items(spark, d)
    # Version predicate inside the join condition; Spark pushes it to the dimension scan.
    hit = (held.item_id == items.item_id) & items["__END_AT"].isNull()
    return held.join(items, hit, "left").select(*PLAYER, "minute", held.item_id, "item_name")


@query("jn04_left_current_dimension", with_px(
    f"""SELECT h.item_id, i.item_name, i.item_category, count(*) AS n
        FROM {_HELD} h LEFT JOIN (SELECT * FROM px_items WHERE __END_AT IS NULL) i ON i.item_id = h.item_id
        WHERE h.item_id IS NOT NULL GROUP BY ALL""", "px_intervals", "px_items"))
def _(spark, d):
    # Count on ids, resolve names last.
    counted = _held(spark, d).groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    return joins.lookup(counted, px_items(spark, d), "item_id")


@query("jn05_inner_current_dimension", with_px(
    f"""SELECT h.item_id, i.item_name, count(*) AS n
        FROM {_HELD} h JOIN (SELECT * FROM px_items WHERE __END_AT IS NULL) i ON i.item_id = h.item_id
        WHERE i.item_category NOT IN ('Other', 'Legacy', 'Distributed') GROUP BY ALL""", "px_intervals", "px_items"))
def _(spark, d):
    counted = _held(spark, d).groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    return joins.lookup(counted, px_items(spark, d), "item_id", "inner").filter(
        ~F.col("item_category").isin(*gold.NO_FIRST_PURCHASE)
    ).drop("item_category")


@query("jn06_star_of_aggregates", """
    SELECT s.s_suppkey, coalesce(a.n, 0) AS lines, coalesce(b.n, 0) AS returned, c.parts
    FROM supplier s
    LEFT JOIN (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1) a ON a.l_suppkey = s.s_suppkey
    LEFT JOIN (SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) b
           ON b.l_suppkey = s.s_suppkey
    LEFT JOIN (SELECT l_suppkey, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1) c
           ON c.l_suppkey = s.s_suppkey""")
def _(spark, d):
    lines = table(spark, d, "lineitem").withColumnRenamed("l_suppkey", "s_suppkey")
    # Lines and returns come from one aggregate; distinct parts are pre-reduced per supplier.
    sums = lines.groupBy("s_suppkey").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.col("l_returnflag") == "R").alias("returned")
    )
    parts = lines.select("s_suppkey", "l_partkey").distinct().groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("parts"))
    return (
        table(spark, d, "supplier").select("s_suppkey")
        .join(sums, "s_suppkey", "left").join(parts, "s_suppkey", "left")
        .select("s_suppkey", F.coalesce("lines", F.lit(0)).alias("lines"), F.coalesce("returned", F.lit(0)).alias("returned"), "parts")
    )


@query("jn07_left_fact_aggregate", with_px(
    """SELECT p.match_id, p.participant_pos_id, p.champion_name, a.snapshots, a.last_minute
       FROM px_players p LEFT JOIN (
           SELECT match_id, participant_pos_id, count(*) AS snapshots, max(minute) AS last_minute
           FROM px_intervals WHERE kills > 5 GROUP BY ALL
       ) a ON a.match_id = p.match_id AND a.participant_pos_id = p.participant_pos_id""", "px_players", "px_intervals"))
def _(spark, d):
    sums = px_intervals(spark, d).filter("kills > 5").groupBy(*PLAYER).agg(
        F.count(F.lit(1)).alias("snapshots"), F.max("minute").alias("last_minute")
    )
    return px_players(spark, d).select(*PLAYER, "champion_name").join(sums, PLAYER, "left")


@query("jn08_one_row_total", f"""
    SELECT a.l_suppkey, {ratio_sql("a.n", "t.n")} AS share
    FROM (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1) a CROSS JOIN (SELECT count(*) AS n FROM orders) t""")
def _(spark, d):
    # The one-row side is a scalar subquery: no join at all.
    total = table(spark, d, "orders").agg(F.count(F.lit(1)).alias("n")).scalar()
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n")).select(
        "l_suppkey", S.rate(F.col("n"), total).alias("share")
    )


@query("jn09_unresolved_anti", """
    SELECT d.doc_id, d.lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def _(spark, d):
    return joins.unresolved(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels"), "doc_id")


@query("jn10_trace_back", with_px(
    """SELECT p.match_id, p.participant_pos_id, r.id, r.file_name FROM px_players p
       JOIN px_raw_players r ON upper(r.match_id) = p.match_id
            AND CAST(round(CAST(r.participant_id AS DOUBLE)) AS INTEGER) = p.participant_pos_id""",
    "px_players", "px_raw_players"))
def _(spark, d):
    raw = player_keys(px_raw_players(spark, d)).select(*PLAYER, "id", "file_name")
    return joins.trace_back(px_players(spark, d).select(*PLAYER), raw, PLAYER)


@query("jn11_in_row_pairs", with_px(
    f"""WITH held AS (
        SELECT rid, item_id FROM (
            SELECT rid, unnest([{_SLOTS}]) AS item_id FROM (SELECT *, row_number() OVER () AS rid FROM px_intervals)
        ) WHERE item_id IS NOT NULL
    ), tiered AS (
        SELECT h.rid, h.item_id, i.item_category AS cat,
               {TIER_SQL}[i.item_category] AS tier
        FROM held h JOIN px_items i ON i.item_id = h.item_id AND i.__END_AT IS NULL
    )
    SELECT l.item_id, r.item_id AS co_item_id, count(*) AS n FROM tiered l JOIN tiered r ON l.rid = r.rid
    WHERE l.item_id != r.item_id AND l.tier <= r.tier GROUP BY ALL""", "px_intervals", "px_items"))
def _(spark, d):
    # Pairs are built inside each row and counted before the tiers are looked up.
    counted = (
        px_intervals(spark, d).select(F.explode(ranking.slot_pairs(ITEM_SLOTS)).alias("p"))
        .filter("p IS NOT NULL").groupBy("p.lo", "p.hi").agg(F.count(F.lit(1)).alias("n"))
    )
    both = counted.select("n", F.inline(F.array(
        F.struct(F.col("lo").alias("item_id"), F.col("hi").alias("co_item_id")),
        F.struct(F.col("hi").alias("item_id"), F.col("lo").alias("co_item_id")),
    )))
    tiers = joins.current(px_items(spark, d)).select("item_id", S.tier_rank("item_category").alias("tier"))
    return (
        both.join(tiers, "item_id")
        .join(tiers.select(F.col("item_id").alias("co_item_id"), F.col("tier").alias("co_tier")), "co_item_id")
        .filter("tier <= co_tier").select("item_id", "co_item_id", "n")
    )


# Aggregates ------------------------------------------------------------------------------


@query("agg01_count_per_group", with_px("SELECT team, minute, count(*) AS n FROM px_intervals GROUP BY ALL", "px_intervals"))
def _(spark, d):
    return ranking.counts(px_intervals(spark, d), ["team", "minute"], "n")


@query("agg02_global_count", "SELECT count(*) AS n FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query("agg03_conditional_sum", with_px(
    """SELECT average_rank, sum(CASE WHEN winning_team = 'BLUE' THEN 1 ELSE 0 END) AS blue_wins,
              count(*) FILTER (WHERE winning_team IS NULL) AS undecided FROM px_matches GROUP BY 1""", "px_matches"))
def _(spark, d):
    return px_matches(spark, d).groupBy("average_rank").agg(
        F.sum(F.when(F.col("winning_team") == "BLUE", 1).otherwise(0)).alias("blue_wins"),
        F.count_if(F.col("winning_team").isNull()).alias("undecided"),
    )


@query("agg04_average_of_expression", with_px(
    f"SELECT minute, {round_sql('avg((kills + assists) / (deaths + 1))', 2)} AS avg_kda FROM px_intervals GROUP BY 1",
    "px_intervals"))
def _(spark, d):
    return px_intervals(spark, d).groupBy("minute").agg(F.round(F.avg(S.kda()), 2).alias("avg_kda"))


@query("agg05_min_per_key", with_px(
    f"""SELECT match_id, participant_pos_id, item_id, min(minute) AS first_minute FROM {_HELD}
        WHERE item_id IS NOT NULL GROUP BY ALL""", "px_intervals"))
def _(spark, d):
    return _held(spark, d).groupBy(*PLAYER, "item_id").agg(F.min("minute").alias("first_minute"))


@query("agg06_max_per_key", with_px(
    "SELECT match_id, max(minute) AS last_minute FROM px_intervals GROUP BY 1", "px_intervals"))
def _(spark, d):
    return px_intervals(spark, d).groupBy("match_id").agg(F.max("minute").alias("last_minute"))


_PIVOT = {"kills": "team_kills", "towers": "team_towers", "barons": "team_barons"}


@query("agg07_conditional_max_pivot", with_px(
    "SELECT match_id, " + ", ".join(
        f"max({source}) FILTER (WHERE team = '{side.upper()}') AS {side}_{name}"
        for name, source in _PIVOT.items() for side in ("blue", "red")
    ) + " FROM px_intervals GROUP BY 1", "px_intervals"))
def _(spark, d):
    return snapshots.pivot_max(px_intervals(spark, d), "match_id", "team", ["BLUE", "RED"], _PIVOT)


_PART_COUNTS = "SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL"


def _top_parts(spark, d):
    counted = ranking.counts(table(spark, d, "lineitem"), ["l_suppkey", "l_partkey"], "n")
    return ranking.top_k(counted, ["l_suppkey"], [F.desc("n"), F.asc("l_partkey")], 3)


@query("agg08_ranks_to_columns", f"""
    WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_partkey) AS r FROM ({_PART_COUNTS}))
    SELECT l_suppkey, max(l_partkey) FILTER (WHERE r = 1) AS part_1, max(l_partkey) FILTER (WHERE r = 2) AS part_2,
           max(l_partkey) FILTER (WHERE r = 3) AS part_3
    FROM ranked WHERE r <= 3 GROUP BY 1""")
def _(spark, d):
    return ranking.ranks_to_columns(_top_parts(spark, d), ["l_suppkey"], "l_partkey", 3, "part_")


@query("agg09_collect_sorted_names", with_px(
    f"""WITH {PLAYER_STATS_CTE}
    SELECT match_id, participant_pos_id, array_to_string(item_build, '|') AS item_build
    FROM build""", *_PX_STATS))
def _(spark, d):
    # At most one list entry per inventory slot.
    builds = gold.named_builds(gold.final_snapshot(px_intervals(spark, d)), px_items(spark, d))
    return builds.filter("item_build IS NOT NULL").select(*PLAYER, F.array_join("item_build", "|").alias("item_build"))


@query("agg10_collect_structs_ordered", with_px(
    f"""WITH {SNAPSHOT_CTE},
    held AS (SELECT match_id, participant_pos_id, unnest([{_SLOTS}]) AS item_id FROM snap),
    tiered AS (
        SELECT h.*, {TIER_SQL}[i.item_category] AS tier
        FROM held h JOIN px_items i ON i.item_id = h.item_id AND i.__END_AT IS NULL
    )
    SELECT match_id, participant_pos_id,
           string_agg(tier || ':' || item_id, ',' ORDER BY tier, item_id) AS items
    FROM tiered WHERE tier IS NOT NULL GROUP BY ALL""", "px_intervals", "px_items"))
def _(spark, d):
    builds = gold.tiered_builds(gold.final_snapshot(px_intervals(spark, d)), px_items(spark, d))
    pairs = F.transform("items", lambda i: F.concat_ws(":", i["tier"].cast("string"), i["id"].cast("string")))
    return builds.select(*PLAYER, F.array_join(pairs, ",").alias("items"))


@query("agg11_distinct_rows", with_px(
    "SELECT DISTINCT match_id, team, minute, team_kills, team_towers FROM px_intervals", "px_intervals"))
def _(spark, d):
    return px_intervals(spark, d).select("match_id", "team", "minute", "team_kills", "team_towers").distinct()


@query("agg12_guarded_ratio", f"""
    WITH sums AS (
        SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
               count(*) FILTER (WHERE l_quantity > 49) AS large FROM lineitem GROUP BY 1
    )
    SELECT l_suppkey, coalesce({ratio_sql("returned", "large")}, 0) AS ratio FROM sums""")
def _(spark, d):
    sums = table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("returned"), F.count_if(F.col("l_quantity") > 49).alias("large")
    )
    return sums.select("l_suppkey", F.coalesce(S.rate(F.col("returned"), F.col("large")), F.lit(0.0)).alias("ratio"))


@query("agg13_mode_per_group", with_px(
    f"""WITH c AS (SELECT champion_name, champion_role, count(*) AS cnt FROM px_players GROUP BY ALL),
    t AS (SELECT *, sum(cnt) OVER (PARTITION BY champion_name) AS total FROM c)
    SELECT champion_name, champion_role, {ratio_sql("cnt", "total")} AS share FROM t
    QUALIFY row_number() OVER (PARTITION BY champion_name ORDER BY cnt DESC, champion_role) = 1""", "px_players"))
def _(spark, d):
    counted = ranking.counts(px_players(spark, d), ["champion_name", "champion_role"])
    return ranking.mode_by(counted, ["champion_name"], "champion_role")


_SHARE_SQL = f"""
    WITH c AS (SELECT event_type, user_id, count(*) AS cnt FROM events GROUP BY ALL),
    t AS (SELECT *, sum(cnt) OVER (PARTITION BY user_id) AS total FROM c)
    SELECT event_type, user_id, cnt, {ratio_sql("cnt", "total")} AS share FROM t"""


@query("agg14_share_of_group_total", _SHARE_SQL)
def _(spark, d):
    counted = ranking.counts(table(spark, d, "events"), ["event_type", "user_id"])
    return ranking.share_of_total(counted, ["user_id"])


# Windows ---------------------------------------------------------------------------------


@query("win01_latest_per_player", with_px(
    f"""WITH {SNAPSHOT_CTE} SELECT match_id, participant_pos_id, minute, level, kills, deaths, assists,
        cs, jungle_cs, total_gold, {_SLOTS} FROM snap""", "px_intervals"))
def _(spark, d):
    return gold.final_snapshot(px_intervals(spark, d))


@query("win02_latest_per_user", """
    SELECT user_id, ts, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def _(spark, d):
    return snapshots.last_snapshot(table(spark, d, "events"), ["user_id"], "ts", ["event_id", "event_type", "value"])


@query("win03_latest_per_team_after_distinct", with_px(
    """WITH rows AS (SELECT DISTINCT match_id, team, minute, team_kills, team_towers FROM px_intervals)
    SELECT * FROM rows
    QUALIFY row_number() OVER (PARTITION BY match_id, team ORDER BY minute DESC, team_kills DESC, team_towers DESC) = 1""",
    "px_intervals"))
def _(spark, d):
    # Copies of a row do not change its maximum, so no separate de-duplication is needed.
    rows = px_intervals(spark, d).select("match_id", "team", "minute", "team_kills", "team_towers")
    return snapshots.last_snapshot(rows, ["match_id", "team"], "minute")


@query("win04_rank_groups_by_count", with_px(
    """SELECT *, row_number() OVER (PARTITION BY champion_name ORDER BY cnt DESC, champion_role) AS rank
       FROM (SELECT champion_name, champion_role, count(*) AS cnt FROM px_players GROUP BY ALL)""", "px_players"))
def _(spark, d):
    counted = ranking.counts(px_players(spark, d), ["champion_name", "champion_role"])
    order = Window.partitionBy("champion_name").orderBy(F.desc("cnt"), "champion_role")
    return counted.withColumn("rank", F.row_number().over(order))


@query("win05_window_total", with_px(
    """SELECT *, CAST(sum(cnt) OVER (PARTITION BY team) AS BIGINT) AS total
       FROM (SELECT champion_role, team, count(*) AS cnt FROM px_players GROUP BY ALL)""", "px_players"))
def _(spark, d):
    counted = ranking.counts(px_players(spark, d), ["champion_role", "team"])
    return counted.withColumn("total", F.sum("cnt").over(Window.partitionBy("team")))


@query("win06_top_k_per_group", f"""
    SELECT l_suppkey, l_partkey, n, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_partkey) AS rank
    FROM ({_PART_COUNTS}) QUALIFY rank <= 3""")
def _(spark, d):
    return _top_parts(spark, d)


@query("win07_mode_first_minute", with_px(
    f"""WITH f AS (SELECT match_id, participant_pos_id, item_id, min(minute) AS minute FROM {_HELD}
                   WHERE item_id IS NOT NULL GROUP BY ALL),
    c AS (SELECT item_id, minute, count(*) AS cnt FROM f GROUP BY ALL)
    SELECT item_id, minute FROM c QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY cnt DESC, minute) = 1""",
    "px_intervals"))
def _(spark, d):
    first = _held(spark, d).groupBy(*PLAYER, "item_id").agg(F.min("minute").alias("minute"))
    return ranking.mode_by(ranking.counts(first, ["item_id", "minute"]), ["item_id"], "minute").drop("share")


# Sort, limit, sample, set ------------------------------------------------------------------


@query("srt01_order_by_aggregate", with_px(
    "SELECT item_category, count(*) AS n FROM px_items GROUP BY 1 ORDER BY n DESC, item_category", "px_items"))
def _(spark, d):
    return ranking.counts(px_items(spark, d), ["item_category"], "n").orderBy(F.desc("n"), "item_category")


@query("srt02_random_rows", """
    SELECT event_id, user_id FROM events ORDER BY md5(CAST(event_id AS VARCHAR)), event_id LIMIT 300""")
def _(spark, d):
    # Hashed order stands in for RANDOM() so that the result can be compared.
    return sampling.hashed_rows(table(spark, d, "events").select("event_id", "user_id"), ["event_id"], 300)


HASH_SQL = "(CAST('0x' || substr(md5('{seed}|' || {key}), 1, 8) AS BIGINT) / 4294967296.0)"


@query("srt03_fraction_sample", f"""
    SELECT event_id, user_id FROM events WHERE {HASH_SQL.format(seed=42, key="event_id")} < 0.1""")
def _(spark, d):
    return sampling.hashed_fraction(table(spark, d, "events"), ["event_id"], 0.1).select("event_id", "user_id")


@query("srt04_sort_in_array", with_px(
    f"""SELECT match_id, participant_pos_id, minute,
               {_text_sql(f"list_sort(list_filter([{_SLOTS}], lambda e: e IS NOT NULL))")} AS items
        FROM px_intervals""", "px_intervals"))
def _(spark, d):
    return px_intervals(spark, d).select(*PLAYER, "minute", _text(F.array_sort(S.held_items(ITEM_SLOTS))).alias("items"))


@query("srt05_head_preview", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(5)


@query("set01_union_distinct_members", with_px(
    """SELECT DISTINCT match_id, champion_id FROM (
           SELECT match_id, unnest(blue_bans) AS champion_id FROM px_matches
           UNION ALL SELECT match_id, unnest(red_bans) FROM px_matches) WHERE champion_id != 0""", "px_matches"))
def _(spark, d):
    return ranking.distinct_members(px_matches(spark, d), "match_id", ["blue_bans", "red_bans"], "champion_id").filter(
        "champion_id != 0"
    )


# Scalars ---------------------------------------------------------------------------------

_TITLE = "array_to_string(list_transform(string_split({c}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"


@query("scl01_upper", "SELECT s_suppkey, upper(s_name) AS name FROM supplier")
def _(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", F.upper("s_name").alias("name"))


@query("scl02_initcap", f"SELECT p_partkey, {_TITLE.format(c='p_name')} AS name, {_TITLE.format(c='p_type')} AS kind FROM part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", F.initcap("p_name").alias("name"), F.initcap("p_type").alias("kind"))


@query("scl03_trim", "SELECT doc_id, trim('  ' || lang || ' ') AS lang FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", F.trim(F.concat(F.lit("  "), "lang", F.lit(" "))).alias("lang"))


@query("scl04_regexp_replace", r"""
    SELECT doc_id, md5(regexp_replace(text, '([a-z])([A-Z])', '\1 \2', 'g')) AS spaced FROM documents""")
def _(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", F.md5(F.regexp_replace("text", "([a-z])([A-Z])", "$1 $2")).alias("spaced")
    )


@query("scl05_length", "SELECT doc_id, length(text) AS n FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", F.length("text").alias("n"))


@query("scl06_try_cast", """
    SELECT p_partkey, try_cast(p_name AS INTEGER) AS bad, try_cast(p_size || '.5' AS DOUBLE) AS good,
           try_cast(p_size || '-13-01' AS TIMESTAMP) AS no_date FROM part""")
def _(spark, d):
    size = F.col("p_size").cast("string")
    return table(spark, d, "part").select(
        "p_partkey", F.col("p_name").try_cast("int").alias("bad"),
        F.concat(size, F.lit(".5")).try_cast("double").alias("good"),
        F.concat(size, F.lit("-13-01")).try_cast("timestamp").alias("no_date"),
    )


@query("scl07_cast", "SELECT l_orderkey, CAST(l_partkey AS INTEGER) AS part, CAST(l_linenumber AS DOUBLE) AS line FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", F.col("l_partkey").cast("int").alias("part"), F.col("l_linenumber").cast("double").alias("line")
    )


@query("scl08_round", f"""
    SELECT l_orderkey, l_linenumber, {round_sql("l_quantity / 4", 0)} AS r0, {round_sql("l_quantity / 8", 2)} AS r2,
           {ratio_sql("CAST(l_quantity AS BIGINT)", "l_partkey + 7", 4)} AS r4 FROM lineitem""")
def _(spark, d):
    q = F.col("l_quantity")
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(q / 4, 0).alias("r0"), F.round(q / 8, 2).alias("r2"),
        F.round(q / (F.col("l_partkey") + 7), 4).alias("r4"),
    )


@query("scl09_nullif", "SELECT l_orderkey, l_linenumber, nullif(l_partkey % 7, 0) AS slot FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif(F.col("l_partkey") % 7, F.lit(0)).alias("slot")
    )


@query("scl10_coalesce", with_px(
    "SELECT match_id, coalesce(winning_team, 'NONE') AS team, coalesce(red_bans[3], -1) AS ban FROM px_matches", "px_matches"))
def _(spark, d):
    return px_matches(spark, d).select(
        "match_id", F.coalesce("winning_team", F.lit("NONE")).alias("team"),
        F.coalesce(F.col("red_bans")[2], F.lit(-1)).alias("ban"),
    )


@query("scl11_greatest_skips_null", with_px(
    "SELECT match_id, participant_pos_id, minute, greatest(item_0, 3, item_1) AS top FROM px_intervals", "px_intervals"))
def _(spark, d):
    return px_intervals(spark, d).select(*PLAYER, "minute", F.greatest("item_0", F.lit(3), "item_1").alias("top"))


@query("scl12_if", "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS positive FROM customer")
def _(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, 1).otherwise(0).alias("positive"))


@query("scl13_arithmetic", """
    SELECT l_orderkey, l_linenumber, l_partkey + l_suppkey AS a, l_partkey - l_suppkey AS b, l_partkey * 3 AS c,
           round(l_partkey / 4, 6) AS q, (l_suppkey - l_partkey) % 10 AS m FROM lineitem""")
def _(spark, d):
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", (part + supp).alias("a"), (part - supp).alias("b"), (part * 3).alias("c"),
        F.round(part / 4, 6).alias("q"), ((supp - part) % 10).alias("m"),
    )


@query("scl14_current_timestamp", "SELECT 1 AS stamps, count(*) AS past_orders FROM orders WHERE o_orderdate <= now()::TIMESTAMP")
def _(spark, d):
    stamped = table(spark, d, "orders").select("o_orderdate", F.current_timestamp().alias("now"))
    return stamped.filter("o_orderdate <= now").agg(
        F.count_distinct("now").alias("stamps"), F.count(F.lit(1)).alias("past_orders")
    )


@query("scl15_timestamp_literal", """
    SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01 00:00:00'""")
def _(spark, d):
    return table(spark, d, "orders").filter(
        F.col("o_orderdate") >= F.lit("1998-06-01 00:00:00").cast("timestamp_ntz")
    ).select("o_orderkey")


@query("scl16_random", "SELECT count(*) AS n, count(*) AS in_range FROM lineitem")
def _(spark, d):
    drawn = table(spark, d, "lineitem").select(F.rand(42).alias("r"))
    return drawn.agg(F.count(F.lit(1)).alias("n"), F.count_if((F.col("r") >= 0) & (F.col("r") < 1)).alias("in_range"))


@query("scl17_cyclic_position", """
    SELECT l_orderkey, l_linenumber, ((l_partkey - 5 - 1) % 10) + 1 AS seat FROM lineitem""")
def _(spark, d):
    # Shifted so that zero and negative numbers occur.
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", S.cyclic_position(F.col("l_partkey") - 5).alias("seat")
    )


# Arrays ----------------------------------------------------------------------------------


@query("arr01_split", "SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word, len(string_split(p_name, ' ')) AS words FROM part")
def _(spark, d):
    words = F.split("p_name", " ")
    return table(spark, d, "part").select("p_partkey", words[0].alias("first_word"), F.size(words).alias("words"))


_BAN_TEXT = "(o_orderkey % 9) || ',-1,x, ' || (o_custkey % 7)"


@query("arr02_transform_bans", f"""
    SELECT o_orderkey, {_text_sql(
        f"list_transform(string_split({_BAN_TEXT}, ','), lambda e: CASE WHEN try_cast(trim(e) AS INTEGER) = -1 THEN 0 "
        "ELSE try_cast(trim(e) AS INTEGER) END)")} AS bans FROM orders""")
def _(spark, d):
    text = F.concat((F.col("o_orderkey") % 9).cast("string"), F.lit(",-1,x, "), (F.col("o_custkey") % 7).cast("string"))
    return table(spark, d, "orders").select("o_orderkey", _text(S.ban_list(text)).alias("bans"))


@query("arr03_array", "SELECT l_orderkey, l_linenumber, array_to_string([l_partkey, l_suppkey], ',') AS ids FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", _text(F.array("l_partkey", "l_suppkey")).alias("ids"))


@query("arr04_filter_not_null", with_px(
    f"""SELECT match_id, participant_pos_id, minute,
               {_text_sql(f"list_filter([{_SLOTS}], lambda e: e IS NOT NULL)")} AS items FROM px_intervals""", "px_intervals"))
def _(spark, d):
    return px_intervals(spark, d).select(*PLAYER, "minute", _text(S.held_items(ITEM_SLOTS)).alias("items"))


@query("arr05_sort_array", "SELECT p_partkey, array_to_string(list_sort(string_split(p_name, ' ')), ' ') AS words FROM part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", F.array_join(F.sort_array(F.split("p_name", " ")), " ").alias("words"))


@query("arr06_array_sort_comparator", with_px(
    f"""SELECT match_id, participant_pos_id, minute, array_to_string(list_transform(list_sort(list_transform(
            list_filter([{_SLOTS}], lambda e: e IS NOT NULL), lambda e: {{'tier': e % 7, 'id': e}})),
            lambda s: s.tier || ':' || s.id), ',') AS items FROM px_intervals""", "px_intervals"))
def _(spark, d):
    # Natural struct order (tier, then id) replaces a comparator.
    tiered = F.transform(S.held_items(ITEM_SLOTS), lambda i: F.struct((i % 7).alias("tier"), i.alias("id")))
    text = F.transform(
        F.array_sort(tiered), lambda s: F.concat_ws(":", s["tier"].cast("string"), s["id"].cast("string"))
    )
    return px_intervals(spark, d).select(*PLAYER, "minute", F.array_join(text, ",").alias("items"))


@query("arr07_struct_fields", """
    SELECT s.a.id AS id, s.a.line AS line FROM (SELECT {'id': l_orderkey, 'line': l_linenumber} AS a FROM lineitem) s""")
def _(spark, d):
    pair = F.struct(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"))
    return table(spark, d, "lineitem").select(pair.alias("a")).select("a.id", "a.line")


@query("arr08_explode", with_px("SELECT match_id, unnest(blue_bans) AS champion_id FROM px_matches", "px_matches"))
def _(spark, d):
    return px_matches(spark, d).select("match_id", F.explode("blue_bans").alias("champion_id"))


@query("arr09_stacked_lateral_explode", with_px(
    """SELECT match_id, b AS blue_ban, r AS red_ban FROM (
           SELECT match_id, b, unnest(red_bans) AS r FROM (SELECT match_id, red_bans, unnest(blue_bans) AS b FROM px_matches))
       WHERE b != r""", "px_matches"))
def _(spark, d):
    # Two short arrays of one row: nine combinations at most.
    return (
        px_matches(spark, d).select("match_id", "red_bans", F.explode("blue_bans").alias("blue_ban"))
        .select("match_id", "blue_ban", F.explode("red_bans").alias("red_ban"))
        .filter("blue_ban != red_ban")
    )


# SQL functions -----------------------------------------------------------------------------


def _with_functions(spark, d, name, sql):
    register_sql_functions(spark)
    table(spark, d, name).createOrReplaceTempView(f"udf_{name}")
    return spark.sql(sql.format(t=f"udf_{name}"))


_PASCAL = "upper(substr({a}, 1, 1)) || substr({a}, 2) || upper(substr({b}, 1, 1)) || lower(substr({b}, 2))"


@query("udf01_pascal_to_title_case", f"""
    WITH w AS (SELECT p_partkey, {_PASCAL.format(a="split_part(p_name, ' ', 1)", b="p_type")} AS raw FROM part)
    SELECT p_partkey, {_TITLE.format(c="trim(regexp_replace(raw, '([a-z])([A-Z])', '" + chr(92) + "1 " + chr(92) + "2', 'g'))")} AS title FROM w""")
def _(spark, d):
    return _with_functions(spark, d, "part", """
        SELECT p_partkey, pascal_to_title_case(raw) AS title FROM (
            SELECT p_partkey, initcap(split_part(p_name, ' ', 1)) || initcap(p_type) AS raw FROM {t})""")


@query("udf02_safecast_to_int", """
    SELECT l_orderkey, l_linenumber, CAST(floor(l_quantity / 2 + 0.5) AS INTEGER) AS half,
           CAST(NULL AS INTEGER) AS bad, CAST(-floor(l_quantity / 2 + 0.5) AS INTEGER) AS negative
    FROM lineitem""")
def _(spark, d):
    return _with_functions(spark, d, "lineitem", """
        SELECT l_orderkey, l_linenumber, safecast_to_int(' ' || CAST(l_quantity / 2 AS STRING)) AS half,
               safecast_to_int(l_returnflag) AS bad,
               safecast_to_int('-' || CAST(l_quantity / 2 AS STRING)) AS negative FROM {t}""")


@query("udf03_valid_num_range", """
    SELECT c_custkey, CASE WHEN c_acctbal BETWEEN 0 AND 5000 THEN c_acctbal END AS balance FROM customer""")
def _(spark, d):
    return _with_functions(spark, d, "customer", "SELECT c_custkey, valid_num_range(c_acctbal, 0, 5000) AS balance FROM {t}")


@query("udf04_valid_ts_range", """
    SELECT o_orderkey, CASE WHEN o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-12-31'
           THEN o_orderdate END AS order_ts FROM orders""")
def _(spark, d):
    return _with_functions(spark, d, "orders", """
        SELECT o_orderkey, valid_ts_range(CAST(o_orderdate AS TIMESTAMP), TIMESTAMP '1997-01-01', TIMESTAMP '1998-12-31')
               AS order_ts FROM {t}""")


@query("udf05_nullify_caplen", """
    SELECT doc_id, CASE WHEN length(text) <= 2000 THEN md5(text) END AS short_text FROM documents""")
def _(spark, d):
    return _with_functions(spark, d, "documents", "SELECT doc_id, md5(nullify_caplen(text, 2000)) AS short_text FROM {t}")
