"""Sources, sinks, streams, history, cleaning and data quality.

Queries about files and streams first write the supplied table in the landed form below the
shared folder, then run the real code path over it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arenalake import schemas
from arenalake.operators import quality
from arenalake.operators.joins import current, unresolved
from arenalake.operators.scd2 import scd2
from arenalake.operators.stats import quality_summary
from arenalake.plans import gold, silver
from arenalake.plans.catalog import Catalog, ratio_sql, round_sql
from arenalake.plans.contracts import EXPECTATIONS
from arenalake.plans.proxy import (
    px_champions, px_intervals, px_matches, px_players, px_raw_champions, px_raw_intervals, px_raw_items,
    px_raw_matches, px_raw_players, table, with_px,
)
from arenalake.plans.queries_gold import PLAYER_STATS_CTE, player_stats
from arenalake.plans.queries_relational import HASH_SQL
from arenalake.sources import csv as csv_source
from arenalake.sources import tables
from arenalake.streaming.history import maintain_history, read_history, refine_history, versions
from arenalake.streaming.ingest import append_available, ingest, refine
from arenalake.workspace import new_dir, written

CATALOG = Catalog()
query = CATALOG.query

PLAYER = gold.PLAYER
_PX_STATS = ("px_matches", "px_players", "px_intervals", "px_items")


def land(df: DataFrame, root: str, source: str) -> None:
    """Write the raw columns of one source as gzip CSV with a header."""
    df.select(*schemas.RAW_COLUMNS[source]).write.options(header="true", compression="gzip").csv(
        f"{root}/{schemas.RAW_FOLDERS[source]}"
    )


def _landed_players(spark: SparkSession, d: str) -> str:
    root = new_dir(spark, "landing")
    land(px_raw_players(spark, d), root, "players")
    return root


_RAW_PLAYER_COLUMNS = ", ".join(schemas.RAW_COLUMNS["players"])
_RAW_PLAYERS_SQL = with_px(f"SELECT {_RAW_PLAYER_COLUMNS} FROM px_raw_players", "px_raw_players")


def _bronze_players(spark: SparkSession, d: str, runs: int = 1, partitions: int | None = None) -> str:
    landing, root = _landed_players(spark, d), new_dir(spark, "lake")
    for _ in range(runs):
        ingest(spark, landing, root, "players", partitions=partitions)
    return root


def _bronze(spark: SparkSession, root: str, name: str) -> DataFrame:
    return tables.read_table(spark, root, "bronze", name, schemas.bronze_schema(name))


# Sources ---------------------------------------------------------------------------------


@query("src01_incremental_csv_scan", _RAW_PLAYERS_SQL)
def _(spark, d):
    return _bronze(spark, _bronze_players(spark, d), "players").select(*schemas.RAW_COLUMNS["players"])


@query("src02_audit_columns", with_px(
    """SELECT id, true AS stamped, true AS from_gzip_csv, 'Kaggle' AS rsrc FROM px_raw_players""", "px_raw_players"))
def _(spark, d):
    return _bronze(spark, _bronze_players(spark, d), "players").select(
        "id", F.col("ldts").isNotNull().alias("stamped"), F.col("file_name").endswith(".csv.gz").alias("from_gzip_csv"), "rsrc"
    )


@query("src03_batch_csv_scan", with_px(
    f"SELECT {_RAW_PLAYER_COLUMNS}, 'static data' AS rsrc, true AS stamped FROM px_raw_players", "px_raw_players"))
def _(spark, d):
    glob = csv_source.landing_glob(_landed_players(spark, d), "players")
    rows = csv_source.read_batch(spark, glob, schemas.raw_schema("players"), "static data")
    return rows.select(*schemas.RAW_COLUMNS["players"], "rsrc", F.col("ldts").isNotNull().alias("stamped"))


@query("src04_inferred_csv_scan", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def _(spark, d):
    path = new_dir(spark, "inferred")
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    lines.write.options(header="false", compression="gzip").csv(path)
    # Without a header the columns are positional.
    return csv_source.read_inferred(spark, path, header=False).toDF("l_orderkey", "l_linenumber", "l_quantity")


@query("src05_layered_glob", with_px("SELECT id, champion FROM px_raw_players", "px_raw_players"))
def _(spark, d):
    glob = csv_source.landing_glob(_landed_players(spark, d), "players")
    return csv_source.read_batch(spark, glob, schemas.raw_schema("players"), "feed").select("id", "champion")


@query("src06_incremental_table_scan", with_px("SELECT id, match_id, role FROM px_raw_players", "px_raw_players"))
def _(spark, d):
    root = _bronze_players(spark, d)
    rows = tables.stream_table(spark, root, "bronze", "players", schemas.bronze_schema("players"))
    out = new_dir(spark, "copy")
    append_available(rows.select("id", "match_id", "role"), out, new_dir(spark, "checkpoint"))
    return spark.read.parquet(out)


@query("src07_static_table_scan", "SELECT o_orderkey, o_totalprice FROM orders")
def _(spark, d):
    root = new_dir(spark, "lake")
    tables.refresh_table(table(spark, d, "orders"), root, "silver", "orders")
    return tables.read_table(spark, root, "silver", "orders").select("o_orderkey", "o_totalprice")


@query("src08_whole_table_with_count", "SELECT count(*) AS n, count(o_orderkey) AS keys FROM orders")
def _(spark, d):
    view = tables.as_view(table(spark, d, "orders"), "src08_orders")
    return view.agg(F.count(F.lit(1)).alias("n"), F.count("o_orderkey").alias("keys"))


# Sinks -----------------------------------------------------------------------------------


@query("snk01_append_stream", with_px(
    "SELECT match_id, count(*) AS n FROM px_raw_players GROUP BY 1", "px_raw_players"))
def _(spark, d):
    # The second run finds nothing new.
    root = _bronze_players(spark, d, runs=2)
    return _bronze(spark, root, "players").groupBy("match_id").agg(F.count(F.lit(1)).alias("n"))


def _pivot(spark, d):
    return gold.matchend_pivot_teamstats(px_intervals(spark, d), px_matches(spark, d))


@query("snk02_refreshed_table", with_px(
    "SELECT s.match_id, s.participant_pos_id, s.minute, p.champion_role FROM px_intervals s "
    "JOIN px_players p ON p.match_id = s.match_id AND p.participant_pos_id = s.participant_pos_id",
    "px_intervals", "px_players"))
def _(spark, d):
    root = new_dir(spark, "lake")
    rows = gold.diff_intervals(px_intervals(spark, d), px_players(spark, d))
    for _ in range(2):  # a refresh replaces the table
        tables.refresh_table(rows, root, "gold", "diff_intervals")
    return tables.read_table(spark, root, "gold", "diff_intervals").select(*PLAYER, "minute", "champion_role")


@query("snk03_logical_view", with_px(
    """SELECT champion_name AS noref_src_champion_name, count(*) AS n FROM px_players p
       WHERE NOT EXISTS (SELECT 1 FROM px_champions c WHERE c.champion_name = p.champion_name)
       GROUP BY 1""", "px_players", "px_champions"))
def _(spark, d):
    view = gold.noref_champion_name(px_players(spark, d), px_champions(spark, d), px_raw_players(spark, d))
    tables.as_view(view, "noref_champion_name")
    return spark.sql("SELECT noref_src_champion_name, count(*) AS n FROM noref_champion_name GROUP BY 1")


@query("snk04_cleaning_view", with_px(
    "SELECT upper(champion) AS champion_name, upper(match_id) AS match_id FROM px_raw_players", "px_raw_players"))
def _(spark, d):
    return px_raw_players(spark, d).transform(silver.clean_players).select("champion_name", "match_id")


_TITLE = "array_to_string(list_transform(string_split({c}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"
_ITEM_HISTORY_SQL = with_px(
    f"""SELECT item_id, {_TITLE.format(c="item_name")} AS item_name, {_TITLE.format(c="item_category")} AS item_category,
               __START_AT AS start_at, __END_AT AS end_at FROM px_items""", "px_items")


def _plain_history(history: DataFrame) -> DataFrame:
    return history.withColumnsRenamed({"__START_AT": "start_at", "__END_AT": "end_at"})


@query("snk05_history_target", with_px(
    f"SELECT item_id, {_TITLE.format(c='item_name')} AS item_name FROM px_items WHERE __END_AT IS NULL", "px_items"))
def _(spark, d):
    # Two deliveries, one stream run after each; the later delivery replaces every item.
    landing, root = new_dir(spark, "landing"), new_dir(spark, "lake")
    rows = px_raw_items(spark, d)
    for day in ("2024-01-01", "2024-01-02"):
        delivery = rows.filter(F.to_date("ldts") == F.lit(day).cast("date"))
        delivery.select(*schemas.RAW_COLUMNS["items_ref"]).write.mode("append").options(
            header="true", compression="gzip"
        ).csv(f"{landing}/{schemas.RAW_FOLDERS['items_ref']}")
        ingest(spark, landing, root, "items_ref")
        refine_history(spark, root, "items_ref")
    return current(read_history(spark, root, "items_ref")).select("item_id", "item_name")


@query("snk06_commented_table", with_px(
    "SELECT match_id, game_duration, winning_team FROM px_matches WHERE match_id IN (SELECT match_id FROM px_intervals)",
    "px_matches", "px_intervals"))
def _(spark, d):
    root = new_dir(spark, "lake")
    tables.refresh_table(
        schemas.conform(_pivot(spark, d), schemas.GOLD["matchend_pivot_teamstats"]), root, "gold", "pivot"
    )
    back = tables.read_table(spark, root, "gold", "pivot")
    commented = [f.name for f in back.schema.fields if f.metadata.get("comment")]
    # Only columns whose comment survived the round trip, and the key.
    return back.select("match_id", *[c for c in ("game_duration", "winning_team") if c in commented])


@query("snk07_clustered_table", with_px(
    "SELECT match_id, participant_pos_id, minute, total_gold FROM px_intervals", "px_intervals"))
def _(spark, d):
    root = new_dir(spark, "lake")
    rows = px_intervals(spark, d).select(*schemas.CLUSTER_BY["silver.intervals"], "total_gold")
    tables.refresh_table(rows, root, "silver", "intervals", schemas.CLUSTER_BY["silver.intervals"])
    return tables.read_table(spark, root, "silver", "intervals")


@query("snk08_declared_key_audit", with_px(
    """SELECT match_id, participant_pos_id, minute, count(*) AS cnt FROM px_intervals
       GROUP BY ALL HAVING count(*) > 1""", "px_intervals"))
def _(spark, d):
    return quality.duplicate_keys(px_intervals(spark, d), schemas.KEYS["silver.intervals"])


# Streams and history -------------------------------------------------------------------------


@query("st01_file_stream_to_bronze", _RAW_PLAYERS_SQL)
def _(spark, d):
    root = _bronze_players(spark, d, runs=2, partitions=4)
    return _bronze(spark, root, "players").select(*schemas.RAW_COLUMNS["players"])


_CLEAN_PLAYERS_SQL = with_px(
    """SELECT upper(match_id) AS match_id, CAST(CAST(participant_id AS DOUBLE) AS INTEGER) AS participant_pos_id,
              CASE team_id WHEN '100' THEN 'BLUE' WHEN '200' THEN 'RED' END AS team, upper(champion) AS champion_name,
              CASE WHEN upper(role) = 'UTILITY' THEN 'SUPPORT' ELSE upper(role) END AS champion_role
       FROM px_raw_players""", "px_raw_players")


@query("st02_table_stream_to_silver", _CLEAN_PLAYERS_SQL)
def _(spark, d):
    root = _bronze_players(spark, d)
    for _ in range(2):
        refine(spark, root, "players")
    return tables.read_table(spark, root, "silver", "players", schemas.SILVER["players"])


# Ties on (key, date) go to the greatest priority; unchanged rows open no version.
_ORDER_HISTORY_SQL = """
    WITH log AS (SELECT o_custkey, o_orderdate, max(o_orderpriority) AS p FROM orders GROUP BY ALL),
    kept AS (
        SELECT * FROM log
        QUALIFY p IS DISTINCT FROM lag(p) OVER (PARTITION BY o_custkey ORDER BY o_orderdate)
    )
    SELECT o_custkey, p AS o_orderpriority, o_orderdate AS start_at,
           lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS end_at
    FROM kept"""


@query("st03_history_batch", _ORDER_HISTORY_SQL)
def _(spark, d):
    return _plain_history(scd2(table(spark, d, "orders"), "o_custkey", "o_orderdate", ["o_orderpriority"]))


@query("st03_history_stream", _ORDER_HISTORY_SQL)
def _(spark, d):
    feed, base = new_dir(spark, "feed"), new_dir(spark, "history")
    # Deliveries in hashed order, so that late changes occur.
    table(spark, d, "orders").repartition(4, F.xxhash64("o_orderkey")).write.parquet(feed)
    orders = spark.readStream.schema(table(spark, d, "orders").schema).option("maxFilesPerTrigger", 2).parquet(feed)
    maintain_history(
        orders, "o_custkey", "o_orderdate", ["o_orderpriority"],
        f"{base}/log", f"{base}/versions", f"{base}/checkpoint",
    )
    return _plain_history(versions(spark, f"{base}/versions", "o_custkey"))


@query("st04_current_version_lookup", f"""
    WITH h AS ({_ORDER_HISTORY_SQL}) SELECT o_custkey, o_orderpriority, start_at FROM h WHERE end_at IS NULL""")
def _(spark, d):
    history = scd2(table(spark, d, "orders"), "o_custkey", "o_orderdate", ["o_orderpriority"])
    return _plain_history(current(history)).drop("end_at")


@query("st05_triggered_run", "SELECT event_id, user_id, event_type FROM events")
def _(spark, d):
    feed, out, checkpoint = (new_dir(spark, label) for label in ("feed", "out", "checkpoint"))
    events = table(spark, d, "events")
    halves = events.select("*", (F.col("event_id") % 2).alias("half"))
    # Each delivery is followed by one triggered run that stops by itself.
    for half in (0, 1):
        halves.filter(F.col("half") == half).drop("half").write.mode("append").parquet(feed)
        rows = spark.readStream.schema(events.schema).parquet(feed)
        append_available(rows.select("event_id", "user_id", "event_type"), out, checkpoint)
    return spark.read.parquet(out)


# Cleaning --------------------------------------------------------------------------------------


def _cleaned(raw: DataFrame, name: str) -> DataFrame:
    return quality.keep_valid(silver.CLEANERS[name](raw), EXPECTATIONS[f"silver.{name}"])


@query("cl01_items", _ITEM_HISTORY_SQL)
def _(spark, d):
    key, tracked = silver.HISTORIES["items_ref"]
    return _plain_history(scd2(_cleaned(px_raw_items(spark, d), "items_ref"), key, "ldts", tracked))


@query("cl02_champions", with_px(
    "SELECT champion_id, champion_name, __START_AT AS start_at, __END_AT AS end_at FROM px_champions", "px_champions"))
def _(spark, d):
    key, tracked = silver.HISTORIES["champions_ref"]
    return _plain_history(scd2(_cleaned(px_raw_champions(spark, d), "champions_ref"), key, "ldts", tracked))


def _ban_sql(column: str) -> str:
    number = "try_cast(trim(e) AS INTEGER)"
    bans = f"list_transform(string_split({column}, ','), lambda e: CASE WHEN {number} = -1 THEN 0 ELSE {number} END)"
    return f"array_to_string(list_transform({bans}, lambda e: coalesce(CAST(e AS VARCHAR), 'null')), ',') AS {column}"


@query("cl03_matches", with_px(
    f"""SELECT upper(match_id) AS match_id, CASE winning_team WHEN '100' THEN 'BLUE' WHEN '200' THEN 'RED' END AS winning_team,
               CAST(round(CAST(game_duration AS DOUBLE)) AS INTEGER) AS game_duration,
               try_cast(game_date AS TIMESTAMP) AS game_date, game_version,
               {_TITLE.format(c="average_rank")} AS average_rank, {_ban_sql("blue_bans")}, {_ban_sql("red_bans")}
        FROM px_raw_matches WHERE winning_team IN ('100', '200')""", "px_raw_matches"))
def _(spark, d):
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), ",", "null")
    return _cleaned(px_raw_matches(spark, d), "matches").withColumns(
        {"blue_bans": text("blue_bans"), "red_bans": text("red_bans")}
    )


@query("cl04_players", _CLEAN_PLAYERS_SQL)
def _(spark, d):
    return _cleaned(px_raw_players(spark, d), "players")


_INT_COLUMNS = schemas.PLAYER_MEASURES + schemas.PLAYER_DIFFS + schemas.TEAM_MEASURES


@query("cl05_intervals", with_px(
    f"""SELECT upper(match_id) AS match_id, (CAST(player_id AS INTEGER) - 1) % 10 + 1 AS participant_pos_id,
               CASE WHEN (CAST(player_id AS INTEGER) - 1) % 10 + 1 <= 5 THEN 'BLUE' ELSE 'RED' END AS team,
               CAST(minute AS INTEGER) AS minute,
               {", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in _INT_COLUMNS)},
               {", ".join(f"nullif(CAST({c} AS INTEGER), 0) AS {c}" for c in schemas.ITEM_SLOTS)}
        FROM px_raw_intervals""", "px_raw_intervals"))
def _(spark, d):
    return _cleaned(px_raw_intervals(spark, d), "intervals")


# Data quality ------------------------------------------------------------------------------------


@query("dq01_drop_rules", with_px(
    """SELECT upper(match_id) AS match_id FROM px_raw_matches WHERE winning_team IN ('100', '200')""", "px_raw_matches"))
def _(spark, d):
    rows = quality.enforce(silver.clean_matches(px_raw_matches(spark, d)), "dq01", EXPECTATIONS["silver.matches"])
    return rows.select("match_id")


@query("dq01_rejected_rows", with_px(
    """SELECT upper(match_id) AS match_id, 'valid_winning_team' AS violated FROM px_raw_matches
       WHERE winning_team NOT IN ('100', '200')""", "px_raw_matches"))
def _(spark, d):
    rows = quality.rejected(silver.clean_matches(px_raw_matches(spark, d)), EXPECTATIONS["silver.matches"])
    return rows.select("match_id", F.array_join("violated", ",").alias("violated"))


@query("dq02_rule_metrics", with_px(
    f"""WITH t AS (
        SELECT count(*) AS rows, 0 AS valid_match_id,
               count(*) FILTER (WHERE winning_team NOT IN ('100', '200')) AS valid_winning_team,
               count(*) FILTER (WHERE NOT coalesce(CAST(game_duration AS DOUBLE) BETWEEN 0 AND 10800, false)) AS ok_game_duration,
               count(*) FILTER (WHERE NOT coalesce(CAST(game_date AS TIMESTAMP) BETWEEN TIMESTAMP '2009-10-27'
                   AND now()::TIMESTAMP, false)) AS ok_game_date,
               count(*) FILTER (WHERE NOT regexp_matches(game_version, '^[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+$')) AS ok_game_version
        FROM px_raw_matches
    ), u AS (UNPIVOT t ON valid_match_id, valid_winning_team, ok_game_duration, ok_game_date, ok_game_version
             INTO NAME rule VALUE violations)
    SELECT rule, CASE WHEN rule LIKE 'valid%' THEN 'drop' ELSE 'warn' END AS action, rows, violations,
           {ratio_sql("rows - violations", "rows")} AS pass_rate FROM u""", "px_raw_matches"))
def _(spark, d):
    return quality.audit(silver.clean_matches(px_raw_matches(spark, d)), EXPECTATIONS["silver.matches"])


@query("dq03_duplicate_keys", """
    SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def _(spark, d):
    return quality.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq04_unresolved_with_source", """
    SELECT d.source, d.lang, count(*) AS n FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY ALL""")
def _(spark, d):
    missing = unresolved(table(spark, d, "documents").select("doc_id", "source", "lang"), table(spark, d, "labels"), "doc_id")
    return missing.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"))


@query("dq05_staleness", with_px(
    f"""WITH {PLAYER_STATS_CTE} SELECT match_id, participant_pos_id, unlogged_duration FROM player_stats""", *_PX_STATS))
def _(spark, d):
    return player_stats(spark, d, with_build=False).select(*PLAYER, "unlogged_duration")


def stats_table(spark: SparkSession, d: str) -> DataFrame:
    """Player statistics written once, as the analyses read them several times."""
    return written(player_stats(spark, d, with_build=False), "stats")


@query("dq06_quality_summary", with_px(
    f"""WITH {PLAYER_STATS_CTE}
    SELECT count(*) AS total_rows, count(DISTINCT match_id) AS total_matches,
           count(*) - count(DISTINCT match_id || '|' || participant_pos_id) AS duplicate_keys,
           {round_sql("avg(CASE WHEN unlogged_duration > 120 THEN 100.0 ELSE 0 END)", 4)} AS stale_pct,
           CAST(median(unlogged_duration) AS DOUBLE) AS median_staleness FROM player_stats""", *_PX_STATS))
def _(spark, d):
    return quality_summary(stats_table(spark, d), PLAYER).withColumn("stale_pct", F.round("stale_pct", 4))
