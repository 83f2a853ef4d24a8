"""Run the layers in order: landed files -> bronze -> silver -> gold."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from arenalake import schemas
from arenalake.operators.quality import audit, keep_valid, surplus_rows
from arenalake.plans import gold
from arenalake.plans.contracts import EXPECTATIONS
from arenalake.plans.silver import HISTORIES
from arenalake.sources.csv import RECORD_SOURCE
from arenalake.sources.tables import as_view, read_table, refresh_table, remove_folder, save_bucketed, subfolders
from arenalake.streaming.history import read_history, refine_history
from arenalake.streaming.ingest import ingest, refine
from arenalake.workspace import written

FACTS = ["matches", "players", "intervals"]


def silver_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    if table in HISTORIES:
        return read_history(spark, root, table)
    return read_table(spark, root, "silver", table, schemas.SILVER[table])


def checked(rows: DataFrame, table: str) -> tuple[DataFrame, dict[str, int]]:
    """Rows that satisfy the drop rules of a table, and how often each of its rules is violated.

    The rows are written first, so that counting does not compute them twice; one row per rule comes back.
    """
    rules = EXPECTATIONS.get(f"gold.{table}", [])
    if not rules:
        return rows, {}
    rows = written(rows, table)
    return keep_valid(rows, rules), {r["rule"]: r["violations"] for r in audit(rows, rules).collect()}


def by_match(spark: SparkSession, root: str, buckets: int | None = None) -> list[DataFrame]:
    """Silver matches, players and intervals bucketed by match and sorted by seat.

    Each is exchanged once, here; every gold table then aggregates and joins them where they lie. Bucket files are
    written to a folder of their own, and the folders of an earlier layout are removed once the new one is there.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    mark = uuid.uuid4().hex[:8]
    base = f"{root.rstrip('/')}/gold/_by_match"
    before = subfolders(spark, base)
    laid = []
    for table in FACTS:
        name = f"{table}_by_match_{mark}"
        sort = schemas.CLUSTER_BY[f"silver.{table}"]
        laid.append(save_bucketed(silver_table(spark, root, table), name, ["match_id"], buckets, sort, f"{base}/{mark}/{table}"))
    for old in before:
        for table in FACTS:
            spark.sql(f"DROP TABLE IF EXISTS {table}_by_match_{old}")
        remove_folder(spark, f"{base}/{old}")
    return laid


def refresh_gold(spark: SparkSession, root: str, buckets: int | None = None) -> dict[str, dict[str, int]]:
    """Recompute every gold table from silver; rule violations by table."""
    matches, players, intervals = by_match(spark, root, buckets)
    items, champions = (silver_table(spark, root, t) for t in HISTORIES)
    products = {
        "matchend_player_stats": gold.matchend_player_stats(intervals, matches, players, items),
        "champion_overviews": gold.champion_overviews(matches, players, champions),
        "matchend_pivot_teamstats": gold.matchend_pivot_teamstats(intervals, matches),
        "item_recommendations": gold.unchecked_recommendations(intervals, matches, players, items, seated=True),
        "diff_intervals": gold.diff_intervals(intervals, players),
    }
    counts = {}
    for name, rows in products.items():
        rows, counts[name] = checked(rows, name)
        rows = schemas.conform(rows, schemas.GOLD[name])
        refresh_table(rows, root, "gold", name, schemas.CLUSTER_BY.get(f"gold.{name}"))
    raw_players = read_table(spark, root, "bronze", "players", schemas.bronze_schema("players"))
    # The view outlives the layout by match.
    as_view(gold.noref_champion_name(silver_table(spark, root, "players"), champions, raw_players), "noref_champion_name")
    return counts


def surplus_keys(spark: SparkSession, root: str) -> dict[str, int]:
    """Rows beyond the first of their declared key, by silver and gold table."""
    found = {}
    for name, keys in schemas.KEYS.items():
        layer, table = name.split(".")
        if layer == "bronze":
            continue
        rows = silver_table(spark, root, table) if layer == "silver" else read_table(spark, root, layer, table, schemas.GOLD[table])
        found[name] = surplus_rows(rows, keys).first()[0]
    return found


def run_medallion(
    spark: SparkSession, landing: str, root: str, record_source: str = RECORD_SOURCE
) -> dict[str, dict[str, int]]:
    """Bring every layer up to date; rule violations by table, and surplus keys under `duplicate_keys`."""
    for table in schemas.RAW_COLUMNS:
        ingest(spark, landing, root, table, record_source)
    counts = {table: refine(spark, root, table) for table in FACTS}
    for table in HISTORIES:
        refine_history(spark, root, table)
    counts |= refresh_gold(spark, root)
    counts["duplicate_keys"] = surplus_keys(spark, root)
    return counts
