"""Triggered micro-batch runs: files to bronze, bronze to silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from arenalake import schemas
from arenalake.operators.quality import Expectation, enforce
from arenalake.plans.contracts import EXPECTATIONS
from arenalake.plans.silver import CLEANERS
from arenalake.sources.csv import RECORD_SOURCE, raw_stream
from arenalake.sources.tables import stream_table, table_path


# Landed (compressed) bytes a writing task gets where few tasks write a micro-batch.
SPREAD_BYTES = 32 << 20

# Batch number -> observed metrics by name.
Observed = dict[int, dict[str, dict[str, int]]]


def _observe(query: StreamingQuery, seen: Observed) -> None:
    for progress in query.recentProgress:
        metrics = {name: row.asDict() for name, row in progress.observedMetrics.items() if row is not None}
        seen[progress.batchId] = {**seen.get(progress.batchId, {}), **metrics}


def append_available(df: DataFrame, path: str, checkpoint: str, seen: Observed | None = None) -> StreamingQuery:
    """Append everything available now, then stop. Rerunning adds only new input.

    Spark keeps the newest progress entries only; `seen` is filled every second while the run lasts, so
    no batch is missed however many there are.
    """
    query = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    seen = {} if seen is None else seen
    while not query.awaitTermination(1):
        _observe(query, seen)
    _observe(query, seen)
    return query


def checkpoint_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/_checkpoints/{layer}/{table}"


def ingest(
    spark: SparkSession,
    landing: str,
    root: str,
    table: str,
    record_source: str = RECORD_SOURCE,
    partitions: int | None = None,
) -> StreamingQuery:
    """Land new files of one source in bronze.

    A gzip file is one task; `partitions` spreads the rows of few large files before writing. So few tasks take
    a bounded micro-batch at a time, however much has landed.
    """
    rows = raw_stream(spark, landing, table, record_source, partitions * SPREAD_BYTES if partitions else None)
    if partitions:
        rows = rows.repartition(partitions)
    return append_available(rows, table_path(root, "bronze", table), checkpoint_path(root, "bronze", table))


def rule_counts(seen: Observed, name: str) -> dict[str, int]:
    """Observed metrics of a run, summed over its micro-batches."""
    totals: dict[str, int] = {}
    for metrics in seen.values():
        for field, value in metrics.get(name, {}).items():
            totals[field] = totals.get(field, 0) + value
    return totals


def refine(
    spark: SparkSession, root: str, table: str, rules: list[Expectation] | None = None
) -> dict[str, int]:
    """Clean new bronze rows into silver and return the rule violation counts."""
    rules = EXPECTATIONS[f"silver.{table}"] if rules is None else rules
    raw = stream_table(spark, root, "bronze", table, schemas.bronze_schema(table))
    rows = schemas.conform(enforce(CLEANERS[table](raw), table, rules), schemas.SILVER[table])
    seen: Observed = {}
    append_available(rows, table_path(root, "silver", table), checkpoint_path(root, "silver", table), seen)
    return rule_counts(seen, table)
