"""Type 2 history kept up to date by a stream, key by key.

A micro-batch adds its cleaned changes to a log and reads back the log of its own keys only; the versions of these
keys are computed anew and become a new part of the version table, which replaces what older parts say about them. All
other keys' versions stay where they are. Late changes land in the right place because a key's versions always
come from its whole log. Parts of one level are merged into one of the next when there are enough of them, so a row
is rewritten a number of times that grows with the logarithm of the batches.

Log and table are named by manifests: readers see a batch entirely or not at all, and a batch that is delivered again
finds its number in the manifest and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arenalake import schemas
from arenalake.operators.quality import keep_valid
from arenalake.operators.scd2 import scd2
from arenalake.plans.contracts import EXPECTATIONS
from arenalake.plans.silver import CLEANERS, HISTORIES
from arenalake.sources.tables import stream_table, table_path
from arenalake.sources.versions import Part, by_key, commit, merge_due, new_part, newest, read_part
from arenalake.streaming.ingest import checkpoint_path
from arenalake.workspace import written

FAN = 4  # parts of a level that become one of the next


def _laid(df: DataFrame, key: str) -> DataFrame:
    """Sorted by key, so that a read for some keys skips row groups."""
    return df.repartitionByRange(key).sortWithinPartitions(key)


def _merged(spark: SparkSession, path: str, parts: list[Part], rows_of) -> list[Part]:
    """`parts` with neighbours of one level merged, from the lowest level up."""
    while due := merge_due(parts, FAN):
        whole = new_part(rows_of(tuple(due)), path, max(p.order for p in due), due[0].level + 1)
        parts = sorted([p for p in parts if p not in due] + [whole], key=lambda p: p.order)
    return parts


def add_changes(spark: SparkSession, rows: DataFrame, batch_id: int, key: str, sequence: str, tracked: list[str], log_path: str, history_path: str) -> None:
    """Fold one batch of changes (key, sequence, tracked...) into log and version table."""
    log, table = newest(spark, log_path), newest(spark, history_path)
    if table is not None and batch_id <= table.batch:
        return
    changes = rows.filter(F.col(key).isNotNull()).select(key, sequence, *tracked).dropDuplicates()
    keys = changes.select(key).distinct()
    # A batch that failed between its two manifests is in the log already.
    if log is None or log.batch < batch_id:
        mine = new_part(_laid(changes, key), log_path, batch_id)
        keys = written(read_part(spark, log_path, mine).select(key).distinct(), "keys")
        distinct = lambda parts: _laid(_all(spark, log_path, parts).dropDuplicates(), key)
        commit(spark, log_path, log, _merged(spark, log_path, [*(log.parts if log else ()), mine], distinct), batch_id)
    whole = _all(spark, log_path, newest(spark, log_path).parts).join(keys, key, "left_semi")
    fresh = new_part(_laid(scd2(whole, key, sequence, tracked), key), history_path, batch_id)
    live = lambda parts: _laid(by_key(spark, history_path, parts, key), key)
    parts = _merged(spark, history_path, [*(table.parts if table else ()), fresh], live)
    commit(spark, history_path, table, parts, batch_id)


def _all(spark: SparkSession, path: str, parts: tuple[Part, ...]) -> DataFrame:
    return spark.read.parquet(*[f"{path}/{p.name}" for p in parts])


def maintain_history(
    changes: DataFrame, key: str, sequence: str, tracked: list[str], log_path: str, history_path: str, checkpoint: str
) -> None:
    """Consume the change stream `changes` and bring the version table at `history_path` up to date."""

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        add_changes(batch.sparkSession, batch, batch_id, key, sequence, tracked, log_path, history_path)

    query = (
        changes.writeStream.foreachBatch(apply_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def refine_history(spark: SparkSession, root: str, table: str) -> None:
    """Fold new bronze reference rows into the silver history."""
    key, tracked = HISTORIES[table]
    raw = stream_table(spark, root, "bronze", table, schemas.bronze_schema(table))
    changes = keep_valid(CLEANERS[table](raw), EXPECTATIONS[f"silver.{table}"])
    maintain_history(
        changes, key, "ldts", tracked,
        table_path(root, "silver", f"_{table}_changes"),
        table_path(root, "silver", table),
        checkpoint_path(root, "silver", table),
    )


def versions(spark: SparkSession, history_path: str, key: str) -> DataFrame:
    """All versions of the table at `history_path`."""
    return by_key(spark, history_path, newest(spark, history_path).parts, key)


def read_history(spark: SparkSession, root: str, table: str) -> DataFrame:
    rows = versions(spark, table_path(root, "silver", table), HISTORIES[table][0])
    return schemas.conform(rows, schemas.SILVER[table])
