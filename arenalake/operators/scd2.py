"""Type 2 history from a change log.

Rules: rows without a key are ignored; of several rows with one (key, sequence) the greatest
tracked values win; a change equal to its predecessor opens no version; arrival order does not
matter. The neighbour of a change is found in two steps, first inside a time slice of its key
and then across slices through one summary row per slice, so a key with very many changes is
sorted slice by slice instead of in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_SLICE, _ROW = "__slice", "__row"


def scd2(changes: DataFrame, key: str, sequence: str, tracked: list[str], slice_unit: str = "month") -> DataFrame:
    """Versions `(key, tracked..., __START_AT, __END_AT)`; the open version has a NULL end."""
    in_slice = Window.partitionBy(key, _SLICE).orderBy(sequence)
    over_slices = Window.partitionBy(key).orderBy(_SLICE)

    # One row per key and sequence; copies collapse before the shuffle.
    log = (
        changes.filter(F.col(key).isNotNull() & F.col(sequence).isNotNull())
        .groupBy(key, sequence)
        .agg(F.max(F.struct(*tracked)).alias(_ROW))
        .withColumn(_SLICE, F.date_trunc(slice_unit, F.col(sequence)))
    )

    slice_ends = log.groupBy(key, _SLICE).agg(F.max_by(_ROW, sequence).alias("__tail"))
    before = slice_ends.select(key, _SLICE, F.lag("__tail").over(over_slices).alias("__before"))
    predecessor = F.coalesce(F.col("__prev"), F.col("__before"))
    kept = (
        log.withColumn("__prev", F.lag(_ROW).over(in_slice))
        .join(before, [key, _SLICE])
        .filter(~F.col(_ROW).eqNullSafe(predecessor))
        .select(key, _SLICE, sequence, _ROW)
    )

    slice_starts = kept.groupBy(key, _SLICE).agg(F.min(sequence).alias("__head"))
    after = slice_starts.select(key, _SLICE, F.lead("__head").over(over_slices).alias("__after"))
    return (
        kept.withColumn("__next", F.lead(sequence).over(in_slice))
        .join(after, [key, _SLICE])
        .select(
            key,
            *[F.col(f"{_ROW}.{c}").alias(c) for c in tracked],
            F.col(sequence).alias("__START_AT"),
            F.coalesce("__next", "__after").alias("__END_AT"),
        )
    )
