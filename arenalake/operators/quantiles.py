"""Exact percentiles that never gather a group in one task.

Distinct values are counted (one map-side combined aggregate), laid out in order over slices, and each
slice is counted per group. Running totals over these few slice rows tell which slice holds a wanted
rank, and only there are values totalled one by one. The same three steps serve every size and every
range of values, so infinities and values near the limits of a double need no care.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arenalake.workspace import written


def measured(df: DataFrame) -> DataFrame:
    """Write a small aggregate once, so that the planner sees its true size and no lineage.

    Spark then broadcasts it only if it is under `autoBroadcastJoinThreshold`; a larger one is
    joined by shuffle.
    """
    return written(df, "measured")


def exact_percentiles(
    df: DataFrame,
    value: str,
    probs: dict[str, float],
    by: list[str] | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Linear-interpolation percentiles of `value`, one column per entry of `probs`.

    NULL and NaN are missing values and left out, as are NULL groups. Between an infinite and a finite
    neighbour the result is infinite, between two opposite infinities NaN.
    """
    groups = by or ["__all"]
    rows = df if by else df.withColumn("__all", F.lit(0))
    present = F.col("__v").isNotNull() & ~F.isnan("__v")
    for group in groups:
        present = present & F.col(group).isNotNull()
    counted = written(
        rows.select(*groups, F.col(value).cast("double").alias("__v")).filter(present)
        .groupBy(*groups, "__v").agg(F.count(F.lit(1)).alias("c")),
        "values",
    )
    # Slices are ranges of (group, value); written, because later jobs must see the same ones.
    ranged = counted.repartitionByRange(slices, *groups, "__v") if slices else counted.repartitionByRange(*groups, "__v")
    sliced = written(ranged.withColumn("slice", F.spark_partition_id()), "slices")
    totals = sliced.groupBy(*groups, "slice").agg(F.sum("c").alias("c"))
    so_far = Window.partitionBy(*groups).orderBy("slice")
    spans = totals.select(
        *groups, "slice", F.sum("c").over(Window.partitionBy(*groups)).alias("n"), F.sum("c").over(so_far).alias("end"),
        (F.sum("c").over(so_far) - F.col("c")).alias("begin"),
    )
    # Two neighbouring ranks per percentile.
    spot = lambda p: (F.col("n") - 1) * F.lit(float(p))
    ranks = F.array(*[
        F.struct(F.lit(f"{name}{side}").alias("rank"), pick(spot(p)).cast("long").alias("k"))
        for name, p in probs.items() for side, pick in (("_low", F.floor), ("_high", F.ceil))
    ])
    targets = measured(
        spans.select(*groups, "slice", "n", "begin", "end", F.inline(ranks)).filter("k >= begin AND k < end")
        .select(*groups, "slice", "n", "rank", (F.col("k") - F.col("begin")).alias("k"))
    )
    wanted = targets.select(*groups, "slice").distinct()
    inside = Window.partitionBy(*groups, "slice").orderBy("__v")
    found = (
        sliced.join(wanted, [*groups, "slice"], "left_semi")
        .withColumn("upto", F.sum("c").over(inside))
        .join(targets, [*groups, "slice"])
        .filter((F.col("k") < F.col("upto")) & (F.col("k") >= F.col("upto") - F.col("c")))
    )
    answer = lambda rank: F.max(F.when(F.col("rank") == rank, F.col("__v")))
    cells = []
    for name, p in probs.items():
        low, high, part = answer(f"{name}_low"), answer(f"{name}_high"), F.max(spot(p) - F.floor(spot(p)))
        # Two products instead of a difference: a range wider than a double must not overflow.
        cells.append(F.when((low == high) | (part == 0), low).otherwise(low * (1 - part) + high * part).alias(name))
    return found.groupBy(*groups).agg(*cells).select(*(by or []), *probs)


def medians(df: DataFrame, value: str, by: list[str] | None = None, name: str = "median") -> DataFrame:
    """Exact median per group."""
    return exact_percentiles(df, value, {name: 0.5}, by)
