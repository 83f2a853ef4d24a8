"""Modes, shares, top-k per group and distinct membership, all on pre-aggregated counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def counts(df: DataFrame, keys: list[str], name: str = "cnt", weight: str | None = None) -> DataFrame:
    """Rows (or summed weight) per key."""
    total = F.sum(weight) if weight else F.count(F.lit(1))
    return df.groupBy(*keys).agg(total.alias(name))


def mode_by(
    counted: DataFrame, keys: list[str], value: str, cnt: str = "cnt", extra: list[Column] | None = None
) -> DataFrame:
    """Most frequent value per key and its share; the smallest value wins a tie.

    `extra` aggregates ride along, so that one pass serves the mode and other totals.
    """
    best = F.min_by(F.col(value), F.struct((-F.col(cnt)).alias("neg"), F.col(value).alias("v")))
    return counted.groupBy(*keys).agg(
        best.alias(value),
        F.round(F.try_divide(F.max(cnt), F.sum(cnt)), 4).alias("share"),
        *(extra or []),
    )


def share_of_total(counted: DataFrame, keys: list[str], cnt: str = "cnt", name: str = "share") -> DataFrame:
    """Each row's share of its group's total."""
    total = F.sum(cnt).over(Window.partitionBy(*keys))
    return counted.withColumn(name, F.round(F.try_divide(F.col(cnt), total), 4))


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """First k rows per key. Spark cuts each map task to k rows per key before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(rank, place).filter(F.col(rank) <= k)


def ranks_to_columns(
    ranked: DataFrame, keys: list[str], value: str, k: int, prefix: str, rank: str = "rank"
) -> DataFrame:
    """Rank 1..k of `value` as columns `<prefix>1..k`."""
    return ranked.groupBy(*keys).agg(
        *[F.max(F.when(F.col(rank) == i, F.col(value))).alias(f"{prefix}{i}") for i in range(1, k + 1)]
    )


def distinct_members(df: DataFrame, key: str, arrays: list[str], name: str) -> DataFrame:
    """Distinct (key, member) over several array columns in one scan."""
    empty = F.array().cast("array<int>")
    both = F.concat(*[F.coalesce(F.col(a), empty) for a in arrays])
    return df.select(key, F.explode(F.array_distinct(both)).alias(name)).distinct()


def slot_pairs(slots: list[str]) -> Column:
    """Array of unordered pairs `(lo, hi)` of different values over fixed slots of one row.

    The slot count bounds the array, and everything is plain generated code: no
    self-join and no shuffle before the pairs are counted.
    """
    pairs = [
        F.when(
            F.col(a) != F.col(b),
            F.struct(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")),
        )
        for i, a in enumerate(slots)
        for b in slots[i + 1:]
    ]
    return F.array(*pairs)
