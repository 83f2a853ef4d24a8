"""Latest-row-per-key operators.

Each is one aggregate over `max(struct(...))`: map tasks already keep a single candidate per
key, so a key that holds a large share of the rows shuffles one row per map task. The struct
lists every remaining column, which makes the choice among ties repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_snapshot(df: DataFrame, keys: list[str], order: str, columns: list[str] | None = None) -> DataFrame:
    """One row per key: the greatest `order`, ties broken by the other columns."""
    rest = columns or [c for c in df.columns if c not in keys and c != order]
    newest = df.groupBy(*keys).agg(F.max(F.struct(order, *rest)).alias("__last"))
    return newest.select(*keys, "__last.*")


def last_per_side(
    df: DataFrame, key: str, side: str, sides: list[str], order: str, columns: list[str]
) -> DataFrame:
    """One row per key with a struct per side holding that side's latest row.

    Also returns `last_<order>`, the maximum over the sides. Latest row, de-duplication and
    pivot happen in the same aggregate, so there is a single shuffle.
    """
    row = F.struct(order, *columns)
    wide = df.groupBy(key).agg(*[F.max(F.when(F.col(side) == name, row)).alias(name.lower()) for name in sides])
    latest = F.greatest(*[F.col(f"{name.lower()}.{order}") for name in sides])
    return wide.withColumn(f"last_{order}", latest)


def pivot_max(df: DataFrame, key: str, side: str, sides: list[str], measures: dict[str, str]) -> DataFrame:
    """Conditional-max pivot: `<side>_<name>` for every side and measure."""
    cells: list[Column] = [
        F.max(F.when(F.col(side) == value, F.col(source))).alias(f"{value.lower()}_{name}")
        for name, source in measures.items()
        for value in sides
    ]
    return df.groupBy(key).agg(*cells)
