"""Random and repeatable samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenalake.functions.scalars import key_fraction


def random_rows(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """n random rows; planned as a distributed top-n, not a full sort."""
    return df.orderBy(F.rand(seed) if seed is not None else F.rand()).limit(n)


def hashed_rows(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """n rows in the order of their hashed key: the same rows on every run."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return df.orderBy(F.md5(text), *keys).limit(n)


def hashed_fraction(df: DataFrame, keys: list[str], fraction: float, seed: int = 42) -> DataFrame:
    """About `fraction` of the rows, chosen by key hash; a filter, so no shuffle."""
    return df.filter(key_fraction(*keys, seed=seed) < F.lit(float(fraction)))


def hashed_split(
    df: DataFrame, keys: list[str], test_size: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; every row lands in exactly one of them."""
    spot = key_fraction(*keys, seed=seed)
    return df.filter(spot >= F.lit(test_size)), df.filter(spot < F.lit(test_size))
