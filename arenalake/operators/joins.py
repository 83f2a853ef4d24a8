"""Join helpers: current-version lookups, unresolved references, and hot-key spreading.

Joins on keys that cannot be hot (a match has ten seats) are plain equi-joins, which AQE splits where
a partition is skewed; `HotKeys` is for keys that can hold a large share of a side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenalake.workspace import written

SALT = "__salt"


def current(dimension: DataFrame) -> DataFrame:
    """Open versions of a type 2 dimension."""
    return dimension.filter(F.col("__END_AT").isNull())


def lookup(facts: DataFrame, dimension: DataFrame, on: str, how: str = "left") -> DataFrame:
    """Join to the open versions of a dimension.

    There is no broadcast hint: Spark broadcasts the dimension while its measured size is
    under `autoBroadcastJoinThreshold` and otherwise falls back to a skew-split sort-merge join.
    """
    return facts.join(current(dimension).drop("__START_AT", "__END_AT"), on, how)


def unresolved(facts: DataFrame, dimension: DataFrame, on: str) -> DataFrame:
    """Rows without a match in the dimension; a NULL key counts as unresolved."""
    return facts.join(dimension.select(on), on, "left_anti")


class HotKeys:
    """Spread the frequent values of one join key over several tasks.

    The frequent values come from `freqItems` (at most `1 / support` of them, and every value
    above that share is found). The list is written once, so both sides read the same one, and used
    as a scalar subquery, so nothing is collected to the driver. One side goes through `spread`, the other through `replicate`, and both join on the
    key columns plus `SALT`. The result is exactly that of the plain join.

    The salt is a hash of the row and of the file split it was read from. It does not depend on
    row order, so a rerun task repeats it, and equal rows still differ by split. Equal rows that
    share a salt are left to AQE: the salt makes both join inputs plain shuffles it can split.
    """

    def __init__(self, df: DataFrame, key: str, support: float = 0.02, salts: int = 32):
        self.key, self.salts = key, salts
        self._frequent = written(df.select(key).stat.freqItems([key], support), "hot-keys").scalar()

    def _is_hot(self) -> Column:
        return F.coalesce(F.array_contains(self._frequent, F.col(self.key)), F.lit(False))

    def spread(self, df: DataFrame, from_scan: bool = True) -> DataFrame:
        """Add the salt. Pass `from_scan=False` for a frame built from several sources."""
        parts = [F.col(c) for c in df.columns]
        if from_scan:
            parts += [F.input_file_name(), F.input_file_block_start()]
        salt = F.pmod(F.xxhash64(*parts), F.lit(self.salts)).cast("int")
        return df.withColumn(SALT, F.when(self._is_hot(), salt).otherwise(F.lit(0)))

    def replicate(self, df: DataFrame) -> DataFrame:
        every = F.sequence(F.lit(0), F.lit(self.salts - 1))
        return df.withColumn(SALT, F.explode(F.when(self._is_hot(), every).otherwise(F.array(F.lit(0)))))


def spread_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", from_scan: bool = True
) -> DataFrame:
    """Equi-join that stays balanced when one value of `on[0]` dominates `left`."""
    hot = HotKeys(left, on[0])
    return hot.spread(left, from_scan).join(hot.replicate(right), on + [SALT], how).drop(SALT)


def trace_back(findings: DataFrame, raw: DataFrame, on: list[str]) -> DataFrame:
    """Attach the raw-layer rows (already carrying cleaned keys) a finding came from."""
    return findings.join(raw, on)
