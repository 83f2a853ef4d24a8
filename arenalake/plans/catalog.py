"""Registry of named queries and the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from arenalake.functions.scalars import ITEM_TIERS

# Category -> tier as a map literal.
TIER_SQL = "map {" + ", ".join(f"'{name}': {rank}" for rank, name in enumerate(ITEM_TIERS, start=1)) + "}"

Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        """Register the decorated function; `sql` is its comparison query, if SQL can express it."""

        def register(fn: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"duplicate query {name}")
            self.queries[name] = fn
            if sql is not None:
                self.oracles[name] = sql.strip()
            return fn

        return register


def ratio_sql(num: str, den: str, digits: int = 4) -> str:
    """num / den rounded half up, exact in integers; NULL when den is 0. For non-negative counts."""
    scale = 10**digits
    return (
        f"CASE WHEN ({den}) > 0 THEN CAST((2 * CAST({num} AS HUGEINT) * {scale} + ({den})) "
        f"// (2 * ({den})) AS DOUBLE) / {scale} END"
    )


def round_sql(expr: str, digits: int) -> str:
    """Round half away from zero; the small nudge undoes binary noise right below a half."""
    scale = 10**digits
    return f"(sign({expr}) * floor(abs({expr}) * {scale} + 0.5 + 1e-7) / {scale})"
