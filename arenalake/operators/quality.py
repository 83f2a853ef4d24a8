"""Row expectations, their metrics, key uniqueness and completeness reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DROP, WARN = "drop", "warn"


@dataclass(frozen=True)
class Expectation:
    """A named SQL predicate; `action` says whether a violating row is dropped or only counted."""

    name: str
    predicate: str
    action: str = WARN

    def holds(self) -> Column:
        """True only when the predicate is true: NULL counts as a violation."""
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def keep_valid(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    """Rows that satisfy every drop rule."""
    for rule in rules:
        if rule.action == DROP:
            df = df.filter(rule.holds())
    return df


def observed(df: DataFrame, name: str, rules: list[Expectation]) -> DataFrame:
    """Attach one metric per rule (violations) and `rows`; works on batch and streaming frames."""
    metrics = [F.count_if(~rule.holds()).alias(rule.name) for rule in rules]
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *metrics)


def enforce(df: DataFrame, name: str, rules: list[Expectation]) -> DataFrame:
    """Count violations of every rule on the incoming rows, then drop the invalid ones."""
    return keep_valid(observed(df, name, rules), rules)


def rejected(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    """The complement of `keep_valid`, with the names of the drop rules each row violates."""
    drops = [rule for rule in rules if rule.action == DROP]
    names = F.array_compact(F.array(*[F.when(~rule.holds(), F.lit(rule.name)) for rule in drops]))
    return df.withColumn("violated", names).filter(F.size("violated") > 0)


def audit(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    """One row per rule: action, rows seen, violations, pass rate. One pass over the data."""
    totals = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(~rule.holds()).alias(rule.name) for rule in rules]
    )
    lines = F.array(*[
        F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.action).alias("action"),
                 F.col(rule.name).alias("violations"))
        for rule in rules
    ])
    return totals.select("rows", F.inline(lines)).select(
        "rule", "action", "rows", "violations",
        F.round(F.try_divide(F.col("rows") - F.col("violations"), F.col("rows")), 4).alias("pass_rate"),
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")


def surplus_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many rows go beyond the first of their key."""
    per_key = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("extra"))
    return per_key.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicate_keys"))


def null_rates(df: DataFrame) -> DataFrame:
    """Null percentage per column, only columns above 0. One pass, then turned to rows."""
    shares = df.agg(*[(F.avg(F.col(c).isNull().cast("int")) * 100).alias(c) for c in df.columns])
    lines = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_pct")) for c in df.columns
    ])
    return shares.select(F.inline(lines)).filter("null_pct > 0")
