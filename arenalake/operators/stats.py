"""Exploratory statistics as small DataFrames: the numbers behind each summary and chart."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenalake.functions import scalars as S
from arenalake.operators.quality import surplus_rows
from arenalake.operators.quantiles import exact_percentiles, measured, medians
from arenalake.operators.sampling import hashed_fraction

# Seconds after which a row counts as stale, and the correlated columns.
STALE_SECONDS = 120
CORRELATED = ["kills", "deaths", "assists", "cs", "total_gold", "level", "win"]

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def quality_summary(
    df: DataFrame,
    keys: list[str],
    entity: str = "match_id",
    staleness: str = "unlogged_duration",
    stale_after: int = STALE_SECONDS,
) -> DataFrame:
    """One row: rows, distinct entities, surplus key rows, stale share (of all rows), median staleness."""
    stale = F.when(F.col(staleness) > stale_after, 1.0).otherwise(0.0)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(entity).alias("total_matches"),
        (F.avg(stale) * 100).alias("stale_pct"),
    ).select(
        "*",
        surplus_rows(df, keys).scalar().alias("duplicate_keys"),
        medians(df, staleness).scalar().alias("median_staleness"),
    )


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between minimum and maximum with their counts; the last bin is closed."""
    v = F.col(value).cast("double")
    span = df.agg(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"))).scalar()
    # A constant column gets a unit-wide range around it.
    flat = F.when(span["lo"] == span["hi"], F.lit(0.5)).otherwise(F.lit(0.0))
    low = span["lo"] - flat
    width = (span["hi"] + flat - low) / bins
    spot = F.least(F.floor((v - low) / width), F.lit(bins - 1)).cast("int")
    filled = df.filter(v.isNotNull()).groupBy(spot.alias("bin")).agg(F.count(F.lit(1)).alias("cnt"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(filled, "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("bin_start"),
        (low + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("cnt", F.lit(0)).alias("cnt"),
    )


def _grouped(df: DataFrame, group: str) -> DataFrame:
    return df.filter(F.col(group).isNotNull())


def win_rate_by(df: DataFrame, group: str, outcome: str = "win") -> DataFrame:
    """Win percentage per group, best first."""
    rate = (F.avg(F.col(outcome).cast("int")) * 100).alias("win_rate")
    return _grouped(df, group).groupBy(group).agg(rate).orderBy(F.desc("win_rate"))


def kda_by(df: DataFrame, group: str) -> DataFrame:
    """Median, sample deviation and count of the KDA ratio per group, widest spread first."""
    ratios = _grouped(df, group).select(group, S.kda().alias("kda_ratio"))
    spread = ratios.groupBy(group).agg(F.stddev_samp("kda_ratio").alias("std"), F.count("kda_ratio").alias("count"))
    return spread.join(medians(ratios, "kda_ratio", [group]), group, "left").orderBy(F.desc("std"))


def cs_by(df: DataFrame, group: str) -> DataFrame:
    """Median, mean and count of the creep score per group, highest median first."""
    scores = _grouped(df, group).select(group, "cs")
    level = scores.groupBy(group).agg(F.avg("cs").alias("mean"), F.count("cs").alias("count"))
    return level.join(medians(scores, "cs", [group]), group, "left").orderBy(F.desc("median"))


def box_stats(df: DataFrame, value: str, group: str) -> DataFrame:
    """Quartiles and whiskers (farthest values within 1.5 IQR of the box) per group."""
    rows = _grouped(df, group).select(group, F.col(value).cast("double").alias("v")).dropna()
    boxes = measured(exact_percentiles(rows, "v", QUARTILES, [group]))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    kept = F.when(F.col("v").between(F.col("q1") - reach, F.col("q3") + reach), F.col("v"))
    return (
        rows.join(boxes, group)
        .groupBy(group, "q1", "median", "q3")
        .agg(F.min(kept).alias("whisker_low"), F.max(kept).alias("whisker_high"))
    )


def correlation(
    df: DataFrame, x: str, y: str, keys: list[str], fraction: float = 1.0, seed: int = 42
) -> DataFrame:
    """Pearson r of a repeatable sample, labelled strong above 0.5 and moderate otherwise."""
    sample = hashed_fraction(df, keys, fraction, seed) if fraction < 1 else df
    r = F.corr(F.col(x).cast("double"), F.col(y).cast("double"))
    return sample.agg(r.alias("r")).select(
        "r", F.when(F.col("r") > 0.5, F.lit("strong")).otherwise(F.lit("moderate")).alias("strength")
    )


def with_gold_per_minute(df: DataFrame) -> DataFrame:
    """Gold per minute played; NULL for matches without length."""
    return df.withColumn("gold_per_min", F.try_divide(F.col("total_gold"), F.col("game_duration") / 60))


def gold_per_minute(df: DataFrame, outcome: str = "win") -> DataFrame:
    """Mean, median and sample deviation of gold per minute per outcome."""
    rows = _grouped(with_gold_per_minute(df), outcome).select(outcome, "gold_per_min")
    level = rows.groupBy(outcome).agg(
        F.avg("gold_per_min").alias("mean"), F.stddev_samp("gold_per_min").alias("std")
    )
    return level.join(medians(rows, "gold_per_min", [outcome]), outcome, "left")


def outcome_gap(per_outcome: DataFrame, outcome: str = "win") -> DataFrame:
    """One row: winner and loser median, their difference and the difference in percent."""
    of = lambda flag: F.max(F.when(F.col(outcome) == flag, F.col("median")))
    gap = F.col("win_median") - F.col("loss_median")
    return per_outcome.agg(of(True).alias("win_median"), of(False).alias("loss_median")).select(
        "*", gap.alias("gap"), (F.try_divide(gap, F.col("loss_median")) * 100).alias("gap_pct")
    )


def outcome_quartiles(df: DataFrame, value: str, outcome: str = "win") -> DataFrame:
    """Quartiles of a value per outcome."""
    return exact_percentiles(df, value, QUARTILES, [outcome])


def _number(name: str) -> Column:
    # Booleans count as 0/1.
    return F.col(name).cast("int").cast("double") if name == "win" else F.col(name).cast("double")


def correlation_matrix(df: DataFrame, columns: list[str] = CORRELATED) -> DataFrame:
    """All pairwise correlations as rows `(a, b, r)`, from one aggregate over the table."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[F.corr(_number(a), _number(b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = [F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"), F.lit(1.0).alias("r")) for c in columns]
    for i, (a, b) in enumerate(pairs):
        for left, right in ((a, b), (b, a)):
            cells.append(F.struct(F.lit(left).alias("a"), F.lit(right).alias("b"), F.col(f"r{i}").alias("r")))
    return wide.select(F.inline(F.array(*cells)))


def outcome_drivers(matrix: DataFrame, outcome: str = "win") -> DataFrame:
    """One row: the columns most positively and most negatively correlated with the outcome."""
    others = matrix.filter((F.col("a") == outcome) & (F.col("b") != outcome))
    return others.agg(
        F.max_by("b", "r").alias("top_positive"), F.max("r").alias("positive_r"),
        F.min_by("b", "r").alias("top_negative"), F.min("r").alias("negative_r"),
    )
