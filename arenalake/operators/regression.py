"""Linear regression from additive sums.

Spark reduces the rows to per-fold cross-products in one pass; everything that follows
(scaling, fits for every fold and penalty, scores) is algebra on matrices as wide as the
feature list. No rows reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenalake.functions.scalars import key_fraction
from arenalake.operators.quantiles import exact_percentiles
from arenalake.operators.sampling import hashed_fraction, hashed_split
from arenalake.operators.stats import histogram

# Preprocessor names, penalty grid, and the modelled columns.
PREPROCESSORS = ["ss", "mms", "dummy"]
ESTIMATORS = ["OLS", "Ridge", "Lasso"]
ALPHA_GRID = [0, 0.01, 0.1, 0.2, 0.5, 1, 2, 5, 10]
MODEL_COLUMNS = [
    "game_duration", "team", "win", "champion_role", "level", "kills", "deaths", "assists", "cs", "total_gold",
]


def select_features(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Fresh rows of full-length matches, outcome as 0/1, only the modelled columns (and keys)."""
    return df.filter("unlogged_duration = 0 AND game_duration > 300").withColumn(
        "win", F.col("win").cast("int")
    ).select(*(keys or []), *MODEL_COLUMNS)


def standardize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace each column by `<name>_ss`, its z-score with the sample deviation."""
    cells = [F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")).alias(c) for c in columns]
    sums = df.agg(F.struct(*cells)).scalar()
    scores = {f"{c}_ss": F.try_divide(F.col(c) - sums[c]["mean"], sums[c]["std"]) for c in columns}
    return df.withColumns(scores).drop(*columns)


def category_levels(df: DataFrame, column: str) -> list:
    """Sorted levels of a categorical column; each but the first becomes a model column."""
    return sorted(row[0] for row in df.select(column).distinct().collect() if row[0] is not None)


@dataclass(frozen=True)
class Feature:
    """One model column: its published name, how it is scaled, and where it comes from."""

    name: str
    kind: str
    source: str
    level: str | None = None

    def value(self) -> Column:
        if self.level is not None:
            return F.when(F.col(self.source) == self.level, 1.0).otherwise(0.0)
        return F.col(self.source).cast("double")


def plan_features(
    df: DataFrame, features: list[str], pp_features: dict[str, list[str]] | None = None
) -> list[Feature]:
    """Scaled columns first, then dummies without their first level, then the rest unchanged."""
    pp_features = pp_features or {}
    unknown = [name for name in pp_features if name not in PREPROCESSORS]
    if unknown:
        raise ValueError(f"no such preprocessing: {', '.join(unknown)} (known: {', '.join(PREPROCESSORS)})")
    plan: list[Feature] = []
    for kind, columns in pp_features.items():
        for column in columns:
            if kind == "dummy":
                plan += [
                    Feature(f"dummy__{column}_{level}", "as_is", column, level)
                    for level in category_levels(df, column)[1:]
                ]
            else:
                plan.append(Feature(f"{kind}__{column}", kind, column))
    used = {c for columns in pp_features.values() for c in columns}
    return plan + [Feature(f"remainder__{c}", "as_is", c) for c in features if c not in used]


def transform(df: DataFrame, plan: list[Feature], keep: list[str] | None = None) -> DataFrame:
    """The model columns of `plan`, scaled with statistics of `df` itself."""
    cells = []
    for f in plan:
        v = f.value()
        if f.kind == "ss":
            cells.append(F.struct(F.avg(v).alias("shift"), F.stddev_pop(v).alias("size")).alias(f.name))
        elif f.kind == "mms":
            cells.append(F.struct(F.min(v).alias("shift"), (F.max(v) - F.min(v)).alias("size")).alias(f.name))
    scale = df.agg(F.struct(*cells)).scalar() if cells else None

    def scaled(f: Feature) -> Column:
        if f.kind == "as_is":
            return f.value().alias(f.name)
        size = F.when(scale[f.name]["size"] == 0, F.lit(1.0)).otherwise(scale[f.name]["size"])
        return ((f.value() - scale[f.name]["shift"]) / size).alias(f.name)

    return df.select(*(keep or []), *[scaled(f) for f in plan])


@dataclass
class Moments:
    """Sums over rows of (1, z..., y): z are features, y the response, both pre-centred and scaled."""

    gram: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def __add__(self, other: "Moments") -> "Moments":
        return Moments(self.gram + other.gram, np.minimum(self.low, other.low), np.maximum(self.high, other.high))

    @property
    def n(self) -> float:
        return self.gram[0, 0]

    def mapped(self, matrix: np.ndarray) -> "Moments":
        return Moments(matrix.T @ self.gram @ matrix, self.low, self.high)


@dataclass
class Design:
    """Feature plan with the centre and size used to keep the sums well conditioned."""

    plan: list[Feature]
    response: str
    centre: np.ndarray
    size: np.ndarray
    y_centre: float
    y_size: float
    total: int = 0
    names: list[str] = field(default_factory=list)

    @classmethod
    def measure(cls, df: DataFrame, plan: list[Feature], response: str) -> "Design":
        # Numeric columns are measured once each; a dummy's mean and spread follow from its level's count.
        numeric = list(dict.fromkeys([f.source for f in plan if f.level is None] + [response]))
        cells = [F.count(F.lit(1))] + [g(F.col(c).cast("double")) for c in numeric for g in (F.count, F.avg, F.stddev_pop)]
        count, *numbers = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(cells)]).first()
        if not count:
            raise ValueError("no rows to fit")
        facts = {c: numbers[3 * i:3 * i + 3] for i, c in enumerate(numeric)}
        levels = {
            c: dict(df.groupBy(c).count().collect()) for c in dict.fromkeys(f.source for f in plan if f.level is not None)
        }
        holes = [c for c, (n, _, _) in facts.items() if n < count] + [c for c, found in levels.items() if None in found]
        if holes:
            raise ValueError(f"NULL values in {holes}")

        def spread(f: Feature) -> tuple[float, float]:
            if f.level is None:
                return facts[f.source][1], facts[f.source][2]
            share = levels[f.source].get(f.level, 0) / count
            return share, math.sqrt(share * (1 - share))

        measured = [spread(f) for f in plan] + [tuple(facts[response][1:])]
        centre, size = np.array([m for m, _ in measured], float), np.array([d for _, d in measured], float)
        size[size == 0] = 1.0
        return cls(plan, response, centre[:-1], size[:-1], centre[-1], size[-1], count, [f.name for f in plan])

    def _source(self, df: DataFrame, fold: Column) -> tuple[DataFrame, list[tuple]]:
        """The columns the matrix is made of, and per matrix column (column, level, centre, size)."""
        names: dict[tuple, str] = {}
        spec = []
        for f, c, s in zip(self.plan, self.centre, self.size):
            name = names.setdefault((f.source, f.level is None), f"s{len(names)}")
            spec.append((name, f.level, float(c), float(s)))
        name = names.setdefault((self.response, True), f"s{len(names)}")
        spec.append((name, None, float(self.y_centre), float(self.y_size)))
        cells = [(F.col(c).cast("double") if number else F.col(c)).alias(n) for (c, number), n in names.items()]
        return df.select(fold.cast("int").alias("fold"), *cells), spec

    def sums(self, df: DataFrame, fold: Column, weigh=None) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per fold the cross-products of (1, z..., y) and the least and greatest value of each column.

        Every task adds up its own rows with numpy and emits a line per matrix row; lines are added by
        Spark, and as many come back as folds times matrix rows. `weigh(matrix)` gives row weights and one
        number to take the least of (in place of the constant's minimum).
        """
        rows, spec = self._source(df, fold)

        def partial(batches):
            import pandas as pd

            total: dict[int, list[np.ndarray]] = {}
            for pdf in batches:
                z = np.ones((len(pdf), len(spec) + 1))
                for j, (name, level, centre, size) in enumerate(spec, start=1):
                    v = pdf[name].to_numpy()
                    z[:, j] = ((v == level) if level is not None else v.astype(float)) * (1 / size) - centre / size
                folds = pdf["fold"].to_numpy()
                for number in np.unique(folds):
                    part = z[folds == number]
                    weight, least = weigh(part) if weigh else (None, None)
                    gram = part.T @ (part if weight is None else part * weight[:, None])
                    low, high = part.min(0), part.max(0)
                    if least is not None:
                        low[0] = least
                    if int(number) in total:
                        old = total[int(number)]
                        total[int(number)] = [old[0] + gram, np.minimum(old[1], low), np.maximum(old[2], high)]
                    else:
                        total[int(number)] = [gram, low, high]
            for number, (gram, low, high) in total.items():
                lines = np.vstack([gram, low, high])
                yield pd.DataFrame({"fold": number, "line": range(len(lines)), "cells": list(lines)})

        width = len(spec) + 1

        def added(pdf):
            import pandas as pd

            lines = np.stack(pdf["cells"].to_numpy())
            line = int(pdf["line"].iloc[0])
            cells = lines.sum(0) if line < width else lines.min(0) if line == width else lines.max(0)
            return pd.DataFrame({"fold": [int(pdf["fold"].iloc[0])], "line": [line], "cells": [cells]})

        shape = "fold int, line int, cells array<double>"
        found = rows.mapInPandas(partial, shape).groupBy("fold", "line").applyInPandas(added, shape).collect()
        out: dict[int, np.ndarray] = {}
        for number, line, cells in found:
            out.setdefault(number, np.zeros((width + 2, width)))[line] = cells
        return {number: (m[:width], m[width], m[width + 1]) for number, m in out.items()}

    def moments(self, df: DataFrame, fold: Column | None = None) -> dict[int, Moments]:
        """Cross-products per fold from one pass."""
        found = self.sums(df, fold if fold is not None else F.lit(0))
        return {number: Moments(gram, low[1:-1], high[1:-1]) for number, (gram, low, high) in found.items()}

    def scaling(self, train: Moments) -> tuple[np.ndarray, np.ndarray]:
        """Shift and size of every feature, in source units, from the training sums."""
        mean = self.centre + self.size * train.gram[0, 1:-1] / train.n
        spread = self.size * np.sqrt(
            np.maximum(np.diag(train.gram)[1:-1] / train.n - (train.gram[0, 1:-1] / train.n) ** 2, 0)
        )
        low, high = self.centre + self.size * train.low, self.centre + self.size * train.high
        kinds = np.array([f.kind for f in self.plan])
        shift = np.where(kinds == "ss", mean, np.where(kinds == "mms", low, 0.0))
        size = np.where(kinds == "ss", spread, np.where(kinds == "mms", high - low, 1.0))
        return shift, np.where(size < 1e-12, 1.0, size)

    def to_scaled(self, shift: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Matrix taking (1, z, y) to (1, scaled features, response in its own units)."""
        k = len(self.plan)
        matrix = np.zeros((k + 2, k + 2))
        matrix[0, 0] = 1.0
        matrix[0, 1:-1] = (self.centre - shift) / size
        matrix[range(1, k + 1), range(1, k + 1)] = self.size / size
        matrix[0, -1], matrix[-1, -1] = self.y_centre, self.y_size
        return matrix


def solve(moments: Moments, estimator: str, alpha: float = 0.0) -> tuple[float, np.ndarray]:
    """Intercept and coefficients. Ridge penalises the sum of squares, Lasso the mean square."""
    if estimator not in ESTIMATORS:
        raise ValueError(f"no such estimator: {estimator} (known: {', '.join(ESTIMATORS)})")
    n, means = moments.n, moments.gram[0, 1:] / moments.n
    centred = moments.gram[1:, 1:] - n * np.outer(means, means)
    xx, xy = centred[:-1, :-1], centred[:-1, -1]
    if estimator == "Lasso" and alpha > 0:
        coef = _lasso(xx / n, xy / n, alpha)
    else:
        penalty = alpha if estimator == "Ridge" else 0.0
        coef = np.linalg.lstsq(xx + penalty * np.eye(len(xy)), xy, rcond=None)[0]
    return float(means[-1] - means[:-1] @ coef), coef


def _lasso(xx: np.ndarray, xy: np.ndarray, alpha: float, tol: float = 1e-12, rounds: int = 100_000) -> np.ndarray:
    """Coordinate descent on the (small) covariance matrix."""
    coef = np.zeros(len(xy))
    for _ in range(rounds):
        moved = 0.0
        for j in range(len(xy)):
            if xx[j, j] <= 0:
                continue
            pull = xy[j] - xx[j] @ coef + xx[j, j] * coef[j]
            new = math.copysign(max(abs(pull) - alpha, 0.0), pull) / xx[j, j]
            moved = max(moved, abs(new - coef[j]) * math.sqrt(xx[j, j]))
            coef[j] = new
        if moved <= tol * max(1.0, float(np.abs(xy).max())):
            return coef
    raise ValueError(f"coordinate descent still moves after {rounds} rounds")


def r_squared(moments: Moments, intercept: float, coef: np.ndarray) -> float:
    """Explained share of the rows behind `moments`, which need not be the training rows."""
    direction = np.concatenate([[-intercept], -coef, [1.0]])
    error = direction @ moments.gram @ direction
    total = moments.gram[-1, -1] - moments.gram[0, -1] ** 2 / moments.n
    return float(1 - error / total)


@dataclass
class LinearModel:
    """Fitted coefficients in scaled units, with the scaling needed to apply them."""

    design: Design
    estimator: str
    alpha: float | None
    intercept: float
    coef: np.ndarray
    shift: np.ndarray
    size: np.ndarray
    train_r2: float

    def prediction(self) -> Column:
        total, levels = F.lit(self.intercept), {}
        for f, w, a, b in zip(self.design.plan, self.coef, self.shift, self.size):
            if f.level is None:
                total = total + F.lit(float(w)) * ((f.value() - F.lit(float(a))) / F.lit(float(b)))
            else:  # dummies are never scaled: a level adds its weight
                levels.setdefault(f.source, []).extend((F.lit(f.level), F.lit(float(w))))
        for source, weights in levels.items():
            total = total + F.coalesce(F.create_map(*weights)[F.col(source)], F.lit(0.0))
        return total

    def predict(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self.prediction())

    def residuals(self, df: DataFrame) -> DataFrame:
        return self.predict(df).withColumn("residual", F.col(self.design.response) - F.col("prediction"))

    def holdout(self, df: DataFrame) -> DataFrame:
        """One row: r2, mse and rmse on rows the model has not seen."""
        y = F.col(self.design.response).cast("double")
        error = y - self.prediction()
        return df.agg(
            F.count(F.lit(1)).alias("n"), F.sum(error * error).alias("sse"), F.var_pop(y).alias("spread")
        ).select(
            (1 - F.try_divide("sse", F.col("spread") * F.col("n"))).alias("test_r2"),
            F.try_divide("sse", "n").alias("mse"),
            F.sqrt(F.try_divide("sse", "n")).alias("rmse"),
        )


def _fit(design: Design, train: Moments, estimator: str, alpha: float) -> LinearModel:
    shift, size = design.scaling(train)
    scaled = train.mapped(design.to_scaled(shift, size))
    intercept, coef = solve(scaled, estimator, alpha)
    return LinearModel(
        design, estimator, None if estimator == "OLS" else alpha, intercept, coef, shift, size,
        r_squared(scaled, intercept, coef),
    )


def _cross_validate(design: Design, folds: dict[int, Moments], estimator: str, alpha: float) -> float:
    """Mean validation R2; scaling and fit come from the other folds each time."""
    scores = []
    for held_out in folds:
        others = [m for fold, m in folds.items() if fold != held_out]
        train = sum(others[1:], others[0])
        shift, size = design.scaling(train)
        matrix = design.to_scaled(shift, size)
        intercept, coef = solve(train.mapped(matrix), estimator, alpha)
        scores.append(r_squared(folds[held_out].mapped(matrix), intercept, coef))
    return float(np.mean(scores))


def fold_of(keys: list[str], folds: int = 5, seed: int = 42) -> Column:
    """Fold number from the key hash: the same for a row on every run."""
    return F.floor(key_fraction(*keys, seed=seed + 1) * folds).cast("int")


@dataclass
class FitReport:
    model: LinearModel
    cv_score: float
    cv_scores: dict[float, float]
    train: DataFrame
    test: DataFrame

    def metrics(self) -> dict[str, float]:
        held_out = self.model.holdout(self.test).first().asDict()
        return {"cv_score": self.cv_score, "train_r2": self.model.train_r2, **held_out}


def linear_model(
    data: DataFrame,
    response: str,
    keys: list[str],
    features: list[str] | None = None,
    pp_features: dict[str, list[str]] | None = None,
    estimator: str = "OLS",
    alpha_grid: list[float] | None = None,
    seed: int = 42,
    folds: int = 5,
) -> FitReport:
    """Split 80/20 by key hash, cross-validate, choose the penalty and refit on all training rows.

    Two aggregates over the training rows serve every fold and every penalty.
    """
    if estimator not in ESTIMATORS:
        raise ValueError(f"no such estimator: {estimator} (known: {', '.join(ESTIMATORS)})")
    train, test = hashed_split(data, keys, 0.2, seed)
    chosen = features or [c for c in data.columns if c != response and c not in keys]
    plan = plan_features(train, chosen, pp_features)
    design = Design.measure(train, plan, response)
    per_fold = design.moments(train, fold_of(keys, folds, seed))
    grid = [0.0] if estimator == "OLS" else [float(a) for a in (alpha_grid or ALPHA_GRID)]
    scores = {alpha: _cross_validate(design, per_fold, estimator, alpha) for alpha in grid}
    best = max(scores, key=scores.get)
    parts = list(per_fold.values())
    model = _fit(design, sum(parts[1:], parts[0]), estimator, best)
    return FitReport(model, scores[best], scores, train, test)


@dataclass
class RobustFit:
    """Least squares with HC3 errors, features in scaled units, constant first."""

    names: list[str]
    coef: np.ndarray
    std_err: np.ndarray
    pvalue: np.ndarray
    model: LinearModel

    def table(self, spark) -> DataFrame:
        """One row per coefficient; as many rows as the model has features."""
        rows = [
            (n, float(c), float(s), float(p), bool(p <= 0.05))
            for n, c, s, p in zip(self.names, self.coef, self.std_err, self.pvalue)
        ]
        return spark.createDataFrame(rows, "feature string, coef double, std_err double, pvalue double, significant boolean")

    def insignificant(self) -> list[str]:
        return [n for n, p in zip(self.names, self.pvalue) if p > 0.05]


def ols_hc3(df: DataFrame, plan: list[Feature], response: str) -> RobustFit:
    """Coefficients with HC3 covariance and normal p-values.

    Pass one sums the cross-products; pass two weighs them by the squared leave-one-out
    residual (e / (1 - h)).
    """
    design = Design.measure(df, plan, response)
    total = design.moments(df)[0]
    k = len(plan)
    xx, xy = total.gram[: k + 1, : k + 1], total.gram[: k + 1, -1]
    if np.linalg.cond(xx) > 1e12:
        raise ValueError("the features are linearly dependent")
    inverse = np.linalg.inv(xx)
    beta = inverse @ xy

    def leave_one_out(z: np.ndarray):
        """Squared residuals without the row itself; the least slack 1 - h of a row."""
        x = z[:, :-1]
        slack = 1 - np.einsum("ij,jk,ik->i", x, inverse, x)
        if slack.min() < 1e-10:
            return np.zeros(len(z)), slack.min()
        return ((z[:, -1] - x @ beta) / slack) ** 2, slack.min()

    gram, low, _ = design.sums(df, F.lit(0), leave_one_out)[0]
    # A row that alone fixes a coefficient has leverage 1 and no leave-one-out residual.
    if low[0] < 1e-10:
        raise ValueError("a row has full leverage; HC3 errors are undefined")
    meat = gram[: k + 1, : k + 1]
    cov = inverse @ meat @ inverse

    # From centred and sized columns to the scaled features and the response's own units.
    shift, size = design.scaling(total)
    back = np.linalg.inv(design.to_scaled(shift, size)[: k + 1, : k + 1])
    coef = back @ (beta * design.y_size)
    coef[0] += design.y_centre
    errors = np.sqrt(np.diag(back @ cov @ back.T)) * design.y_size
    pvalue = np.array([math.erfc(abs(c / s) / math.sqrt(2)) if s > 0 else float("nan") for c, s in zip(coef, errors)])
    model = LinearModel(
        design, "OLS", None, float(coef[0]), coef[1:], shift, size,
        r_squared(total.mapped(design.to_scaled(shift, size)), float(coef[0]), coef[1:]),
    )
    return RobustFit(["const"] + design.names, coef, errors, pvalue, model)


def residual_summary(residuals: DataFrame) -> DataFrame:
    """Mean, sample deviation and the 2- and 4-deviation marks of the residuals."""
    base = residuals.agg(F.avg("residual").alias("mean"), F.stddev_samp("residual").alias("std"))
    marks = {
        f"{side}_{m}_sigma": F.col("mean") + sign * m * F.col("std")
        for m in (2, 4) for side, sign in (("minus", -1), ("plus", 1))
    }
    return base.withColumns(marks)


def residual_histogram(residuals: DataFrame, bins: int = 50) -> DataFrame:
    """Share of residuals per bin beside the share a normal curve of the same mean and deviation has."""
    facts = residuals.agg(
        F.struct(F.avg("residual").alias("mean"), F.stddev_samp("residual").alias("std"), F.count("residual").alias("n"))
    ).scalar()
    middle = (F.col("bin_start") + F.col("bin_end")) / 2
    score = (middle - facts["mean"]) / facts["std"]
    density = F.exp(-score * score / 2) / (facts["std"] * math.sqrt(2 * math.pi))
    return histogram(residuals, "residual", bins).select(
        "bin", "bin_start", "bin_end",
        (F.col("cnt") / facts["n"]).alias("share"),
        (density * (F.col("bin_end") - F.col("bin_start"))).alias("normal_share"),
    )


def qq_points(residuals: DataFrame, points: int = 19) -> DataFrame:
    """Standardised residual quantiles beside normal quantiles at evenly spaced probabilities."""
    probs = {f"p{i}": i / (points + 1) for i in range(1, points + 1)}
    facts = residuals.agg(F.struct(F.avg("residual").alias("mean"), F.stddev_samp("residual").alias("std"))).scalar()
    lines = F.array(*[
        F.struct(
            F.lit(p).alias("probability"),
            F.lit(NormalDist().inv_cdf(p)).alias("normal_quantile"),
            ((F.col(name) - facts["mean"]) / facts["std"]).alias("residual_quantile"),
        )
        for name, p in probs.items()
    ])
    return exact_percentiles(residuals, "residual", probs).select(F.inline(lines))


def residual_scatter(residuals: DataFrame, keys: list[str], fraction: float | None = None, seed: int = 42) -> DataFrame:
    """Fitted value and residual of every row; of a repeatable sample where a fraction is asked for."""
    rows = residuals if fraction is None else hashed_fraction(residuals, keys, fraction, seed)
    return rows.select(*keys, "prediction", "residual")
