import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from arenalake.operators import regression as R

PP = {"ss": ["a"], "mms": ["b"], "dummy": ["kind"]}


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(0)
    rows = []
    for i in range(400):
        a, b, kind, w = rng.gauss(50, 9), rng.uniform(0, 7), rng.choice("pqr"), rng.randrange(2)
        y = 1000 + 20 * a - 35 * b + {"p": 0, "q": 40, "r": -90}[kind] + 60 * w + rng.gauss(0, 5 + a)
        rows.append((i, a, b, kind, w, y))
    return spark.createDataFrame(rows, "id long, a double, b double, kind string, w int, y double").cache()


def matrix(rows):
    """Features as in PP (unscaled), with the dummies of q and r, then w."""
    x = np.array([[r["a"], r["b"], r["kind"] == "q", r["kind"] == "r", r["w"]] for r in rows], float)
    return x, np.array([r["y"] for r in rows])


def scale(train, x):
    shift, size = np.zeros(5), np.ones(5)
    shift[0], size[0] = train[:, 0].mean(), train[:, 0].std()
    shift[1], size[1] = train[:, 1].min(), train[:, 1].max() - train[:, 1].min()
    return (x - shift) / size


def ridge(x, y, alpha):
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return y.mean() - x.mean(0) @ w, w


def r2(y, p):
    return 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()


def test_hc3_matches_closed_form(spark, data):
    fit = R.ols_hc3(data, R.plan_features(data, ["a", "b", "kind", "w"], PP), "y")
    x, y = matrix(data.collect())
    x = np.column_stack([np.ones(len(y)), scale(x, x)])
    inv = np.linalg.inv(x.T @ x)
    beta = inv @ x.T @ y
    h = np.einsum("ij,jk,ik->i", x, inv, x)
    u = (y - x @ beta) / (1 - h)
    errors = np.sqrt(np.diag(inv @ (x.T * u**2) @ x @ inv))
    assert fit.names == ["const", "ss__a", "mms__b", "dummy__kind_q", "dummy__kind_r", "remainder__w"]
    np.testing.assert_allclose(fit.coef, beta, rtol=1e-7)
    np.testing.assert_allclose(fit.std_err, errors, rtol=1e-7)
    np.testing.assert_allclose(fit.pvalue, [math.erfc(abs(z) / math.sqrt(2)) for z in beta / errors], rtol=1e-6, atol=1e-300)
    assert fit.table(spark).count() == 6
    np.testing.assert_allclose(fit.model.train_r2, r2(y, x @ beta), rtol=1e-9)


def test_dependent_features_are_refused(spark, data):
    twice = data.withColumn("a2", F.col("a") * 2)
    with pytest.raises(ValueError, match="dependent"):
        R.ols_hc3(twice, R.plan_features(twice, ["a", "a2"]), "y")


def test_nulls_are_refused(spark, data):
    holes = data.withColumn("a", F.when(F.col("id") > 3, F.col("a")))
    with pytest.raises(ValueError, match="NULL"):
        R.ols_hc3(holes, R.plan_features(holes, ["a"]), "y")


@pytest.mark.parametrize("estimator", ["OLS", "Ridge"])
def test_cross_validated_grid_matches_numpy(data, estimator):
    grid = [0, 0.5, 5, 50]
    report = R.linear_model(data, "y", ["id"], None, PP, estimator, grid)
    rows = report.train.withColumn("fold", R.fold_of(["id"])).collect()
    x, y = matrix(rows)
    fold = np.array([r["fold"] for r in rows])
    scores = {}
    for alpha in grid if estimator == "Ridge" else [0]:
        parts = []
        for f in range(5):
            tr, va = fold != f, fold == f
            b0, w = ridge(scale(x[tr], x[tr]), y[tr], alpha)
            parts.append(r2(y[va], b0 + scale(x[tr], x[va]) @ w))
        scores[float(alpha)] = np.mean(parts)
    assert report.cv_scores == {a: pytest.approx(s, rel=1e-8) for a, s in scores.items()}
    best = max(scores, key=scores.get)
    assert report.cv_score == pytest.approx(scores[best])
    b0, w = ridge(scale(x, x), y, best)
    np.testing.assert_allclose(report.model.coef, w, rtol=1e-7)
    xt, yt = matrix(report.test.collect())
    pred = b0 + scale(x, xt) @ w
    metrics = report.metrics()
    assert metrics["test_r2"] == pytest.approx(r2(yt, pred))
    assert metrics["rmse"] == pytest.approx(math.sqrt(((yt - pred) ** 2).mean()))
    assert metrics["train_r2"] == pytest.approx(r2(y, b0 + scale(x, x) @ w))


def test_lasso_meets_its_optimality_conditions(data):
    alpha = 8.0
    report = R.linear_model(data, "y", ["id"], None, PP, "Lasso", [alpha])
    x, y = matrix(report.train.collect())
    z = scale(x, x)
    model = report.model
    gradient = z.T @ (y - model.intercept - z @ model.coef) / len(y)
    for g, w in zip(gradient, model.coef):
        assert abs(g) <= alpha * (1 + 1e-6) if w == 0 else g == pytest.approx(math.copysign(alpha, w), rel=1e-6)


def test_ridge_zero_equals_ols(data):
    ols = R.linear_model(data, "y", ["id"], ["a", "b"], None, "OLS").model
    zero = R.linear_model(data, "y", ["id"], ["a", "b"], None, "Ridge", [0]).model
    np.testing.assert_allclose(ols.coef, zero.coef)


def test_unknown_names_are_refused(data):
    with pytest.raises(ValueError, match="no such estimator"):
        R.linear_model(data, "y", ["id"], estimator="Elastic")
    with pytest.raises(ValueError, match="no such preprocessing"):
        R.plan_features(data, ["a"], {"robust": ["a"]})


def test_transform_and_standardize(data):
    rows = R.transform(data, R.plan_features(data, ["a", "b", "kind", "w"], PP), ["id"])
    x, _ = matrix(data.orderBy("id").collect())
    got = np.array([tuple(r)[1:] for r in rows.orderBy("id").collect()], float)
    np.testing.assert_allclose(got, scale(x, x), rtol=1e-9, atol=1e-12)
    z = R.standardize(data, ["a"]).select(F.avg("a_ss"), F.stddev_samp("a_ss")).first()
    assert z[0] == pytest.approx(0, abs=1e-9) and z[1] == pytest.approx(1)


def test_residual_diagnostics(data):
    fit = R.ols_hc3(data, R.plan_features(data, ["a"]), "y")
    residuals = fit.model.residuals(data)
    e = np.array([r["residual"] for r in residuals.collect()])
    marks = R.residual_summary(residuals).first()
    assert marks["mean"] == pytest.approx(0, abs=1e-6) and marks["std"] == pytest.approx(e.std(ddof=1))
    assert marks["plus_4_sigma"] - marks["minus_4_sigma"] == pytest.approx(8 * marks["std"])
    shares = R.residual_histogram(residuals, 20).agg(F.sum("share"), F.sum("normal_share")).first()
    assert shares[0] == pytest.approx(1) and 0.9 < shares[1] < 1.02
    points = R.qq_points(residuals, 9).orderBy("probability").collect()
    want = (np.quantile(e, [p / 10 for p in range(1, 10)]) - e.mean()) / e.std(ddof=1)
    np.testing.assert_allclose([p["residual_quantile"] for p in points], want, rtol=1e-6, atol=1e-9)
    assert points[4]["normal_quantile"] == pytest.approx(0, abs=1e-12)
    assert R.residual_scatter(residuals, ["id"], 0.2).columns == ["id", "prediction", "residual"]


def test_levels_have_no_limit(data):
    wide = data.sparkSession.range(1500).select(F.col("id").cast("string").alias("c"))
    assert len(R.category_levels(wide, "c")) == 1500


def test_many_levels(spark):
    """300 levels are 299 columns; fit and errors equal the closed form."""
    rng = random.Random(2)
    rows = [(i, f"l{i % 300:03d}", rng.gauss(0, 1), (i % 300) * 2.0 + rng.gauss(0, 1)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, kind string, a double, y double")
    fit = R.ols_hc3(df, R.plan_features(df, ["kind", "a"], {"dummy": ["kind"]}), "y")
    x = np.zeros((3000, 301))
    x[:, 0] = 1
    for i, kind, a, _ in rows:
        if int(kind[1:]):
            x[i, int(kind[1:])] = 1
        x[i, 300] = a
    y = np.array([r[3] for r in rows])
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    np.testing.assert_allclose(fit.coef, beta, rtol=1e-6, atol=1e-8)
    residual = fit.model.residuals(df).orderBy("id").toPandas()["residual"].to_numpy()
    np.testing.assert_allclose(residual, y - x @ beta, atol=1e-6)


def test_null_levels_are_refused(spark, data):
    holes = data.withColumn("kind", F.when(F.col("id") > 3, F.col("kind")))
    with pytest.raises(ValueError, match="NULL"):
        R.ols_hc3(holes, R.plan_features(holes, ["a", "kind"], {"dummy": ["kind"]}), "y")


def test_scatter_has_every_row(data):
    rows = R.ols_hc3(data, R.plan_features(data, ["a"]), "y").model.residuals(data)
    assert R.residual_scatter(rows, ["id"]).count() == data.count() > R.residual_scatter(rows, ["id"], 0.3).count()


def test_estimators_train_on_rows_written_once(spark):
    """All estimators of the comparison read one written frame; nothing else is written on the way."""
    import os

    import __spark_entry__ as entry
    from arenalake.workspace import shared_dir

    before = set(os.listdir(shared_dir(spark)))
    assert entry.queries()["ml07_estimators"](spark, "/root/testdata/sf0.001").count() == 3
    new = sorted(name.rsplit("-", 1)[0] for name in set(os.listdir(shared_dir(spark))) - before)
    assert new == ["features"]
