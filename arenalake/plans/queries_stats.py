"""Exploratory statistics and regression over the player statistics table."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arenalake import schemas
from arenalake.operators import quality, regression, sampling, stats
from arenalake.plans.catalog import Catalog, round_sql
from arenalake.plans.gold import PLAYER
from arenalake.plans.proxy import px_intervals, with_px
from arenalake.plans.queries_flow import stats_table
from arenalake.plans.queries_gold import PLAYER_STATS_CTE, player_stats
from arenalake.plans.queries_relational import HASH_SQL
from arenalake.workspace import written

CATALOG = Catalog()
query = CATALOG.query

_PX_STATS = ("px_matches", "px_players", "px_intervals", "px_items")
_KEY_SQL = "match_id || '|' || participant_pos_id"


def _sql(body: str, ctes: str = "") -> str:
    return with_px(f"WITH {PLAYER_STATS_CTE}{ctes} {body}", *_PX_STATS)


def _rounded(df: DataFrame, digits: int = 6, *columns: str) -> DataFrame:
    """Rounded floats for comparison; adding zero turns -0.0 into 0.0."""
    names = columns or [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in names})


# Exploration -------------------------------------------------------------------------------


@query("eda01_null_rates", with_px(
    "WITH t AS (SELECT " + ", ".join(f"avg(CASE WHEN {c} IS NULL THEN 100.0 ELSE 0 END) AS {c}" for c in schemas.ITEM_SLOTS)
    + f""" FROM px_intervals), u AS (UNPIVOT t ON {", ".join(schemas.ITEM_SLOTS)} INTO NAME column_name VALUE null_pct)
    SELECT column_name, {round_sql("null_pct", 4)} AS null_pct FROM u WHERE null_pct > 0""", "px_intervals"))
def _(spark, d):
    rates = quality.null_rates(px_intervals(spark, d)).withColumn("null_pct", F.round("null_pct", 4))
    return rates.orderBy(F.desc("null_pct"))


@query("eda02_distinct_matches", _sql("SELECT count(*) AS total_rows, count(DISTINCT match_id) AS total_matches FROM player_stats"))
def _(spark, d):
    return stats_table(spark, d).agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_distinct("match_id").alias("total_matches")
    )


@query("eda03_duplicate_keys", """
    SELECT count(*) - count(DISTINCT l_orderkey || '|' || l_linenumber) AS duplicate_keys
    FROM lineitem""")
def _(spark, d):
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    return quality.surplus_rows(lines, ["l_orderkey", "l_linenumber"])


@query("eda04_staleness", _sql(f"""
    SELECT {round_sql("avg(CASE WHEN unlogged_duration > 120 THEN 100.0 ELSE 0 END)", 4)} AS stale_pct,
           CAST(median(unlogged_duration) AS DOUBLE) AS median_staleness FROM player_stats"""))
def _(spark, d):
    summary = stats.quality_summary(stats_table(spark, d), PLAYER)
    return summary.select(F.round("stale_pct", 4).alias("stale_pct"), "median_staleness")


@query("eda05_histogram", _sql("""
    SELECT b.bin, r.lo + b.bin * r.width AS bin_start, r.lo + (b.bin + 1) * r.width AS bin_end, coalesce(c.cnt, 0) AS cnt
    FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(50)) b CROSS JOIN ranges r
    LEFT JOIN (SELECT CAST(least(floor((v - lo) / width), 49) AS INTEGER) AS bin, count(*) AS cnt
               FROM (SELECT CAST(unlogged_duration AS DOUBLE) AS v FROM player_stats) CROSS JOIN ranges GROUP BY 1) c
           ON c.bin = b.bin""", """,
    ranges AS (SELECT CAST(min(unlogged_duration) AS DOUBLE) AS lo,
                      (CAST(max(unlogged_duration) AS DOUBLE) - min(unlogged_duration)) / 50 AS width FROM player_stats)"""))
def _(spark, d):
    return stats.histogram(stats_table(spark, d), "unlogged_duration", 50)


@query("eda06_win_rate_by", _sql(f"""
    SELECT team, {round_sql("avg(CASE WHEN win THEN 100.0 WHEN NOT win THEN 0 END)", 6)} AS win_rate
    FROM player_stats WHERE team IS NOT NULL GROUP BY team"""))
def _(spark, d):
    return _rounded(stats.win_rate_by(stats_table(spark, d), "team"))


_KDA = "(kills + assists) / (deaths + 1)"


@query("eda07_kda_by", _sql(f"""
    SELECT champion_role, {round_sql(f"median({_KDA})", 6)} AS median, {round_sql(f"stddev_samp({_KDA})", 6)} AS std,
           count({_KDA}) AS count FROM player_stats GROUP BY champion_role"""))
def _(spark, d):
    return _rounded(stats.kda_by(stats_table(spark, d), "champion_role"))


@query("eda08_cs_by", _sql(f"""
    SELECT champion_role, {round_sql("median(cs)", 6)} AS median, {round_sql("avg(cs)", 6)} AS mean, count(cs) AS count
    FROM player_stats GROUP BY champion_role"""))
def _(spark, d):
    return _rounded(stats.cs_by(stats_table(spark, d), "champion_role"))


@query("eda09_box_stats", _sql(f"""
    SELECT champion_role, q1, median, q3, min(cs) FILTER (WHERE ok) AS whisker_low, max(cs) FILTER (WHERE ok) AS whisker_high
    FROM (SELECT p.champion_role, CAST(p.cs AS DOUBLE) AS cs, q1, median, q3,
                 cs BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ok
          FROM player_stats p JOIN boxes b ON b.champion_role = p.champion_role)
    GROUP BY ALL""", """,
    boxes AS (SELECT champion_role, quantile_cont(CAST(cs AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(cs AS DOUBLE), 0.5) AS median,
                     quantile_cont(CAST(cs AS DOUBLE), 0.75) AS q3 FROM player_stats GROUP BY champion_role)"""))
def _(spark, d):
    return stats.box_stats(stats_table(spark, d), "cs", "champion_role")


@query("eda10_sample_correlation", _sql(f"""
    SELECT {round_sql("corr(kills, total_gold)", 6)} AS r,
           CASE WHEN corr(kills, total_gold) > 0.5 THEN 'strong' ELSE 'moderate' END AS strength
    FROM player_stats WHERE {HASH_SQL.format(seed=42, key=_KEY_SQL)} < 0.1"""))
def _(spark, d):
    return _rounded(stats.correlation(stats_table(spark, d), "kills", "total_gold", PLAYER, 0.1))


_GPM = "total_gold / (game_duration / 60)"
_GPM_SQL = _sql(f"""
    SELECT win, {round_sql(f"avg({_GPM})", 6)} AS mean, {round_sql(f"median({_GPM})", 6)} AS median,
           {round_sql(f"stddev_samp({_GPM})", 6)} AS std FROM player_stats WHERE win IS NOT NULL GROUP BY win""")


@query("eda11_gold_per_minute", _GPM_SQL)
def _(spark, d):
    return _rounded(stats.gold_per_minute(stats_table(spark, d)))


@query("eda11_outcome_gap", _sql(f"""
    SELECT {round_sql("w", 6)} AS win_median, {round_sql("l", 6)} AS loss_median, {round_sql("w - l", 6)} AS gap,
           {round_sql("(w - l) / l * 100", 6)} AS gap_pct
    FROM (SELECT median({_GPM}) FILTER (WHERE win) AS w, median({_GPM}) FILTER (WHERE NOT win) AS l FROM player_stats)"""))
def _(spark, d):
    return _rounded(stats.outcome_gap(stats.gold_per_minute(stats_table(spark, d))))


_NUM = {c: f"CAST({c} AS DOUBLE)" if c != "win" else "CAST(CAST(win AS INTEGER) AS DOUBLE)" for c in stats.CORRELATED}


def _cell_sql(a: str, b: str) -> str:
    r = "1.0" if a == b else round_sql(f"corr({_NUM[a]}, {_NUM[b]})", 6)
    return f"SELECT '{a}' AS a, '{b}' AS b, {r} AS r FROM player_stats HAVING count(*) > 0"


@query("eda12_correlation_matrix", _sql(
    " UNION ALL ".join(_cell_sql(a, b) for a in stats.CORRELATED for b in stats.CORRELATED)))
def _(spark, d):
    return _rounded(stats.correlation_matrix(stats_table(spark, d)))


_WIN_R = {c: f"corr({_NUM[c]}, {_NUM['win']})" for c in stats.CORRELATED if c != "win"}


@query("eda12_outcome_drivers", _sql(f"""
    SELECT arg_max(b, r) AS top_positive, {round_sql("max(r)", 6)} AS positive_r,
           arg_min(b, r) AS top_negative, {round_sql("min(r)", 6)} AS negative_r
    FROM ({" UNION ALL ".join(f"SELECT '{c}' AS b, {r} AS r FROM player_stats" for c, r in _WIN_R.items())})"""))
def _(spark, d):
    return _rounded(stats.outcome_drivers(stats.correlation_matrix(stats_table(spark, d))))


@query("eda13_outcome_quartiles", _sql(f"""
    SELECT win, {", ".join(f"{round_sql(f'quantile_cont({_GPM}, {p})', 6)} AS {n}" for n, p in stats.QUARTILES.items())}
    FROM player_stats WHERE win IS NOT NULL GROUP BY win"""))
def _(spark, d):
    return _rounded(stats.outcome_quartiles(stats.with_gold_per_minute(stats_table(spark, d)), "gold_per_min"))


# Regression ----------------------------------------------------------------------------------

_FEATURES_CTE = f""",
    feat AS (
        SELECT match_id, participant_pos_id, game_duration, team, CAST(win AS INTEGER) AS win, champion_role,
               level, kills, deaths, assists, cs, total_gold,
               {HASH_SQL.format(seed=42, key=_KEY_SQL)} AS split_at, {HASH_SQL.format(seed=43, key=_KEY_SQL)} AS fold_at
        FROM player_stats WHERE unlogged_duration = 0 AND game_duration > 300
    )"""


def features(spark: SparkSession, d: str) -> DataFrame:
    """Model rows written once; training passes read them several times."""
    return written(regression.select_features(player_stats(spark, d, with_build=False), PLAYER), "features")


@query("ml01_feature_selection", _sql("SELECT * EXCLUDE (split_at, fold_at) FROM feat", _FEATURES_CTE))
def _(spark, d):
    return features(spark, d)


@query("ml02_sample_standardize", _sql(f"""
    SELECT match_id, participant_pos_id,
           {round_sql("(kills - avg(kills) OVER ()) / stddev_samp(kills) OVER ()", 6)} AS kills_ss,
           {round_sql("(cs - avg(cs) OVER ()) / stddev_samp(cs) OVER ()", 6)} AS cs_ss
    FROM feat""", _FEATURES_CTE))
def _(spark, d):
    rows = features(spark, d).select(*PLAYER, "kills", "cs")
    return _rounded(regression.standardize(rows, ["kills", "cs"]))


_PP = {"ss": ["game_duration", "cs", "level"], "mms": ["kills", "deaths", "assists"], "dummy": ["champion_role", "team"]}


def _scaled_sql(column: str, kind: str) -> str:
    if kind == "ss":
        value = f"({column} - avg({column}) OVER ()) / stddev_pop({column}) OVER ()"
    else:
        value = f"({column} - min({column}) OVER ()) / (max({column}) OVER () - min({column}) OVER ())"
    return f"{round_sql(value, 6)} AS {kind}__{column}"


@query("ml03_preprocess", _sql(f"""
    SELECT match_id, participant_pos_id, {", ".join(_scaled_sql(c, k) for k in ("ss", "mms") for c in _PP[k])},
           {", ".join(f"CASE champion_role WHEN '{r}' THEN 1.0 ELSE 0 END AS dummy__champion_role_{r}" for r in ("JUNGLE", "MIDDLE", "SUPPORT", "TOP"))},
           CASE team WHEN 'RED' THEN 1.0 ELSE 0 END AS dummy__team_RED, CAST(win AS DOUBLE) AS remainder__win
    FROM feat""", _FEATURES_CTE))
def _(spark, d):
    rows = features(spark, d)
    names = [c for c in regression.MODEL_COLUMNS if c != "total_gold"]
    return _rounded(regression.transform(rows, regression.plan_features(rows, names, _PP), PLAYER))


@query("ml04_train_test_split", _sql(
    "SELECT match_id, participant_pos_id, CASE WHEN split_at < 0.2 THEN 'test' ELSE 'train' END AS part FROM feat", _FEATURES_CTE))
def _(spark, d):
    train, test = sampling.hashed_split(features(spark, d).select(*PLAYER), PLAYER)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


_LINE_CTE = _FEATURES_CTE + """,
    xy AS (SELECT CAST(cs AS DOUBLE) AS x, CAST(total_gold AS DOUBLE) AS y, split_at, fold_at FROM feat),
    line AS (SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, regr_sxx(y, x) AS sxx, regr_slope(y, x) AS b1,
                    regr_intercept(y, x) AS b0 FROM xy WHERE split_at >= 0.2),
    resid AS (SELECT x, y, y - b0 - b1 * x AS e, 1 - 1.0 / n - (x - mx) * (x - mx) / sxx AS slack, line.*
              FROM xy CROSS JOIN line WHERE split_at >= 0.2)"""


@query("ml05_ols_hc3", _sql(f"""
    SELECT feature, {round_sql("coef", 4)} AS coef, {round_sql("std_err", 4)} AS std_err,
           abs(coef / std_err) >= 1.959963984540054 AS significant FROM (SELECT 'const' AS feature, any_value(b0) AS coef,
           sqrt(sum(power(e / slack, 2) * power(1.0 / n - mx * (x - mx) / sxx, 2))) AS std_err FROM resid
    UNION ALL
    SELECT 'remainder__cs', any_value(b1), sqrt(sum(power(e / slack, 2) * power((x - mx) / sxx, 2))) FROM resid)""", _LINE_CTE))
def _(spark, d):
    rows = sampling.hashed_split(features(spark, d), PLAYER)[0]
    fit = regression.ols_hc3(rows, regression.plan_features(rows, ["cs"]), "total_gold")
    return _rounded(fit.table(spark).drop("pvalue"), 4)


@query("ml05_ols_hc3_all_features")
def _(spark, d):
    rows = features(spark, d).filter("win IS NOT NULL")
    names = [c for c in regression.MODEL_COLUMNS if c != "total_gold"]
    return regression.ols_hc3(rows, regression.plan_features(rows, names, _PP), "total_gold").table(spark)


def _line_residuals(spark: SparkSession, d: str) -> DataFrame:
    """Residuals of the training part, which the diagnostics are about."""
    rows = sampling.hashed_split(features(spark, d), PLAYER)[0]
    return regression.ols_hc3(rows, regression.plan_features(rows, ["cs"]), "total_gold").model.residuals(rows)


@query("ml06_residual_summary", _sql(f"""
    SELECT {", ".join(f"{round_sql(v, 2)} + 0.0 AS {n}" for n, v in {
        "mean": "m", "std": "s", "minus_2_sigma": "(m - 2 * s)", "plus_2_sigma": "(m + 2 * s)",
        "minus_4_sigma": "(m - 4 * s)", "plus_4_sigma": "(m + 4 * s)"}.items())}
    FROM (SELECT round(avg(e), 6) AS m, stddev_samp(e) AS s FROM resid)""", _LINE_CTE))
def _(spark, d):
    return _rounded(regression.residual_summary(_line_residuals(spark, d)), 2)


@query("ml06_residual_histogram", _sql(f"""
    SELECT b.bin, {round_sql("coalesce(c.cnt, 0) / n", 6)} AS share,
           {round_sql("(lo + b.bin * (hi - lo) / 20)", 4)} AS bin_start, {round_sql("(lo + (b.bin + 1) * (hi - lo) / 20)", 4)} AS bin_end,
           {round_sql("((hi - lo) / 20 * exp(-power((lo + (b.bin + 0.5) * (hi - lo) / 20 - m) / s, 2) / 2) / (s * sqrt(2 * pi())))", 6)} AS normal_share
    FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(20)) b CROSS JOIN (SELECT count(*) AS n, min(e) AS lo, max(e) AS hi, avg(e) AS m, stddev_samp(e) AS s FROM resid) t
    LEFT JOIN (SELECT CAST(least(floor((e - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, count(*) AS cnt
               FROM resid CROSS JOIN (SELECT min(e) AS lo, max(e) AS hi FROM resid) GROUP BY 1) c ON c.bin = b.bin""", _LINE_CTE))
def _(spark, d):
    bins = regression.residual_histogram(_line_residuals(spark, d), 20)
    for name, digits in (("share", 6), ("normal_share", 6), ("bin_start", 4), ("bin_end", 4)):
        bins = _rounded(bins, digits, name)
    return bins


_NORMAL = ", ".join(f"({i / 20}::DOUBLE, {NormalDist().inv_cdf(i / 20)!r}::DOUBLE)" for i in range(1, 20))


@query("ml06_qq_points", _sql(f"""
    SELECT p AS probability, {round_sql("z", 6)} AS normal_quantile,
           {round_sql("(((SELECT quantile_cont(e, [" + ", ".join(str(i / 20) for i in range(1, 20)) + "]) FROM resid)[CAST(round(p * 20) AS INTEGER)] - (SELECT avg(e) FROM resid)) / (SELECT stddev_samp(e) FROM resid))", 6)} AS residual_quantile
    FROM (VALUES {_NORMAL}) AS normal(p, z)""", _LINE_CTE))
def _(spark, d):
    return _rounded(_rounded(regression.qq_points(_line_residuals(spark, d)), 6, "normal_quantile"), 6, "residual_quantile")


@query("ml06_residual_scatter", _sql(f"""
    SELECT match_id, participant_pos_id, {round_sql("(b0 + b1 * cs)", 4)} AS prediction, {round_sql("(total_gold - b0 - b1 * cs)", 4)} AS residual
    FROM feat CROSS JOIN line WHERE split_at >= 0.2""", _LINE_CTE))
def _(spark, d):
    return _rounded(regression.residual_scatter(_line_residuals(spark, d), PLAYER), 4)


def _one_feature(rows, estimator, grid=None):
    return regression.linear_model(
        rows.select(*PLAYER, "cs", "total_gold"), "total_gold", PLAYER, ["cs"], {"ss": ["cs"]}, estimator, grid
    )


# Closed forms for one standardised feature: the slope is shrunk (Ridge) or shortened (Lasso).
_TRAIN_CTE = _LINE_CTE + """,
    train AS (SELECT x, y, CAST(floor(fold_at * 5) AS INTEGER) AS fold FROM xy WHERE split_at >= 0.2),
    whole AS (SELECT count(*) AS n, avg(y) AS my, stddev_pop(x) AS sd, covar_pop(x, y) / stddev_pop(x) AS c FROM train)"""


@query("ml07_estimators", _sql(f"""
    SELECT 'OLS' AS estimator, {round_sql("my", 4)} AS intercept, {round_sql("c", 4)} AS coef FROM whole
    UNION ALL SELECT 'Ridge', {round_sql("my", 4)}, {round_sql("(n * c / (n + 5))", 4)} FROM whole
    UNION ALL SELECT 'Lasso', {round_sql("my", 4)}, {round_sql("(sign(c) * greatest(abs(c) - 5, 0))", 4)} FROM whole""", _TRAIN_CTE))
def _(spark, d):
    # Every estimator trains on the same written rows.
    data, rows = features(spark, d), []
    for estimator in regression.ESTIMATORS:
        model = _one_feature(data, estimator, [5]).model
        rows.append((estimator, model.intercept, float(model.coef[0])))
    return _rounded(spark.createDataFrame(rows, "estimator string, intercept double, coef double"), 4)


# Validation R2 of each fold for a one-feature ridge fit on the other folds.
_CV_CTE = _TRAIN_CTE + """,
    alphas AS (SELECT unnest({alphas}) AS alpha),
    fits AS (
        SELECT f.fold, alpha, avg(t.x) AS mx, avg(t.y) AS my, stddev_pop(t.x) AS sd,
               count(*) * covar_pop(t.x, t.y) / stddev_pop(t.x) / (count(*) + alpha) AS w
        FROM (SELECT DISTINCT fold FROM train) f JOIN train t ON t.fold != f.fold CROSS JOIN alphas GROUP BY f.fold, alpha
    ),
    scored AS (
        SELECT s.alpha, s.fold, 1 - sum(power(t.y - s.my - s.w * (t.x - s.mx) / s.sd, 2)) / (var_pop(t.y) * count(*)) AS r2
        FROM fits s JOIN train t ON t.fold = s.fold GROUP BY s.alpha, s.fold
    )"""


@query("ml08_cross_validation", _sql(
    f"SELECT {round_sql('avg(r2)', 6)} AS cv_score FROM scored", _CV_CTE.format(alphas="[0.0]")))
def _(spark, d):
    report = _one_feature(features(spark, d), "OLS")
    return _rounded(spark.createDataFrame([(report.cv_score,)], "cv_score double"))


@query("ml09_penalty_grid", _sql(
    f"SELECT alpha, {round_sql('avg(r2)', 6)} AS cv_score FROM scored GROUP BY alpha",
    _CV_CTE.format(alphas="[0.0, 0.01, 0.1, 0.2, 0.5, 1.0, 2.0, 5.0, 10.0]")))
def _(spark, d):
    report = _one_feature(features(spark, d), "Ridge")
    return _rounded(spark.createDataFrame(list(report.cv_scores.items()), "alpha double, cv_score double"))


@query("ml10_holdout_metrics", _sql(f"""
    SELECT {round_sql("(1 - sse / sst)", 6)} AS test_r2, {round_sql("sse / n", 2)} AS mse, {round_sql("sqrt(sse / n)", 4)} AS rmse
    FROM (SELECT count(*) AS n, sum(power(y - b0 - b1 * x, 2)) AS sse, var_pop(y) * count(*) AS sst
          FROM xy CROSS JOIN (SELECT regr_slope(y, x) AS b1, regr_intercept(y, x) AS b0 FROM train) WHERE split_at < 0.2)""", _TRAIN_CTE))
def _(spark, d):
    report = _one_feature(features(spark, d), "OLS")
    scores = report.model.holdout(report.test)
    return _rounded(_rounded(_rounded(scores, 6, "test_r2"), 2, "mse"), 4, "rmse")


@query("ml10_ridge_all_features")
def _(spark, d):
    rows = features(spark, d).filter("win IS NOT NULL")
    report = regression.linear_model(rows, "total_gold", PLAYER, None, _PP, "Ridge")
    metrics = {"alpha": report.model.alpha, **report.metrics()}
    return spark.createDataFrame([tuple(metrics.values())], ", ".join(f"{k} double" for k in metrics))
