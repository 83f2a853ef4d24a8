import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from arenalake.operators import joins, quality, quantiles, ranking, sampling, snapshots, stats
from arenalake.operators.quality import DROP, WARN, Expectation


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_last_snapshot_breaks_ties_the_same_way(spark):
    data = [("m", 1, 10, 5, 7), ("m", 1, 10, 6, 1), ("m", 1, 5, 9, 9), ("m", 2, 0, None, 3)]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "m string, p int, minute int, a int, b int").repartition(3)
        assert rows_of(snapshots.last_snapshot(df, ["m", "p"], "minute")) == [("m", 1, 10, 6, 1), ("m", 2, 0, None, 3)]


def test_last_per_side_gives_one_row_per_match(spark):
    df = spark.createDataFrame(
        [("m", "BLUE", 10, 1), ("m", "BLUE", 10, 2), ("m", "RED", 15, 4), ("m", "RED", 5, 9), ("n", "RED", 5, 1)],
        "match_id string, team string, minute int, team_kills int",
    )
    wide = snapshots.last_per_side(df, "match_id", "team", ["BLUE", "RED"], "minute", ["team_kills"])
    got = wide.select("match_id", "blue.team_kills", "red.team_kills", "last_minute")
    assert rows_of(got) == [("m", 2, 4, 15), ("n", None, 1, 5)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_plain_join_on_a_hot_key(spark, how):
    rng = random.Random(1)
    left = spark.createDataFrame(
        [("hot" if i % 3 == 0 else f"k{rng.randrange(200)}" if i % 50 else None, i) for i in range(3000)], "k string, a int"
    )
    right = spark.createDataFrame([("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(150)] + [(None, 9)], "k string, b int")
    assert rows_of(joins.spread_join(left, right, ["k"], how)) == rows_of(left.join(right, ["k"], how))


def test_hot_key_reaches_many_tasks(spark):
    left = spark.range(0, 6000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    hot = joins.HotKeys(left, "k")
    spread = hot.spread(left)
    per_salt = spread.filter("k = 'hot'").groupBy(joins.SALT).count().collect()
    assert len(per_salt) == hot.salts
    assert max(r["count"] for r in per_salt) < 2000 / 8
    # The salt belongs to the row, whatever order the rows come in.
    again = hot.spread(left.repartition(7, "id"), from_scan=False)
    assert again.exceptAll(hot.spread(left, from_scan=False)).count() == 0


def test_copies_in_several_files_get_several_salts(spark, tmp_path):
    path = str(tmp_path / "copies")
    spark.range(0, 4000, 1, 16).select(F.lit("hot").alias("k"), F.lit(1).alias("v")).write.parquet(path)
    copies = spark.read.parquet(path)
    assert joins.HotKeys(copies, "k").spread(copies).select(joins.SALT).distinct().count() > 4


def test_unresolved_keeps_null_keys(spark):
    facts = spark.createDataFrame([("A",), ("B",), (None,)], "name string")
    dim = spark.createDataFrame([("A",)], "name string")
    assert rows_of(joins.unresolved(facts, dim, "name")) == [("B",), (None,)]


def test_mode_tie_goes_to_smallest(spark):
    df = spark.createDataFrame([("c", "TOP", 2), ("c", "JUNGLE", 2), ("c", "MID", 1)], "name string, role string, cnt long")
    assert rows_of(ranking.mode_by(df, ["name"], "role")) == [("c", "JUNGLE", 0.4)]


def test_slot_pairs_count_copies(spark):
    df = spark.createDataFrame([(1, 1, 2, None)], "s0 int, s1 int, s2 int, s3 int")
    pairs = df.select(F.explode(ranking.slot_pairs(df.columns)).alias("p")).filter("p IS NOT NULL").select("p.*")
    assert rows_of(pairs) == [(1, 2), (1, 2)]


def test_distinct_members_with_missing_arrays(spark):
    df = spark.createDataFrame([("m", [1, 1], [2]), ("n", None, [3, None])], "m string, a array<int>, b array<int>")
    assert rows_of(ranking.distinct_members(df, "m", ["a", "b"], "c")) == [("m", 1), ("m", 2), ("n", 3), ("n", None)]


RULES = [
    Expectation("has_id", "id IS NOT NULL", DROP),
    Expectation("known", "team IN ('BLUE', 'RED')", DROP),
    Expectation("on_grid", "minute % 5 = 0", WARN),
]


def test_rules_split_the_input(spark):
    df = spark.createDataFrame(
        [(1, "BLUE", 5), (None, "RED", 7), (2, None, 10), (3, "RED", 7), (4, "RED", None)], "id int, team string, minute int"
    )
    kept, dropped = quality.keep_valid(df, RULES), quality.rejected(df, RULES)
    assert rows_of(kept.select("id")) == [(1,), (3,), (4,)]
    assert rows_of(dropped.select("id", F.concat_ws(",", "violated"))) == [(2, "known"), (None, "has_id")]
    counts = {r["rule"]: (r["action"], r["violations"]) for r in quality.audit(df, RULES).collect()}
    assert counts == {"has_id": ("drop", 1), "known": ("drop", 1), "on_grid": ("warn", 3)}


def test_key_reports(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), ("b", None)], "k string, v int")
    assert rows_of(quality.duplicate_keys(df, ["k"])) == [("a", 3)]
    assert quality.surplus_rows(df, ["k"]).first()[0] == 2
    assert rows_of(quality.null_rates(df)) == [("v", 25.0)]


@pytest.mark.parametrize("slices", [None, 1, 7])
def test_exact_percentiles(spark, slices):
    rng = random.Random(3)
    groups = {"a": [rng.gauss(0, 1) for _ in range(997)], "b": [float(rng.randrange(5)) for _ in range(800)], "c": [4.0], "d": [1.0, 2.0]}
    data = [(g, v) for g, values in groups.items() for v in values] + [("a", None), (None, 1.0)]
    df = spark.createDataFrame(data, "g string, v double").repartition(4)
    got = quantiles.exact_percentiles(df, "v", {"q1": 0.25, "med": 0.5, "q9": 0.9}, ["g"], slices)
    want = df.dropna().groupBy("g").agg(*[F.percentile("v", p) for p in (0.25, 0.5, 0.9)])
    assert {r[0]: pytest.approx(tuple(r)[1:]) for r in want.collect()} == {r[0]: tuple(r)[1:] for r in got.collect()}


def test_global_median_of_a_dominant_value(spark):
    df = spark.createDataFrame([(7,)] * 700 + [(i,) for i in range(300)], "v int").repartition(4)
    want = statistics.median([7] * 700 + list(range(300)))
    assert quantiles.medians(df, "v").first()[0] == want
    # Small limits force several narrowing rounds.
    assert quantiles.exact_percentiles(df, "v", {"m": 0.5}, slices=3).first()[0] == want


def test_percentile_with_a_far_outlier(spark):
    df = spark.createDataFrame([(float(i),) for i in range(500)] + [(1e12,)], "v double")
    got = quantiles.exact_percentiles(df, "v", {"a": 0.1, "m": 0.5, "top": 1.0}, slices=5).first()
    assert tuple(got) == (50.0, 250.0, 1e12)


def test_histogram_covers_everything(spark):
    df = spark.createDataFrame([(float(i % 10),) for i in range(100)] + [(None,)], "v double")
    bins = stats.histogram(df, "v", 5).orderBy("bin").collect()
    assert [b["cnt"] for b in bins] == [20, 20, 20, 20, 20]
    assert bins[0]["bin_start"] == 0.0 and bins[-1]["bin_end"] == 9.0
    flat = stats.histogram(df.select(F.lit(3.0).alias("v")), "v", 4)
    assert flat.agg(F.sum("cnt")).first()[0] == 101


def test_box_whiskers_leave_outliers_out(spark):
    df = spark.createDataFrame([("g", float(v)) for v in [1, 2, 3, 4, 5, 100]], "g string, v double")
    row = stats.box_stats(df, "v", "g").first()
    assert (row["q1"], row["median"], row["q3"]) == (2.25, 3.5, 4.75)
    assert (row["whisker_low"], row["whisker_high"]) == (1.0, 5.0)


def test_zero_length_matches_have_no_rate(spark):
    df = spark.createDataFrame([(100, 0), (100, 60)], "total_gold int, game_duration int")
    assert rows_of(stats.with_gold_per_minute(df).select("gold_per_min")) == [(100.0,), (None,)]


def test_samples_and_split(spark):
    df = spark.range(2000)
    train, test = sampling.hashed_split(df, ["id"])
    assert train.count() + test.count() == 2000 and train.intersect(test).count() == 0
    assert sampling.random_rows(df, 10).count() == 10
    assert rows_of(sampling.hashed_rows(df, ["id"], 10)) == rows_of(sampling.hashed_rows(df.repartition(5), ["id"], 10))


def test_top_k_matches_window(spark):
    df = spark.createDataFrame([("g", i % 7, i) for i in range(50)], "g string, n int, v int")
    order = [F.desc("n"), F.asc("v")]
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy(*order))).filter("rank <= 3")
    assert rows_of(ranking.top_k(df, ["g"], order, 3)) == rows_of(want)


@pytest.mark.parametrize("slices", [1, 4])
def test_percentiles_end_on_wide_ranges(spark, slices):
    """Infinities, values at the ends of a double, NaN and NULL: same as a plain sort, in one pass."""
    inf, nan = float("inf"), float("nan")
    cases = {
        "inf": [*range(19), inf, -inf], "wide": [1e308, -1e308, *range(18), 0.5], "all": [inf] * 5, "gap": [1.0, 2.0, nan],
        "null": [None, 3.0, None, 5.0, nan],
    }
    rows = [(g, None if v is None else float(v)) for g, vs in cases.items() for v in vs]
    got = quantiles.exact_percentiles(spark.createDataFrame(rows, "g string, v double"), "v", {"lo": 0.0, "m": 0.5, "hi": 1.0}, ["g"], slices)
    for r in got.collect():
        values = sorted(v for v in cases[r.g] if v is not None and v == v)
        half = (len(values) - 1) / 2
        a, b = values[int(half)], values[-(-(len(values) - 1) // 2)]
        assert (r.lo, r.m, r.hi) == (values[0], a if a == b else a * 0.5 + b * 0.5, values[-1])
