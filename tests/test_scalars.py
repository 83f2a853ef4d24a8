import datetime as dt

import pytest
from pyspark.sql import functions as F

from arenalake.functions import scalars as S
from arenalake.functions.registry import register_sql_functions


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("text,want", [
    ("2.5", 3), ("-2.5", -3), (" 7 ", 7), ("1e2", 100), ("abc", None), ("", None), ("3e9", None), ("NaN", None),
    ("Infinity", None), (None, None),
])
def test_safecast_to_int(spark, text, want):
    assert one(spark, S.safecast_to_int(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("number,seat,team", [
    (3210, 10, "RED"), (3156, 6, "RED"), (1, 1, "BLUE"), (5, 5, "BLUE"), (0, 0, None), (-5, -5, None),
])
def test_seat_from_running_number(spark, number, seat, team):
    column = S.cyclic_position(F.lit(number))
    assert one(spark, column) == seat
    assert one(spark, S.team_from_position(column)) == team


@pytest.mark.parametrize("code,team", [("100", "BLUE"), ("200", "RED"), ("300", None), (None, None)])
def test_team_code(spark, code, team):
    assert one(spark, S.team_from_code(F.lit(code).cast("string"))) == team


@pytest.mark.parametrize("text,want", [("1,-1,x, 5", [1, 0, None, 5]), (None, None), ("", [None])])
def test_ban_list(spark, text, want):
    assert one(spark, S.ban_list(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("role,want", [("utility", "SUPPORT"), ("top", "TOP"), ("invalid", "INVALID"), (None, None)])
def test_role(spark, role, want):
    assert one(spark, S.normalise_role(F.lit(role).cast("string"))) == want


@pytest.mark.parametrize("text,want", [("TwistedFate", "Twisted Fate"), ("doran's BLADE", "Doran's Blade"), (" aB ", "A B")])
def test_title_case(spark, text, want):
    assert one(spark, S.pascal_to_title_case(F.lit(text))) == want


def test_missing_duration_counts_as_fresh(spark):
    assert one(spark, S.unlogged_duration(F.lit(None).cast("int"), F.lit(20))) == 0
    assert one(spark, S.unlogged_duration(F.lit(1300), F.lit(20))) == 100


def test_ratios_without_division_errors(spark):
    rows = spark.createDataFrame([(1, -1, 2)], "kills int, deaths int, assists int")
    assert rows.select(S.kda().alias("v")).first()["v"] is None
    assert one(spark, S.rate(F.lit(1), F.lit(0))) is None


def test_sql_functions(spark):
    register_sql_functions(spark)
    row = spark.sql("""
        SELECT pascal_to_title_case('TwistedFate') AS a, safecast_to_int('2.5') AS b, valid_num_range(11, 1, 10) AS c,
               valid_ts_range(TIMESTAMP '2020-01-01', TIMESTAMP '2019-01-01', TIMESTAMP '2021-01-01') AS d,
               nullify_caplen('abcd', 3) AS e, nullify_caplen('abc', 3) AS f
    """).first()
    assert (row.a, row.b, row.c, row.d, row.e, row.f) == (
        "Twisted Fate", 3, None, dt.datetime(2020, 1, 1), None, "abc"
    )
    assert one(spark, S.valid_num_range(F.lit(5), 1, 10)) == 5.0
    assert one(spark, S.nullify_caplen(F.lit("abcd"), 3)) is None
    stamp = F.lit("2020-01-01").cast("timestamp")
    assert one(spark, S.valid_ts_range(stamp, stamp, stamp)) == dt.datetime(2020, 1, 1)


def test_key_fraction_is_repeatable_and_even(spark):
    rows = spark.range(20_000).select(S.key_fraction("id").alias("f"))
    low, high, below = rows.agg(F.min("f"), F.max("f"), F.avg((F.col("f") < 0.2).cast("int"))).first()
    assert 0 <= low and high < 1 and abs(below - 0.2) < 0.02
    assert rows.exceptAll(spark.range(20_000).select(S.key_fraction("id").alias("f"))).count() == 0
