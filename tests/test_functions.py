"""Column functions: NULL rules, rounding, exactness, text forms."""

import math
from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hirelattice import functions as fn


def values(spark, column, rows, schema="x double"):
    return [r[0] for r in spark.createDataFrame([(x,) for x in rows], schema).select(column).collect()]


def test_month_stays_a_date(spark):
    out = values(spark, fn.month_of("x"), [date(2025, 2, 28), None], "x date")
    assert out == [date(2025, 2, 1), None]


def test_days_between_keeps_null(spark):
    df = spark.createDataFrame([(date(2025, 1, 1), date(2025, 1, 31)), (date(2025, 1, 1), None)], "a date, b date")
    assert [r[0] for r in df.select(fn.days_between("a", "b")).collect()] == [30, None]


def test_parse_day(spark):
    assert values(spark, fn.parse_day("x"), ["2025-01-31", "", "  ", None], "x string") == [date(2025, 1, 31), None, None, None]
    with pytest.raises(Exception, match="not a date: 31/01/2025"):
        values(spark, fn.parse_day("x"), ["31/01/2025"], "x string")


def test_percentage_rounds_half_up_and_survives_zero(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (0, 0), (None, 2)], "k bigint, n bigint")
    assert [r[0] for r in df.select(fn.percentage(F.col("k"), F.col("n"), 1)).collect()] == [12.5, 33.3, None, None]
    df = spark.createDataFrame([(1, 800)], "k bigint, n bigint")
    assert df.select(fn.percentage(F.col("k"), F.col("n"), 2)).first()[0] == 0.13  # 0.125


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1.0, 4), (1.0, 0), (None, 1), (1.0, None)], "a double, b bigint")
    assert [r[0] for r in df.select(fn.safe_ratio(F.col("a"), F.col("b"))).collect()] == [0.25, None, None, None]


def test_clip_keeps_null(spark):
    assert values(spark, fn.clip(F.col("x"), 7, 120), [1.0, 50.0, 500.0, None]) == [7.0, 50.0, 120.0, None]


def test_ids(spark):
    assert values(spark, fn.padded_id("v_", "x", 4), [7, 12345, None], "x bigint") == ["v_0007", "v_12345", None]
    assert values(spark, fn.trailing_number("x", "cand_"), ["cand_00042", None], "x string") == [42, None]


@settings(max_examples=25, deadline=None)
@given(cents=st.lists(st.integers(-10**12, 10**12), min_size=1, max_size=30))
def test_exact_total_is_exact(spark, cents):
    amounts = [c / 100 for c in cents]
    total = values(spark, fn.exact_total("x"), amounts)[0]
    assert total == sum(cents) / 100


def test_exact_total_and_mean_of_nothing(spark):
    assert values(spark, fn.exact_total("x"), [None, None]) == [None]
    assert values(spark, fn.exact_mean("x"), [None, None]) == [None]
    assert values(spark, fn.exact_mean("x"), [1.0, None, 2.0]) == [1.5]


@pytest.mark.parametrize(
    "value, text",
    [
        (280.0, "280"), (0.5, "0.5"), (-3.0, "-3"), (0.0, "0"), (3758439620.06, "3758439620.06"), (None, "null"),
        (1e20, "100000000000000000000"), (1e21, "1e+21"), (1.5e22, "1.5e+22"), (1e-7, "1e-7"), (2.5e-7, "2.5e-7"),
        (0.000001, "0.000001"), (0.1, "0.1"), (1234567.891, "1234567.891"), (-0.25, "-0.25"), (100.0, "100"),
        (12345678901234.5, "12345678901234.5"),
    ],
)
def test_plain_number(spark, value, text):
    assert values(spark, fn.plain_number("x"), [value]) == [text]


def test_console_number(spark):
    column = fn.plain_number("x", "None", ".0")
    assert values(spark, column, [280.0, 0.0, 0.5, None]) == ["280.0", "0.0", "0.5", "None"]


@settings(max_examples=40, deadline=None)
@given(st.floats(min_value=1e-5, max_value=1e15, allow_nan=False))
def test_plain_number_reads_back(spark, value):
    assert math.isclose(float(values(spark, fn.plain_number("x"), [value])[0]), value, rel_tol=1e-15)
