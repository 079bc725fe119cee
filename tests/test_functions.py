from __future__ import annotations

from fractions import Fraction

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerline import functions as fn


def test_totals_do_not_depend_on_row_order(spark):
    amounts = [(0.1,), (0.2,), (0.3,), (104949.99,), (-0.01,)] * 200
    forward = spark.createDataFrame(amounts, "x double").repartition(3)
    backward = spark.createDataFrame(amounts[::-1], "x double").coalesce(1)
    totals = {df.agg(fn.units_total("x", 2)).first()[0] for df in (forward, backward)}
    assert totals == {20990116.0}


def test_units_keep_sign_and_null(spark):
    df = spark.createDataFrame([(1.15,), (-1.15,), (None,), (-0.0,)], "x double")
    assert [r[0] for r in df.select(fn.units("x", 2)).collect()] == [115, -115, None, 0]


def test_units_mean_skips_nulls(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (float("nan"),)], "x double")
    for scale in (None, 0, 2):
        assert df.agg(fn.units_mean("x", scale)).first()[0] == 1.5
        assert df.agg(fn.units_total("x", scale)).first()[0] == 3.0


def test_total_of_nothing_is_null(spark):
    df = spark.createDataFrame([], "x double")
    for scale in (None, 2):
        assert df.agg(fn.units_total("x", scale)).first()[0] is None


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_totals_above_the_bigint_range(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(9 * 10**18,)] * 4 + [(-5,)], "u bigint").repartition(3)
        assert df.agg(fn.exact_total("u")).first()[0] == 36 * 10**18 - 5
        amounts = spark.createDataFrame([(9e16,)] * 4, "x double")
        assert amounts.agg(fn.units_total("x", 2)).first()[0] == 3.6e17
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize(("amount", "scale"), [(0.004, 2), (2.9, 0), (float("inf"), 2)])
def test_digits_beyond_the_stated_ones_are_refused(spark, amount, scale):
    df = spark.createDataFrame([(amount,)], "x double")
    with pytest.raises(PySparkException, match="not whole"):
        df.agg(fn.units_total("x", scale)).collect()


@pytest.mark.parametrize(
    ("amount", "expected"), [(10.05, 1.01), (10.04, 1.0), (None, None), (-10.05, -1.01)]
)
def test_share_rounds_half_cents_away_from_zero(spark, amount, expected):
    df = spark.createDataFrame([(amount,)], "x double")
    assert df.select(fn.share_of("x", "0.10")).first()[0] == expected


def test_bands_take_the_highest_floor_reached(spark):
    df = spark.createDataFrame([(95.0,), (90.0,), (89.9,), (70.0,), (1.0,), (None,)], "x double")
    label = fn.banded("x", [(70.0, "B"), (90.0, "A")], "C")
    assert [r[0] for r in df.select(label).collect()] == ["A", "A", "B", "B", "C", "C"]


def test_two_way_label_of_null_is_no(spark):
    df = spark.createDataFrame([(5,), (1,), (None,)], "x int")
    label = fn.two_way_label(F.col("x") >= 5, "yes", "no")
    assert [r[0] for r in df.select(label).collect()] == ["yes", "no", "no"]


def test_dates_that_do_not_parse_are_null(spark):
    df = spark.createDataFrame([("2024-02-29",), ("2023-02-29",), ("1/2/2024",), (None,)], "d string")
    parsed = [r[0] for r in df.select(fn.parsed_date("d").cast("string")).collect()]
    assert parsed == ["2024-02-29", None, None, None]


def test_date_parts(spark):
    df = spark.sql("SELECT DATE'2024-03-09' AS d")
    row = df.select(fn.year_number("d"), fn.year_text("d"), fn.month_text("d")).first()
    assert tuple(row) == (2024, "2024", "03")


def test_amounts_without_fixed_digits(spark):
    df = spark.createDataFrame([(0.004,)] * 1000, "x double")
    assert df.agg(fn.units_total("x", 3)).first()[0] == 4.0
    assert abs(df.agg(fn.units_total("x")).first()[0] - 4.0) < 1e-9
    assert abs(df.agg(fn.units_mean("x")).first()[0] - 0.004) < 1e-12


def test_shares_use_all_stored_digits(spark):
    df = spark.createDataFrame([(100.049,), (1.005,)], "x double")
    assert [r[0] for r in df.select(fn.share_of("x", "0.10")).collect()] == [10.0, 0.1]
    assert [r[0] for r in df.select(fn.raised_by("x", "0.10")).collect()] == [110.05, 1.11]


def deviation_of(values, scale):
    whole = [round(v * 10**scale) for v in values]
    n = len(whole)
    return (Fraction(n * sum(x * x for x in whole) - sum(whole) ** 2, n * (n - 1)) ** 0.5) / 10**scale


@pytest.mark.parametrize(
    ("values", "scale"),
    [
        ([0.1, 0.2, 0.3, 104949.99, -0.01] * 40, 2),
        ([1e13 + k / 8 for k in (0, 8, 16, 24)], 0),  # large and close together: doubles would cancel
        ([-9007199254740.99, 9007199254740.99, 0.0], 2),
        ([-1.5, -1.5, -1.5], 1),
        ([0.0] * 999 + [1.0], 0),
    ],
)
def test_deviation_is_exact(spark, values, scale):
    found = spark.createDataFrame([(v,) for v in values], "x double").agg(fn.units_deviation("x", scale)).first()[0]
    assert found == pytest.approx(deviation_of(values, scale), rel=1e-14, abs=0)


def test_deviation_does_not_depend_on_partitions(spark):
    df = spark.range(20_000).selectExpr("(id * 7919 % 1000003) / 100 AS x", "id % 3 AS g")
    found = {
        tuple(sorted(map(tuple, df.repartition(k, "x").groupBy("g").agg(fn.units_deviation("x", 2)).collect()))) for k in (1, 3, 17)
    }
    assert len(found) == 1


def test_deviation_of_few_values_and_gaps(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (2, None), (3, 1.0), (3, float("nan")), (3, 2.0)], "g int, x double")
    assert dict(map(tuple, df.groupBy("g").agg(fn.units_deviation("x", 0)).collect())) == {1: None, 2: None, 3: 0.5**0.5}


def test_squares_of_many_large_numbers_stay_exact(spark):
    largest = 2**53 - 1
    df = spark.range(1000).selectExpr(f"IF(id % 2 = 0, {largest}, -{largest}) AS x")
    assert int(df.agg(fn.money.exact_squares("x")).first()[0]) == 1000 * largest**2
