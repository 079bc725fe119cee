from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import cleaning, profile, shaping, transforms
from ledgerline.operators.ordering import SortKey, ascending, descending, ordered, top_k


def test_duplicate_rows_with_nulls_are_one_row(spark, rows):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (None, None)], "k int, v string")
    assert rows(cleaning.drop_duplicate_rows(df)) == [(None, None), (1, None), (1, "a")]


def test_duplicate_report(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a")], "k int, v string")
    assert tuple(cleaning.duplicate_report(df).first()) == (3, 2, 1)
    assert tuple(cleaning.duplicate_report(df.limit(0)).first()) == (0, 0, 0)


def test_fill_everything_covers_numbers_nan_and_text(spark, rows):
    df = spark.createDataFrame(
        [(None, None, None), (float("nan"), 2, "x")], "d double, i int, s string"
    )
    assert rows(cleaning.fill_everything(df)) == [(0.0, 0, "0"), (0.0, 2, "x")]


def test_fill_columns_keeps_types(spark):
    df = spark.createDataFrame([(None, None)], "salary float, name string")
    filled = cleaning.fill_columns(df, {"salary": 80000.0})
    assert filled.dtypes == df.dtypes
    assert tuple(filled.first()) == (80000.0, None)


def test_drop_rows_missing_any(spark, rows):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a int, b int")
    assert rows(cleaning.drop_rows_missing(df, "a")) == [(1, None), (3, 4)]
    assert rows(cleaning.drop_rows_missing(df, "a", "b")) == [(3, 4)]


def test_trim_leaves_inner_space_and_null(spark, rows):
    df = spark.createDataFrame([("  a b ",), (None,)], "s string")
    assert rows(cleaning.trim_columns(df, "s")) == [(None,), ("a b",)]


def test_range_guard_is_inclusive(spark, rows):
    df = spark.createDataFrame([(17,), (18,), (100,), (101,), (None,)], "age int")
    assert rows(cleaning.keep_in_range(df, "age", 18, 100)) == [(18,), (100,)]
    nulled = cleaning.null_outside_range(df, "age", 18, 100)
    assert rows(nulled) == [(None,), (None,), (None,), (18,), (100,)]
    assert rows(cleaning.drop_rows_missing(nulled, "age")) == [(18,), (100,)]


def test_clean_rows_order_of_steps(spark, rows):
    df = spark.createDataFrame(
        [
            (20, None, " West ", "2024-01-05"),
            (None, 5.0, "East", "2024-01-06"),
            (17, 5.0, "East", "2024-01-06"),
            (30, 7.0, "East", "bad"),
        ],
        "age int, price double, region string, day string",
    )
    out = cleaning.clean_rows(
        df,
        fill={"price": 0.0},
        required=["age"],
        trim=["region"],
        dates=["day"],
        ranges={"age": (18, 100)},
    )
    assert out.dtypes[3] == ("day", "date")
    assert [(a, p, r, d and str(d)) for a, p, r, d in rows(out)] == [
        (20, 0.0, "West", "2024-01-05"),
        (30, 7.0, "East", None),
    ]


def test_clean_rows_is_one_narrow_stage(spark, plan_of):
    df = spark.createDataFrame([(1, " a")], "age int, region string")
    out = cleaning.clean_rows(
        df, fill={}, required=["age"], trim=["region"], dates=[], ranges={"age": (0, 5)}
    )
    assert "Exchange" not in plan_of(out)


def test_null_counts_include_nan_on_request(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, None)], "x double, s string")
    assert tuple(profile.null_counts(df).first()) == (2, 2)
    assert tuple(profile.null_counts(df, nan_is_missing=False).first()) == (1, 2)
    assert tuple(profile.null_counts(df, ["s"]).first()) == (2,)


def test_shape_schema_and_description(spark, rows):
    df = spark.createDataFrame([(1, 2.0), (3, None)], "a int, b double")
    assert tuple(profile.table_shape(df).first()) == (2, 2)
    assert rows(profile.schema_frame(df)) == [(1, "a", "int", 2), (2, "b", "double", 1)]
    described = {r["column_name"]: r for r in profile.describe_columns(df, ["a", "b"]).collect()}
    assert described["a"]["mean"] == 2.0
    assert math.isclose(described["a"]["stddev"], math.sqrt(2))
    assert (described["b"]["n_values"], described["b"]["stddev"]) == (1, None)


def test_head_and_tail(spark):
    df = spark.createDataFrame([(3,), (1,), (None,), (2,)], "a int")
    assert [r[0] for r in profile.head_rows(df, 2, ["a"]).collect()] == [None, 1]
    assert [r[0] for r in profile.tail_rows(df, 2, ["a"]).collect()] == [3, 2]
    last = SortKey("a", True, nulls_first=False)
    assert [r[0] for r in profile.tail_rows(df, 2, [last]).collect()] == [None, 3]


def test_null_order_is_stated(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "a int")
    assert [r[0] for r in ordered(df, [ascending("a")]).collect()] == [None, 1, 2]
    assert [r[0] for r in ordered(df, [descending("a")]).collect()] == [2, 1, None]
    assert [r[0] for r in ordered(df, [descending("a", True)]).collect()] == [None, 2, 1]
    assert [r[0] for r in ordered(df, [ascending("a", False)]).collect()] == [1, 2, None]


def test_top_k_exchanges_only_candidates(spark, plan_of):
    df = spark.range(100).selectExpr("id AS a")
    top = top_k(df, 3, [descending("a")])
    assert [r[0] for r in top.collect()] == [99, 98, 97]
    assert "TakeOrderedAndProject" in plan_of(top)


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], [" Order ID", "Sub-Category ", "City"])
    assert shaping.clean_column_names(df).columns == ["Order_ID", "Sub_Category", "City"]
    assert shaping.rename_columns(df, {"City": "town"}).columns[2] == "town"
    assert shaping.drop_columns(df, "City").columns == [" Order ID", "Sub-Category "]


def test_whole_part_truncates_and_does_not_overflow(spark):
    df = spark.createDataFrame([(2.9,), (-2.9,), (1e30,), (None,)], "x double")
    out = transforms.add_whole_part(df, "n", "x", "int")
    assert [r["n"] for r in out.collect()] == [2, -2, None, None]


def test_rounding_in_place(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (1.25,)], "x double")
    assert [r[0] for r in transforms.add_rounded(df, "x", "x").collect()] == [3.0, -3.0, 1.0]


@pytest.fixture
def copies(spark, tmp_path):
    df = spark.range(4000).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('t', id % 1500)) AS text", "IF(id % 3 = 0, NULL, id % 2) AS n",
        "CASE WHEN id % 3 = 0 THEN 0.0 WHEN id % 5 = 0 THEN double('NaN') WHEN id % 7 = 0 THEN -0.0 ELSE 0.0 END AS x", "id",
    )
    df.repartition(6).write.parquet(str(tmp_path / "t"))
    return spark.read.parquet(str(tmp_path / "t"))


def test_locator_dedup_equals_full_row_dedup(copies):
    columns = ["text", "n", "x"]
    found = cleaning.drop_duplicates_by_locator(copies, columns)
    plain = cleaning.drop_duplicate_rows(copies.select(*columns))
    assert sorted(map(str, found.select(*columns).collect())) == sorted(map(str, plain.collect()))
    # The locator is that of a row with these values, the smallest one.
    places = copies.select("*", "_metadata.file_path", "_metadata.row_index").groupBy(*columns).agg(
        F.min(F.struct("file_path", "row_index")).alias("at")
    )
    expected = {(r.at.file_path, r.at.row_index) for r in places.collect()}
    assert {(r.file_path, r.row_index) for r in found.collect()} == expected


def test_locator_dedup_tells_rows_with_equal_digests_apart(copies, monkeypatch):
    monkeypatch.setattr(cleaning, "row_hash", lambda schema, salt: F.lit(salt).cast("bigint"))
    found = cleaning.drop_duplicates_by_locator(copies, ["text", "n"])
    assert found.count() == copies.select("text", "n").distinct().count()


def test_locator_dedup_of_filtered_and_empty_scans(copies):
    assert cleaning.drop_duplicates_by_locator(copies.where("id < 0")).count() == 0
    assert cleaning.drop_duplicates_by_locator(copies.where("id < 30"), ["text"]).count() == 21
    assert cleaning.drop_duplicates_by_locator(copies).count() == 4000


def test_digest_exchange_has_no_text(copies, plan_of, monkeypatch):
    plans = []
    monkeypatch.setattr(cleaning, "freeze", lambda df, label: plans.append(plan_of(df)) or df)
    cleaning.drop_duplicates_by_locator(copies, ["text", "n"])
    (plan,) = plans
    exchange = next(line for line in plan.splitlines() if "Exchange" in line)
    assert "hashpartitioning(_a" in exchange and plan.count("Exchange") == 1
    above_scan = plan[: plan.index("Project")].replace(exchange, "")
    assert "text" not in above_scan
