"""Stored layouts that save later exchanges."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from ledgerline.operators import layout


@pytest.fixture
def by_key(spark, tmp_path):
    df = spark.range(5000).selectExpr("id", "IF(id % 3 = 0, 7, id % 100) AS k", "id % 11 AS part", "id * 2 AS v")
    yield layout.store_bucketed(df, "t_by_key", str(tmp_path / "a"), ["k"], 8), df
    spark.sql("DROP TABLE IF EXISTS t_by_key")


def test_groupings_and_joins_on_the_key_exchange_nothing(spark, by_key, plan_of, rows, tmp_path):
    stored, df = by_key
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        other = layout.store_bucketed(spark.range(100).withColumnRenamed("id", "k"), "t_keys", str(tmp_path / "b"), ["k"], 8)
        count, total = F.count("*").alias("n"), F.sum("v").alias("total")
        found = stored.groupBy("k").agg(count).join(stored.groupBy("k").agg(total), "k").join(other, "k")
        assert "Exchange" not in plan_of(found)
        assert rows(found) == rows(df.groupBy("k").agg(count, total))
        assert "Exchange" not in plan_of(stored.join(other, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS t_keys")


def test_one_file_for_each_bucket(by_key, tmp_path):
    assert 0 < len(list(Path(tmp_path / "a").glob("*.parquet"))) <= 8


def test_a_name_is_given_to_a_new_store(spark, by_key, rows, tmp_path):
    again = layout.store_bucketed(spark.range(3).withColumnRenamed("id", "k"), "t_by_key", str(tmp_path / "c"), ["k"], 4)
    assert rows(again) == [(0,), (1,), (2,)]
    broken = spark.range(3).select(F.raise_error(F.lit("torn")).cast("bigint").alias("k"))
    with pytest.raises(Exception, match="torn"):
        layout.store_bucketed(broken, "t_by_key", str(tmp_path / "d"), ["k"], 4)
    assert rows(spark.table("t_by_key")) == [(0,), (1,), (2,)]


def test_hot_keys_are_split_by_finer_columns(spark, plan_of, rows, tmp_path):
    df = spark.range(6000).selectExpr("IF(id % 2 = 0, 1, id % 50) AS k", "id % 40 AS part", "id AS v")
    stored = layout.store_bucketed(df, "t_finer", str(tmp_path / "f"), ["k", "part"], 8)
    sums = {"total": F.col("v"), "n": F.lit(1)}
    found = layout.grouped_in_steps(stored, ["k"], ["part"], sums)
    plan = plan_of(found)
    assert plan.count("Exchange") == 1  # the small finer totals
    assert rows(found) == rows(df.groupBy("k").agg(F.sum("v"), F.count("*")))
    spark.sql("DROP TABLE t_finer")


def test_registered_groupings_exchange_no_line_items(spark, sf_dir, plan_of):
    plan = plan_of(queries()["bucketed_groupings"](spark, sf_dir))
    assert "Exchange hashpartitioning" not in plan and plan.count("FileScan") == 3
