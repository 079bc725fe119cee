"""Distinct counts from stored bitmaps."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerline import sources
from ledgerline.operators import distinct_state as ds


@pytest.fixture
def events(spark):
    return spark.range(60_000).selectExpr(
        "CAST(id % 12 AS INT) AS month", "IF(id % 4 = 0, 'x', concat('k', id % 5)) AS kind",
        "CASE WHEN id % 97 = 0 THEN NULL WHEN id % 3 = 0 THEN 'hot' ELSE concat('v', id * 31 % 41000) END AS value",
    )


def test_any_range_equals_counting(events, rows):
    states = ds.distinct_states(events, ["month", "kind"], "value", ds.value_numbers(events, "value"))
    for low, high in ((0, 11), (3, 3), (4, 8)):
        within = F.col("month").between(low, high)
        found = ds.distinct_counts(states.where(within), ["kind"], "n")
        assert rows(found) == rows(events.where(within).groupBy("kind").agg(F.count_distinct("value").alias("n")))
    assert ds.distinct_counts(states, [], "n").first()["n"] == events.select("value").where("value IS NOT NULL").distinct().count()
    assert ds.distinct_counts(states.where("month > 50"), [], "n").first()["n"] == 0


def test_a_new_month_adds_rows_and_keeps_numbers(spark, events, rows, tmp_path, plan_of):
    path = str(tmp_path / "states")
    early, late = events.where("month < 6"), events.where("month >= 6")
    numbers = ds.value_numbers(early, "value")
    sources.write_parquet(ds.distinct_states(early, ["month", "kind"], "value", numbers), path, partition_by=["month"])
    more = ds.value_numbers(late, "value", numbers)
    kept = numbers.join(more.withColumnRenamed("number", "now"), "value").where("number <> now").count()
    assert kept == 0 and more.count() == more.select("number").distinct().count() == events.select("value").distinct().count() - 1
    ds.distinct_states(late, ["month", "kind"], "value", more).write.mode("append").partitionBy("month").parquet(path)
    stored = spark.read.parquet(path)
    found = ds.distinct_counts(stored.where("month BETWEEN 4 AND 9"), ["kind"], "n")
    assert "PartitionFilters: [isnotnull(month" in plan_of(found)
    expected = events.where("month BETWEEN 4 AND 9").groupBy("kind").agg(F.count_distinct("value").alias("n"))
    assert rows(found) == rows(expected)
    again = ds.merged_states(stored.unionByName(stored), ["kind"])
    assert rows(ds.distinct_counts(again, ["kind"], "n")) == rows(events.groupBy("kind").agg(F.count_distinct("value").alias("n")))


def test_nothing_and_only_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "k int, value string")
    numbers = ds.value_numbers(df, "value")
    assert numbers.count() == 0 and ds.distinct_states(df, ["k"], "value", numbers).count() == 0
    assert ds.value_numbers(df, "value", numbers).count() == 0
