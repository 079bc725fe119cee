"""Copies compared by fingerprints first."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline import sources

SCHEMA = "id bigint, text string, x double"


def surplus(left, right):
    count = Counter(map(tuple, left.collect()))
    count.subtract(map(tuple, right.collect()))
    return {row: n for row, n in count.items() if n}


def found(left, right, **options):
    return {tuple(r)[:-1]: r.surplus for r in sources.row_differences(left, right, **options).collect()}


@pytest.fixture
def base(spark):
    return spark.range(3000).selectExpr("id % 1000 AS id", "concat('text ', id % 7) AS text", "id / 8 AS x")


@pytest.mark.parametrize("buckets", [1, 16, 4096])
def test_differences_equal_counting(spark, base, buckets):
    changed = base.withColumn("text", F.when(F.col("id") == 5, None).otherwise(F.col("text")))
    for right in (base.repartition(7, "x"), changed, base.where("id <> 3"), base.unionByName(base.where("id = 9")), base.limit(0)):
        assert found(base, right, buckets=buckets) == surplus(base, right)
        checked = sources.verify_copy(base, right, buckets=buckets).first()
        assert tuple(checked) == (3000, right.count(), len(surplus(base, right)))


def test_hard_rows(spark):
    def rows(*values):
        return spark.createDataFrame(list(values), SCHEMA)

    # A null that changes place, copies that would cancel in pairs, swapped cells of two rows.
    assert found(rows((1, None, 2.0)), rows((None, "1", 2.0))) == {(1, None, 2.0): 1, (None, "1", 2.0): -1}
    twice = [(1, "a", 1.0)] * 2
    assert found(rows(*twice, *twice), rows(*twice)) == {(1, "a", 1.0): 2}
    assert len(found(rows((1, "a", 1.0), (2, "b", 1.0)), rows((1, "b", 1.0), (2, "a", 1.0)))) == 4
    assert found(rows((1, "a", 0.0), (2, "b", float("nan"))), rows((1, "a", -0.0), (2, "b", float("nan")))) == {}
    assert found(rows(), rows()) == {}


def test_types_of_the_sides_may_differ(spark):
    left = spark.createDataFrame([(1, 2.5), (2, 3.0)], "id int, x double")
    right = spark.createDataFrame([(2.5, 1), (3.0, 2)], "x double, id bigint")
    assert tuple(sources.verify_copy(left, right).first()) == (2, 2, 0)
    assert found(left, right.withColumn("id", F.col("id") + 0.5)) != {}


def test_fingerprints_of_parts_add_up(spark, base):
    whole = sources.fingerprints(base, buckets=32)
    parts = [sources.fingerprints(base.where(f"id % 3 = {i}"), buckets=32) for i in range(3)]
    summed = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("bucket").sum(*whole.columns[1:])
    assert sorted(map(tuple, summed.collect())) == sorted(map(tuple, whole.collect()))


def test_equal_sides_exchange_only_fingerprints(spark, base, plan_of, tmp_path):
    base.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = plan_of(sources.fingerprints(stored))
    exchange = next(line for line in plan.splitlines() if "Exchange" in line)
    assert "hashpartitioning(bucket" in exchange
    below = plan[plan.index(exchange) :]
    partial = next(line for line in below.splitlines() if "HashAggregate" in line)
    assert "text" not in partial.split("output=")[-1] and "partial_sum" in partial
    equal = plan_of(sources.verify_copy(stored, base))
    assert "FileScan" not in equal and "Exchange" not in equal
    assert "FileScan" in plan_of(sources.verify_copy(stored, base.limit(10)))
