from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ledgerline.functions import from_units, units
from ledgerline.operators import aggregates, filters, layout, normalise, quality, subqueries
from ledgerline.operators.joins import aggregate_then_join, join_dimension


def test_date_range_includes_the_last_day(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP_NTZ'2016-12-31 23:59:59'), (TIMESTAMP_NTZ'2017-01-01 00:00:00'),"
        " (TIMESTAMP_NTZ'2016-01-01 00:00:00'), (NULL) AS t(at)"
    )
    first, last = date(2016, 1, 1), date(2016, 12, 31)
    assert filters.where_date_between(df, "at", first, last).count() == 2
    days = df.select(F.to_date("at").alias("day"))
    assert filters.where_date_between(days, "day", first, last).count() == 2
    texts = days.sparkSession.createDataFrame([("1996-1-5",), ("11/8/1996",), ("later",), (None,)], "t string")
    assert filters.where_date_between(texts, "t", date(1996, 1, 1), date(1996, 12, 31)).count() == 0
    us = filters.where_date_between(texts, "t", date(1996, 1, 1), date(1996, 12, 31), pattern="M/d/yyyy")
    assert [r.t for r in us.collect()] == ["11/8/1996"]


def test_predicates(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "b"), (3, "b")], "n int, s string")
    assert rows(filters.where_equal(df, "s", "b")) == [(None, "b"), (3, "b")]
    assert rows(filters.where_greater(df, "n", 2)) == [(3, "b")]
    assert rows(filters.where_less(df, "n", 2)) == [(1, "a")]
    assert rows(filters.where_between(df, "n", 1, 2)) == [(1, "a"), (2, None)]
    assert rows(filters.where_all(df, F.col("n") > 1, F.col("s") == "b")) == [(3, "b")]
    assert rows(filters.where_any_null(df, ["n", "s"])) == [(None, "b"), (2, None)]
    assert rows(filters.where_text(df, "n > 1 AND s IS NULL")) == [(2, None)]


def test_above_average_ignores_nulls_in_the_average(spark, rows):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "x double")
    assert rows(subqueries.above_average(df, "x")) == [(3.0,)]
    assert rows(subqueries.above_average(df.limit(0), "x")) == []


def test_group_maximum_keeps_ties(spark, rows):
    df = spark.createDataFrame(
        [("a", 5, 1), ("a", 5, 2), ("a", 4, 3), ("b", None, 4), (None, 9, 5)],
        "k string, v int, id int",
    )
    assert rows(subqueries.rows_at_group_maximum(df, "k", "v")) == [("a", 5, 1), ("a", 5, 2)]


def test_aggregate_then_join_equals_join_then_aggregate(spark, rows):
    fact = spark.createDataFrame(
        [(1, 1.1), (1, 2.2), (2, 3.3), (3, 9.9), (None, 5.0), (2, None)], "k int, x double"
    )
    dim = spark.createDataFrame(
        [(1, "red"), (2, "red"), (2, "blue"), (4, "blue"), (None, "none")], "id int, colour string"
    )
    measures = {
        "total": ("sum", units("x", 2)),
        "n": ("count", None),
        "filled": ("count", "x"),
        "low": ("min", "x"),
        "high": ("max", "x"),
    }
    early = aggregate_then_join(fact, dim, "k", "id", ["colour"], measures)
    late = (
        join_dimension(fact, dim, "k", "id")
        .groupBy("colour")
        .agg(
            F.sum(units("x", 2)).alias("total"),
            F.count("*").alias("n"),
            F.count("x").alias("filled"),
            F.min("x").alias("low"),
            F.max("x").alias("high"),
        )
    )
    assert rows(early) == rows(late)
    assert len(rows(late)) == 2


def test_hot_key_joins_as_one_row(spark):
    fact = spark.range(3000).select(
        F.when(F.col("id") < 2000, 7).otherwise(F.col("id") % 50).alias("k"), F.lit(1.0).alias("x")
    )
    dim = spark.range(50).select(F.col("id").alias("d"), (F.col("id") % 2).alias("parity"))
    out = aggregate_then_join(fact, dim, "k", "d", ["parity"], {"n": ("count", None)})
    assert {r["parity"]: r["n"] for r in out.collect()} == {0: 500, 1: 2500}


def test_hot_key_of_a_row_level_join_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    own = spark.newSession()
    for name, value in settings.items():
        own.conf.set(name, value)
    fact = own.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.rand(1).alias("x")
    )
    dim = own.range(60000).select(F.col("id").alias("d"))
    joined = join_dimension(fact, dim, "k", "d")
    assert len(joined.collect()) == 60000
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_summaries(spark, rows):
    df = spark.createDataFrame([("w", 1.0), ("w", 2.0), ("e", None)], "region string, price double")
    summary = aggregates.amount_summary_by(df, ["region"], "price", extremes=True)
    assert rows(summary) == [("e", 1, None, None, None, None), ("w", 2, 3.0, 1.5, 1.0, 2.0)]
    assert rows(aggregates.sum_by(df, ["region"], "price", "t")) == [("e", None), ("w", 3.0)]
    assert rows(aggregates.mean_by(df, ["region"], "price", "m")) == [("e", None), ("w", 1.5)]
    assert rows(aggregates.row_counts({"a": df, "b": df.limit(1)})) == [("a", 3), ("b", 1)]
    assert aggregates.mean_of_totals(df, ["region"], "price", "m").first()[0] == 3.0
    assert aggregates.distinct_count(df, "price", "n").first()[0] == 2
    counted = aggregates.count_by(df, ["region"])
    assert rows(aggregates.groups_where(counted, "count > 1")) == [("w", 2)]


def test_statistics(spark, rows):
    df = spark.createDataFrame([("a", 1.25, 3), ("a", 2.25, None), ("b", None, 4)], "k string, price double, age int")
    measures = {"n": ("rows", None), "sum": ("total", "price", 1), "mean": ("mean", "age"), "top": ("max", "price")}
    found = aggregates.statistics(df, measures, ["k"], scales={"price": 2})
    assert rows(found) == [("a", 2, 3.5, 3.0, 2.25), ("b", 1, None, 4.0, None)]
    assert rows(aggregates.statistics(df.limit(0), measures)) == [(0, None, None, None)]


def test_dimension_choice_does_not_depend_on_row_order(spark, rows):
    data = [(1, "b", "x"), (1, "a", "z"), (1, "a", "y"), (2, None, "q"), (2, "c", "q")]
    forward = spark.createDataFrame(data, "k int, v string, w string")
    backward = spark.createDataFrame(data[::-1], "k int, v string, w string").repartition(3)
    for df in (forward, backward):
        assert rows(normalise.dimension(df, "k", ["v", "w"])) == [(1, "a", "y"), (2, None, "q")]


def test_dimension_hashes_copies_away_before_it_sorts(spark, tmp_path, plan_of):
    path = str(tmp_path / "flat")
    spark.range(10).selectExpr("id AS k", "'a' AS v").write.parquet(path)
    plan = plan_of(normalise.dimension(spark.read.parquet(path), "k", ["v"]))
    assert plan.rindex("HashAggregate") > plan.rindex("SortAggregate")


def test_key_checks(spark, rows):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (9, "e")], "k int, v string")
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int")
    assert rows(quality.orphan_rows(child, parent, "k", "id")) == [(9, "e")]
    assert rows(quality.duplicate_keys(child, ["k"])) == [(1, 2)]
    assert rows(quality.key_violations(child, ["k"])) == [(None, 1), (1, 2)]


def test_layout_by_key(spark, tmp_path, rows):
    path = str(tmp_path / "copies")
    spark.range(4000).select(F.when(F.col("id") < 3000, 1).otherwise(2).alias("k")).write.parquet(path)
    df = spark.read.parquet(path)
    whole = layout.partition_usage(layout.repartition_by_key(df, ["k"], 4), ["k"])
    assert rows(whole) == [(1, 3000, 1), (2, 1000, 1)]
    dealt = layout.repartition_by_key(df, ["k"], 16, spread=8)
    usage = {r["k"]: r for r in layout.partition_usage(dealt, ["k"]).collect()}
    # Rows of a key are identical here, and are split all the same.
    assert usage[1]["n_rows"] == 3000 and 1 < usage[1]["n_partitions"] <= 8
    assert dealt.columns == ["k"]


def test_reusing_the_layout_saves_a_shuffle(spark, plan_of):
    df = spark.range(100).select((F.col("id") % 5).alias("k"))
    by_key = layout.repartition_by_key(df, ["k"], 4)
    assert plan_of(by_key.groupBy("k").count()).count("Exchange") == 1


def test_from_units_of_wide_totals(spark):
    df = spark.createDataFrame([(10**18,)], "u bigint")
    wide = df.select(from_units(F.col("u").cast("decimal(38,0)"), 4).alias("x"))
    assert wide.first()[0] == 1e14
