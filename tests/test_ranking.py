from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators.ordering import ascending, descending, sort_columns
from ledgerline.operators.ranking import rank_rows, rank_top

KINDS = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}


@pytest.fixture(scope="module")
def scores(spark):
    """400 rows: one group holds half, another has a null key, scores tie and are null."""
    rng = random.Random(5)
    data = []
    for i in range(400):
        group = "hot" if i % 2 == 0 else rng.choice(["a", "b", "c", None])
        score = None if rng.random() < 0.1 else rng.randrange(12)
        data.append((i, group, score))
    return spark.createDataFrame(data, "id int, g string, score int").repartition(3).cache()


def expected(df, keys, groups, kind):
    window = Window.partitionBy(*groups).orderBy(*sort_columns(keys))
    return {r["id"]: r["x"] for r in df.withColumn("x", KINDS[kind]().over(window)).collect()}


def got(df):
    collected = df.collect()
    assert len({r["id"] for r in collected}) == len(collected)
    return {r["id"]: r["rank"] for r in collected}


@pytest.mark.parametrize("group_rows", [0, 60, 1000])
@pytest.mark.parametrize("groups", [[], ["g"]])
@pytest.mark.parametrize("kind", sorted(KINDS))
def test_every_group_size_limit_gives_the_window_result(scores, kind, groups, group_rows):
    keys = [descending("score")]
    if kind == "row_number":
        keys.append(ascending("id"))
    ranked = rank_rows(scores, keys, groups, kind=kind, group_rows=group_rows)
    assert ranked.columns == ["id", "g", "score", "rank"]
    assert got(ranked) == expected(scores, keys, groups, kind)


def test_slices_follow_the_null_order(scores):
    keys = [ascending("score", nulls_first=False), descending("id")]
    ranked = rank_rows(scores, keys, ["g"], kind="row_number", group_rows=0)
    assert got(ranked) == expected(scores, keys, ["g"], "row_number")


def test_rank_of_nothing(scores):
    assert rank_rows(scores.limit(0), ["score"], ["g"]).count() == 0
    assert rank_rows(scores.limit(0), ["score"]).count() == 0


def test_single_row(spark):
    df = spark.createDataFrame([(1, 5)], "id int, score int")
    assert got(rank_rows(df, ["score"], group_rows=0)) == {1: 1}


@pytest.mark.parametrize("groups", [[], ["g"]])
@pytest.mark.parametrize("kind", ["rank", "dense_rank"])
@pytest.mark.parametrize("keys", [[descending("score")], [ascending("score")]])
def test_top_ranks_keep_all_ties(scores, kind, groups, keys):
    top = rank_top(scores, keys, 3, groups, kind=kind)
    full = expected(scores, keys, groups, kind)
    assert got(top) == {i: r for i, r in full.items() if r <= 3}


def test_top_ranks_stop_early(scores, plan_of):
    one_order = plan_of(rank_top(scores, [descending("score")], 3))
    assert "TakeOrderedAndProject" in one_order or "WindowGroupLimit" in one_order
    grouped = plan_of(rank_top(scores, [descending("score")], 3, ["g"]))
    assert "WindowGroupLimit" in grouped


def test_only_slice_totals_are_gathered(scores, plan_of):
    plan = plan_of(rank_rows(scores, [descending("score")], kind="rank", group_rows=10))
    assert plan.count("SinglePartition") == 1
    below = plan[plan.index("SinglePartition") :]
    assert "partial_sum(_ties" in below.split("SinglePartition")[1]


def test_few_rows_use_a_plain_window(spark, plan_of):
    df = spark.range(20).selectExpr("id", "id % 3 AS g", "id % 7 AS score")
    plan = plan_of(rank_rows(df, [descending("score")], ["g"]))
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_tied_row_numbers_do_not_depend_on_the_way(spark):
    df = spark.range(400).selectExpr("id % 2 AS g", "id % 3 AS v", "id AS other").repartition(5)
    plain = rank_rows(df, ["v"], ["g"], kind="row_number", name="n")
    sliced = rank_rows(df.repartition(3), ["v"], ["g"], kind="row_number", name="n", group_rows=50, slices=4)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, sliced.collect()))


def test_many_top_ranks_do_not_gather_all_keys(spark, plan_of, tmp_path):
    spark.range(9000).selectExpr("id", "id % 3000 AS v").write.parquet(str(tmp_path / "t"))
    top = rank_top(spark.read.parquet(str(tmp_path / "t")), ["v"], 2000, name="r")
    assert "TakeOrderedAndProject" in plan_of(top) or "GlobalLimit" in plan_of(top)
    assert top.count() == 2001
