"""Merges that rewrite what changes, and loads that are swapped in."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerline import sources
from ledgerline.sources import versioned

SCHEMA = "id bigint, name string, price double"


def stored_files(path):
    return {str(f) for f in Path(path).glob("data/**/*.parquet")}


@pytest.fixture
def thousand(spark):
    return spark.range(1000).selectExpr("id", "concat('n', id) AS name", "id / 4 AS price")


def test_updates_inserts_deletes_and_a_repeated_run(spark, thousand, tmp_path, rows):
    path = str(tmp_path / "t")
    sources.create_versioned(thousand, path, ["id"], buckets=8)
    changes = spark.createDataFrame(
        [(5, "five", None, False), (7, "n7", 1.75, True), (2000, None, 1.0, None), (3000, "gone", 1.0, True)],
        f"{SCHEMA}, gone boolean",
    )
    expected = {r.id: tuple(r) for r in thousand.collect()} | {5: (5, "five", None), 2000: (2000, None, 1.0)}
    del expected[7]
    assert sources.merge_rows(changes, path, deleted="gone").number == 2
    assert rows(sources.read_versioned(spark, path)) == rows(spark.createDataFrame(list(expected.values()), SCHEMA))
    before = stored_files(path)
    again = sources.merge_rows(changes.select("gone", "price", "name", "id"), path, deleted="gone")
    assert again.number == 2 and sources.versions(spark, path) == [1, 2] and stored_files(path) == before
    assert rows(sources.read_versioned(spark, path, 1)) == rows(thousand)


def test_only_buckets_with_a_changed_row_are_rewritten(spark, thousand, tmp_path):
    path = str(tmp_path / "t")
    first = sources.create_versioned(thousand, path, ["id"], buckets=16)
    assert len(first.folders) == 16
    # All rows are delivered again, one of them altered.
    changes = thousand.withColumn("name", F.when(F.col("id") == 123, "other").otherwise(F.col("name")))
    second = sources.merge_rows(changes, path)
    moved = [b for b in first.folders if first.folders[b] != second.folders[b]]
    assert len(moved) == 1
    assert sum("data" in f for f in stored_files(path)) == 17
    assert sources.read_versioned(spark, path).where("name = 'other'").count() == 1


def test_repeated_keys_in_a_delivery(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sources.create_versioned(spark.createDataFrame([(1, "a", 1.0), (1, "b", 0.5), (2, "x", 1.0)], SCHEMA), path, ["id"], buckets=2)
    assert rows(sources.read_versioned(spark, path)) == [(1, "b", 0.5), (2, "x", 1.0)]
    changes = spark.createDataFrame([(1, "z", 9.0, 1), (1, "c", 2.0, 3), (1, "y", 8.0, None)], f"{SCHEMA}, at int")
    sources.merge_rows(changes, path, latest="at")
    assert rows(sources.read_versioned(spark, path)) == [(1, "c", 2.0), (2, "x", 1.0)]


def test_two_key_columns_and_odd_names(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    schema = "`a.b` string, `c d` int, v int"
    sources.create_versioned(spark.createDataFrame([("x", 1, 1), ("x", 2, 2)], schema), path, ["a.b", "c d"], buckets=4)
    sources.merge_rows(spark.createDataFrame([("x", 2, 5), ("y", 1, None)], schema), path)
    assert rows(sources.read_versioned(spark, path)) == [("x", 1, 1), ("x", 2, 5), ("y", 1, None)]


def test_empty_tables_and_null_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    none = spark.createDataFrame([], SCHEMA)
    sources.create_versioned(none, path, ["id"], buckets=4)
    assert sources.read_versioned(spark, path).collect() == []
    assert sources.merge_rows(none, path).number == 1
    with pytest.raises(Exception, match="null in key column id"):
        sources.merge_rows(spark.createDataFrame([(None, "a", 1.0)], SCHEMA), path)
    assert sources.merge_rows(spark.createDataFrame([(4, "a", 1.0)], SCHEMA), path).number == 2
    gone = spark.createDataFrame([(4, "a", 1.0, True)], f"{SCHEMA}, d boolean")
    assert sources.merge_rows(gone, path, deleted="d").folders == {}
    assert sources.read_versioned(spark, path).count() == 0
    with pytest.raises(ValueError, match="no version"):
        sources.read_versioned(spark, str(tmp_path / "nothing"))


def test_a_lost_race_and_a_failed_merge_change_nothing(spark, thousand, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "t")
    sources.create_versioned(thousand, path, ["id"], buckets=4)
    with pytest.raises(sources.VersionConflict):
        sources.create_versioned(thousand, path, ["id"])
    mine, real = spark.createDataFrame([(1, "mine", 0.0)], SCHEMA), versioned._write

    def overtaken(*args):
        monkeypatch.setattr(versioned, "_write", real)
        sources.merge_rows(spark.createDataFrame([(2, "theirs", 0.0)], SCHEMA), path)
        return real(*args)

    monkeypatch.setattr(versioned, "_write", overtaken)
    with pytest.raises(sources.VersionConflict):
        sources.merge_rows(mine, path)
    found = {r.id: r.name for r in sources.read_versioned(spark, path).where("id < 3").collect()}
    assert found == {0: "n0", 1: "n1", 2: "theirs"}
    broken = mine.withColumn("price", F.raise_error(F.lit("broken source")).cast("double"))
    with pytest.raises(Exception, match="broken source"):
        sources.merge_rows(broken, path)
    assert sources.versions(spark, path) == [1, 2]
    sources.merge_rows(mine, path)
    assert {r.id: r.name for r in sources.read_versioned(spark, path).where("id < 3").collect()} == found | {1: "mine"}


def test_forgetting_versions_keeps_the_files_of_the_rest(spark, thousand, tmp_path, rows):
    path = str(tmp_path / "t")
    sources.create_versioned(thousand, path, ["id"], buckets=4)
    for i in range(3):
        sources.merge_rows(spark.createDataFrame([(i, "new", float(i))], SCHEMA), path)
    now = rows(sources.read_versioned(spark, path))
    assert sources.forget_versions(spark, path, keep=1) == [1, 2, 3]
    assert sources.versions(spark, path) == [4] and rows(sources.read_versioned(spark, path)) == now
    assert len(stored_files(path)) == 4


def test_merge_moves_no_rows_of_untouched_buckets(spark, thousand, tmp_path):
    path = str(tmp_path / "t")
    version = sources.create_versioned(thousand, path, ["id"], buckets=16)
    (bucket,) = {r[0] for r in spark.range(1).select(versioned._bucket_of(["id"], 16)).collect()}
    read = versioned._scan(spark, path, version, [bucket])
    assert {f.split("/data/")[1].rsplit("/", 1)[0] for f in read.inputFiles()} == {version.folders[bucket].removeprefix("data/")}


def test_a_load_that_fails_midway_leaves_the_old_rows(spark, thousand, tmp_path, rows):
    path, name = str(tmp_path / "loads"), "t_swapped"
    sources.replace_table(thousand, name, path)
    fails_late = thousand.withColumn(
        "price", F.when(F.col("id") < 900, F.col("price")).otherwise(F.raise_error(F.lit("torn")).cast("double"))
    )
    with pytest.raises(Exception, match="torn"):
        sources.replace_table(fails_late, name, path)
    assert rows(spark.table(name)) == rows(thousand)
    # The new rows may come from the table itself, with the same columns or others.
    sources.replace_table(spark.table(name).where("id < 10"), name, path)
    assert rows(spark.table(name)) == rows(thousand.where("id < 10"))
    sources.replace_table(spark.table(name).select("id").where("id < 3"), name, path)
    assert rows(spark.table(name)) == [(0,), (1,), (2,)]
    sources.insert_rows(spark.range(5, 6), name)
    assert sources.drop_old_loads(spark, name, path) == 3
    assert rows(spark.table(name)) == [(0,), (1,), (2,), (5,)]
    spark.sql(f"DROP TABLE {name}")
