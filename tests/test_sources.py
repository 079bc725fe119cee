from __future__ import annotations

import gzip
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest

from ledgerline import sources, workspace

SCHEMA = "id bigint, name string, price double"


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(1, "  padded ", 1.5), (2, None, None), (3, 'quote " and, comma', -2.25), (4, "é", 0.0)], SCHEMA
    )


def files(path, suffix):
    return sorted(Path(path).glob(f"part-*{suffix}"))


def test_csv_round_trip_keeps_padding_nulls_and_quotes(spark, people, tmp_path, rows):
    path = str(tmp_path / "out")
    sources.write_csv(people, path)
    assert rows(sources.read_csv(spark, path, people.schema)) == rows(people)
    sources.write_csv(people.limit(1), path)
    assert sources.read_csv(spark, path, people.schema).count() == 1


def test_gzip_round_trip_and_spread(spark, people, tmp_path, rows):
    path = str(tmp_path / "zipped")
    sources.write_csv(people, path, compression="gzip")
    assert b"price" in gzip.decompress(files(path, ".csv.gz")[0].read_bytes())
    back = sources.read_csv(spark, path, people.schema, spread=6)
    assert back.rdd.getNumPartitions() == 6
    assert rows(back) == rows(people)


def test_latin1_with_line_breaks(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "café\nnaïve, \"x\"\r\nend"), (2, "plain")], "id bigint, text string")
    path = str(tmp_path / "latin")
    sources.write_csv(df, path, encoding="ISO-8859-1", quote_all=True)
    assert any(b"caf\xe9" in f.read_bytes() for f in files(path, ".csv"))
    back = sources.read_csv(spark, path, df.schema, encoding="ISO-8859-1", multi_line=True)
    assert rows(back) == rows(df)


def test_cells_that_do_not_fit_become_null(spark, people, tmp_path):
    file = tmp_path / "dirty.csv"
    file.write_text("id,name,price\n1,a,x\n2,,3.5\n,b,4\n")
    back = sources.read_csv(spark, str(file), people.schema)
    assert [tuple(r) for r in back.collect()] == [(1, "a", None), (2, None, 3.5), (None, "b", 4.0)]


def test_null_token(spark, people, tmp_path):
    file = tmp_path / "tokens.csv"
    file.write_text("id,name,price\n1,NA,NA\n")
    back = sources.read_csv(spark, str(file), people.schema, null_token="NA")
    assert tuple(back.first()) == (1, None, None)


def test_number_of_files_is_honoured_and_order_kept(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(5000).selectExpr("id", "id % 977 AS v").repartition(40).orderBy("v", "id")
        sources.write_csv(df, str(tmp_path / "one"), files=1)
        sources.write_parquet(df, str(tmp_path / "one"), files=1)
        sources.write_csv(spark.range(100).repartition(4), str(tmp_path / "many"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(files(tmp_path / "many", ".csv")) == 4
    assert len(files(tmp_path / "one", ".parquet")) == 1
    sources.write_csv(df, str(tmp_path / "one"), files=1)
    (file,) = files(tmp_path / "one", ".csv")
    lines = [tuple(map(int, line.split(",")))[::-1] for line in file.read_text().splitlines()[1:]]
    assert len(lines) == 5000 and lines == sorted(lines)


def test_partitioned_parquet_prunes(spark, people, tmp_path, plan_of):
    path = str(tmp_path / "by_name")
    sources.write_parquet(people, path, partition_by=["name"])
    kept = sources.read_parquet(spark, path).where("name = 'é'")
    assert "PartitionFilters: [isnotnull(name" in plan_of(kept)
    assert kept.count() == 1


def test_declare_insert_replace(spark, people, tmp_path, rows):
    path = str(tmp_path / "a")
    sources.declare_table(spark, "t_people", people.schema, path)
    assert spark.table("t_people").count() == 0
    sources.insert_rows(people.select("price", "name", "id"), "t_people")
    assert rows(sources.read_table(spark, "t_people")) == rows(people)
    for _ in range(2):  # the same location, so nothing may be left over
        sources.replace_table(people.where("id < 3"), "t_people", path)
        assert rows(spark.table("t_people")) == rows(people.where("id < 3"))
    spark.sql("DROP TABLE t_people")


def test_copy_and_compare(spark, people, tmp_path, rows):
    source, target = tmp_path / "source", str(tmp_path / "target")
    source.mkdir()
    (source / "a.csv").write_text('id,name,price\n1,x,"1,200.50"\n2,"",\n3,"line\nbreak ""q""",x\n,  padded ,7\n1,x,"1,200.50"\n')
    sources.copy_csv(spark, str(source), target, people.columns, multi_line=True)
    left = sources.read_text_cells(spark, str(source), people.columns, multi_line=True)
    right = sources.read_text_cells(spark, target, people.columns, multi_line=True)
    cells = [("1", "x", "1,200.50"), ("1", "x", "1,200.50"), ("2", "", None), ("3", 'line\nbreak "q"', "x"), (None, "  padded ", "7")]
    assert sorted(rows(left), key=str) == sorted(rows(right), key=str) == sorted(cells, key=str)
    assert tuple(sources.verify_copy(left, right).first()) == (5, 5, 0)
    assert tuple(sources.verify_copy(left, right.dropDuplicates()).first()) == (5, 4, 1)
    assert tuple(sources.verify_copy(left, right.na.fill("")).first()) == (5, 5, 4)
    extra = sources.row_differences(left, right.dropDuplicates())
    assert rows(extra) == [("1", "x", "1,200.50", 1)]
    found = sources.file_metadata(spark, str(source)).collect()
    assert sum(r["file_size"] for r in found) == (source / "a.csv").stat().st_size


def test_copy_keeps_an_encoding(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_bytes("id,name\n1,é\n".encode("latin-1"))
    sources.copy_csv(spark, str(tmp_path / "a.csv"), str(tmp_path / "b"), ["id", "name"], encoding="ISO-8859-1")
    assert rows(sources.read_text_cells(spark, str(tmp_path / "b"), ["id", "name"], encoding="ISO-8859-1")) == [("1", "é")]


def test_sql_text_leaves_no_views_and_takes_turns(spark, people, rows):
    people.limit(0).createOrReplaceTempView("mine")
    with ThreadPoolExecutor(4) as pool:
        found = list(
            pool.map(lambda i: sources.run_query(spark, 'SELECT "id" FROM mine', {"mine": people.where(f"id = {i}")}).collect(), [1, 2, 3, 4])
        )
    assert [[r.id for r in part] for part in found] == [[1], [2], [3], [4]]
    assert spark.table("mine").count() == 0
    spark.catalog.dropTempView("mine")
    sources.run_query(spark, "SELECT * FROM other", {"other": people})
    assert "other" not in {t.name for t in spark.catalog.listTables()}
    assert spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers") == "false"


def test_nothing_to_copy(spark, people, tmp_path):
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "a.csv").write_text("")
    with pytest.raises(ValueError, match="nothing to copy"):
        sources.copy_csv(spark, str(tmp_path / "empty"), str(tmp_path / "to"), people.columns)


def test_sql_text(spark, people, rows):
    flat = people.withColumnRenamed("name", "Product Name").withColumnRenamed("price", "Unit-Price")
    out = sources.run_query(
        spark,
        """SELECT "Product Name", COUNT(*) AS n FROM flat
           WHERE "Unit-Price" IS NOT NULL GROUP BY "Product Name" HAVING n > 0;""",
        {"flat": flat},
    )
    assert len(rows(out)) == 3
    assert spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers") == "false"


def test_strftime_on_text_and_dates(spark):
    df = spark.sql("SELECT '2016-03-01' AS t, DATE'2017-05-02' AS d, '11/8/2016' AS bad")
    out = sources.run_query(
        spark,
        "SELECT strftime('%Y', t), strftime('%m', d), strftime('%Y-%m-%d', d), strftime('%Y', bad) FROM v",
        {"v": df},
    )
    assert tuple(out.first()) == ("2016", "05", "2017-05-02", None)


def test_inline_rows_and_views(spark, rows):
    df = sources.inline_table(spark, [(1, "a"), (2, None)], "id int, v string")
    assert rows(sources.register_view(df, "v_inline")) == [(1, "a"), (2, None)]
    assert sources.inline_table(spark, [], "id int, v string").count() == 0


def test_inline_lookup_is_the_broadcast_side(spark, plan_of):
    lookup = sources.inline_table(spark, [(1, "a"), (2, None)], "id bigint, v string")
    joined = spark.range(10**9).join(lookup, "id")
    assert "LocalTableScan" in plan_of(joined) and "BroadcastHashJoin" in plan_of(joined)


def test_freeze_is_a_table_of_its_own(spark, plan_of):
    frozen = workspace.freeze(spark.range(10).selectExpr("id * 2 AS x", "id AS y"))
    pruned = plan_of(frozen.where("x > 4").select("x"))
    assert "PushedFilters: [IsNotNull(x), GreaterThan(x,4)]" in pruned
    assert "ReadSchema: struct<x:bigint>" in pruned and "Range" not in pruned
    assert frozen.agg({"x": "sum"}).first()[0] == 90


def test_release_deletes_only_stored_tables(spark, tmp_path):
    frozen = workspace.freeze(spark.range(5))
    folder = frozen.inputFiles()[0].rsplit("/", 1)[0].replace("file://", "").replace("file:", "")
    spark.range(3).write.parquet(f"{tmp_path}/kept")
    kept = spark.read.parquet(f"{tmp_path}/kept")
    workspace.release(frozen, kept)
    assert not Path(folder).exists() and kept.count() == 3


def test_workspace_is_the_folder_the_session_names(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    first, second = workspace.fresh_path(spark, "t"), workspace.fresh_path(spark, "t")
    assert first.startswith(folder) and first != second


class _Session:
    """Stands in for a session whose checkpoint folder is not set."""

    def __init__(self, master):
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.folder = None

    def get(self, name, default=None):
        return default

    def getConf(self):
        return self

    def getCheckpointDir(self):
        return self.folder


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_folder(_Session("yarn"))


def test_a_local_session_uses_its_warehouse():
    class Local(_Session):
        def get(self, name, default=None):
            return "/warehouse/" if name == "spark.sql.warehouse.dir" else default

    assert workspace.shared_folder(Local("local[2]")) == "/warehouse"
