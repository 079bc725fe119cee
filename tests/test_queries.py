"""Every registered query against its SQL counterpart, and the plans they get."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from check import rows_of, same_type
from ledgerline.bindings import oracle_sql, queries
from ledgerline.bindings.tables import sales, table
from ledgerline.sources import run_query


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def test_every_query_has_a_counterpart():
    assert set(oracle_sql()) == set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, duck, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    result = duck.execute(oracle_sql()[name])
    names = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    assert sorted(df.columns) == sorted(names)
    assert [c for c, t in df.dtypes if not same_type(t, kinds[c])] == []
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0


# The same question as SQL text and as operators.
SQL_FORMS = {
    "filter_eq": """
        SELECT l_orderkey, l_linenumber, c_name, r_name, p_type, l_extendedprice
        FROM sales WHERE r_name = 'ASIA'""",
    "subquery_above_avg": "SELECT * FROM orders WHERE o_totalprice > (SELECT AVG(o_totalprice) FROM orders)",
    "subquery_max_per_group": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem o WHERE l_quantity =
        (SELECT MAX(i.l_quantity) FROM lineitem i WHERE i.l_orderkey = o.l_orderkey)""",
    "single_order_customers": """
        WITH counts AS (SELECT o_custkey, COUNT(DISTINCT o_orderkey) AS n_orders FROM orders GROUP BY o_custkey)
        SELECT c.c_custkey, c.c_name, k.n_orders FROM counts k JOIN customer c ON c.c_custkey = k.o_custkey
        WHERE k.n_orders = 1 ORDER BY c.c_name""",
    "row_number_per_customer": """
        SELECT o_custkey, o_orderkey, o_totalprice, CAST(ROW_NUMBER() OVER (
            PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS order_row_num
        FROM orders""",
    "dense_rank_top3": """
        WITH ranked AS (SELECT p_brand, COUNT(*) AS n_parts,
            CAST(DENSE_RANK() OVER (ORDER BY COUNT(*) DESC) AS BIGINT) AS brand_rank FROM part GROUP BY p_brand)
        SELECT * FROM ranked WHERE brand_rank <= 3""",
    "rank_within_segment": """
        SELECT c_custkey, c_name, c_mktsegment, c_acctbal, CAST(RANK() OVER (
            PARTITION BY c_mktsegment ORDER BY c_acctbal DESC) AS BIGINT) AS segment_rank FROM customer""",
    "max_per_customer": """
        SELECT c.c_custkey, c.c_name, MAX(o.o_totalprice) AS highest_order_value
        FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY c.c_custkey, c.c_name""",
    "duplicate_keys": """
        SELECT l_orderkey, l_partkey, COUNT(*) AS duplicate_count FROM lineitem
        GROUP BY l_orderkey, l_partkey HAVING COUNT(*) > 1""",
    "distinct_values": "SELECT DISTINCT p_type FROM part",
    "agg_count_distinct": "SELECT COUNT(DISTINCT o_custkey) AS unique_customers FROM orders",
    "month_key": """
        SELECT strftime('%Y', o_orderdate) AS order_year, strftime('%m', o_orderdate) AS order_month
        FROM orders GROUP BY order_year, order_month""",
}


@pytest.mark.parametrize("name", sorted(SQL_FORMS))
def test_sql_text_equals_operators(spark, sf_dir, name):
    tables = {n: table(spark, sf_dir, n) for n in ("orders", "lineitem", "customer", "part")}
    tables["sales"] = sales(spark, sf_dir)
    text = run_query(spark, SQL_FORMS[name], tables)
    built = queries()[name](spark, sf_dir)
    assert rows_of(text.columns, text.collect()) == rows_of(built.columns, built.collect())


def scan_lines(plan):
    return [line for line in plan.splitlines() if "FileScan" in line]


@pytest.mark.parametrize(
    "name",
    ["filter_gt", "filter_between_num", "filter_between_date", "filter_expr", "clean_chain", "case_multi_way"],
)
def test_row_level_queries_do_not_shuffle(spark, sf_dir, plan_of, name):
    assert "Exchange" not in plan_of(queries()[name](spark, sf_dir))


@pytest.mark.parametrize(
    ("name", "pushed"),
    [
        ("filter_gt", "GreaterThan(l_quantity,45.0)"),
        ("filter_between_date", "LessThan(o_orderdate"),
        ("filter_between_num", "LessThanOrEqual(l_quantity,30.0)"),
        ("filter_eq", "EqualTo(r_name,ASIA)"),
        ("range_guard", "GreaterThanOrEqual(l_quantity,5.0)"),
    ],
)
def test_predicates_reach_the_scan(spark, sf_dir, name, pushed):
    df = queries()[name](spark, sf_dir)
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert pushed in text


def test_scans_read_only_needed_columns(spark, sf_dir, plan_of):
    plan = plan_of(queries()["distinct_per_group"](spark, sf_dir))
    assert all("l_extendedprice" not in line for line in scan_lines(plan))
    plan = plan_of(queries()["sum_by_region"](spark, sf_dir))
    assert all("c_name" not in line and "o_totalprice" not in line for line in scan_lines(plan))


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_query_pairs_all_rows(spark, sf_dir, plan_of, name):
    plan = plan_of(queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_facts_are_reduced_before_they_are_joined(spark, sf_dir, plan_of):
    plan = plan_of(queries()["revenue_by_category"](spark, sf_dir)).splitlines()
    lineitem = next(i for i, line in enumerate(plan) if "l_extendedprice" in line and "FileScan" in line)
    join = next(i for i, line in enumerate(plan) if "Join" in line)
    # Totals are checked, so the partial sums are too.
    assert any("partial_sum" in line or "partial_try_sum" in line for line in plan[join:lineitem])


def test_correlated_maximum_becomes_a_semi_join(spark, sf_dir, plan_of):
    plan = plan_of(queries()["subquery_max_per_group"](spark, sf_dir))
    assert "LeftSemi" in plan and "partial_max" in plan
