"""Ranks and row numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.bindings.filtered import TOTALS_SQL
from ledgerline.bindings.registry import query
from ledgerline.bindings.tables import customer_totals, dollars_sql, table
from ledgerline.functions import from_units, units
from ledgerline.operators.joins import aggregate_then_join, join_dimension
from ledgerline.operators.ordering import ascending, descending, ordered
from ledgerline.operators.ranking import rank_rows, rank_top
from ledgerline.workspace import freeze

NAMED_SQL = f"""
WITH {TOTALS_SQL}, named AS (
    SELECT c_custkey, c_name, cents, {dollars_sql("cents")} AS total_sales
    FROM totals JOIN customer ON c_custkey = o_custkey)"""


def _named_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer key, name and order value in cents: the sort key of the ranks."""
    return join_dimension(
        customer_totals(spark, sf_dir), table(spark, sf_dir, "customer"), "o_custkey", "c_custkey"
    ).select("c_custkey", "c_name", "total_units")


def _with_total(df: DataFrame, *others: str) -> DataFrame:
    return df.select(
        "c_custkey", "c_name", from_units("total_units", 2).alias("total_sales"), *others
    )


@query(
    "rank_customers",
    f"""
    {NAMED_SQL}
    SELECT c_custkey, c_name, total_sales, rank() OVER (ORDER BY cents DESC) AS sales_rank
    FROM named ORDER BY sales_rank
    """,
)
def rank_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = aggregate_then_join(
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "customer"),
        "o_custkey",
        "c_custkey",
        ["c_custkey", "c_name"],
        {"total_units": ("total", units("o_totalprice", 2))},
    )
    ranked = rank_rows(freeze(totals), [descending("total_units")], name="sales_rank")
    return ordered(_with_total(ranked, "sales_rank"), [ascending("sales_rank"), "c_custkey"])


@query(
    "rank_cte_join",
    f"""
    {NAMED_SQL}
    SELECT c_name, total_sales, rank() OVER (ORDER BY cents DESC) AS sales_rank
    FROM named ORDER BY sales_rank
    """,
)
def rank_cte_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = freeze(_named_totals(spark, sf_dir))
    ranked = rank_rows(totals, [descending("total_units")], name="sales_rank")
    return ordered(_with_total(ranked, "sales_rank"), [ascending("sales_rank"), "c_custkey"]).drop(
        "c_custkey"
    )


ROW_NUMBER_SQL = """
    SELECT o_custkey, o_orderkey, o_totalprice,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS order_row_num
    FROM orders"""


def _numbered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"
    )
    return rank_rows(
        orders, ["o_orderdate", "o_orderkey"], ["o_custkey"], kind="row_number", name="order_row_num"
    ).drop("o_orderdate")


@query("row_number_per_customer", f"{ROW_NUMBER_SQL} ORDER BY o_custkey, order_row_num")
def row_number_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered(_numbered_orders(spark, sf_dir), ["o_custkey", "order_row_num"])


@query(
    "join_row_level",
    f"""
    SELECT o_custkey, c_name, o_orderkey, o_totalprice, order_row_num
    FROM ({ROW_NUMBER_SQL}) JOIN customer ON c_custkey = o_custkey
    ORDER BY o_custkey, order_row_num
    """,
)
def join_row_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = join_dimension(
        _numbered_orders(spark, sf_dir), table(spark, sf_dir, "customer"), "o_custkey", "c_custkey"
    ).select("o_custkey", "c_name", "o_orderkey", "o_totalprice", "order_row_num")
    return ordered(named, ["o_custkey", "order_row_num"])


def _parts_per_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count("*").alias("n_parts"))


@query(
    "dense_rank_top3",
    """
    SELECT * FROM (
        SELECT p_brand, count(*) AS n_parts, dense_rank() OVER (ORDER BY count(*) DESC) AS brand_rank
        FROM part GROUP BY p_brand)
    WHERE brand_rank <= 3
    """,
)
def dense_rank_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_top(
        _parts_per_brand(spark, sf_dir),
        [descending("n_parts")],
        3,
        kind="dense_rank",
        name="brand_rank",
    )


@query(
    "rank_top5",
    f"""
    {NAMED_SQL}
    SELECT * FROM (
        SELECT c_name, total_sales, rank() OVER (ORDER BY cents DESC) AS sales_rank FROM named)
    WHERE sales_rank <= 5
    """,
)
def rank_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = rank_top(_named_totals(spark, sf_dir), [descending("total_units")], 5, name="sales_rank")
    return _with_total(top, "sales_rank").drop("c_custkey")


@query(
    "rank_bottom5",
    f"""
    {NAMED_SQL}
    SELECT * FROM (
        SELECT c_name, total_sales, rank() OVER (ORDER BY cents ASC) AS sales_rank FROM named)
    WHERE sales_rank <= 5
    """,
)
def rank_bottom5(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = rank_top(_named_totals(spark, sf_dir), [ascending("total_units")], 5, name="sales_rank")
    return _with_total(low, "sales_rank").drop("c_custkey")


@query(
    "top_quantities_per_supplier",
    """
    SELECT * FROM (
        SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity,
               rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS quantity_rank
        FROM lineitem)
    WHERE quantity_rank <= 5
    """,
)
def top_quantities_per_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity"
    )
    return rank_top(lines, [descending("l_quantity")], 5, ["l_suppkey"], name="quantity_rank")


@query(
    "rank_within_segment",
    """
    SELECT c_custkey, c_name, c_mktsegment, c_acctbal,
           rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC) AS segment_rank
    FROM customer ORDER BY c_mktsegment, segment_rank
    """,
)
def rank_within_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", "c_acctbal"
    )
    ranked = rank_rows(
        customer, [descending("c_acctbal")], ["c_mktsegment"], name="segment_rank"
    )
    return ordered(ranked, ["c_mktsegment", "segment_rank", "c_custkey"])
