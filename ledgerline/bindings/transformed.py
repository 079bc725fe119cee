"""Derived columns, labels, conversions and date parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.bindings.registry import query
from ledgerline.bindings.tables import cents_sql, dollars_sql, table
from ledgerline.functions import month_text, units_total, year_text
from ledgerline.operators import aggregates, transforms


@query(
    "derive_product",
    "SELECT p_partkey, p_size, p_retailprice, p_size * p_retailprice AS score FROM part",
)
def derive_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    return transforms.add_product(part, "score", "p_size", "p_retailprice")


@query(
    "derive_bonus",
    """
    SELECT o_orderkey, o_totalprice,
           CAST(round(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.10 AS DECIMAL(4,2)), 2) AS DOUBLE)
               AS bonus
    FROM orders
    """,
)
def derive_bonus(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return transforms.add_share(orders, "bonus", "o_totalprice", "0.10")


@query(
    "derive_total",
    """
    SELECT o_orderkey, o_totalprice,
           CAST(round(CAST(o_totalprice AS DECIMAL(12,2))
                + CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.10 AS DECIMAL(4,2)), 2) AS DOUBLE)
               AS total
    FROM orders
    """,
)
def derive_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return transforms.add_raised(orders, "total", "o_totalprice", "0.10")


LABEL_SQL = "CASE WHEN o_totalprice >= 200000 THEN 'High Value' ELSE 'Standard' END"


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.add_label(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"),
        "value_segment",
        F.col("o_totalprice") >= 200000,
        "High Value",
        "Standard",
    )


@query(
    "case_two_way",
    f"SELECT o_orderkey, o_totalprice, {LABEL_SQL} AS value_segment FROM orders",
)
def case_two_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir)


@query(
    "count_by_label",
    f"SELECT {LABEL_SQL} AS value_segment, count(*) AS n_orders FROM orders GROUP BY 1",
)
def count_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.count_by(_labelled(spark, sf_dir), ["value_segment"], "n_orders")


@query(
    "case_multi_way",
    """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS salary,
           CASE WHEN c_acctbal >= 9000 THEN 'A' WHEN c_acctbal >= 7000 THEN 'B' ELSE 'C' END AS grade
    FROM customer
    """,
)
def case_multi_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    staff = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("salary")
    )
    return transforms.add_band(staff, "grade", "salary", [(9000.0, "A"), (7000.0, "B")], "C")


@query(
    "cast_truncate",
    "SELECT o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS price_whole FROM orders",
)
def cast_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return transforms.add_whole_part(orders, "price_whole", "o_totalprice").select(
        "o_orderkey", "price_whole"
    )


@query("round_whole", "SELECT o_orderkey, round(o_totalprice, 0) AS price_round FROM orders")
def round_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return transforms.add_rounded(orders, "price_round", "o_totalprice").select(
        "o_orderkey", "price_round"
    )


@query(
    "round_inplace",
    """
    SELECT l_orderkey, l_linenumber, round(l_extendedprice / 7.0, 2) AS l_extendedprice
    FROM lineitem
    """,
)
def round_inplace(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") / 7).alias("l_extendedprice")
    )
    return transforms.add_rounded(lines, "l_extendedprice", "l_extendedprice", 2)


@query(
    "extract_year",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS join_year FROM orders",
)
def extract_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("join_date")
    )
    return transforms.add_year(text, "join_year", "join_date").select("o_orderkey", "join_year")


@query(
    "month_key",
    """
    SELECT DISTINCT strftime(o_orderdate, '%Y') AS order_year, strftime(o_orderdate, '%m') AS order_month
    FROM orders
    """,
)
def month_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        year_text("o_orderdate").alias("order_year"), month_text("o_orderdate").alias("order_month")
    ).distinct()


@query(
    "monthly_sales",
    f"""
    SELECT strftime(o_orderdate, '%Y') AS order_year, strftime(o_orderdate, '%m') AS order_month,
           {dollars_sql(f"sum({cents_sql('o_totalprice')})")} AS monthly_sales
    FROM orders GROUP BY 1, 2 ORDER BY 1, 2
    """,
)
def monthly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            year_text("o_orderdate").alias("order_year"),
            month_text("o_orderdate").alias("order_month"),
        )
        .agg(units_total("o_totalprice", 2).alias("monthly_sales"))
        .orderBy("order_year", "order_month")
    )
