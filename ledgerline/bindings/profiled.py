"""First looks at a table: rows, shape, types, nulls, summaries, column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.bindings.registry import query
from ledgerline.bindings.tables import sales, table, SALES_SQL
from ledgerline.operators import profile, shaping


@query("head_n", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def head_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.head_rows(table(spark, sf_dir, "orders"), 5, ["o_orderkey"])


@query("tail_n", "SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 5")
def tail_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.tail_rows(table(spark, sf_dir, "orders"), 5, ["o_orderkey"])


@query("table_shape", "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem")
def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.table_shape(table(spark, sf_dir, "lineitem"))


@query(
    "schema_frame",
    """
    SELECT CAST(1 AS BIGINT) AS position, 'o_orderkey' AS column_name, 'bigint' AS data_type,
           count(o_orderkey) AS n_present FROM orders
    UNION ALL SELECT 2, 'o_custkey', 'bigint', count(o_custkey) FROM orders
    UNION ALL SELECT 3, 'o_orderstatus', 'string', count(o_orderstatus) FROM orders
    UNION ALL SELECT 4, 'o_totalprice', 'double', count(o_totalprice) FROM orders
    UNION ALL SELECT 5, 'o_orderdate', 'timestamp_ntz', count(o_orderdate) FROM orders
    UNION ALL SELECT 6, 'o_orderpriority', 'string', count(o_orderpriority) FROM orders
    """,
)
def schema_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.schema_frame(table(spark, sf_dir, "orders"))


@query(
    "describe_numeric",
    """
    SELECT 'o_totalprice' AS column_name, count(o_totalprice) AS n_values,
           round(avg(o_totalprice), 2) AS mean, round(stddev_samp(o_totalprice), 2) AS stddev,
           min(o_totalprice) AS min_value, max(o_totalprice) AS max_value FROM orders
    UNION ALL
    SELECT 'o_custkey', count(o_custkey), round(avg(o_custkey), 2),
           round(stddev_samp(o_custkey), 2), CAST(min(o_custkey) AS DOUBLE),
           CAST(max(o_custkey) AS DOUBLE) FROM orders
    """,
)
def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = profile.describe_columns(table(spark, sf_dir, "orders"), ["o_totalprice", "o_custkey"])
    return stats.withColumns({"mean": F.round("mean", 2), "stddev": F.round("stddev", 2)})


@query(
    "null_counts",
    """
    SELECT count(*) - count(l_orderkey) AS l_orderkey,
           count(*) - count(nullif(l_discount, 0.0)) AS l_discount,
           count(*) - count(nullif(l_tax, 0.0)) AS l_tax,
           count(*) - count(nullif(l_returnflag, 'R')) AS l_returnflag
    FROM lineitem
    """,
)
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    holed = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.expr("nullif(l_discount, 0.0D)").alias("l_discount"),
        F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("l_tax"),
        F.expr("nullif(l_returnflag, 'R')").alias("l_returnflag"),
    )
    return profile.null_counts(holed)


@query(
    "clean_column_names",
    """
    SELECT o_orderkey AS Order_ID, o_orderdate AS Order_Date, o_orderpriority AS Sub_Category
    FROM orders
    """,
)
def clean_column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    messy = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(" Order ID"),
        F.col("o_orderdate").alias("Order Date "),
        F.col("o_orderpriority").alias("Sub-Category"),
    )
    return shaping.clean_column_names(messy)


@query(
    "rename_columns",
    """
    SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey, c_acctbal, c_mktsegment
    FROM customer
    """,
)
def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"c_custkey": "customer_id", "c_name": "customer_name"}
    return shaping.rename_columns(table(spark, sf_dir, "customer"), names)


@query("drop_column", "SELECT p_partkey, p_name, p_brand, p_type, p_retailprice FROM part")
def drop_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.drop_columns(table(spark, sf_dir, "part"), "p_size")


@query("project_columns", f"WITH {SALES_SQL} SELECT c_name, n_name FROM sales")
def project_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.project(sales(spark, sf_dir), "c_name", "n_name")
