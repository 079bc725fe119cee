"""Row filters and filters against subqueries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.bindings.registry import query
from ledgerline.bindings.tables import (
    PROFIT_SCALE,
    PROFIT_SQL,
    SALES_SQL,
    buyers,
    cents_sql,
    customer_totals,
    dollars_sql,
    profit_units,
    sales,
    table,
)
from ledgerline.functions import from_units
from ledgerline.operators import filters, ordering, subqueries
from ledgerline.operators.joins import join_dimension
from ledgerline.sources import run_query
from ledgerline.workspace import freeze

LINE_COLUMNS = ["l_orderkey", "l_linenumber", "c_name", "r_name", "p_type", "l_extendedprice"]
LINE_SQL = ", ".join(LINE_COLUMNS)


@query(
    "quoted_identifier",
    "SELECT c_name AS customer_name, c_mktsegment AS segment FROM customer WHERE c_acctbal > 0",
)
def quoted_identifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("Customer Name"),
        F.col("c_mktsegment").alias("Sub-Segment"),
        F.col("c_acctbal").alias("Balance Due"),
    )
    return run_query(
        spark,
        """
        SELECT "Customer Name" AS customer_name, "Sub-Segment" AS segment
        FROM customer_list WHERE "Balance Due" > 0
        """,
        {"customer_list": flat},
    )


@query("filter_eq", f"WITH {SALES_SQL} SELECT {LINE_SQL} FROM sales WHERE r_name = 'ASIA'")
def filter_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.where_equal(sales(spark, sf_dir), "r_name", "ASIA").select(*LINE_COLUMNS)


@query("filter_gt", "SELECT * FROM lineitem WHERE l_quantity > 45")
def filter_gt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.where_greater(table(spark, sf_dir, "lineitem"), "l_quantity", 45.0)


@query(
    "filter_negative",
    f"""
    SELECT l_orderkey, l_linenumber, p_partkey, {dollars_sql(PROFIT_SQL, PROFIT_SCALE)} AS profit
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE {PROFIT_SQL} < 0
    """,
)
def filter_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = join_dimension(
        table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"), "l_partkey", "p_partkey"
    ).withColumn("profit", from_units(profit_units(), PROFIT_SCALE))
    return filters.where_less(lines, "profit", 0.0).select(
        "l_orderkey", "l_linenumber", "p_partkey", "profit"
    )


@query("filter_between_num", "SELECT * FROM lineitem WHERE l_quantity BETWEEN 18 AND 30")
def filter_between_num(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.where_between(table(spark, sf_dir, "lineitem"), "l_quantity", 18.0, 30.0)


@query(
    "filter_between_date",
    """
    SELECT * FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
    """,
)
def filter_between_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.where_date_between(
        table(spark, sf_dir, "orders"), "o_orderdate", date(1996, 1, 1), date(1996, 12, 31)
    )


@query(
    "filter_between_date_text",
    """
    WITH texts AS (
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS iso_date,
            month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate) AS us_date
        FROM orders
    )
    SELECT * FROM texts
    WHERE CAST(try_strptime(us_date, '%m/%d/%Y') AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
        AND CAST(try_strptime(iso_date, '%Y-%m-%d') AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1997-12-31'
    """,
)
def filter_between_date_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    texts = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(F.date_format(day, "yyyy-MM-dd")).alias("iso_date"),
        F.concat_ws("/", F.month(day), F.dayofmonth(day), F.year(day)).alias("us_date"),
    )
    in_1996 = filters.where_date_between(texts, "us_date", date(1996, 1, 1), date(1996, 12, 31), pattern="M/d/yyyy")
    return filters.where_date_between(in_1996, "iso_date", date(1996, 3, 1), date(1997, 12, 31))


@query(
    "filter_and",
    """
    SELECT c_custkey, c_name, r_name, c_mktsegment FROM customer
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE r_name = 'EUROPE' AND c_mktsegment = 'BUILDING'
    """,
)
def filter_and(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.where_all(
        buyers(spark, sf_dir), F.col("r_name") == "EUROPE", F.col("c_mktsegment") == "BUILDING"
    ).select("c_custkey", "c_name", "r_name", "c_mktsegment")


@query(
    "filter_null_rows",
    """
    SELECT l_orderkey, l_linenumber, nullif(l_discount, 0.0) AS discount, nullif(l_tax, 0.0) AS tax
    FROM lineitem WHERE nullif(l_discount, 0.0) IS NULL OR nullif(l_tax, 0.0) IS NULL
    """,
)
def filter_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    holed = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.expr("nullif(l_discount, 0.0D)").alias("discount"),
        F.expr("nullif(l_tax, 0.0D)").alias("tax"),
    )
    return filters.where_any_null(holed, ["discount", "tax"])


@query(
    "filter_expr",
    "SELECT * FROM part WHERE p_size > 40 AND p_retailprice < 1200",
)
def filter_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.where_text(table(spark, sf_dir, "part"), "p_size > 40 AND p_retailprice < 1200")


@query(
    "subquery_above_avg",
    "SELECT * FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)",
)
def subquery_above_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subqueries.above_average(table(spark, sf_dir, "orders"), "o_totalprice")


@query(
    "subquery_max_per_group",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem o
    WHERE l_quantity = (SELECT max(i.l_quantity) FROM lineitem i WHERE i.l_orderkey = o.l_orderkey)
    """,
)
def subquery_max_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"
    )
    return subqueries.rows_at_group_maximum(lines, "l_orderkey", "l_quantity")


TOTALS_SQL = f"""
totals AS (SELECT o_custkey, sum({cents_sql("o_totalprice")}) AS cents FROM orders GROUP BY 1)"""


@query(
    "cte_above_avg",
    f"""
    WITH {TOTALS_SQL}
    SELECT c_custkey, c_name, {dollars_sql("cents")} AS total_sales
    FROM totals JOIN customer ON c_custkey = o_custkey
    WHERE cents > (SELECT avg(cents) FROM totals)
    ORDER BY total_sales DESC
    """,
)
def cte_above_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The totals are used twice, so they are computed once and stored.
    totals = freeze(customer_totals(spark, sf_dir))
    rich = subqueries.above_average(totals, "total_units")
    named = join_dimension(rich, table(spark, sf_dir, "customer"), "o_custkey", "c_custkey")
    return ordering.ordered(
        named.select("c_custkey", "c_name", from_units("total_units", 2).alias("total_sales")),
        [ordering.descending("total_sales"), "c_custkey"],
    )


@query(
    "join_cte_dim",
    f"""
    WITH {TOTALS_SQL}
    SELECT c_custkey, c_name, {dollars_sql("cents")} AS total_sales
    FROM totals JOIN customer ON c_custkey = o_custkey ORDER BY total_sales DESC
    """,
)
def join_cte_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = join_dimension(
        customer_totals(spark, sf_dir), table(spark, sf_dir, "customer"), "o_custkey", "c_custkey"
    )
    return ordering.ordered(
        named.select("c_custkey", "c_name", from_units("total_units", 2).alias("total_sales")),
        [ordering.descending("total_sales"), "c_custkey"],
    )
