"""The test tables, and the flat sales view the analyst queries are written on.

Joins start at the small dimensions, so a filter on region or segment shrinks
orders and line items before they are exchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import exact_total, units
from ledgerline.operators.joins import aggregate_then_join, join_dimension
from ledgerline.sources import read_parquet

# Declared columns: reading them costs no look at the files beforehand.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
        "p_retailprice DOUBLE"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet", SCHEMAS[name])


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_dimension(
        table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"), "n_regionkey", "r_regionkey"
    )


def buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_dimension(
        table(spark, sf_dir, "customer"), places(spark, sf_dir), "c_nationkey", "n_nationkey"
    )


def placed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_dimension(
        table(spark, sf_dir, "orders"), buyers(spark, sf_dir), "o_custkey", "c_custkey"
    )


def sales(spark: SparkSession, sf_dir: str, parts_first: bool = False) -> DataFrame:
    """One row per line item with its order, customer, place and part.

    Orders come first, so that filters on them shrink the second join. A query
    that goes on to group by part asks for ``parts_first``: its grouping then
    needs an exchange of its own, and a part with very many lines can be split in
    the join (adaptive splitting keeps out of joins whose partitioning is reused).
    """
    lines = table(spark, sf_dir, "lineitem")
    part, orders = table(spark, sf_dir, "part"), placed_orders(spark, sf_dir)
    if parts_first:
        lines = join_dimension(lines, part, "l_partkey", "p_partkey")
        return join_dimension(lines, orders, "l_orderkey", "o_orderkey")
    lines = join_dimension(lines, orders, "l_orderkey", "o_orderkey")
    return join_dimension(lines, part, "l_partkey", "p_partkey")


SALES_SQL = """
sales AS (
    SELECT * FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    JOIN part ON l_partkey = p_partkey
)"""

# Profit of a line: what was paid minus twice the list price of what was sold.
# It is held in units of 1/10000, in which every stored amount is whole.
PROFIT_SCALE = 4

PROFIT_SQL = """
(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT))
 - 200 * CAST(l_quantity AS BIGINT) * CAST(round(p_retailprice * 100) AS BIGINT))"""


def profit_units() -> Column:
    paid = units("l_extendedprice", 2) * (F.lit(100) - units("l_discount", 2))
    return paid - F.lit(200) * units("l_quantity", 0) * units("p_retailprice", 2)


def profit_by_part(spark: SparkSession, sf_dir: str, *attributes: str) -> DataFrame:
    """Profit units, paid units and quantity per part.

    Line items are reduced to one row per part before the part table is joined:
    the list price is constant within a part and can be applied to the totals.
    """
    paid = units("l_extendedprice", 2) * (F.lit(100) - units("l_discount", 2))
    per_part = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(
            exact_total(paid).alias("paid_units"),
            exact_total(units("l_quantity", 0)).alias("quantity"),
            F.count("*").alias("n_lines"),
        )
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", *attributes)
    cost = F.lit(200) * F.col("quantity") * units("p_retailprice", 2)
    return join_dimension(per_part, part, "l_partkey", "p_partkey").select(
        "p_partkey",
        *attributes,
        "quantity",
        "n_lines",
        (F.col("paid_units") - cost).alias("profit_units"),
    )


def profit_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profit units per order key."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    lines = join_dimension(table(spark, sf_dir, "lineitem"), part, "l_partkey", "p_partkey")
    return lines.groupBy("l_orderkey").agg(exact_total(profit_units()).alias("profit_units"))


def profit_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate_then_join(
        profit_by_order(spark, sf_dir),
        table(spark, sf_dir, "orders"),
        "l_orderkey",
        "o_orderkey",
        ["o_custkey"],
        {"profit_units": ("sum", "profit_units")},
    )


def customer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order value in cents and number of orders per customer key."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(exact_total(units("o_totalprice", 2)).alias("total_units"), F.count("*").alias("n_orders"))
    )


CENTS_SQL = "CAST(round({0} * 100) AS BIGINT)"


def cents_sql(column: str) -> str:
    return CENTS_SQL.format(column)


def dollars_sql(cents: str, scale: int = 2) -> str:
    return f"CAST({cents} AS DOUBLE) / {10**scale}.0"
