"""Normalisation of the flat sales view, key checks, and layout by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.bindings.registry import query
from ledgerline.bindings.tables import SALES_SQL, cents_sql, dollars_sql, sales, table
from ledgerline.functions import from_units, units
from ledgerline.operators import layout, normalise, quality
from ledgerline.workspace import fresh_path

FACT_COLUMNS = [
    "l_orderkey",
    "l_linenumber",
    "o_orderdate",
    "l_shipdate",
    "o_orderpriority",
    "c_custkey",
    "p_partkey",
    "l_extendedprice",
    "l_quantity",
    "l_discount",
    "l_tax",
]


@query(
    "normalise_customers",
    f"""
    WITH {SALES_SQL}
    SELECT c_custkey, min(c_name) AS c_name, min(c_mktsegment) AS c_mktsegment
    FROM sales GROUP BY c_custkey
    """,
)
def normalise_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise.dimension(sales(spark, sf_dir), "c_custkey", ["c_name", "c_mktsegment"])


@query(
    "normalise_products",
    f"""
    WITH {SALES_SQL}
    SELECT p_partkey, min(p_type) AS p_type, min(p_brand) AS p_brand, min(p_name) AS p_name
    FROM sales GROUP BY p_partkey
    """,
)
def normalise_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = sales(spark, sf_dir, parts_first=True)
    return normalise.dimension(flat, "p_partkey", ["p_type", "p_brand", "p_name"])


# Names repeat over parts, so attributes disagree and the smallest set is taken.
@query(
    "normalise_conflicts",
    """
    SELECT p_name, p_type, p_brand, p_size FROM (
        SELECT p_name, p_type, p_brand, p_size,
               row_number() OVER (PARTITION BY p_name ORDER BY p_type, p_brand, p_size) AS n
        FROM part)
    WHERE n = 1
    """,
)
def normalise_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return normalise.dimension(part, "p_name", ["p_type", "p_brand", "p_size"])


@query("normalise_orders", f"WITH {SALES_SQL} SELECT {', '.join(FACT_COLUMNS)} FROM sales")
def normalise_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise.fact(sales(spark, sf_dir), FACT_COLUMNS)


@query(
    "pk_violations",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows
    FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
    """,
)
def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "fk_orphans",
    """
    SELECT doc_id, lang, source, n_chars FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    """,
)
def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return quality.orphan_rows(documents, table(spark, sf_dir, "labels"), "doc_id", "doc_id")


# Five priorities share all orders, so each may use up to eight partitions.
@query(
    "repartition_by_key",
    f"""
    SELECT o_orderpriority, count(*) AS n_rows, TRUE AS within_spread,
           {dollars_sql(f"sum({cents_sql('o_totalprice')})")} AS total_sales
    FROM orders GROUP BY o_orderpriority
    """,
)
def repartition_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = 8
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_totalprice")
    dealt = layout.repartition_by_key(
        orders, ["o_orderpriority"], 2 * spark.sparkContext.defaultParallelism, spread
    )
    usage = layout.partition_usage(
        dealt, ["o_orderpriority"], {"total_units": units("o_totalprice", 2)}
    )
    return usage.select(
        "o_orderpriority",
        "n_rows",
        (F.col("n_partitions") <= spread).alias("within_spread"),
        from_units("total_units", 2).alias("total_sales"),
    )


# Line items and orders are stored by order once; the three questions below then read them without an exchange.
@query(
    "bucketed_groupings",
    """
    SELECT o_orderkey, o_custkey, n_lines, total_quantity, n_returned, last_shipped
    FROM orders
    JOIN (SELECT l_orderkey, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_quantity
          FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
    JOIN (SELECT l_orderkey AS k, CAST(count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS BIGINT) AS n_returned,
                 max(l_shipdate) AS last_shipped
          FROM lineitem GROUP BY 1) ON k = o_orderkey
    """,
)
def bucketed_groupings(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = 2 * spark.sparkContext.defaultParallelism
    stored = {
        name: layout.store_bucketed(
            table(spark, sf_dir, name).select(*columns), f"ledger_{name}_by_order", fresh_path(spark, f"{name}-by-order"), columns[:1], buckets
        )
        for name, columns in {
            "lineitem": ["l_orderkey", "l_quantity", "l_returnflag", "l_shipdate"],
            "orders": ["o_orderkey", "o_custkey"],
        }.items()
    }
    lineitem = stored["lineitem"]
    sizes = lineitem.groupBy("l_orderkey").agg(
        F.count("*").alias("n_lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("total_quantity")
    )
    returns = lineitem.groupBy("l_orderkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("n_returned"), F.max("l_shipdate").alias("last_shipped")
    )
    return (
        stored["orders"].withColumnRenamed("o_orderkey", "l_orderkey").join(sizes, "l_orderkey").join(returns, "l_orderkey")
        .withColumnRenamed("l_orderkey", "o_orderkey")
    )
