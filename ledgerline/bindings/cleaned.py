"""Cleaning, on tables with injected duplicates, nulls, padding and bad dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.bindings.registry import query
from ledgerline.bindings.tables import table
from ledgerline.operators import cleaning


@query("dedup_full_row", "SELECT DISTINCT text, lang FROM documents")
def dedup_full_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_duplicate_rows(table(spark, sf_dir, "documents").select("text", "lang"))


@query("dedup_by_locator", "SELECT DISTINCT text, lang FROM documents")
def dedup_by_locator(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return cleaning.drop_duplicates_by_locator(documents, ["text", "lang"]).select("text", "lang")


@query(
    "dedup_report",
    """
    SELECT count(*) AS rows_before, count(DISTINCT (text, lang)) AS rows_after,
           count(*) - count(DISTINCT (text, lang)) AS rows_removed
    FROM documents
    """,
)
def dedup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.duplicate_report(table(spark, sf_dir, "documents").select("text", "lang"))


def _holed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.expr("nullif(l_discount, 0.0D)").alias("discount"),
        F.expr("nullif(l_quantity, 1.0D)").alias("quantity"),
        F.expr("nullif(l_returnflag, 'N')").alias("flag"),
    )


@query(
    "fill_all_zero",
    """
    SELECT l_orderkey, l_linenumber, coalesce(nullif(l_discount, 0.0), 0.0) AS discount,
           coalesce(nullif(l_quantity, 1.0), 0.0) AS quantity,
           coalesce(nullif(l_returnflag, 'N'), '0') AS flag
    FROM lineitem
    """,
)
def fill_all_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.fill_everything(_holed_lines(spark, sf_dir), 0)


@query(
    "fill_per_column",
    """
    SELECT l_orderkey, l_linenumber, nullif(l_discount, 0.0) AS discount,
           coalesce(nullif(l_quantity, 1.0), 25.0) AS quantity,
           coalesce(nullif(l_returnflag, 'N'), 'Unknown') AS flag
    FROM lineitem
    """,
)
def fill_per_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.fill_columns(
        _holed_lines(spark, sf_dir), {"quantity": 25.0, "flag": "Unknown"}
    )


@query(
    "drop_null_subset",
    """
    SELECT l_orderkey, l_linenumber, l_discount AS discount, nullif(l_quantity, 1.0) AS quantity,
           l_returnflag AS flag
    FROM lineitem WHERE nullif(l_discount, 0.0) IS NOT NULL AND nullif(l_returnflag, 'N') IS NOT NULL
    """,
)
def drop_null_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_rows_missing(_holed_lines(spark, sf_dir), "discount", "flag")


@query(
    "drop_null_column",
    """
    SELECT l_orderkey, l_linenumber, l_discount AS discount, nullif(l_quantity, 1.0) AS quantity,
           nullif(l_returnflag, 'N') AS flag
    FROM lineitem WHERE nullif(l_discount, 0.0) IS NOT NULL
    """,
)
def drop_null_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_rows_missing(_holed_lines(spark, sf_dir), "discount")


@query("trim_strings", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def trim_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit(" "), "c_name").alias("c_name"),
        F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("c_mktsegment"),
    )
    return cleaning.trim_columns(padded, "c_name", "c_mktsegment")


# Urgent orders carry their date in another format, which the pattern rejects.
# The parsed date goes out as a timestamp, the type both engines share.
@query(
    "parse_date",
    """
    SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN NULL
                            ELSE date_trunc('day', o_orderdate) END AS order_date
    FROM orders
    """,
)
def parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(
            F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "M/d/yyyy")
        )
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("order_date"),
    )
    parsed = cleaning.parse_date_column(text, "order_date")
    return parsed.withColumn("order_date", F.col("order_date").cast("timestamp_ntz"))


@query(
    "range_guard",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity BETWEEN 5 AND 45",
)
def range_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return cleaning.keep_in_range(lines, "l_quantity", 5.0, 45.0)


@query(
    "clean_chain",
    """
    SELECT l_orderkey, l_linenumber, l_quantity AS age, coalesce(nullif(l_tax, 0.0), 0.0) AS price,
           coalesce(nullif(l_returnflag, 'N'), 'Unknown') AS status, l_linestatus AS line_status,
           date_trunc('day', l_shipdate) AS ship_date
    FROM lineitem
    WHERE nullif(l_discount, 0.0) IS NOT NULL AND l_quantity BETWEEN 18 AND 100
    """,
)
def clean_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_discount") != 0, F.col("l_quantity")).alias("age"),
        F.expr("nullif(l_tax, 0.0D)").alias("price"),
        F.concat(F.lit(" "), F.expr("nullif(l_returnflag, 'N')"), F.lit("  ")).alias("status"),
        F.concat(F.lit("  "), "l_linestatus").alias("line_status"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"),
    )
    cleaned = cleaning.clean_rows(
        raw,
        fill={"price": 0.0, "status": "Unknown"},
        required=["age"],
        trim=["status", "line_status"],
        dates=["ship_date"],
        ranges={"age": (18.0, 100.0)},
    )
    return cleaned.withColumn("ship_date", F.col("ship_date").cast("timestamp_ntz"))
