"""E-commerce transactions: load, clean, and report revenue."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from ledgerline.functions import exact_total, from_units, units
from ledgerline.operators import cleaning, transforms
from ledgerline.operators.ordering import ascending, descending, ordered, top_k
from ledgerline.sources import read_csv, write_csv
from ledgerline.workspace import freeze

TRANSACTIONS = StructType(
    [
        StructField("transaction_id", LongType()),
        StructField("user_id", StringType()),
        StructField("age", IntegerType()),
        StructField("product_category", StringType()),
        StructField("region", StringType()),
        StructField("city", StringType()),
        StructField("price", DoubleType()),
        StructField("status", StringType()),
        StructField("transaction_date", StringType()),
        StructField("subscription", StringType()),
    ]
)

# Fixed values of the cleaning rules.
FILL = {"price": 0.0, "status": "Unknown"}
REQUIRED = ("age", "user_id")
AGES = (18, 100)
HIGH_VALUE = 2000.0


def load_transactions(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, TRANSACTIONS, null_token="")


def clean_transactions(raw: DataFrame) -> DataFrame:
    """One copy of each row, filled, trimmed, typed, guarded and labelled."""
    cleaned = cleaning.clean_rows(
        cleaning.drop_duplicate_rows(raw),
        fill=FILL,
        required=REQUIRED,
        trim=("product_category", "region", "subscription"),
        dates=("transaction_date",),
        ranges={"age": AGES},
    )
    rounded = transforms.add_rounded(cleaned, "price", "price", 2)
    return transforms.add_label(
        rounded, "value_segment", F.col("price") >= HIGH_VALUE, "High Value", "Standard"
    )


def clean_in_steps(raw: DataFrame) -> DataFrame:
    """The variant that requires only an age, trims all text and keeps prices."""
    return cleaning.clean_rows(
        cleaning.drop_duplicate_rows(raw),
        fill=FILL,
        required=("age",),
        trim=("user_id", "product_category", "region", "city", "status", "subscription"),
        dates=("transaction_date",),
        ranges={"age": AGES},
    )


def cleaning_counts(raw: DataFrame) -> DataFrame:
    """One row with the number of rows after each step.

    Every count comes from one grouping of the raw rows, not from one run of the
    chain per count.
    """
    copies = raw.groupBy(*raw.columns).agg(F.count("*").alias("_copies"))
    complete = F.lit(True)
    for column in REQUIRED:
        complete = complete & F.col(column).isNotNull()
    return copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows_loaded"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicates_removed"),
        F.count_if(complete).alias("rows_after_nulls"),
        F.count_if(complete & F.col("age").between(*AGES)).alias("final_rows"),
    )


@dataclass(frozen=True)
class RevenueReports:
    by_category: DataFrame
    by_region: DataFrame
    top_cities: DataFrame


def revenue_reports(cleaned: DataFrame) -> RevenueReports:
    """All reports from one run over the transactions.

    Counts and totals add up, so the transactions are summarised once at the
    finest level the reports share; the stored summary then serves all three.
    """
    summary = freeze(
        cleaned.groupBy("product_category", "region", "city").agg(
            F.count("*").alias("n"), exact_total(units("price", 2)).alias("price_units")
        )
    )
    by_category = _report(summary, "product_category")
    by_region = _report(summary, "region")
    by_city = _report(summary, "city").drop("avg_order_value")
    return RevenueReports(
        by_category=ordered(by_category, [descending("total_revenue")]),
        by_region=ordered(by_region, [descending("total_revenue")]),
        top_cities=top_k(by_city, 5, [descending("total_revenue"), ascending("city")]),
    )


def _report(summary: DataFrame, key: str) -> DataFrame:
    transactions, revenue = F.sum("n"), F.sum("price_units")
    return summary.groupBy(key).agg(
        transactions.alias("transactions"),
        F.round(from_units(revenue, 2), 2).alias("total_revenue"),
        F.round(from_units(revenue.cast("double") / transactions, 2), 2).alias("avg_order_value"),
    )


def run_revenue_job(spark: SparkSession, source: str, target: str) -> RevenueReports:
    """Load, clean, report, and write the category and region reports below ``target``."""
    reports = revenue_reports(clean_transactions(load_transactions(spark, source)))
    write_csv(reports.by_category, f"{target}/revenue_by_category", files=1)
    write_csv(reports.by_region, f"{target}/revenue_by_region", files=1)
    return reports
