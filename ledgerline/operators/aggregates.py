"""Global and grouped statistics.

Spark combines every aggregate here inside the map tasks, so a key that holds a
large part of the table reaches the shuffle as one row per task. Where ``scale`` states
how many digits amounts are stored with, their totals are exact; otherwise they are
double aggregates (see ``functions.money``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import exact_total, from_units, units, units_deviation, units_mean, units_total


def mean_of(df: DataFrame, value: str, name: str, scale: int | None = None) -> DataFrame:
    return df.agg(units_mean(value, scale).alias(name))


def maximum_of(df: DataFrame, value: str, name: str) -> DataFrame:
    return df.agg(F.max(value).alias(name))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its name and number of rows."""
    counted = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows"
        )
        counted = one if counted is None else counted.unionByName(one)
    return counted


def distinct_count(df: DataFrame, value: str, name: str) -> DataFrame:
    return df.agg(F.count_distinct(value).alias(name))


def distinct_count_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Distinct values per group.

    Duplicates are removed on (keys, value) first, so a large group is spread
    over its values before its count is added up.
    """
    return df.groupBy(*keys).agg(F.count_distinct(value).alias(name))


# What ``statistics`` can work out, by name, from a column and the scale of its amounts.
_STATISTICS = {
    "rows": lambda column, scale: F.count("*"),
    "count": lambda column, scale: F.count(column),
    "mean": units_mean,
    "total": units_total,
    "min": lambda column, scale: F.min(column),
    "max": lambda column, scale: F.max(column),
    "stddev": lambda column, scale: F.stddev(column),
    "exact_stddev": units_deviation,
}


def statistics(
    df: DataFrame,
    measures: Mapping[str, tuple],
    keys: Sequence[str] = (),
    *,
    scales: Mapping[str, int] | None = None,
) -> DataFrame:
    """Named statistics in one pass, per group or over the whole table.

    ``measures`` maps an output name to (statistic, column) or (statistic, column,
    digits), where digits rounds the result. ``scales`` states the stored digits
    of amount columns.
    """
    columns = []
    for name, (kind, column, *digits) in measures.items():
        found = _STATISTICS[kind](column, (scales or {}).get(column))
        columns.append((F.round(found, digits[0]) if digits else found).alias(name))
    return df.groupBy(*keys).agg(*columns)


def sum_by(
    df: DataFrame, keys: Sequence[str], value: str, name: str, scale: int | None = None
) -> DataFrame:
    return df.groupBy(*keys).agg(units_total(value, scale).alias(name))


def mean_by(
    df: DataFrame, keys: Sequence[str], value: str, name: str, scale: int | None = None
) -> DataFrame:
    return df.groupBy(*keys).agg(units_mean(value, scale).alias(name))


def count_by(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def amount_summary_by(
    df: DataFrame,
    keys: Sequence[str],
    amount: str,
    *,
    count_name: str = "transactions",
    total_name: str = "total_revenue",
    mean_name: str | None = "avg_order_value",
    extremes: bool = False,
    scale: int | None = None,
) -> DataFrame:
    """Rows, total, mean and (optionally) extremes of an amount per group."""
    measures = [
        F.count("*").alias(count_name),
        F.round(units_total(amount, scale), 2).alias(total_name),
    ]
    if mean_name:
        measures.append(F.round(units_mean(amount, scale), 2).alias(mean_name))
    if extremes:
        measures.append(F.round(F.min(amount), 2).alias("min_price"))
        measures.append(F.round(F.max(amount), 2).alias("max_price"))
    return df.groupBy(*keys).agg(*measures)


def groups_where(grouped: DataFrame, predicate: str) -> DataFrame:
    """Keep groups by a predicate on their aggregates (HAVING)."""
    return grouped.where(predicate)


def mean_of_totals(
    df: DataFrame, keys: Sequence[str], value: str, name: str, scale: int | None = None
) -> DataFrame:
    """Average of per-group totals."""
    if scale is None:
        totals = df.groupBy(*keys).agg(units_total(value, None).alias("total"))
        return totals.agg(F.round(F.avg("total"), 2).alias(name))
    totals = df.groupBy(*keys).agg(exact_total(units(value, scale)).alias("total"))
    mean = F.sum("total").cast("double") / F.count("total")
    return totals.agg(F.round(from_units(mean, scale), 2).alias(name))
