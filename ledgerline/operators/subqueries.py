"""Filters against an aggregate of the same table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def above_average(df: DataFrame, value: str) -> DataFrame:
    """Rows whose value exceeds the table's average (a scalar subquery)."""
    return df.where(F.col(value) > df.select(F.avg(value)).scalar())


def rows_at_group_maximum(df: DataFrame, key: str, value: str) -> DataFrame:
    """Every row that holds its group's largest value, ties included.

    The maxima are combined before they are exchanged, and the semi join is on
    (key, value), so the rows of one large group spread over its values.
    """
    best = df.groupBy(key).agg(F.max(value).alias(value))
    return df.join(best, [key, value], "left_semi").select(*df.columns)
