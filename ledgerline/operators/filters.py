"""Row filters. All are plain predicates that reach the file scan."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import ISO_DATE, parsed_date


def where_equal(df: DataFrame, column: str, value: Any) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def where_greater(df: DataFrame, column: str, value: Any) -> DataFrame:
    return df.where(F.col(column) > F.lit(value))


def where_less(df: DataFrame, column: str, value: Any) -> DataFrame:
    return df.where(F.col(column) < F.lit(value))


def where_between(df: DataFrame, column: str, low: Any, high: Any) -> DataFrame:
    """Inclusive at both ends."""
    return df.where(F.col(column).between(low, high))


def where_date_between(
    df: DataFrame, column: str, first: date, last: date, *, pattern: str = ISO_DATE
) -> DataFrame:
    """Rows of the days ``first`` to ``last``; the whole last day counts.

    A text column is read by ``pattern`` and compared as dates; text that does not
    match the pattern is no date and drops out.

    On a timestamp column the bounds stay plain comparisons with the column, so
    they are pushed into the scan.
    """
    if df.schema[column].dataType.typeName() == "string":
        return df.where(parsed_date(F.col(column), pattern).between(F.lit(first), F.lit(last)))
    start, end = F.lit(first), F.date_add(F.lit(last), 1)
    if df.schema[column].dataType.typeName() == "date":
        return df.where((F.col(column) >= start) & (F.col(column) <= F.lit(last)))
    kind = df.schema[column].dataType
    return df.where((F.col(column) >= start.cast(kind)) & (F.col(column) < end.cast(kind)))


def where_all(df: DataFrame, *conditions: Column) -> DataFrame:
    return df.where(reduce(and_, conditions))


def where_any_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which at least one of the columns is null."""
    return df.where(reduce(or_, [F.col(c).isNull() for c in columns]))


def where_text(df: DataFrame, predicate: str) -> DataFrame:
    """Predicate written as SQL text."""
    return df.where(predicate)
