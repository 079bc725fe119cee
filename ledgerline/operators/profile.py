"""Shape, types, null counts and numeric summaries of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ledgerline.operators.ordering import SortKey, ordered


def head_rows(df: DataFrame, n: int, order_by: Sequence[SortKey | str]) -> DataFrame:
    """First ``n`` rows of a stated order."""
    return ordered(df, order_by).limit(n)


def tail_rows(df: DataFrame, n: int, order_by: Sequence[SortKey | str]) -> DataFrame:
    """Last ``n`` rows of a stated order, last row first."""
    keys = [key if isinstance(key, SortKey) else SortKey(key) for key in order_by]
    return ordered(df, [key.reversed() for key in keys]).limit(n)


def table_shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count("*").alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint")
    )


def _missing(df: DataFrame, name: str, nan_is_missing: bool) -> Column:
    test = F.col(name).isNull()
    if nan_is_missing and isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        test = test | F.isnan(name)
    return test


def null_counts(
    df: DataFrame, columns: Sequence[str] | None = None, nan_is_missing: bool = True
) -> DataFrame:
    """One row: missing values per column, all counted in one pass."""
    return df.agg(
        *[F.count_if(_missing(df, c, nan_is_missing)).alias(c) for c in columns or df.columns]
    )


def schema_frame(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and number of present values."""
    types = dict(df.dtypes)
    present = df.agg(*[F.count(c).alias(c) for c in df.columns])
    rows = [
        F.struct(
            F.lit(position).cast("bigint").alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(types[name]).alias("data_type"),
            F.col(name).alias("n_present"),
        )
        for position, name in enumerate(df.columns, start=1)
    ]
    return present.select(F.inline(F.array(*rows)))


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum, one row per column."""
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("n_values"),
                F.avg(c).alias("mean"),
                F.stddev(c).alias("stddev"),
                F.min(c).cast("double").alias("min_value"),
                F.max(c).cast("double").alias("max_value"),
            ).alias(c)
            for c in columns
        ]
    )
    return stats.select(F.inline(F.array(*[F.col(c) for c in columns])))
