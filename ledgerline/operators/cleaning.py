"""Duplicates, missing values, padding, dates kept as text, bad values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from ledgerline.functions import parsed_date, row_hash, value_within
from ledgerline.functions.times import ISO_DATE
from ledgerline.workspace import freeze


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """One copy of every row; copies are combined before the shuffle."""
    return df.dropDuplicates()


def drop_duplicates_by_locator(scan: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One copy of every row of a file scan, without shuffling rows that have no copy for it.

    First only 128-bit digests are exchanged, to find those that occur twice or more. Rows of these are then grouped
    as whole rows, which confirms that they are equal, and keep the smallest locator; copies are combined in
    the map tasks, so a row that is a third of the table is no large group. All other rows pass from the scan. Repeated
    digests reach the rows by a broadcast where Spark finds them few, otherwise by a join.

    ``scan`` is a Parquet scan, possibly filtered, read three times. The result has its columns (or ``columns``) and the
    locator of the kept copy: ``file_path`` and ``row_index``.
    """
    columns = list(columns or scan.columns)
    schema = scan.select(*[f"`{c}`" for c in columns]).schema
    digests = [row_hash(schema, 1).alias("_a"), row_hash(schema, 2).alias("_b")]
    # The parts of a locator order copies; other than that they are not looked at.
    locator = [F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("row_index")]
    located = scan.select(*[F.col(f"`{c}`") for c in columns], *locator, *digests)
    repeated = freeze(
        scan.select(*digests).groupBy("_a", "_b").agg(F.count("*").alias("_n")).where("_n > 1").select("_a", "_b"),
        "repeated-digests",
    )
    names = [f"`{c}`" for c in columns]
    singles = located.join(repeated, ["_a", "_b"], "left_anti").select(*names, "file_path", "row_index")
    equal = located.join(repeated, ["_a", "_b"]).groupBy(*names).agg(F.min(F.struct("file_path", "row_index")).alias("_at"))
    return singles.unionByName(equal.select(*names, "_at.file_path", "_at.row_index"))


def duplicate_report(df: DataFrame) -> DataFrame:
    """One row: rows before, rows after and copies removed, in a single pass."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    return copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows_before"),
        F.count("*").alias("rows_after"),
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def fill_everything(df: DataFrame, value: int = 0) -> DataFrame:
    """Fill numbers with ``value`` and text with its digits."""
    numbers = [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
    texts = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    filled = df.na.fill(value, subset=numbers) if numbers else df
    return filled.na.fill(str(value), subset=texts) if texts else filled


def fill_columns(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    return df.na.fill(dict(values))


def drop_rows_missing(df: DataFrame, *columns: str) -> DataFrame:
    """Drop rows in which any of the columns is null."""
    return df.na.drop(how="any", subset=list(columns))


def trim_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.trim(c) for c in columns})


def parse_date_column(df: DataFrame, column: str, pattern: str = ISO_DATE) -> DataFrame:
    """Text column to date in place; unreadable text becomes null."""
    return df.withColumn(column, parsed_date(column, pattern))


def null_outside_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Turn values outside the inclusive range into nulls."""
    return df.withColumn(column, value_within(column, low, high))


def keep_in_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Drop rows whose value is null or outside the inclusive range.

    This is what nulling such values and dropping the nulls leaves, written as a
    comparison that can be pushed into the scan.
    """
    return df.where(F.col(column).between(low, high))


def clean_rows(
    df: DataFrame,
    *,
    fill: Mapping[str, Any],
    required: Sequence[str],
    trim: Sequence[str],
    dates: Sequence[str],
    ranges: Mapping[str, tuple[float, float]],
) -> DataFrame:
    """Fill, drop, trim, parse, guard: one narrow stage, no exchange."""
    out = fill_columns(df, fill) if fill else df
    out = drop_rows_missing(out, *required) if required else out
    out = trim_columns(out, *trim) if trim else out
    for column in dates:
        out = parse_date_column(out, column)
    for column, (low, high) in ranges.items():
        out = keep_in_range(out, column, low, high)
    return out
