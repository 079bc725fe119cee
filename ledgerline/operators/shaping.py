"""Choosing, renaming and dropping columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def project(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns)


def clean_column_names(df: DataFrame) -> DataFrame:
    """Strip column names and turn spaces and hyphens into underscores."""
    names = [name.strip().replace(" ", "_").replace("-", "_") for name in df.columns]
    return df.toDF(*names)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)
