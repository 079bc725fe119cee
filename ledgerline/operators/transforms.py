"""Derived and converted columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import banded, raised_by, share_of, two_way_label, year_number
from ledgerline.functions.times import ISO_DATE, parsed_date


def add_product(df: DataFrame, name: str, left: str, right: str) -> DataFrame:
    return df.withColumn(name, F.col(left) * F.col(right))


def add_share(df: DataFrame, name: str, amount: str, share: str) -> DataFrame:
    """``share`` (decimal text) of an amount, to the cent."""
    return df.withColumn(name, share_of(amount, share))


def add_raised(df: DataFrame, name: str, amount: str, share: str) -> DataFrame:
    """Amount plus a ``share`` of it, to the cent."""
    return df.withColumn(name, raised_by(amount, share))


def add_label(df: DataFrame, name: str, condition: Column, yes: str, no: str) -> DataFrame:
    return df.withColumn(name, two_way_label(condition, yes, no))


def add_band(
    df: DataFrame, name: str, value: str, floors: Sequence[tuple[float, str]], otherwise: str
) -> DataFrame:
    return df.withColumn(name, banded(value, floors, otherwise))


def add_whole_part(df: DataFrame, name: str, value: str, kind: str = "bigint") -> DataFrame:
    """Integer part of a number; null where the integer type is too small."""
    return df.withColumn(name, F.col(value).try_cast(kind))


def add_rounded(df: DataFrame, name: str, value: str, digits: int = 0) -> DataFrame:
    """Half-up rounding; ``name`` may be the column itself."""
    return df.withColumn(name, F.round(value, digits))


def add_year(df: DataFrame, name: str, date_text: str, pattern: str = ISO_DATE) -> DataFrame:
    """Year of a date kept as text."""
    return df.withColumn(name, year_number(parsed_date(date_text, pattern)))
