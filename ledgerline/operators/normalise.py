"""Split a flat table into dimensions and a fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dimension(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """One row per key. Where attributes disagree the smallest combination wins,
    so the result does not depend on row order.

    Duplicates are removed first, by hashing inside the map tasks; the choice per
    key then sorts only the few distinct combinations that are left. Counting the
    copies keeps the two steps apart: a bare distinct under a minimum is optimised
    away, and every row would be sorted.
    """
    combinations = (
        df.groupBy(key, *attributes).agg(F.count("*").alias("_copies")).where(F.col("_copies") > 0)
    )
    chosen = combinations.groupBy(key).agg(F.min(F.struct(*attributes)).alias("chosen"))
    return chosen.select(key, *[F.col(f"chosen.{a}").alias(a) for a in attributes])


def fact(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)
