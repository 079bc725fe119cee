"""Key checks: Spark declares no primary or foreign keys, so they are queried."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "duplicate_count") -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias(name)).where(F.col(name) > 1)


def key_violations(df: DataFrame, keys: Sequence[str], name: str = "n_rows") -> DataFrame:
    """Key values that break a primary key: repeated ones and ones with nulls."""
    incomplete = F.lit(False)
    for key in keys:
        incomplete = incomplete | F.col(key).isNull()
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias(name))
        .where((F.col(name) > 1) | incomplete)
    )


def orphan_rows(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Child rows whose key is set but has no parent row.

    The check runs on distinct keys, so a key that many child rows share is
    exchanged once per task; only orphan keys then go back to the rows.
    """
    known = parent.select(F.col(parent_key).alias(key))
    orphans = (
        child.where(F.col(key).isNotNull()).select(key).distinct().join(known, key, "left_anti")
    )
    return child.join(orphans, key, "left_semi").select(*child.columns)
