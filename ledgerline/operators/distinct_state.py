"""Exact distinct counts from stored bitmaps that merge over any range.

Every value gets a number once, in a stored dictionary. A state row is a bitmap of
32,768 numbers: for each period (and whatever else is grouped by) and each block of numbers, which values occur. States of
periods are OR-ed to those of ranges, so a question reads bitmaps of the periods it asks about and never the facts again;
a new period adds rows and changes none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.workspace import freeze


def value_numbers(df: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """Dictionary (``column``, ``number``) of the distinct values; nulls get none.

    Values of ``known``, an earlier dictionary, keep their numbers, and new ones are numbered after them. Numbers are
    unique but not consecutive: each writing task counts on from a start of its own, so that none waits for another. The
    result is a stored table.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    first = F.lit(1)
    if known is not None:
        values = values.join(known.select(column), column, "left_anti")
        first = F.lit((known.agg(F.max("number")).first()[0] or 0) + 1)
    fresh = values.withColumn("number", F.monotonically_increasing_id() + first)
    return freeze(fresh if known is None else known.select(column, "number").unionByName(freeze(fresh, "numbers")), "numbers")


def distinct_states(df: DataFrame, keys: Sequence[str], column: str, numbers: DataFrame) -> DataFrame:
    """States (keys, ``block``, ``bitmap``) of the values of ``column`` for each combination of keys.

    ``numbers`` must hold all values. Repeated values are combined before the dictionary is joined, so a value or key
    with much of the table is no large group.
    """
    pairs = df.select(*keys, column).where(F.col(column).isNotNull()).distinct().join(numbers, column)
    block = F.bitmap_bucket_number("number").alias("block")
    return pairs.groupBy(*keys, block).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))


def merged_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States by fewer keys, or of several tables together: bitmaps of a block are OR-ed."""
    return states.groupBy(*keys, "block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_counts(states: DataFrame, keys: Sequence[str], name: str = "n_distinct") -> DataFrame:
    """Number of distinct values for each combination of keys, from states that may have more keys."""
    counts = merged_states(states, keys).select(*keys, F.bitmap_count("bitmap").alias("_n"))
    return counts.groupBy(*keys).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(name))
