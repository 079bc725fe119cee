"""Partitioning of a table ahead of several operations on the same keys, in one job or in all later ones."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def repartition_by_key(
    df: DataFrame, keys: Sequence[str], partitions: int, spread: int = 1
) -> DataFrame:
    """Hash-partition rows by ``keys``.

    With ``spread=1`` every key lives in one partition. For keys that hold much
    of the table give the number of partitions each may use: rows are dealt over
    them by position, so identical rows are split as well. The position has to be
    the same when a lost task is run again: use it on a scan or a frozen table.
    """
    if spread <= 1:
        return df.repartition(partitions, *keys)
    return (
        df.withColumn("_deal", F.pmod(F.monotonically_increasing_id(), F.lit(spread)))
        .repartition(partitions, *keys, "_deal")
        .drop("_deal")
    )


def partition_usage(
    df: DataFrame, keys: Sequence[str], sums: Mapping[str, Column] | None = None
) -> DataFrame:
    """Rows per key and the number of partitions that hold them.

    ``sums`` names further columns to total per key in the same pass.
    """
    sums = sums or {}
    per_partition = df.groupBy(*keys, F.spark_partition_id().alias("_partition")).agg(
        F.count("*").alias("_n"), *[F.sum(column).alias(name) for name, column in sums.items()]
    )
    return per_partition.groupBy(*keys).agg(
        F.sum("_n").alias("n_rows"),
        F.count("*").alias("n_partitions"),
        *[F.sum(name).alias(name) for name in sums],
    )


def store_bucketed(
    df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int, *, sorted_by: Sequence[str] | None = None
) -> DataFrame:
    """Store a table bucketed by ``keys`` and sorted within buckets, one file for each bucket.

    Groupings on the keys, and joins on them with tables of as many buckets, need no exchange in any later job
    that reads the table by its name. ``path`` must be a new folder: the rows are complete there before
    the name is theirs, and an earlier table of that name keeps its files. A key that holds much of the table fills one bucket; where
    there are such keys, store by more columns and group in two steps (``grouped_in_steps``).
    """
    spark = df.sparkSession
    # Dealt by the hash that buckets have, so a task writes one bucket as one file.
    dealt = df.repartition(buckets, *[f"`{k}`" for k in keys])
    staged = f"{name}_{uuid.uuid4().hex}"
    writer = dealt.write.format("parquet").option("path", path).bucketBy(buckets, *keys)
    writer.sortBy(*(sorted_by or keys)).saveAsTable(staged)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    return spark.table(name)


def grouped_in_steps(
    df: DataFrame, keys: Sequence[str], finer: Sequence[str], sums: Mapping[str, Column]
) -> DataFrame:
    """Totals by ``keys`` of a table stored by ``keys`` and ``finer`` columns.

    Rows are totalled where they lie, and one row for each finer group is exchanged; so a hot key is split over the buckets
    of its finer groups.
    """
    first = df.groupBy(*keys, *finer).agg(*[F.sum(column).alias(name) for name, column in sums.items()])
    return first.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in sums])
