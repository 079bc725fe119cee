"""Ranks over sort keys, globally or within groups.

A window sends each of its groups to one task. That is right while groups are
small and wrong for a global rank of very many rows or for a group that holds a
third of the table, so ``rank_rows`` measures the groups: small ones go through
a plain window, larger ones through range-partitioned slices whose local ranks
are shifted by what the slices before them hold.

``rank_rows`` and ``rank_top`` read their input more than once. Order columns
therefore need values that do not change between reads: stored columns, or exact
totals from ``functions.money``, rather than sums of doubles. Pass an expensive
input, such as an aggregate over a join, through ``workspace.freeze`` first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.ordering import SortKey, sort_columns
from ledgerline.workspace import freeze

# One task sorts a group of this many rows without strain, wide rows included.
GROUP_ROWS = 1_000_000

_UNSORTED = {"map", "variant", "interval"}
_KINDS = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}


def _keys(order_by: Sequence[SortKey | str]) -> list[SortKey]:
    return [key if isinstance(key, SortKey) else SortKey(key) for key in order_by]


def _with_window(
    df: DataFrame, keys: list[SortKey], groups: Sequence[str], kind: str, name: str
) -> DataFrame:
    window = Window.partitionBy(*groups).orderBy(*sort_columns(keys))
    return df.withColumn(name, _KINDS[kind]().over(window).cast("bigint"))


def _total(df: DataFrame, keys: list[SortKey], groups: Sequence[str]) -> list[SortKey]:
    """Sort keys followed by the remaining columns that can be sorted, so that only
    rows which are the same all over still tie."""
    used = {*groups, *[key.name for key in keys]}
    rest = [f.name for f in df.schema.fields if f.name not in used and f.dataType.typeName() not in _UNSORTED]
    return [*keys, *[SortKey(name) for name in rest]]


def _prefixed(df: DataFrame, columns: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in columns})


def _same(columns: Sequence[str], prefix: str) -> Column:
    match = F.lit(True)
    for c in columns:
        match = match & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return match


def _sliced_positions(
    keyed: DataFrame, keys: list[SortKey], groups: Sequence[str], slices: int
) -> DataFrame:
    """Add to rows (groups, order columns, ``_ties``) how many keys and rows of
    their group sort up to and including them: ``_key_position``, ``_row_position``.
    """
    order = sort_columns(keys)
    # Slices are contiguous runs of (groups, order). They are stored, since a
    # second evaluation could draw other boundaries.
    sliced = freeze(
        keyed.repartitionByRange(slices, *[F.col(g) for g in groups], *order).withColumn(
            "_slice", F.spark_partition_id()
        )
    )
    local = Window.partitionBy("_slice", *groups).orderBy(*order)
    upto = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = sliced.repartition(slices, "_slice", *groups).withColumns(
        {
            "_key_position": F.row_number().over(local).cast("bigint"),
            "_row_position": F.sum("_ties").over(upto),
        }
    )
    # One row per (group, slice): a group has at most as many as there are slices.
    earlier = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = (
        sliced.groupBy("_slice", *groups)
        .agg(F.count("*").alias("_slice_keys"), F.sum("_ties").alias("_slice_rows"))
        .withColumns(
            {
                "_keys_before": F.coalesce(F.sum("_slice_keys").over(earlier), F.lit(0)),
                "_rows_before": F.coalesce(F.sum("_slice_rows").over(earlier), F.lit(0)),
            }
        )
        .drop("_slice_keys", "_slice_rows")
    )
    before = _prefixed(before, ["_slice", *groups], "before_")
    here = (F.col("_slice") == F.col("before__slice")) & _same(groups, "before_")
    return (
        within.join(before, here)
        .withColumns(
            {
                "_key_position": F.col("_key_position") + F.col("_keys_before"),
                "_row_position": F.col("_row_position") + F.col("_rows_before"),
            }
        )
        .drop("_slice", "_keys_before", "_rows_before", "before__slice")
        .drop(*[f"before_{g}" for g in groups])
    )


def _rank_value(kind: str) -> Column:
    if kind == "dense_rank":
        return F.col("_key_position")
    return F.col("_row_position") - F.col("_ties") + 1


def _with_slices(
    df: DataFrame, keys: list[SortKey], groups: Sequence[str], kind: str, name: str, slices: int
) -> DataFrame:
    if kind == "row_number":
        numbered = _sliced_positions(df.withColumn("_ties", F.lit(1)), keys, groups, slices)
        return numbered.withColumn(name, F.col("_row_position")).select(*df.columns, name)
    # Equal sort keys share a rank, so ranks are worked out on distinct keys:
    # a tie of any size is one row here.
    on = [*groups, *[key.name for key in keys]]
    distinct = df.groupBy(*on).agg(F.count("*").alias("_ties"))
    ranked = _sliced_positions(distinct, keys, groups, slices).withColumn(name, _rank_value(kind))
    ranked = _prefixed(ranked.select(*on, name), on, "ranked_")
    return df.join(ranked, _same(on, "ranked_")).select(*df.columns, name)


def rank_rows(
    df: DataFrame,
    order_by: Sequence[SortKey | str],
    partition_by: Sequence[str] = (),
    *,
    kind: str = "rank",
    name: str = "rank",
    group_rows: int = GROUP_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Add ``rank``, ``dense_rank`` or ``row_number`` over an order.

    For ``row_number`` rows that tie on the order are told apart by their other
    columns, so a number does not depend on how the rows are laid out. Groups of
    more than ``group_rows`` rows are ranked in slices; by default there are as many
    as the session has shuffle partitions.
    """
    keys, groups = _keys(order_by), list(partition_by)
    if kind == "row_number":
        keys = _total(df, keys, groups)
    sizes = df.groupBy(*groups).agg(F.count("*").alias("_n"))
    large = F.col("_n") > group_rows
    measured = sizes.agg(F.count_if(large).alias("n_large")).first()
    if not measured["n_large"]:
        return _with_window(df, keys, groups, kind, name)
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not groups:
        return _with_slices(df, keys, groups, kind, name, slices)
    # At most (rows / group_rows) groups can be large; stored, their size is known to Spark.
    hot = _prefixed(freeze(sizes.where(large).select(*groups)), groups, "hot_")
    is_hot = _same(groups, "hot_")
    small_part = df.join(hot, is_hot, "left_anti")
    large_part = df.join(hot, is_hot, "left_semi")
    return _with_window(small_part, keys, groups, kind, name).unionByName(
        _with_slices(large_part, keys, groups, kind, name, slices)
    )


def rank_top(
    df: DataFrame,
    order_by: Sequence[SortKey | str],
    k: int,
    partition_by: Sequence[str] = (),
    *,
    kind: str = "rank",
    name: str = "rank",
) -> DataFrame:
    """Rows whose ``rank`` or ``dense_rank`` is at most ``k``, all ties kept.

    Ranks up to ``k`` need at most ``k`` distinct sort keys per group. Those are
    found first (each task passes on its own best ``k``), then the rows that
    carry them are looked up, so a tie of any size stays distributed.
    """
    keys, groups = _keys(order_by), list(partition_by)
    on = [*groups, *[key.name for key in keys]]
    window = Window.partitionBy(*groups).orderBy(*sort_columns(keys))
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = df.groupBy(*on).agg(F.count("*").alias("_ties"))
    if not groups:
        counted = counted.orderBy(*sort_columns(keys)).limit(k)  # no more than k keys meet in one task
    leading = (
        counted.withColumn("_key_position", F.row_number().over(window).cast("bigint"))
        .where(F.col("_key_position") <= k)
        .withColumn("_row_position", F.sum("_ties").over(upto))
        .withColumn(name, _rank_value(kind))
        .where(F.col(name) <= k)
    )
    leading = _prefixed(leading.select(*on, name), on, "leading_")
    return df.join(leading, _same(on, "leading_")).select(*df.columns, name)
