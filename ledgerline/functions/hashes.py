"""Hashes of whole rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType


def row_hash(schema: StructType, salt: int) -> Column:
    """64-bit hash of the columns of ``schema``; other salts give independent hashes.

    Rows that a grouping takes for equal have equal hashes: zeros of either sign are one value, and so are all
    NaN. A null is unlike any value of any column.
    """
    cells = []
    for field in schema:
        cell = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (FloatType, DoubleType)):
            cell = F.when(cell == 0, F.lit(0.0).cast(field.dataType)).otherwise(cell)
        # A hash passes over nulls, so where they are is hashed too.
        cells += [cell.isNull(), cell]
    return F.xxhash64(F.lit(salt), *cells)
