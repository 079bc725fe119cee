"""Conditional labels and range guards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def two_way_label(condition: Column, yes: str, no: str) -> Column:
    """One of two labels; a null condition takes ``no``."""
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def banded(value: str, floors: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first floor that ``value`` reaches, highest floor first."""
    label = None
    for floor, name in sorted(floors, reverse=True):
        reached = F.col(value) >= F.lit(floor)
        label = F.when(reached, F.lit(name)) if label is None else label.when(reached, F.lit(name))
    if label is None:
        return F.lit(otherwise)
    return label.otherwise(F.lit(otherwise))


def value_within(value: str, low: float, high: float) -> Column:
    """``value`` inside the inclusive range, null outside it."""
    return F.when(F.col(value).between(low, high), F.col(value))
