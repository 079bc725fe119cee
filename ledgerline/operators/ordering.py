"""Sort keys with a stated direction and null order, sorting, and top-k."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SortKey:
    """A column, its direction, and where its nulls go.

    Nulls count as the smallest value unless said otherwise.
    """

    name: str
    ascending: bool = True
    nulls_first: bool | None = None

    @property
    def column(self) -> Column:
        nulls_first = self.ascending if self.nulls_first is None else self.nulls_first
        value = F.col(self.name)
        if self.ascending:
            return value.asc_nulls_first() if nulls_first else value.asc_nulls_last()
        return value.desc_nulls_first() if nulls_first else value.desc_nulls_last()

    def reversed(self) -> SortKey:
        nulls_first = None if self.nulls_first is None else not self.nulls_first
        return replace(self, ascending=not self.ascending, nulls_first=nulls_first)


def ascending(name: str, nulls_first: bool | None = None) -> SortKey:
    return SortKey(name, True, nulls_first)


def descending(name: str, nulls_first: bool | None = None) -> SortKey:
    return SortKey(name, False, nulls_first)


def sort_columns(keys: Sequence[SortKey | str]) -> list[Column]:
    return [(key if isinstance(key, SortKey) else SortKey(key)).column for key in keys]


def ordered(df: DataFrame, keys: Sequence[SortKey | str]) -> DataFrame:
    """Globally sorted rows.

    Rows with equal keys are sorted by one task. Where many may be equal, end the
    keys with a unique column, which lets the ties be spread as well.
    """
    return df.orderBy(*sort_columns(keys))


def top_k(df: DataFrame, k: int, keys: Sequence[SortKey | str]) -> DataFrame:
    """First ``k`` rows of an order. End the keys with a unique one to fix ties.

    Every task keeps its own best ``k`` rows, so only those are exchanged.
    """
    return ordered(df, keys).limit(k)


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()
