"""Column types of CSV text, inferred from every cell and without loss.

The state of a column is a set of the types that all its cells fit, one bit for each. The state of
several cells is the intersection of theirs, so states of files, days or columns of the same name merge in any
order, and one aggregate over the text finds those of a whole dataset; nothing is sampled.

A type that one cell has ruled out stays ruled out. A file's first rows are therefore looked at beforehand, and the
aggregate over all cells only tests what they have left open.

A cell fits a type only if the value keeps what the text says: a number with leading
zeros, a plus sign or more than 15 digits is no double, an integer beyond 64 bits is no bigint, a day that does not
exist is no date. Absent cells fit everything.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.sources.readers import read_csv

_BOOLEAN, _BIGINT, _DOUBLE, _TIMESTAMP, _FIRST_DATE = 1, 2, 4, 8, 16

#: Date patterns tried by default, the preferred reading of an ambiguous column first.
DATE_PATTERNS = ("yyyy-MM-dd", "M/d/yyyy", "d/M/yyyy", "yyyy/MM/dd", "dd-MM-yyyy", "dd.MM.yyyy")

_INTEGER = r"^(0|-?[1-9][0-9]{0,18})$"
_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]{1,3})?$"
_MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$"
_DIGITS = 15  # decimal digits that a double always keeps
# Numbers that need no look at their digits: so short that a double, and of integers a bigint, keeps them.
_SHORT_INTEGER = rf"^(0|-?[1-9][0-9]{{0,{_DIGITS - 1}}})$"
_SHORT_NUMBER = rf"^(?=[-.0-9]{{1,{_DIGITS}}}$)-?(0|[1-9][0-9]*)(\.[0-9]+)?$"
_IN_RANGE = {"MM": "(0[1-9]|1[0-2])", "M": "(0?[1-9]|1[0-2])", "dd": "(0[1-9]|[12][0-9]|3[01])", "d": "(0?[1-9]|[12][0-9]|3[01])"}
_FIRST_ROWS, _FIRST_LENGTH = 256, 64  # rows looked at beforehand, and the length of their cells


@dataclass(frozen=True)
class InferredColumn:
    """Name and type of a column; dates come with their pattern."""

    name: str
    type_name: str
    pattern: str | None = None

    def converted(self) -> Column:
        """The text column as a value of its type. Text that does not fit any more raises."""
        cell = F.col(f"`{self.name}`")
        if self.pattern:
            cell = F.to_date(cell, self.pattern)
        elif self.type_name != "string":
            cell = cell.cast(self.type_name)
        return cell.alias(self.name)


def _date_shape(pattern: str) -> str:
    """Regular expression of a pattern's texts: as many digits as it has letters, or one or two for a single letter.

    Months and days that stand alone are within their ranges: a text that cannot be parsed costs an exception.
    """
    shape, i = "", 0
    while i < len(pattern):
        run = len(pattern[i:]) - len(pattern[i:].lstrip(pattern[i]))
        letter = pattern[i].isalpha()
        alone = not (pattern[i - 1 : i] + pattern[i + run : i + run + 1]).isalnum()
        if letter and alone and pattern[i : i + run] in _IN_RANGE:
            shape += _IN_RANGE[pattern[i : i + run]]
        else:
            shape += (f"[0-9]{{{run}}}" if run > 1 else "[0-9]{1,2}") if letter else f"[{pattern[i]}]" * run
        i += run
    return f"^{shape}$"


def cell_types(cell: Column, date_patterns: Sequence[str] = DATE_PATTERNS, among: int | None = None) -> Column:
    """Column: the types that a text cell fits, as bits; null for an absent cell.

    Only the types in ``among`` are tested, the others count as not fitting.
    """
    digits = F.regexp_replace(F.regexp_replace(cell, r"[eE].*$", ""), r"[^0-9]", "")
    significant = F.char_length(F.ltrim(digits, F.lit("0")))
    as_double = cell.try_cast("double")
    # Digits may not vanish (too small) or overflow (too large).
    kept = (significant <= _DIGITS) & ((as_double != 0) | (significant == 0)) & (F.abs(as_double) < float("inf"))

    def bit(value: int, fits: Column) -> Column:
        return F.when(fits, value).otherwise(0)

    integer = cell.rlike(_INTEGER) & cell.try_cast("bigint").isNotNull()
    number = F.when(cell.rlike(_SHORT_NUMBER), _DOUBLE).when(cell.rlike(_NUMBER), bit(_DOUBLE, kept)).otherwise(0)
    tests = {
        _BOOLEAN: bit(_BOOLEAN, F.lower(cell).isin("true", "false")),
        _BIGINT: bit(_BIGINT, integer),
        _DOUBLE: number,
        _TIMESTAMP: F.when(cell.rlike(_MOMENT), bit(_TIMESTAMP, cell.try_cast("timestamp_ntz").isNotNull())).otherwise(0),
    }
    for i, pattern in enumerate(date_patterns):
        valid = F.try_to_timestamp(cell, F.lit(pattern)).isNotNull()
        tests[_FIRST_DATE << i] = F.when(cell.rlike(_date_shape(pattern)), bit(_FIRST_DATE << i, valid)).otherwise(0)
    among = sum(tests) if among is None else among
    if among & _BIGINT and among & _DOUBLE:
        each = tests.pop(_BIGINT).bitwiseOR(tests.pop(_DOUBLE))
        tests[_BIGINT | _DOUBLE] = F.when(cell.rlike(_SHORT_INTEGER), _BIGINT | _DOUBLE).otherwise(each)
    found = [test for value, test in tests.items() if among & value]
    return F.when(cell.isNotNull(), reduce(lambda a, b: a.bitwiseOR(b), found, F.lit(0))).cast("bigint")


def column_states(
    cells: DataFrame, date_patterns: Sequence[str] = DATE_PATTERNS, among: Mapping[str, int] | None = None
) -> DataFrame:
    """One row: the state of each text column, null where it has no cell at all.

    A single aggregate with map-side combining. Rows of several calls with the same patterns merge by
    ``merge_states``, so new files need no second look at the old ones. ``among`` names the types that are
    tested in a column; all, if it does not name the column.
    """
    among = among or {}
    return cells.agg(
        *[F.bit_and(cell_types(F.col(f"`{c}`"), date_patterns, among.get(c))).alias(c) for c in cells.columns]
    )


def _left_open(cells: DataFrame, date_patterns: Sequence[str]) -> dict[str, int]:
    """The types that some first rows leave open in each column that has a cell there.

    Which rows these are does not matter, they only rule out. Long cells count as absent. The cells
    go below each other, so that the tests are compiled once and not for each column.
    """
    names = cells.columns
    first = cells.select(
        *[F.when(F.char_length(F.col(f"`{c}`")) <= _FIRST_LENGTH, F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(names)]
    ).limit(_FIRST_ROWS)
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("place"), F.col(f"c{i}").alias("cell")) for i in range(len(names))]))
    below = first.select(each.alias("e")).select("e.place", "e.cell").where("cell IS NOT NULL")
    states = below.groupBy("place").agg(F.bit_and(cell_types(F.col("cell"), date_patterns)).alias("state"))
    return {names[row["place"]]: row["state"] for row in states.collect()}


def infer_columns(cells: DataFrame, date_patterns: Sequence[str] = DATE_PATTERNS) -> list[InferredColumn]:
    """Names and types of text columns. Every cell is tested for all types that the first rows leave open."""
    left = _left_open(cells, date_patterns) if cells.columns else {}
    states: dict[str, int | None] = {c: left.get(c) for c in cells.columns}
    tested = [c for c in cells.columns if left.get(c) != 0]
    if tested:
        states |= column_states(cells.select(*[F.col(f"`{c}`") for c in tested]), date_patterns, left).first().asDict()
    return types_of(states, date_patterns)


def merge_states(states: DataFrame) -> DataFrame:
    """One row from stored rows of states."""
    return states.agg(*[F.bit_and(F.col(f"`{c}`")).alias(c) for c in states.columns])


def types_of(states: Mapping[str, int | None], date_patterns: Sequence[str] = DATE_PATTERNS) -> list[InferredColumn]:
    """The narrowest type of each state; columns without cells and mixed ones stay text."""
    out = []
    for name, state in states.items():
        state = state or 0
        dates = [p for i, p in enumerate(date_patterns) if state & (_FIRST_DATE << i)]
        if state & _BOOLEAN:
            out.append(InferredColumn(name, "boolean"))
        elif state & _BIGINT:
            out.append(InferredColumn(name, "bigint"))
        elif state & _DOUBLE:
            out.append(InferredColumn(name, "double"))
        elif dates:
            out.append(InferredColumn(name, "date", dates[0]))
        elif state & _TIMESTAMP:
            out.append(InferredColumn(name, "timestamp_ntz"))
        else:
            out.append(InferredColumn(name, "string"))
    return out


def read_csv_as_text(
    spark: SparkSession, path: str, *, null_token: str = "", encoding: str = "UTF-8", multi_line: bool = False
) -> DataFrame:
    """CSV with all columns as text, named by the header; ``null_token`` cells are null."""
    header = spark.read.option("header", True).option("encoding", encoding).option("multiLine", multi_line)
    names = header.option("escape", '"').csv(path).columns
    schema = StructType([StructField(name, StringType()) for name in names])
    return read_csv(spark, path, schema, null_token=null_token, encoding=encoding, multi_line=multi_line)


def infer_csv(
    spark: SparkSession,
    path: str,
    *,
    null_token: str = "",
    encoding: str = "UTF-8",
    multi_line: bool = False,
    date_patterns: Sequence[str] = DATE_PATTERNS,
) -> list[InferredColumn]:
    """Names and types of the columns, from one pass over all cells that can matter."""
    cells = read_csv_as_text(spark, path, null_token=null_token, encoding=encoding, multi_line=multi_line)
    return infer_columns(cells, date_patterns)


def read_csv_inferred(
    spark: SparkSession,
    path: str,
    *,
    null_token: str = "",
    encoding: str = "UTF-8",
    multi_line: bool = False,
    date_patterns: Sequence[str] = DATE_PATTERNS,
) -> DataFrame:
    """CSV with inferred types: one pass decides them, the returned frame is a lazy scan.

    Types as in this module's description; a column takes one date pattern for all its cells, and the first
    fitting one where days and months could be exchanged throughout. A file whose cells change after the types were
    decided raises when it is read.
    """
    cells = read_csv_as_text(spark, path, null_token=null_token, encoding=encoding, multi_line=multi_line)
    return cells.select(*[c.converted() for c in infer_columns(cells, date_patterns)])
