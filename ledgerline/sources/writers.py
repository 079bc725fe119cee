"""Table writers. Outputs are replaced as a whole, so a job can be run again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.readwriter import DataFrameWriter


def _in_files(df: DataFrame, files: int | None) -> DataFrame:
    """Merge into at most ``files`` partitions, keeping the order of a sorted result.

    Merged partitions keep their order and are read one after the other, unlike
    exchanged ones, whose blocks come as they arrive.
    """
    return df if files is None else df.coalesce(files)


def write_csv(
    df: DataFrame,
    path: str,
    *,
    files: int | None = None,
    compression: str | None = None,
    encoding: str = "UTF-8",
    quote_all: bool = False,
    partition_by: Sequence[str] = (),
) -> None:
    """CSV with a header row. Cell padding is kept; nulls are empty cells.

    ``files=1`` gives one file, whatever the number of rows: one task then writes
    all of them, so it is meant for grouped reports. Row tables leave it out.
    """
    out = _in_files(df, files)
    writer = (
        out.write.mode("overwrite")
        .option("header", True)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("quoteAll", quote_all)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    files: int | None = None,
    partition_by: Sequence[str] = (),
) -> None:
    out = _in_files(df, files)
    writer: DataFrameWriter = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
