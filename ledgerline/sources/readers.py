"""Table readers. Every CSV read takes an explicit schema: no inference scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    null_token: str = "",
    encoding: str = "UTF-8",
    multi_line: bool = False,
    spread: int | None = None,
) -> DataFrame:
    """CSV with a header row, plain or compressed (the codec follows the suffix).

    ``null_token`` cells become null, and so do cells that do not fit their
    declared type. ``multi_line`` accepts line breaks inside quoted cells; such
    files, like gzip files, are read by one task each, so write many of them.
    ``spread`` redistributes the rows of a few large unsplittable files.
    """
    df = (
        spark.read.option("header", True)
        .option("nullValue", null_token)
        .option("encoding", encoding)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .schema(schema)
        .csv(path)
    )
    return df.repartition(spread) if spread else df


def read_parquet(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """Parquet by its declared columns, or by the columns the files state."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)
