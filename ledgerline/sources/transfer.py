"""Copy a CSV dataset: look at the source files, copy, compare the two sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.functions.hashes import row_hash
from ledgerline.sources.writers import write_csv


# Stands for a quoted empty cell while a file is read (two private-use characters).
_EMPTY = "\ue000\ue001"

FINGERPRINT_BUCKETS = 4096  # groups of rows that are told apart before rows are


def file_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Name, size and modification time of every file below ``path``.

    Only the listing is used; no file content is read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("modified_at"),
    )


def read_text_cells(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str],
    *,
    encoding: str = "UTF-8",
    multi_line: bool = False,
    file_column: str | None = None,
) -> DataFrame:
    """CSV cells as the text they hold; an absent cell is null, a quoted empty one is not.

    ``file_column`` names one more column, the file that a row comes from.
    """
    schema = StructType([StructField(name, StringType()) for name in columns])
    cells = (
        spark.read.option("header", True)
        .option("encoding", encoding)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("emptyValue", _EMPTY)
        .schema(schema)
        .csv(path)
    )
    file = [F.col("_metadata.file_path").alias(file_column)] if file_column else []
    return cells.select(*[F.when(F.col(c) == _EMPTY, "").otherwise(F.col(c)).alias(c) for c in columns], *file)


def copy_csv(
    spark: SparkSession,
    source: str,
    target: str,
    columns: Sequence[str],
    *,
    encoding: str = "UTF-8",
    multi_line: bool = False,
) -> None:
    """Copy a CSV dataset after checking that the source holds any bytes.

    Cells are copied as text, so one that would not fit a type is kept as it is.
    ``multi_line`` accepts line breaks inside quoted cells. A cell of the copy
    that holds empty text is quoted, so it stays apart from absent ones.
    """
    found = file_metadata(spark, source).agg(
        F.count("*").alias("files"), F.sum("file_size").alias("size")
    ).first()
    if not found["files"] or not found["size"]:
        raise ValueError(f"nothing to copy in {source}")
    cells = read_text_cells(spark, source, columns, encoding=encoding, multi_line=multi_line)
    write_csv(cells, target, encoding=encoding)


def _comparable(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the left one's columns, in the types that a union of them has."""
    columns = [f"`{c}`" for c in left.columns]
    types = left.limit(0).unionByName(right.select(*columns).limit(0)).schema
    return tuple(side.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in types]) for side in (left, right))


def fingerprints(df: DataFrame, *, buckets: int = FINGERPRINT_BUCKETS) -> DataFrame:
    """Order-free fingerprints of the rows: ``bucket, n, a_high, a_low, b_high, b_low``.

    Rows are dealt by a hash of all their cells; a bucket has the number of its rows and the sums of two independent
    64-bit hashes, kept in halves so that no sum leaves 64 bits below two billion rows a bucket. Equal
    multisets of rows have equal fingerprints, whatever their order, files and partitions, and fingerprints of
    parts add up. No more than ``buckets`` rows leave a task.
    """
    hashed = df.select(row_hash(df.schema, 1).alias("_a"), row_hash(df.schema, 2).alias("_b"))
    dealt = hashed.withColumn("bucket", F.pmod(F.xxhash64("_a"), F.lit(buckets)).cast("int"))
    return dealt.groupBy("bucket").agg(
        F.count("*").alias("n"),
        *[
            F.sum(part).alias(f"{name}_{half}")
            for name in ("a", "b")
            for half, part in (
                ("high", F.shiftrightunsigned(f"_{name}", 32)),
                ("low", F.col(f"_{name}").bitwiseAND(0xFFFFFFFF)),
            )
        ],
    )


def _compared(left: DataFrame, right: DataFrame, buckets: int) -> tuple[int, int, list[int]]:
    """Rows on each side and the buckets whose fingerprints differ; one small row for each bucket comes here."""
    sides = fingerprints(left, buckets=buckets).withColumn("_side", F.lit(0)).unionByName(
        fingerprints(right, buckets=buckets).withColumn("_side", F.lit(1))
    )
    found: tuple[dict, dict] = ({}, {})
    for row in sides.collect():
        found[row["_side"]][row["bucket"]] = tuple(row)[1:-1]
    here, there = found
    return (
        sum(row[0] for row in here.values()),
        sum(row[0] for row in there.values()),
        sorted(b for b in here.keys() | there.keys() if here.get(b) != there.get(b)),
    )


def _surplus(left: DataFrame, right: DataFrame, buckets: int, differing: list[int]) -> DataFrame:
    """Rows of these buckets whose number of copies differs, with the surplus on the left side."""
    within = F.pmod(F.xxhash64(row_hash(left.schema, 1)), F.lit(buckets)).cast("int").isin(differing)
    signed = left.where(within).withColumn("surplus", F.lit(1)).unionByName(
        right.where(within).withColumn("surplus", F.lit(-1))
    )
    return (
        signed.groupBy(*[f"`{c}`" for c in left.columns])
        .agg(F.sum("surplus").alias("surplus"))
        .where(F.col("surplus") != 0)
    )


def row_differences(left: DataFrame, right: DataFrame, *, buckets: int = FINGERPRINT_BUCKETS) -> DataFrame:
    """Rows whose number of copies differs, with the surplus on the left side.

    Fingerprints of both sides are compared at once; only rows of buckets that differ are grouped, with
    map-side combining, so a row that occurs very often reaches the shuffle once per task.
    """
    left, right = _comparable(left, right)
    _, _, differing = _compared(left, right, buckets)
    return _surplus(left, right, buckets, differing)


def verify_copy(source: DataFrame, target: DataFrame, *, buckets: int = FINGERPRINT_BUCKETS) -> DataFrame:
    """One row: rows on each side and distinct rows that differ (0 if equal).

    Equal sides exchange nothing but fingerprints, a bounded number of rows for each task; where
    buckets differ, the rows of these alone are grouped. Different rows go unseen only if the sums of two
    independent hashes agree by chance. Both sides are read when this is called.
    """
    source, target = _comparable(source, target)
    here, there, differing = _compared(source, target, buckets)
    counts = [F.lit(here).cast("bigint").alias("source_rows"), F.lit(there).cast("bigint").alias("target_rows")]
    if not differing:
        return source.sparkSession.range(1).select(*counts, F.lit(0).cast("bigint").alias("rows_that_differ"))
    surplus = _surplus(source, target, buckets, differing)
    return surplus.agg(F.count("*").alias("rows_that_differ")).select(*counts, "rows_that_differ")
