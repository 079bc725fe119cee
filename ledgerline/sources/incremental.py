"""Copies that can be run again: only new and changed files are copied.

What was copied is kept as state, a keyed table of versions with one row for each file: its size, its time, the
fingerprint of its rows and their number. A run lists the source, reads the files whose size or time is not the
recorded one, writes those whose rows are others, and merges the state at the end. A run that fails
before that is simply repeated: it writes the same files again.

The copy has a folder for the rows of each source file, which the state names. A changed file gets a new one, so readers see
the files of the last complete run and never those of one that is under way.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.hashes import row_hash
from ledgerline.sources.transfer import read_text_cells
from ledgerline.sources.versioned import create_versioned, merge_rows, read_versioned, versions
from ledgerline.sources.writers import write_csv
from ledgerline.workspace import freeze

STATE = "file string, size bigint, modified_at timestamp, digest string, n_rows bigint, folder string"
_FILE = "source_file"
_STATE_BUCKETS = 16


def _listing(spark: SparkSession, source: str) -> DataFrame:
    """Every file below ``source`` with its size and time, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    meta = [F.col("_metadata.file_path"), F.col("_metadata.file_size"), F.col("_metadata.file_modification_time")]
    return files.select(*[m.alias(n) for m, n in zip(meta, ("file", "size", "modified_at"), strict=True)])


def _file_digests(cells: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Order-free fingerprint and number of rows of each file (see ``transfer.fingerprints``)."""
    schema = cells.select(*[f"`{c}`" for c in columns]).schema
    hashed = cells.select(_FILE, row_hash(schema, 1).alias("_a"), row_hash(schema, 2).alias("_b"))
    halves: list[Column] = []
    for name in ("_a", "_b"):
        halves += [F.sum(F.shiftrightunsigned(name, 32)), F.sum(F.col(name).bitwiseAND(0xFFFFFFFF))]
    return hashed.groupBy(F.col(_FILE).alias("file")).agg(
        F.concat_ws(":", *[h.cast("string") for h in halves]).alias("digest"), F.count("*").alias("n_rows")
    )


def copy_incremental(
    spark: SparkSession,
    source: str,
    target: str,
    columns: Sequence[str],
    *,
    encoding: str = "UTF-8",
    multi_line: bool = False,
) -> DataFrame:
    """Copy what is new or changed in a CSV dataset; one row for each file: ``file, status, n_rows``.

    ``new`` and ``changed`` files were copied, ``touched`` ones were read and hold the rows that are recorded, ``same`` ones have
    the recorded size and time and were not read. ``vanished`` files are recorded and not in the
    source; their rows stay in the copy. Rows are compared as a multiset of text cells. The names of new
    and changed files come to the driver, as in any listing; rows do not.
    """
    state = f"{target}/state"
    if not versions(spark, state):
        create_versioned(spark.createDataFrame([], STATE), state, ["file"], buckets=_STATE_BUCKETS)
    known = read_versioned(spark, state).withColumn("_known", F.lit(True)).alias("k")
    listed = _listing(spark, source).withColumn("_listed", F.lit(True)).alias("l")
    same = (F.col("l.size") == F.col("k.size")) & (F.col("l.modified_at") == F.col("k.modified_at"))
    found = freeze(
        listed.join(known, "file", "full_outer").select(
            "file", "l.size", "l.modified_at", F.col("k.digest").alias("_digest"), F.col("k.n_rows").alias("_n_rows"),
            F.col("k.folder").alias("_folder"),
            F.when(F.col("_listed").isNull(), "vanished").when(F.col("_known").isNull(), "new")
            .when(same, "same").otherwise("changed").alias("status"),
        ),
        "listing",
    )
    to_read = [row.file for row in found.where("status IN ('new', 'changed')").select("file").collect()]
    if to_read:
        cells = read_text_cells(spark, _plain(to_read), columns, encoding=encoding, multi_line=multi_line, file_column=_FILE)
        digests = _file_digests(cells, columns)
    else:
        digests = spark.createDataFrame([], "file string, digest string, n_rows bigint")
    # A file of no rows has no digest row.
    read = F.col("status").isin("new", "changed")
    digest = F.when(read, F.coalesce("digest", F.lit(""))).otherwise(F.col("_digest"))
    status = F.when((F.col("status") == "changed") & (digest == F.col("_digest")), "touched").otherwise(F.col("status"))
    n_rows = F.when(read, F.coalesce("n_rows", F.lit(0))).otherwise(F.col("_n_rows")).cast("bigint")
    done = freeze(
        found.join(digests, "file", "left").select(
            "file", status.alias("status"), n_rows.alias("n_rows"), "size", "modified_at", digest.alias("digest"), "_folder"
        ),
        "copied-files",
    )
    run = uuid.uuid4().hex
    written = [row.file for row in done.where("status IN ('new', 'changed')").select("file").collect()]
    if written:
        cells = read_text_cells(spark, _plain(written), columns, encoding=encoding, multi_line=multi_line, file_column=_FILE)
        named = cells.withColumn(_FILE, F.sha1(_FILE))
        write_csv(named, f"{target}/data/{run}", encoding=encoding, partition_by=[_FILE])
    folder = F.when(F.col("status") == "touched", F.col("_folder")).when(
        F.col("n_rows") > 0, F.concat(F.lit(f"{run}/{_FILE}="), F.sha1("file"))
    )
    news = done.where("status IN ('new', 'changed', 'touched')")
    merge_rows(news.select("file", "size", "modified_at", "digest", "n_rows", folder.alias("folder")), state)
    return done.select("file", "status", "n_rows")


def _plain(files: Sequence[str]) -> list[str]:
    """Paths that a reader takes, from the URIs that file metadata states."""
    return [re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(f)) for f in files]


def read_copied(
    spark: SparkSession, target: str, columns: Sequence[str], *, encoding: str = "UTF-8", multi_line: bool = False
) -> DataFrame:
    """Rows of the copy as text cells, as the last complete run left it; those of vanished files are among them."""
    named = read_versioned(spark, f"{target}/state").where("folder IS NOT NULL").select("folder").collect()
    paths = [f"{target}/data/{row.folder}" for row in named]
    if not paths:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))
    return read_text_cells(spark, paths, columns, encoding=encoding, multi_line=multi_line)
