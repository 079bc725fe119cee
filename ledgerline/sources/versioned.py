"""Keyed tables that change by whole versions: copy-on-write merge and atomic commit.

Rows are dealt into a fixed number of buckets by a hash of the key. A version is a small manifest: for each
bucket the folder that holds its rows. A merge rewrites only buckets in which a row really
changes, into new folders, and names the others by the folders they are in; so untouched files stay as they are. The
commit is the appearance of the next manifest, by a rename that fails if another writer was first. A
failed job leaves folders that no manifest names, and readers never see them.

Buckets are the unit of rewriting, so their number should make them a few hundred megabytes. Keys are spread
over them evenly whatever their values are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_BUCKET = "_bucket"


@dataclass(frozen=True)
class Version:
    """What a manifest says."""

    number: int
    schema: StructType
    keys: tuple[str, ...]
    buckets: int
    folders: dict[int, str]  # bucket to folder below the table's path; empty buckets are absent


class VersionConflict(RuntimeError):
    """Another writer committed first; the merge can be run again on its version."""


def _name(column: str) -> Column:
    return F.col(f"`{column}`")


def _bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[_name(k) for k in keys]), F.lit(buckets)).cast("int")


def _files(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, folder = _files(spark, f"{path}/commits")
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())


def _commit(spark: SparkSession, path: str, version: Version) -> Version:
    """Make ``version`` the newest one, or raise if its number is taken."""
    text = json.dumps(
        {
            "schema": version.schema.jsonValue(),
            "keys": version.keys,
            "buckets": version.buckets,
            "folders": {str(b): folder for b, folder in sorted(version.folders.items())},
        }
    )
    target = f"{path}/commits/{version.number:08d}.json"
    fs, draft = _files(spark, f"{path}/commits/draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    no_overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(target)), no_overwrite)
    except Exception as error:
        fs.delete(draft, False)
        if version.number in _numbers(spark, path):
            raise VersionConflict(f"version {version.number} of {path} exists") from error
        raise
    return version


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed versions, oldest first."""
    return _numbers(spark, path)


def version_of(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """The newest version, or the one of that number."""
    known = _numbers(spark, path)
    if not known or (number is not None and number not in known):
        raise ValueError(f"no version {'' if number is None else number} in {path}".replace("  ", " "))
    number = known[-1] if number is None else number
    fs, file = _files(spark, f"{path}/commits/{number:08d}.json")
    stream = fs.open(file)
    try:
        held = json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
    finally:
        stream.close()
    return Version(
        number,
        StructType.fromJson(held["schema"]),
        tuple(held["keys"]),
        held["buckets"],
        {int(b): folder for b, folder in held["folders"].items()},
    )


def _scan(spark: SparkSession, path: str, version: Version, buckets: Iterable[int] | None = None) -> DataFrame:
    wanted = version.folders if buckets is None else [b for b in buckets if b in version.folders]
    paths = [f"{path}/{version.folders[b]}" for b in wanted]
    if not paths:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).parquet(*paths)


def read_versioned(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """Rows of the newest version, or of an older one that is still kept."""
    return _scan(spark, path, version_of(spark, path, number))


def _write(rows: DataFrame, path: str, buckets: int) -> dict[int, str]:
    """Write rows with their bucket to new folders, one task for each bucket: {bucket: folder}."""
    spark = rows.sparkSession
    folder = f"data/{uuid.uuid4().hex}"
    rows.repartition(buckets, _BUCKET).write.partitionBy(_BUCKET).parquet(f"{path}/{folder}")
    fs, written = _files(spark, f"{path}/{folder}")
    names = [status.getPath().getName() for status in fs.listStatus(written)]
    return {int(n.split("=")[1]): f"{folder}/{n}" for n in names if n.startswith(f"{_BUCKET}=")}


def one_row_per_key(df: DataFrame, keys: Sequence[str], latest: str | None = None) -> DataFrame:
    """The row of the greatest ``latest``, if given, and then of the greatest other columns.

    Copies are combined in the map tasks, so a key that repeats very often is no large group. Nulls are smallest.
    """
    rest = [c for c in df.columns if c not in keys and c != latest]
    order = [c for c in [latest, *rest] if c]
    if not order:
        return df.dropDuplicates()
    chosen = df.groupBy(*[_name(k) for k in keys]).agg(F.max(F.struct(*[_name(c) for c in order])).alias("_row"))
    return chosen.select(*[_name(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def _checked(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is complete; a null in a key raises when the rows are read."""
    missing = F.coalesce(*[F.when(_name(k).isNull(), F.lit(k)) for k in keys])
    message = F.concat(F.lit("null in key column "), missing)
    first = F.when(missing.isNull(), _name(keys[0])).otherwise(F.raise_error(message).cast(df.schema[keys[0]].dataType))
    return df.withColumn(keys[0], first)


def create_versioned(
    df: DataFrame, path: str, keys: Sequence[str], *, buckets: int = 64, latest: str | None = None
) -> Version:
    """First version of a table, one row for each key (see ``one_row_per_key``). The path must hold no version."""
    spark = df.sparkSession
    if _numbers(spark, path):
        raise VersionConflict(f"{path} holds versions already")
    rows = one_row_per_key(_checked(df, keys), keys, latest).withColumn(_BUCKET, _bucket_of(keys, buckets))
    return _commit(spark, path, Version(1, df.schema, tuple(keys), buckets, _write(rows, path, buckets)))


def merge_rows(changes: DataFrame, path: str, *, deleted: str | None = None, latest: str | None = None) -> Version:
    """Update the rows whose keys are there, insert the others, drop those that a flag marks.

    ``changes`` has the table's columns, in any order, and, if named, the boolean column ``deleted``; of several changes of a
    key one counts (see ``one_row_per_key``). Only buckets in which a row becomes another one, appears or
    goes are rewritten; if there are none, as when a load runs again, no version is made and the
    newest one is returned. Runs that lose a race raise ``VersionConflict`` and leave the table as it is.
    """
    spark = changes.sparkSession
    now = version_of(spark, path)
    keys, columns = list(now.keys), now.schema.names
    flag = F.coalesce(_name(deleted), F.lit(False)) if deleted else F.lit(False)
    known = changes.select(
        *[_name(f.name).cast(f.dataType).alias(f.name) for f in now.schema], flag.alias("_deleted"),
        *([_name(latest).alias("_latest")] if latest and latest not in columns else []),
    )
    order = "_latest" if latest and latest not in columns else latest
    staged = one_row_per_key(_checked(known, keys), keys, order).drop("_latest")
    staged = staged.withColumn(_BUCKET, _bucket_of(keys, now.buckets))

    # At most as many numbers as there are buckets come to the driver, here and below.
    touched = sorted(row[0] for row in staged.select(_BUCKET).distinct().collect())
    old = _scan(spark, path, now, touched).withColumn(_BUCKET, _bucket_of(keys, now.buckets))
    before = F.struct(*[F.col(f"old.`{c}`") for c in columns])
    after = F.struct(*[F.col(f"new.`{c}`") for c in columns])
    matched = F.col(f"old.{_BUCKET}") == F.col(f"new.{_BUCKET}")
    for key in keys:
        matched &= F.col(f"old.`{key}`") == F.col(f"new.`{key}`")
    pairs = old.alias("old").join(staged.alias("new"), matched, "full_outer").select(
        F.coalesce(F.col(f"old.{_BUCKET}"), F.col(f"new.{_BUCKET}")).alias(_BUCKET),
        F.when(F.col(f"old.{_BUCKET}").isNotNull(), before).alias("before"),
        F.when(F.col("new._deleted"), None).when(F.col(f"new.{_BUCKET}").isNotNull(), after)
        .when(F.col(f"old.{_BUCKET}").isNotNull(), before).alias("after"),
    )
    changed = sorted(
        row[0] for row in pairs.where(~F.col("before").eqNullSafe(F.col("after"))).select(_BUCKET).distinct().collect()
    )
    if not changed:
        return now
    rows = pairs.where(F.col(_BUCKET).isin(changed) & F.col("after").isNotNull()).select(
        *[F.col("after")[c].alias(c) for c in columns], _BUCKET
    )
    written = _write(rows, path, len(changed))
    kept = {b: folder for b, folder in now.folders.items() if b not in changed}
    return _commit(spark, path, Version(now.number + 1, now.schema, now.keys, now.buckets, kept | written))


def forget_versions(spark: SparkSession, path: str, *, keep: int = 2) -> list[int]:
    """Delete all but the newest versions and the folders that only they name; their numbers.

    Folders of merges that are still running are not named yet, so call it when none is.
    """
    known = _numbers(spark, path)
    gone, kept = known[:-keep], known[-keep:]
    named = {folder for n in kept for folder in version_of(spark, path, n).folders.values()}
    for number in gone:
        for folder in version_of(spark, path, number).folders.values():
            if folder not in named:
                fs, place = _files(spark, f"{path}/{folder}")
                fs.delete(place, True)
    for number in gone:
        fs, place = _files(spark, f"{path}/commits/{number:08d}.json")
        fs.delete(place, False)
    return gone
