"""Where intermediate results go: always the folder the cluster names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_WAREHOUSE = "spark.sql.warehouse.dir"


def shared_folder(spark: SparkSession) -> str:
    """Folder for written intermediate tables.

    It is the session's ``spark.checkpoint.dir``. Where that is unset, a local
    master (tests) uses its warehouse folder; any other master must name one,
    because a driver-local path is not visible to the executors.
    """
    context = spark.sparkContext
    folder = spark.conf.get(_SETTING, None) or context.getConf().get(_SETTING)
    folder = folder or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder shared by the whole cluster")
        folder = spark.conf.get(_WAREHOUSE)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other call has been given."""
    return f"{shared_folder(spark)}/ledgerline/{label}-{uuid.uuid4().hex}"


def freeze(df: DataFrame, label: str = "frozen") -> DataFrame:
    """Compute ``df`` once into a Parquet table and read it from there on.

    The table is columnar, so later reads prune columns and push filters, and it
    does not depend on the executors that wrote it.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(*frames: DataFrame) -> None:
    """Delete the stored tables that ``freeze`` made for these frames.

    Only files below the shared folder's own subfolder are touched. Call it when
    no plan that reads the frames will run again.
    """
    for df in frames:
        spark = df.sparkSession
        own = f"{shared_folder(spark)}/ledgerline/"
        own = own if ":" in own.split("/", 1)[0] else f"file:{own}"
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            if _plain(folder).startswith(_plain(own)):
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _plain(uri: str) -> str:
    """A file URI in one spelling: file:///x and file:/x are the same place."""
    return uri.replace("file:///", "file:/")
