"""Named tables and SQL text."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_QUOTED_IDENTIFIERS = "spark.sql.ansi.doubleQuotedIdentifiers"

# One session has one set of view names and settings.
_session_state = threading.RLock()

# strftime('%Y', d) and strftime('%m', d) as a SQL function, for dates kept as text
# as well as for date columns; other text gives null. Its body becomes part of the
# plan, so it stays in the JVM.
_STRFTIME = """
CREATE OR REPLACE TEMPORARY FUNCTION strftime(pattern STRING, moment STRING)
RETURNS STRING
RETURN date_format(
    try_cast(moment AS TIMESTAMP_NTZ),
    replace(replace(replace(pattern, '%Y', 'yyyy'), '%m', 'MM'), '%d', 'dd'))
"""


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` readable by name in SQL, replacing an earlier one."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def run_query(
    spark: SparkSession, text: str, tables: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """SQL text to a DataFrame; ``tables`` are its views, for this call only.

    Views of the same names come back afterwards. Calls from several threads take turns.

    Double quotes delimit identifiers, as in standard SQL, so names with spaces
    or hyphens can be written ``"Order Date"``. ``strftime`` is available.
    """
    with _session_state:
        catalog = spark.catalog
        replaced = {name: spark.table(name) for name in tables or {} if name in _views(spark)}
        spark.sql(_STRFTIME)
        before = spark.conf.get(_QUOTED_IDENTIFIERS)
        spark.conf.set(_QUOTED_IDENTIFIERS, "true")
        try:
            for name, df in (tables or {}).items():
                df.createOrReplaceTempView(name)
            return spark.sql(text.strip().rstrip(";"))  # resolved here; the views are not needed any more
        finally:
            spark.conf.set(_QUOTED_IDENTIFIERS, before)
            for name in tables or {}:
                catalog.dropTempView(name)
            for name, df in replaced.items():
                df.createOrReplaceTempView(name)


def _views(spark: SparkSession) -> set[str]:
    return {t.name for t in spark.catalog.listTables() if t.isTemporary}


def inline_table(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """Rows written in code as a table; for small lookups only.

    They travel as an Arrow table, which gives a local relation: Spark then knows
    its size and broadcasts it in a join instead of shuffling the other side.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    columns = {
        field.name: pa.array([row[i] for row in rows]) for i, field in enumerate(schema.fields)
    }
    return spark.createDataFrame(pa.table(columns), schema=schema)


def declare_table(spark: SparkSession, name: str, schema: StructType, path: str) -> None:
    """Drop the table if it exists and create it empty with the given columns.

    Dropping a table at a location leaves its files, which the next table there
    would pick up; so the location is emptied by overwriting it with no rows.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}'")


def insert_rows(df: DataFrame, name: str, *, overwrite: bool = False) -> DataFrame:
    """Append ``df`` to a declared table, or replace its rows; columns match by name."""
    columns = df.sparkSession.table(name).columns
    df.select(*columns).write.insertInto(name, overwrite=overwrite)
    return df.sparkSession.table(name)


def replace_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Load a table anew; running it again changes nothing.

    The rows are written to a new folder below ``path`` first, and the table is pointed there
    when they are complete. A load that fails leaves the table and its old rows as they are, and ``df`` may read the
    table that it replaces. With the same columns the swap is one change of the table's location; with other columns
    a complete table takes the place of the old one. Earlier folders stay until ``drop_old_loads``.
    """
    spark = df.sparkSession
    place = f"{path.rstrip('/')}/load-{uuid.uuid4().hex}"
    df.write.parquet(place)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    same = spark.catalog.tableExists(name) and [(f.name, f.dataType) for f in spark.table(name).schema] == [
        (f.name, f.dataType) for f in df.schema
    ]
    if same:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
        spark.catalog.refreshTable(name)
    else:
        loaded = f"{name}_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {loaded} ({columns}) USING parquet LOCATION '{place}'")
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"ALTER TABLE {loaded} RENAME TO {name}")
    return spark.table(name)


def drop_old_loads(spark: SparkSession, name: str, path: str) -> int:
    """Delete the folders of earlier and failed loads below ``path``; how many there were.

    Call it when no plan that reads an earlier load will run again and no load is running.
    """
    current = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    loads = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName().startswith("load-")]
    gone = [load for load in loads if load.getName() != current.rstrip("/").rsplit("/", 1)[-1]]
    for load in gone:
        files.delete(load, True)
    return len(gone)
