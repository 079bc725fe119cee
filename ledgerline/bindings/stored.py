"""Scans, sinks, named tables and copies.

A query that writes puts its files under the folder for intermediate tables and
returns what a reader finds there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ledgerline import sources
from ledgerline.bindings.registry import query
from ledgerline.bindings.tables import customer_totals, table
from ledgerline.functions import from_units
from ledgerline.operators import aggregates, ordering
from ledgerline.operators.joins import join_dimension
from ledgerline.workspace import fresh_path

ORDERS_SQL = "SELECT * FROM orders"


@query("scan_csv_roundtrip", "SELECT * FROM customer")
def scan_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    path = fresh_path(spark, "customer-csv")
    sources.write_csv(customer, path)
    return sources.read_csv(spark, path, customer.schema)


@query("scan_csv_gzip", ORDERS_SQL)
def scan_csv_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = fresh_path(spark, "orders-gzip")
    sources.write_csv(orders, path, compression="gzip")
    # A gzip file is read by one task, so its rows are dealt out again.
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return sources.read_csv(spark, path, orders.schema, spread=width)


@query("scan_csv_latin1", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def scan_csv_latin1(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    path = fresh_path(spark, "documents-latin1")
    sources.write_csv(documents, path, encoding="ISO-8859-1", quote_all=True)
    return sources.read_csv(
        spark, path, documents.schema, encoding="ISO-8859-1", multi_line=True
    )


# Empty cells become null, and so does the text in the price column of 'F' rows.
@query(
    "scan_csv_explicit_schema",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS priority,
           CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS price
    FROM orders
    """,
)
def scan_csv_explicit_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = fresh_path(spark, "orders-dirty")
    dirty = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderstatus") == "F", F.lit("not known"))
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("price"),
    )
    sources.write_csv(dirty, path)
    schema = StructType(
        [
            StructField("o_orderkey", LongType()),
            StructField("priority", StringType()),
            StructField("price", DoubleType()),
        ]
    )
    return sources.read_csv(spark, path, schema, null_token="")


# Columns that look like numbers or dates and are not, next to those that are.
@query(
    "scan_csv_inferred",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS order_day, o_orderdate AS order_moment,
        o_orderpriority, lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS padded_key, 1234567890000000 + o_orderkey AS long_key,
        CAST(o_orderkey AS VARCHAR) || '00000000000000000000' AS longer_key, o_orderstatus = 'F' AS is_final,
        CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 0.5 ELSE CAST(o_custkey AS DOUBLE) END AS one_fraction,
        CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS one_word,
        CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN '2024-02-30'
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS one_bad_day,
        CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_custkey END AS with_gaps, CAST(NULL AS VARCHAR) AS no_cells
    FROM orders
    """,
)
def scan_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    last = F.col("o_orderkey") == orders.agg(F.max("o_orderkey")).scalar()
    customer = F.col("o_custkey").cast("string")
    moment = F.col("o_orderdate")
    written = orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.date_format(moment, "M/d/yyyy").alias("order_day"),
        F.date_format(moment, "yyyy-MM-dd HH:mm:ss").alias("order_moment"),
        "o_orderpriority",
        F.lpad(customer, 9, "0").alias("padded_key"),
        (F.lit(1234567890000000) + F.col("o_orderkey")).alias("long_key"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit("0" * 20)).alias("longer_key"),
        (F.col("o_orderstatus") == "F").alias("is_final"),
        F.when(last, "0.5").otherwise(customer).alias("one_fraction"),
        F.when(last, "n/a").otherwise(customer).alias("one_word"),
        F.when(last, "2024-02-30").otherwise(F.date_format(moment, "yyyy-MM-dd")).alias("one_bad_day"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_custkey")).alias("with_gaps"),
        F.lit(None).cast("string").alias("no_cells"),
    )
    path = fresh_path(spark, "orders-inferred")
    sources.write_csv(written, path)
    return sources.read_csv_inferred(spark, path)


@query("scan_parquet", ORDERS_SQL)
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_parquet(spark, f"{sf_dir}/orders.parquet")


SEGMENT_GROUPS = [
    ("AUTOMOBILE", "trade"),
    ("BUILDING", "trade"),
    ("FURNITURE", "home"),
    ("HOUSEHOLD", "home"),
    ("MACHINERY", "industry"),
]


@query(
    "inline_table",
    """
    SELECT c_custkey, c_name, c_mktsegment, segment_group
    FROM customer JOIN (VALUES ('AUTOMOBILE', 'trade'), ('BUILDING', 'trade'),
        ('FURNITURE', 'home'), ('HOUSEHOLD', 'home'), ('MACHINERY', 'industry'))
        AS lookup(segment, segment_group) ON c_mktsegment = segment
    """,
)
def inline_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = sources.inline_table(spark, SEGMENT_GROUPS, "segment string, segment_group string")
    joined = join_dimension(table(spark, sf_dir, "customer"), lookup, "c_mktsegment", "segment")
    return joined.select("c_custkey", "c_name", "c_mktsegment", "segment_group")


@query("register_view", "SELECT c_mktsegment, count(*) AS n_customers FROM customer GROUP BY 1")
def register_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources.register_view(table(spark, sf_dir, "customer"), "ledger_customer")
    return sources.run_query(
        spark,
        "SELECT c_mktsegment, count(*) AS n_customers FROM ledger_customer GROUP BY c_mktsegment",
    )


@query("scan_all", "SELECT * FROM lineitem")
def scan_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources.register_view(table(spark, sf_dir, "lineitem"), "ledger_lineitem")
    return sources.run_query(spark, "SELECT * FROM ledger_lineitem;")


@query(
    "sql_text_query",
    """
    SELECT strftime(o_orderdate, '%Y') AS order_year, strftime(o_orderdate, '%m') AS order_month,
           count(*) AS n_orders, max(o_totalprice) AS largest
    FROM orders GROUP BY 1, 2 HAVING count(*) > 1
    """,
)
def sql_text_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.run_query(
        spark,
        """
        SELECT strftime('%Y', "Order Date") AS order_year,
               strftime('%m', "Order Date") AS order_month,
               COUNT(*) AS n_orders, MAX("Order-Value") AS largest
        FROM order_list GROUP BY order_year, order_month
        HAVING n_orders > 1 ORDER BY order_year, order_month;
        """,
        {
            "order_list": table(spark, sf_dir, "orders").select(
                F.col("o_orderdate").alias("Order Date"),
                F.col("o_totalprice").alias("Order-Value"),
            )
        },
    )


@query("sink_csv", "SELECT * FROM part")
def sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    path = fresh_path(spark, "part-csv")
    sources.write_csv(part, path)
    return sources.read_csv(spark, path, part.schema)


@query(
    "sink_csv_single",
    """
    SELECT o_orderpriority, count(*) AS transactions,
           CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS total_revenue
    FROM orders GROUP BY 1
    """,
)
def sink_csv_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = aggregates.amount_summary_by(
        table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_totalprice", mean_name=None, scale=2
    )
    path = fresh_path(spark, "priorities-csv")
    sources.write_csv(summary, path, files=1)
    return sources.read_csv(spark, path, summary.schema)


@query("sink_parquet", ORDERS_SQL)
def sink_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    path = fresh_path(spark, "orders-parquet")
    sources.write_parquet(orders, path, partition_by=["o_orderstatus"])
    return sources.read_parquet(spark, path).select(*orders.columns)


@query(
    "parquet_schema_roundtrip",
    """
    SELECT o_custkey, n_orders, total_price, n_rows, TRUE AS same_schema FROM (
        SELECT o_custkey, count(*) AS n_orders,
               CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS total_price,
               count(*) OVER () AS n_rows
        FROM orders GROUP BY o_custkey)
    """,
)
def parquet_schema_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = customer_totals(spark, sf_dir).select(
        "o_custkey", "n_orders", from_units("total_units", 2).alias("total_price")
    )
    path = fresh_path(spark, "totals-parquet")
    sources.write_parquet(totals, path)
    back = sources.read_parquet(spark, path)
    same = [f.simpleString() for f in back.schema] == [f.simpleString() for f in totals.schema]
    n_rows = back.agg(F.count("*")).scalar()
    return back.select("*", n_rows.alias("n_rows"), F.lit(same).alias("same_schema"))


COPIED = ["doc_id", "text", "lang", "source", "n_chars"]

# Line breaks and quotes come with the texts; empty, absent and unfitting cells are put in.
COPIED_SQL = """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, CASE WHEN lang = 'fr' THEN '' ELSE lang END AS lang,
    CASE WHEN lang = 'de' THEN NULL ELSE source END AS source,
    CASE WHEN lang = 'es' THEN '1,200 or so' ELSE CAST(n_chars AS VARCHAR) END AS n_chars
FROM documents"""


def _copied_documents(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    lang = F.col("lang")
    cells = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string"),
        "text",
        F.when(lang == "fr", "").otherwise(lang).alias("lang"),
        F.when(lang != "de", F.col("source")).alias("source"),
        F.when(lang == "es", "1,200 or so").otherwise(F.col("n_chars").cast("string")).alias("n_chars"),
    )
    source, target = fresh_path(spark, "copy-source"), fresh_path(spark, "copy-target")
    sources.write_csv(cells, source)
    sources.copy_csv(spark, source, target, COPIED, multi_line=True)
    return source, target


@query("copy_dataset", COPIED_SQL)
def copy_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, target = _copied_documents(spark, sf_dir)
    return sources.read_text_cells(spark, target, COPIED, multi_line=True)


@query(
    "copy_verify",
    """
    SELECT 'copy' AS target, count(*) AS source_rows, count(*) AS target_rows, CAST(0 AS BIGINT) AS rows_that_differ
    FROM documents
    UNION ALL SELECT 'altered', count(*), count(*), CAST(2 AS BIGINT) FROM documents
    """,
)
def copy_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _copied_documents(spark, sf_dir)
    before = sources.read_text_cells(spark, source, COPIED, multi_line=True)
    after = sources.read_text_cells(spark, target, COPIED, multi_line=True)
    # One cell of one row: the row is missing on one side and new on the other.
    altered = after.withColumn("source", F.when(F.col("doc_id") == "0", "elsewhere").otherwise(F.col("source")))
    checks = {"copy": after, "altered": altered}
    found = [sources.verify_copy(before, side).withColumn("target", F.lit(name)) for name, side in checks.items()]
    return found[0].unionByName(found[1])


def _place(df: DataFrame, path: str) -> None:
    """Write ``df`` as one CSV file of that name, replacing it."""
    spark = df.sparkSession
    folder = fresh_path(spark, "one-file")
    sources.write_csv(df, folder, files=1)
    written = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/part-*.csv")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = written.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place.getParent())
    files.delete(place, False)
    files.rename(files.globStatus(written)[0].getPath(), place)


# Orders by priority, one file each. The second run finds one file changed, one new and one gone, the third none.
@query(
    "copy_incremental",
    """
    WITH files AS (
        SELECT lower(o_orderpriority[1:1]) || '.csv' AS file, o_orderpriority[1:1] AS p, count(*) AS n,
            count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS n_first
        FROM orders GROUP BY 1, 2
    )
    SELECT CAST(1 AS INTEGER) AS run, file, 'new' AS status, CASE WHEN p = '1' THEN n_first ELSE n END AS n_rows FROM files WHERE p <> '5'
    UNION ALL SELECT 2, file, CASE p WHEN '1' THEN 'changed' WHEN '2' THEN 'vanished' WHEN '5' THEN 'new' ELSE 'same' END, n FROM files
    UNION ALL SELECT 3, file, CASE p WHEN '2' THEN 'vanished' ELSE 'same' END, n FROM files
    """,
)
def copy_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    source, target = fresh_path(spark, "files-source"), fresh_path(spark, "files-target")

    def deliver(priority: str, rows: DataFrame = orders) -> None:
        _place(rows.where(F.col("o_orderpriority").startswith(priority)), f"{source}/{priority}.csv")

    deliver("1", orders.where("o_orderstatus = 'F'"))
    for priority in "234":
        deliver(priority)
    runs = []
    for run in (1, 2, 3):
        if run == 2:
            deliver("1")
            deliver("5")
            gone = spark._jvm.org.apache.hadoop.fs.Path(f"{source}/2.csv")
            gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, False)
        done = sources.copy_incremental(spark, source, target, orders.columns)
        file = F.element_at(F.split("file", "/"), -1).alias("file")
        runs.append(done.select(F.lit(run).alias("run"), file, "status", "n_rows"))
    return runs[0].unionByName(runs[1]).unionByName(runs[2])


@query(
    "file_metadata",
    """
    SELECT 'lineitem' AS table_name, TRUE AS has_files, TRUE AS has_bytes, count(*) AS n_rows
    FROM lineitem
    UNION ALL SELECT 'orders', TRUE, TRUE, count(*) FROM orders
    UNION ALL SELECT 'customer', TRUE, TRUE, count(*) FROM customer
    """,
)
def file_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["lineitem", "orders", "customer"]
    found = None
    for name in names:
        files = sources.file_metadata(spark, f"{sf_dir}/{name}.parquet").agg(
            (F.count("*") > 0).alias("has_files"), (F.sum("file_size") > 0).alias("has_bytes")
        )
        one = files.select(F.lit(name).alias("table_name"), "has_files", "has_bytes")
        found = one if found is None else found.unionByName(one)
    rows = aggregates.row_counts({name: table(spark, sf_dir, name) for name in names})
    return found.join(rows, "table_name")


@query(
    "insert_select",
    "SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders",
)
def insert_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"
    )
    name = "ledger_orders_loaded"
    sources.declare_table(spark, name, chosen.schema, fresh_path(spark, "orders-loaded"))
    return sources.insert_rows(chosen, name)


@query("recreate_table", "SELECT * FROM customer")
def recreate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    name, path = "ledger_customer_loaded", fresh_path(spark, "customer-loaded")
    for rows in (customer.where("c_acctbal < 0").withColumn("c_name", F.lit("old")), customer, customer):
        sources.replace_table(rows, name, path)
    sources.drop_old_loads(spark, name, path)
    return sources.read_table(spark, name)


# A first load of what is known early, then a later delivery that overlaps it, delivered twice.
@query(
    "merge_customers",
    """
    SELECT c_custkey, c_name, c_nationkey,
        CASE WHEN c_nationkey < 15 THEN c_acctbal ELSE 0.0 END AS c_acctbal, c_mktsegment,
        CAST(2 AS BIGINT) AS n_versions
    FROM customer WHERE (c_acctbal >= 0 OR c_nationkey < 15) AND NOT (c_nationkey < 15 AND c_mktsegment = 'MACHINERY')
    """,
)
def merge_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    path = fresh_path(spark, "customer-versions")
    early = customer.where("c_acctbal >= 0").withColumn("c_acctbal", F.lit(0.0))
    sources.create_versioned(early, path, ["c_custkey"], buckets=16)
    later = customer.where("c_nationkey < 15").withColumn("closed", F.col("c_mktsegment") == "MACHINERY")
    for _ in range(2):
        sources.merge_rows(later, path, deleted="closed")
    n_versions = F.lit(len(sources.versions(spark, path))).cast("bigint").alias("n_versions")
    return sources.read_versioned(spark, path).select("*", n_versions)


@query("distinct_values", "SELECT DISTINCT p_type FROM part")
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.distinct_values(table(spark, sf_dir, "part"), "p_type")
