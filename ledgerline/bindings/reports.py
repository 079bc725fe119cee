"""The end-to-end jobs, on raw tables derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import sources
from ledgerline.bindings.registry import query
from ledgerline.bindings.tables import SALES_SQL, sales, table
from ledgerline.operators.joins import join_dimension
from ledgerline.plans import people, products, revenue
from ledgerline.workspace import fresh_path

# --- revenue -----------------------------------------------------------------
# Transactions are line items with nulls and padding put in; returned items
# occur twice, as full copies.

TRANSACTIONS_SQL = f"""
{SALES_SQL},
flat AS (
    SELECT l_orderkey AS transaction_id,
           CASE WHEN n_name = 'NATION_0' THEN NULL ELSE c_name END AS user_id,
           CASE WHEN l_discount = 0 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS age,
           p_type AS product_category, r_name AS region, n_name AS city,
           CASE WHEN l_tax = 0 THEN NULL ELSE l_extendedprice END AS price,
           CASE WHEN l_linestatus = 'O' THEN NULL ELSE o_orderstatus END AS status,
           o_orderdate AS transaction_date, c_mktsegment AS subscription, l_returnflag
    FROM sales),
raw AS (
    SELECT * EXCLUDE (l_returnflag) FROM flat
    UNION ALL SELECT * EXCLUDE (l_returnflag) FROM flat WHERE l_returnflag = 'R'),
single AS (SELECT DISTINCT * FROM raw),
cleaned AS (
    SELECT * REPLACE (round(coalesce(price, 0.0), 2) AS price, coalesce(status, 'Unknown') AS status)
    FROM single WHERE age IS NOT NULL AND user_id IS NOT NULL AND age BETWEEN 18 AND 100)"""


def _raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = lambda name: F.concat(F.lit("  "), F.col(name), F.lit(" "))
    flat = sales(spark, sf_dir).select(
        F.col("l_orderkey").alias("transaction_id"),
        F.when(F.col("n_name") != "NATION_0", F.col("c_name")).alias("user_id"),
        F.when(F.col("l_discount") != 0, F.col("l_quantity").cast("int")).alias("age"),
        padded("p_type").alias("product_category"),
        padded("r_name").alias("region"),
        F.col("n_name").alias("city"),
        F.when(F.col("l_tax") != 0, F.col("l_extendedprice")).alias("price"),
        F.when(F.col("l_linestatus") != "O", F.col("o_orderstatus")).alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("transaction_date"),
        padded("c_mktsegment").alias("subscription"),
        "l_returnflag",
    )
    twice = F.when(F.col("l_returnflag") == "R", F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    return flat.withColumn("copy", F.explode(twice)).drop("copy", "l_returnflag")


def _staged_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "transactions")
    sources.write_csv(_raw_transactions(spark, sf_dir), path)
    return revenue.load_transactions(spark, path)


def _report_sql(key: str, mean: bool = True, tail: str = "") -> str:
    average = (
        ", round(CAST(sum(c) AS DOUBLE) / count(*) / 100.0, 2) AS avg_order_value" if mean else ""
    )
    return f"""
    WITH {TRANSACTIONS_SQL}
    SELECT {key}, count(*) AS transactions, CAST(sum(c) AS DOUBLE) / 100.0 AS total_revenue{average}
    FROM (SELECT *, CAST(round(price * 100) AS BIGINT) AS c FROM cleaned)
    GROUP BY {key} ORDER BY total_revenue DESC {tail}
    """


def _reports(spark: SparkSession, sf_dir: str) -> revenue.RevenueReports:
    staged = _staged_transactions(spark, sf_dir)
    return revenue.revenue_reports(revenue.clean_transactions(staged))


@query("revenue_report_category", _report_sql("product_category"))
def revenue_report_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reports(spark, sf_dir).by_category


@query("revenue_report_region", _report_sql("region"))
def revenue_report_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = fresh_path(spark, "transactions"), fresh_path(spark, "reports")
    sources.write_csv(_raw_transactions(spark, sf_dir), source)
    reports = revenue.run_revenue_job(spark, source, target)
    return sources.read_csv(spark, f"{target}/revenue_by_region", reports.by_region.schema)


@query("revenue_report_cities", _report_sql("city", mean=False, tail=", city LIMIT 5"))
def revenue_report_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reports(spark, sf_dir).top_cities


@query(
    "revenue_report_counts",
    f"""
    WITH {TRANSACTIONS_SQL}
    SELECT (SELECT count(*) FROM raw) AS rows_loaded,
           (SELECT count(*) FROM raw) - (SELECT count(*) FROM single) AS duplicates_removed,
           (SELECT count(*) FROM single WHERE age IS NOT NULL AND user_id IS NOT NULL)
               AS rows_after_nulls,
           (SELECT count(*) FROM cleaned) AS final_rows
    """,
)
def revenue_report_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue.cleaning_counts(_staged_transactions(spark, sf_dir))


@query(
    "revenue_cleaned_rows",
    f"""
    WITH {TRANSACTIONS_SQL}
    SELECT *, CASE WHEN price >= 2000 THEN 'High Value' ELSE 'Standard' END AS value_segment
    FROM cleaned
    """,
)
def revenue_cleaned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = revenue.clean_transactions(_staged_transactions(spark, sf_dir))
    return cleaned.withColumn(
        "transaction_date", F.col("transaction_date").cast("timestamp_ntz")
    )


@query(
    "revenue_stepwise_rows",
    f"""
    WITH {TRANSACTIONS_SQL}
    SELECT * REPLACE (coalesce(price, 0.0) AS price, coalesce(status, 'Unknown') AS status)
    FROM single WHERE age IS NOT NULL AND age BETWEEN 18 AND 100
    """,
)
def revenue_stepwise_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = revenue.clean_in_steps(_staged_transactions(spark, sf_dir))
    return cleaned.withColumn(
        "transaction_date", F.col("transaction_date").cast("timestamp_ntz")
    )


# --- people ------------------------------------------------------------------
# Employees are customers; ten times the balance is the salary, missing where
# the balance is negative, and the first order's day is the join date.

STAFF_SQL = """
raw AS (
    SELECT c_custkey AS emp_id,
           CASE WHEN n_name = 'NATION_0' THEN NULL ELSE c_name END AS emp_name,
           c_mktsegment AS department,
           CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_acctbal * 10 AS FLOAT) END AS salary,
           joined AS join_date, n_name AS city
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS joined FROM orders GROUP BY 1)
        ON o_custkey = c_custkey),
paid AS (
    SELECT * REPLACE (coalesce(salary, 80000.0) AS salary) FROM raw WHERE emp_name IS NOT NULL),
staff AS (
    SELECT emp_id, emp_name, department, CAST(salary AS DOUBLE) AS salary, city,
           CASE WHEN salary >= 90000 THEN 'A' WHEN salary >= 70000 THEN 'B' ELSE 'C' END
               AS salary_grade,
           CAST(round(money * CAST(0.10 AS DECIMAL(4,2)), 2) AS DOUBLE) AS annual_bonus,
           CAST(round(money + money * CAST(0.10 AS DECIMAL(4,2)), 2) AS DOUBLE) AS total_comp,
           CAST(year(join_date) AS BIGINT) AS join_year
    FROM (SELECT *, CAST(CAST(salary AS DOUBLE) AS DECIMAL(12,2)) AS money FROM paid))"""

STAFF_COLUMNS = [
    "emp_id",
    "emp_name",
    "department",
    "salary",
    "city",
    "salary_grade",
    "annual_bonus",
    "total_comp",
    "join_year",
]


def _employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("joined"))
    )
    customer = join_dimension(
        table(spark, sf_dir, "customer"),
        table(spark, sf_dir, "nation"),
        "c_nationkey",
        "n_nationkey",
    )
    return customer.join(joined, customer["c_custkey"] == joined["o_custkey"], "left").select(
        F.col("c_custkey").alias("emp_id"),
        F.when(F.col("n_name") != "NATION_0", F.col("c_name")).alias("emp_name"),
        F.col("c_mktsegment").alias("department"),
        F.when(F.col("c_acctbal") >= 0, (F.col("c_acctbal") * 10).cast("float")).alias("salary"),
        F.date_format("joined", "yyyy-MM-dd").alias("join_date"),
        F.col("n_name").alias("city"),
        F.col("c_nationkey").alias("experience_yr"),
    )


def _staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people.with_pay_columns(people.clean_employees(_employees(spark, sf_dir)))


@query("staff_pay_columns", f"WITH {STAFF_SQL} SELECT * FROM staff")
def staff_pay_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    staff = _staff(spark, sf_dir)
    target = fresh_path(spark, "staff")
    back = people.save_staff(staff, people.department_report(staff), target)
    return back.select(*STAFF_COLUMNS).withColumn("salary", F.col("salary").cast("double"))


@query(
    "staff_department_report",
    f"""
    WITH {STAFF_SQL}
    SELECT department, count(emp_id) AS headcount,
           round(CAST(sum(CAST(round(salary * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100.0, 2)
               AS avg_salary,
           max(salary) AS max_salary, min(salary) AS min_salary,
           CAST(sum(CAST(round(total_comp * 100) AS BIGINT)) AS DOUBLE) / 100.0
               AS total_compensation
    FROM staff GROUP BY department ORDER BY avg_salary DESC
    """,
)
def staff_department_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = people.department_report(_staff(spark, sf_dir))
    return report.withColumns(
        {c: F.col(c).cast("double") for c in ("max_salary", "min_salary")}
    )


@query(
    "staff_pay_ranks",
    f"""
    WITH {STAFF_SQL}
    SELECT emp_id, emp_name, department, salary,
           rank() OVER (PARTITION BY department ORDER BY salary DESC) AS dept_salary_rank
    FROM staff ORDER BY department, dept_salary_rank
    """,
)
def staff_pay_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = people.pay_ranks(_staff(spark, sf_dir))
    return ranks.withColumn("salary", F.col("salary").cast("double"))


@query(
    "staff_well_paid",
    f"""
    WITH {STAFF_SQL}
    SELECT emp_id, emp_name, department, salary, city FROM staff
    WHERE department = 'MACHINERY' AND salary > 80000
    """,
)
def staff_well_paid(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = people.clean_employees(_employees(spark, sf_dir))
    kept = people.well_paid(cleaned, "MACHINERY", 80000.0)
    return kept.withColumn("salary", F.col("salary").cast("double"))


# --- products ----------------------------------------------------------------
# Ratings are parts with their number of line items; the largest parts have no
# rating, and the parts of one brand occur twice.

RATINGS_SQL = """
raw AS (
    SELECT p_partkey AS product_id, p_retailprice AS final_price,
           CASE WHEN p_size > 45 THEN NULL ELSE p_size / 10.0 END AS rating, ratings_count
    FROM part JOIN (SELECT l_partkey, count(*) AS ratings_count FROM lineitem GROUP BY 1)
        ON l_partkey = p_partkey)"""


def _ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = (
        table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n_lines"))
    )
    parts = join_dimension(counted, table(spark, sf_dir, "part"), "l_partkey", "p_partkey")
    twice = F.when(F.col("p_brand") == "Brand#1", F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    return parts.withColumn("copy", F.explode(twice)).select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_retailprice").alias("final_price"),
        F.when(F.col("p_size") <= 45, F.col("p_size") / 10).alias("rating"),
        F.col("n_lines").alias("ratings_count"),
        (F.col("p_retailprice") - 900).alias("difference"),
    )


def _staged_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "ratings")
    sources.write_csv(_ratings(spark, sf_dir), path)
    return sources.read_csv(spark, path, products.RATINGS)


@query(
    "ratings_cleaned",
    f"""
    WITH {RATINGS_SQL}
    SELECT product_id, final_price, CAST(coalesce(rating, 0) AS DOUBLE) AS rating, ratings_count,
           CAST(coalesce(rating, 0) AS DOUBLE) * ratings_count AS popularity_score
    FROM raw
    """,
)
def ratings_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = products.clean_ratings(_staged_ratings(spark, sf_dir))
    path = fresh_path(spark, "ratings-cleaned")
    sources.write_csv(cleaned, path)
    return sources.read_csv(spark, path, cleaned.schema)


@query(
    "ratings_above_three",
    f"""
    WITH {RATINGS_SQL}
    SELECT DISTINCT product_id, final_price FROM raw WHERE rating > 3
    """,
)
def ratings_above_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.prices(products.well_rated(_ratings(spark, sf_dir))).distinct()
