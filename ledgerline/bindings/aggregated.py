"""Global and grouped statistics, HAVING filters and top lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.bindings.registry import query
from ledgerline.bindings.tables import (
    PROFIT_SCALE,
    PROFIT_SQL,
    SALES_SQL,
    buyers,
    cents_sql,
    dollars_sql,
    profit_by_customer,
    profit_by_part,
    table,
)
from ledgerline.functions import from_units, units
from ledgerline.operators import aggregates, distinct_state, quality
from ledgerline.operators.joins import aggregate_then_join, join_dimension
from ledgerline.operators.ordering import ascending, descending, ordered, top_k
from ledgerline.operators.transforms import add_raised
from ledgerline.sources import read_parquet, write_parquet
from ledgerline.workspace import fresh_path

ORDER_CENTS = cents_sql("o_totalprice")


@query(
    "agg_global_avg",
    f"SELECT CAST(sum({ORDER_CENTS}) AS DOUBLE) / count(*) / 100.0 AS avg_sales FROM orders",
)
def agg_global_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.mean_of(table(spark, sf_dir, "orders"), "o_totalprice", "avg_sales", 2)


@query("agg_global_max", "SELECT max(l_discount) AS highest_discount FROM lineitem")
def agg_global_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.maximum_of(table(spark, sf_dir, "lineitem"), "l_discount", "highest_discount")


@query(
    "agg_counts",
    """
    SELECT 'customer' AS table_name, count(*) AS n_rows FROM customer
    UNION ALL SELECT 'part', count(*) FROM part
    UNION ALL SELECT 'orders', count(*) FROM orders
    """,
)
def agg_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.row_counts(
        {name: table(spark, sf_dir, name) for name in ("customer", "part", "orders")}
    )


@query("agg_count_distinct", "SELECT count(DISTINCT o_custkey) AS unique_customers FROM orders")
def agg_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.distinct_count(table(spark, sf_dir, "orders"), "o_custkey", "unique_customers")


@query(
    "distinct_per_group",
    "SELECT l_suppkey, count(DISTINCT l_orderkey) AS n_orders FROM lineitem GROUP BY l_suppkey",
)
def distinct_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.distinct_count_by(
        table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_orderkey", "n_orders"
    )


@query(
    "agg_overall_stats",
    f"""
    SELECT count(*) AS total_rows, count(l_extendedprice) AS non_null_amounts,
           round(CAST(sum(c) AS DOUBLE) / count(c) / 100.0, 2) AS avg_amount,
           round(min(l_extendedprice), 2) AS min_amount, round(max(l_extendedprice), 2) AS max_amount,
           CAST(sum(c) AS DOUBLE) / 100.0 AS total_amount,
           round(stddev_samp(l_extendedprice), 2) AS stddev_amount,
           round(CAST(sum(q) AS DOUBLE) / count(q) / 100.0, 1) AS avg_other,
           min(l_quantity) AS min_other, max(l_quantity) AS max_other
    FROM (SELECT *, {cents_sql("l_extendedprice")} AS c, {cents_sql("l_quantity")} AS q FROM lineitem)
    """,
)
def agg_overall_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, quantity = "l_extendedprice", "l_quantity"
    measures = {
        "total_rows": ("rows", None),
        "total_amount": ("total", price, 2),
        "avg_amount": ("mean", price, 2),
        "stddev_amount": ("stddev", price, 2),
        "min_amount": ("min", price, 2),
        "max_amount": ("max", price, 2),
        "non_null_amounts": ("count", price),
        "min_other": ("min", quantity),
        "max_other": ("max", quantity),
        "avg_other": ("mean", quantity, 1),
    }
    return aggregates.statistics(table(spark, sf_dir, "lineitem"), measures, scales={price: 2, quantity: 2})


# The deviation from whole cents: the same on every run, however the rows are dealt.
@query(
    "agg_exact_deviation",
    f"""
    SELECT l_returnflag, l_linestatus, count(c) AS n_prices, CAST(sum(c) AS DOUBLE) / count(c) / 100.0 AS mean_price,
        sqrt(CAST(count(c) * sum(CAST(c AS HUGEINT) * c) - sum(CAST(c AS HUGEINT)) * sum(CAST(c AS HUGEINT)) AS DOUBLE)
            / count(c) / (count(c) - 1)) / 100.0 AS price_deviation,
        sqrt(CAST(count(q) * sum(CAST(q AS HUGEINT) * q) - sum(CAST(q AS HUGEINT)) * sum(CAST(q AS HUGEINT)) AS DOUBLE)
            / count(q) / (count(q) - 1)) AS quantity_deviation
    FROM (SELECT *, {cents_sql("l_extendedprice")} AS c, CAST(l_quantity AS BIGINT) AS q FROM lineitem)
    GROUP BY 1, 2
    """,
)
def agg_exact_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, quantity = "l_extendedprice", "l_quantity"
    measures = {
        "n_prices": ("count", price),
        "mean_price": ("mean", price),
        "price_deviation": ("exact_stddev", price),
        "quantity_deviation": ("exact_stddev", quantity),
    }
    lineitem = table(spark, sf_dir, "lineitem")
    return aggregates.statistics(lineitem, measures, ["l_returnflag", "l_linestatus"], scales={price: 2, quantity: 0})


RANGES = [("spring 1995", "1995-03", "1995-05"), ("1995", "1995-01", "1995-12"), ("two years", "1996-07", "1998-06")]


# Buyers of any range of months, from monthly bitmaps stored once.
@query(
    "distinct_by_month_range",
    """
    SELECT range_name, o_orderpriority, count(DISTINCT o_custkey) AS n_customers
    FROM orders JOIN (VALUES ('spring 1995', '1995-03', '1995-05'), ('1995', '1995-01', '1995-12'),
        ('two years', '1996-07', '1998-06')) AS r(range_name, first_month, last_month)
        ON strftime(o_orderdate, '%Y-%m') BETWEEN first_month AND last_month
    GROUP BY 1, 2
    """,
)
def distinct_by_month_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    numbers = distinct_state.value_numbers(orders, "o_custkey")
    path = fresh_path(spark, "buyers-by-month")
    states = distinct_state.distinct_states(orders, ["month", "o_orderpriority"], "o_custkey", numbers)
    write_parquet(states, path, partition_by=["month"])
    stored = read_parquet(spark, path, states.schema)
    found = [
        distinct_state.distinct_counts(stored.where(F.col("month").between(low, high)), ["o_orderpriority"], "n_customers")
        .withColumn("range_name", F.lit(name))
        for name, low, high in RANGES
    ]
    return reduce(DataFrame.unionByName, found)


def _orders_by_place(spark: SparkSession, sf_dir: str, group_by: Sequence[str]) -> DataFrame:
    """Order value and count per buyer attribute, reduced to one row per buyer first."""
    measures = {"total_units": ("total", units("o_totalprice", 2)), "n": ("count", None)}
    return aggregate_then_join(
        table(spark, sf_dir, "orders"),
        buyers(spark, sf_dir),
        "o_custkey",
        "c_custkey",
        group_by,
        measures,
    )


@query(
    "sum_by_region",
    f"""
    SELECT r_name, {dollars_sql(f"sum({cents_sql('l_extendedprice')})")} AS total_sales
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY r_name
    """,
)
def sum_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_customer = aggregate_then_join(
        table(spark, sf_dir, "lineitem"),
        table(spark, sf_dir, "orders"),
        "l_orderkey",
        "o_orderkey",
        ["o_custkey"],
        {"sales_units": ("total", units("l_extendedprice", 2))},
    )
    per_region = aggregate_then_join(
        per_customer,
        buyers(spark, sf_dir),
        "o_custkey",
        "c_custkey",
        ["r_name"],
        {"sales_units": ("sum", "sales_units")},
    )
    return per_region.select("r_name", from_units("sales_units", 2).alias("total_sales"))


QUANTITY_SQL = "CAST(sum(l_quantity) AS BIGINT)"


def _quantity_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate_then_join(
        table(spark, sf_dir, "lineitem"),
        table(spark, sf_dir, "part"),
        "l_partkey",
        "p_partkey",
        ["p_brand"],
        {"total_quantity": ("total", units("l_quantity", 0))},
    ).withColumn("total_quantity", F.col("total_quantity").cast("bigint"))


@query(
    "sum_by_fine_amounts",
    f"""
    SELECT l_returnflag, l_linestatus,
        CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT))) AS DOUBLE)
            / 10000.0 AS net_exact,
        round(sum(l_extendedprice * (1 - l_discount)), 2) AS net_rounded
    FROM lineitem GROUP BY ALL
    """,
)
def sum_by_fine_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same total with four stated digits, and with none stated and a rounded result."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    lines = table(spark, sf_dir, "lineitem").withColumns({"net": F.round(net, 6), "free": net})
    keys = ["l_returnflag", "l_linestatus"]
    measures = {"net_exact": ("total", "net"), "net_rounded": ("total", "free", 2)}
    return aggregates.statistics(lines, measures, keys, scales={"net": 4})


@query(
    "qty_by_subcategory",
    f"""
    SELECT p_brand, {QUANTITY_SQL} AS total_quantity
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand
    """,
)
def qty_by_subcategory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quantity_by_brand(spark, sf_dir)


@query(
    "top1_subcategory",
    f"""
    SELECT p_brand, {QUANTITY_SQL} AS total_quantity
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand
    ORDER BY total_quantity DESC, p_brand LIMIT 1
    """,
)
def top1_subcategory(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = [descending("total_quantity"), ascending("p_brand")]
    return top_k(_quantity_by_brand(spark, sf_dir), 1, keys)


LINE_PROFIT_SQL = f"""
profits AS (SELECT p_partkey, p_type, {PROFIT_SQL} AS profit
            FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def _wide_sum(name: str) -> Column:
    # Totals per part fit a bigint; a total over very many parts may not.
    return F.sum(F.col(name).cast("decimal(38,0)"))


@query(
    "avg_profit_by_category",
    f"""
    WITH {LINE_PROFIT_SQL}
    SELECT p_type, CAST(sum(profit) AS DOUBLE) / count(*) / 10000.0 AS avg_profit
    FROM profits GROUP BY p_type
    """,
)
def avg_profit_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_part = profit_by_part(spark, sf_dir, "p_type")
    mean = _wide_sum("profit_units").cast("double") / F.sum("n_lines")
    return per_part.groupBy("p_type").agg(from_units(mean, PROFIT_SCALE).alias("avg_profit"))


@query(
    "profit_by_category",
    f"""
    WITH {LINE_PROFIT_SQL}
    SELECT p_type, {dollars_sql("sum(profit)", PROFIT_SCALE)} AS total_profit
    FROM profits GROUP BY p_type ORDER BY total_profit DESC
    """,
)
def profit_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_part = profit_by_part(spark, sf_dir, "p_type")
    totals = per_part.groupBy("p_type").agg(
        from_units(_wide_sum("profit_units"), PROFIT_SCALE).alias("total_profit")
    )
    return ordered(totals, [descending("total_profit")])


@query(
    "having_alias",
    f"""
    WITH {LINE_PROFIT_SQL}
    SELECT p_partkey, {dollars_sql("sum(profit)", PROFIT_SCALE)} AS total_profit
    FROM profits GROUP BY p_partkey HAVING total_profit < 0 ORDER BY total_profit
    """,
)
def having_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = profit_by_part(spark, sf_dir).select(
        "p_partkey", from_units("profit_units", PROFIT_SCALE).alias("total_profit")
    )
    losses = aggregates.groups_where(totals, "total_profit < 0")
    return ordered(losses, [ascending("total_profit"), "p_partkey"])


@query(
    "profit_by_state",
    f"""
    WITH {SALES_SQL}
    SELECT n_name, {dollars_sql(f"sum({PROFIT_SQL})", PROFIT_SCALE)} AS total_profit
    FROM sales GROUP BY n_name ORDER BY total_profit DESC
    """,
)
def profit_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_customer = profit_by_customer(spark, sf_dir)
    states = join_dimension(per_customer, buyers(spark, sf_dir), "o_custkey", "c_custkey")
    totals = states.groupBy("n_name").agg(
        from_units(_wide_sum("profit_units"), PROFIT_SCALE).alias("total_profit")
    )
    return ordered(totals, [descending("total_profit")])


@query(
    "top10_customers",
    f"""
    WITH {SALES_SQL}
    SELECT c_custkey, c_name, {dollars_sql(f"sum({PROFIT_SQL})", PROFIT_SCALE)} AS total_profit
    FROM sales GROUP BY c_custkey, c_name ORDER BY total_profit DESC, c_custkey LIMIT 10
    """,
)
def top10_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = join_dimension(
        profit_by_customer(spark, sf_dir), table(spark, sf_dir, "customer"), "o_custkey", "c_custkey"
    ).select("c_custkey", "c_name", from_units("profit_units", PROFIT_SCALE).alias("total_profit"))
    return top_k(named, 10, [descending("total_profit"), ascending("c_custkey")])


@query(
    "top10_products",
    f"""
    SELECT p_name, {dollars_sql(f"sum({cents_sql('l_extendedprice')})")} AS total_sales
    FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY p_name ORDER BY total_sales DESC, p_name LIMIT 10
    """,
)
def top10_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = aggregate_then_join(
        table(spark, sf_dir, "lineitem"),
        table(spark, sf_dir, "part"),
        "l_partkey",
        "p_partkey",
        ["p_name"],
        {"sales_units": ("total", units("l_extendedprice", 2))},
    ).select("p_name", from_units("sales_units", 2).alias("total_sales"))
    return top_k(totals, 10, [descending("total_sales"), ascending("p_name")])


@query(
    "top5_cities",
    f"""
    SELECT n_name, count(*) AS transactions, {dollars_sql(f"sum({ORDER_CENTS})")} AS total_revenue
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name ORDER BY total_revenue DESC, n_name LIMIT 5
    """,
)
def top5_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = _orders_by_place(spark, sf_dir, ["n_name"]).select(
        "n_name",
        F.col("n").alias("transactions"),
        from_units("total_units", 2).alias("total_revenue"),
    )
    return top_k(totals, 5, [descending("total_revenue"), ascending("n_name")])


MEAN_SQL = "round(CAST(sum({0}) AS DOUBLE) / count(*) / 100.0, 2)"


@query(
    "revenue_by_category",
    f"""
    SELECT p_type, count(*) AS transactions,
           {dollars_sql(f"sum({cents_sql('l_extendedprice')})")} AS total_revenue,
           {MEAN_SQL.format(cents_sql("l_extendedprice"))} AS avg_order_value,
           min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type ORDER BY total_revenue DESC
    """,
)
def revenue_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = aggregate_then_join(
        table(spark, sf_dir, "lineitem"),
        table(spark, sf_dir, "part"),
        "l_partkey",
        "p_partkey",
        ["p_type"],
        {
            "transactions": ("count", None),
            "units": ("total", units("l_extendedprice", 2)),
            "min_price": ("min", "l_extendedprice"),
            "max_price": ("max", "l_extendedprice"),
        },
    )
    summary = merged.select(
        "p_type",
        "transactions",
        from_units("units", 2).alias("total_revenue"),
        F.round(from_units(F.col("units").cast("double") / F.col("transactions"), 2), 2).alias("avg_order_value"),
        "min_price",
        "max_price",
    )
    return ordered(summary, [descending("total_revenue")])


def _summary_sql(keys: str, tables: str, order: str = "total_revenue DESC") -> str:
    return f"""
    SELECT {keys}, count(*) AS transactions, {dollars_sql(f"sum({ORDER_CENTS})")} AS total_revenue,
           {MEAN_SQL.format(ORDER_CENTS)} AS avg_order_value
    FROM {tables} GROUP BY {keys} ORDER BY {order}
    """


def _summary(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    merged = _orders_by_place(spark, sf_dir, keys)
    return merged.select(
        *keys,
        F.col("n").alias("transactions"),
        from_units("total_units", 2).alias("total_revenue"),
        F.round(from_units(F.col("total_units").cast("double") / F.col("n"), 2), 2).alias("avg_order_value"),
    )


BUYERS_SQL = """orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


@query("revenue_by_region", _summary_sql("r_name", BUYERS_SQL))
def revenue_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered(_summary(spark, sf_dir, "r_name"), [descending("total_revenue")])


@query("revenue_by_segment", _summary_sql("c_mktsegment", BUYERS_SQL))
def revenue_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered(_summary(spark, sf_dir, "c_mktsegment"), [descending("total_revenue")])


@query("revenue_by_priority", _summary_sql("o_orderpriority", "orders"))
def revenue_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = aggregates.amount_summary_by(
        table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_totalprice", scale=2
    )
    return ordered(summary, [descending("total_revenue")])


@query(
    "region_by_segment",
    _summary_sql("r_name, c_mktsegment", BUYERS_SQL, "r_name, total_revenue DESC"),
)
def region_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = _summary(spark, sf_dir, "r_name", "c_mktsegment")
    return ordered(summary, [ascending("r_name"), descending("total_revenue")])


@query(
    "duplicate_keys",
    """
    SELECT l_orderkey, l_partkey, count(*) AS duplicate_count
    FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
    """,
)
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"])


@query(
    "having_count",
    """
    SELECT c_nationkey, count(*) AS n_customers FROM customer
    GROUP BY 1 HAVING count(*) > 60 ORDER BY n_customers DESC
    """,
)
def having_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = aggregates.count_by(table(spark, sf_dir, "customer"), ["c_nationkey"], "n_customers")
    return ordered(
        aggregates.groups_where(counted, "n_customers > 60"), [descending("n_customers")]
    )


@query(
    "department_stats",
    """
    SELECT c_mktsegment, count(c_custkey) AS headcount,
           round(CAST(sum(c) AS DOUBLE) / count(*) / 100.0, 2) AS avg_salary,
           max(c_acctbal) AS max_salary, min(c_acctbal) AS min_salary,
           CAST(sum(CAST(round(comp * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS total_compensation
    FROM (SELECT *, CAST(round(c_acctbal * 100) AS BIGINT) AS c,
                 round(CAST(c_acctbal AS DECIMAL(12,2))
                       + CAST(c_acctbal AS DECIMAL(12,2)) * CAST(0.10 AS DECIMAL(4,2)), 2) AS comp
          FROM customer)
    GROUP BY 1 ORDER BY avg_salary DESC
    """,
)
def department_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    staff = add_raised(table(spark, sf_dir, "customer"), "total_comp", "c_acctbal", "0.10")
    measures = {
        "total_compensation": ("total", "total_comp", 2),
        "avg_salary": ("mean", "c_acctbal", 2),
        "min_salary": ("min", "c_acctbal"),
        "max_salary": ("max", "c_acctbal"),
        "headcount": ("count", "c_custkey"),
    }
    stats = aggregates.statistics(staff, measures, ["c_mktsegment"], scales={"total_comp": 2, "c_acctbal": 2})
    return ordered(stats, [descending("avg_salary")])


@query(
    "max_per_customer",
    """
    SELECT c_custkey, c_name, max(o_totalprice) AS highest_order_value
    FROM orders JOIN customer ON c_custkey = o_custkey
    GROUP BY 1, 2 ORDER BY highest_order_value DESC
    """,
)
def max_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    highest = aggregate_then_join(
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "customer"),
        "o_custkey",
        "c_custkey",
        ["c_custkey", "c_name"],
        {"highest_order_value": ("max", "o_totalprice")},
    )
    return ordered(highest, [descending("highest_order_value"), "c_custkey"])


@query(
    "avg_of_totals",
    f"""
    SELECT round(CAST(sum(cents) AS DOUBLE) / count(*) / 100.0, 2) AS avg_total
    FROM (SELECT o_custkey, sum({ORDER_CENTS}) AS cents FROM orders GROUP BY 1)
    """,
)
def avg_of_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.mean_of_totals(
        table(spark, sf_dir, "orders"), ["o_custkey"], "o_totalprice", "avg_total", 2
    )


@query(
    "single_order_customers",
    """
    SELECT c_custkey, c_name, n_orders FROM customer JOIN (
        SELECT o_custkey, count(DISTINCT o_orderkey) AS n_orders FROM orders GROUP BY 1
    ) ON c_custkey = o_custkey
    WHERE n_orders = 1 ORDER BY c_name
    """,
)
def single_order_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = aggregates.distinct_count_by(
        table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey", "n_orders"
    )
    single = aggregates.groups_where(counted, "n_orders = 1")
    named = join_dimension(single, table(spark, sf_dir, "customer"), "o_custkey", "c_custkey")
    return ordered(named.select("c_custkey", "c_name", "n_orders"), [ascending("c_name"), "c_custkey"])


@query(
    "join_then_group",
    f"""
    SELECT c_custkey, c_name, count(*) AS n_orders, {dollars_sql(f"sum({ORDER_CENTS})")} AS total_sales
    FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2
    """,
)
def join_then_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate_then_join(
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "customer"),
        "o_custkey",
        "c_custkey",
        ["c_custkey", "c_name"],
        {"n_orders": ("count", None), "total_units": ("total", units("o_totalprice", 2))},
    ).select("c_custkey", "c_name", "n_orders", from_units("total_units", 2).alias("total_sales"))
