"""Summary tables for reports, as batch aggregates over refined tables."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from paywarden.operators.partials import Partials
from paywarden.operators.sizing import BROADCAST_BYTES, measured_bytes

MONEY = "decimal(18,2)"  # summed as decimal: the order of addition cannot matter
TOTAL = "decimal(28,2)"


def daily_active(events: DataFrame, at: str = "ts", user: str = "user_id") -> DataFrame:
    """Distinct users and events per day.

    Events are first counted per day and user inside each task, so neither a
    busy day nor a busy user reaches one task as raw rows.
    """
    per_user = events.groupBy(F.to_date(at).alias("day"), user).agg(F.count("*").alias("n"))
    return per_user.groupBy("day").agg(
        F.count(user).alias("active_users"), F.sum("n").alias("events")
    )


def weekly_sales(lines: DataFrame, at: str, store: str, amount: str) -> DataFrame:
    """Sales per store and week (named by its Monday)."""
    return lines.groupBy(F.trunc(F.to_date(at), "week").alias("week"), F.col(store).alias("store")).agg(
        F.sum(F.col(amount).cast(MONEY)).cast(TOTAL).alias("sales"), F.count("*").alias("lines")
    )


def quarter_revenue(
    orders: DataFrame,
    customers: DataFrame,
    at: str,
    amount: str,
    order_customer: str,
    customer: str,
    department: str,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Gross revenue per department and quarter; a customer belongs to a department.

    Customers that measure at most `broadcast_bytes` are broadcast, and orders
    are summed per department inside each task. Otherwise orders are first
    summed per customer and quarter: a customer with very many orders is then a
    few rows, so the join by shuffle has no hot key.
    """
    departments = customers.select(F.col(customer).alias("_customer"), F.col(department).alias("department"))
    keyed = orders.select(
        F.col(order_customer).alias("_customer"),
        F.year(at).alias("year"),
        F.quarter(at).alias("quarter"),
        F.col(amount).cast(MONEY).alias("revenue"),
        F.lit(1).cast("bigint").alias("orders"),
    )
    totals = [F.sum(c).alias(c) for c in ("revenue", "orders")]
    if measured_bytes(departments) <= broadcast_bytes:
        joined = keyed.join(F.broadcast(departments), "_customer")
    else:
        joined = keyed.groupBy("_customer", "year", "quarter").agg(*totals).join(departments, "_customer")
    return (
        joined.groupBy("year", "quarter", "department")
        .agg(*totals)
        .withColumn("revenue", F.col("revenue").cast(TOTAL))
    )


def weekly_sales_parts(spark: SparkSession, path: str, at: str, store: str, amount: str, store_type: str = "bigint") -> Partials:
    """Weekly sales that are kept up to date part by part."""
    return Partials(
        spark,
        path,
        lambda lines: weekly_sales(lines, at, store, amount),
        ("week", "store"),
        ("sales", "lines"),
        f"week DATE, store {store_type}, sales {TOTAL}, lines BIGINT",
    )


def quarter_revenue_parts(spark: SparkSession, path: str, customers: DataFrame, **columns) -> Partials:
    """Revenue per quarter that is kept up to date part by part of the orders. The departments are
    those of the customers at the time a part is added."""
    return Partials(
        spark,
        path,
        lambda orders: quarter_revenue(orders, customers, **columns),
        ("year", "quarter", "department"),
        ("revenue", "orders"),
        f"year INT, quarter INT, department STRING, revenue {TOTAL}, orders BIGINT",
    )
