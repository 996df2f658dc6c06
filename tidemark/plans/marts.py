"""Daily, per-customer and reconciliation marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalar as S
from tidemark.plans import staging

# Fixed value: orders a day may be apart and still count as capture delay.
TOLERANCE = 5


def stamped(mart: DataFrame, column: str, at: str) -> DataFrame:
    """A mart with the time of the run that made it, which the caller gives so that results repeat."""
    return mart.withColumn(column, F.lit(at).cast("timestamp_ntz"))


def daily_sales(items: DataFrame, orders: DataFrame, products: DataFrame, day: str | None = None) -> DataFrame:
    """Orders, items and revenue per day and category, cancelled orders left out.

    Inputs are staging models. Lines meet their order first, on the key both
    are spread by. The distinct count adds one step: partial sums per (day,
    category, order) and task are shuffled, then those per (day, category).
    ``day`` limits the result to one day through the order's timestamp.
    """
    sold = orders.filter(F.col("status") != "cancelled")
    if day:
        sold = sold.filter(S.in_day("created_at", day))
    sold = sold.select("order_id", F.to_date("created_at").alias("day"))
    lines = items.select("order_id", "product_id", "quantity", "unit_price")
    catalogue = products.select("product_id", "category")
    return (
        lines.join(sold, "order_id")
        .join(catalogue, "product_id")
        .groupBy("day", "category")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.sum("quantity").cast("bigint").alias("items"),
            F.sum(S.line_total("quantity", "unit_price")).cast("decimal(18,2)").alias("revenue"),
        )
    )


def daily_sales_of_day(logs: dict[str, DataFrame], day: str) -> DataFrame:
    """The sales mart of one day straight from the logs, without collapsing the other days.

    The day's orders are few; the line log is cut down to them before its
    versions are collapsed.
    """
    orders = staging.stg_orders(logs["orders"], ["order_id", "status", "created_at"], day)
    items = staging.stg_order_items(
        logs["order_items"], ["order_item_id", "order_id", "product_id", "quantity", "unit_price"], orders
    )
    products = staging.stg_products(logs["products"], ["product_id", "category"])
    return daily_sales(items, orders, products)


def customer_summary(
    customers: DataFrame, orders: DataFrame, items: DataFrame, as_of: str, computed_at: str | None = None
) -> DataFrame:
    """One row per customer; customers without orders have zero counts and null dates.

    Lines are added up per order and orders per customer before the next join,
    so a customer with very many orders shrinks to one row per task.
    """
    per_order = items.groupBy("order_id").agg(F.sum("quantity").alias("items"))
    counted = F.col("status") != "cancelled"
    complete = F.col("status").isin("delivered", "paid")
    day = F.to_date("created_at")
    per_customer = (
        orders.select("order_id", "customer_id", "status", "total_amount", "created_at")
        .join(per_order, "order_id", "left")
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("orders_placed"),
            F.count_if(~counted).alias("orders_cancelled"),
            F.count_if(complete).alias("orders_completed"),
            F.sum(F.when(counted, F.col("total_amount"))).alias("lifetime_value"),
            F.sum(F.when(counted, F.col("items"))).alias("items_bought"),
            F.min(day).alias("first_order_date"),
            F.max(day).alias("last_order_date"),
        )
    )

    def zero(name: str, dtype: str):
        return F.coalesce(F.col(name).cast(dtype), F.lit(0).cast(dtype)).alias(name)

    summary = (
        customers.select("customer_id", "country_code", "signup_date")
        .join(per_customer, "customer_id", "left")
        .select(
            "customer_id", "country_code", "signup_date",
            zero("orders_placed", "bigint"),
            zero("orders_cancelled", "bigint"),
            zero("orders_completed", "bigint"),
            zero("lifetime_value", "decimal(18,2)"),
            zero("items_bought", "bigint"),
            "first_order_date", "last_order_date",
            S.days_since("last_order_date", F.lit(as_of).cast("date")).cast("bigint")
            .alias("days_since_last_order"),
        )
    )
    return stamped(summary, "computed_at", computed_at) if computed_at else summary


def day_totals(orders: DataFrame, day, prefix: str) -> DataFrame:
    """Orders and revenue per day of one route."""
    return orders.groupBy(day.alias("order_date")).agg(
        F.count(F.lit(1)).alias(f"{prefix}_orders"),
        F.sum("total_amount").cast("decimal(18,2)").alias(f"{prefix}_revenue"),
    )


def reconcile(
    control: DataFrame, warehouse: DataFrame, lake: DataFrame, tolerance: int = TOLERANCE, checked_at: str | None = None
) -> DataFrame:
    """Orders and revenue per day over three routes, their gap, and a verdict.

    The routes are stacked and grouped once, which gives the same rows as
    joining three aggregates to the union of their days. A route without a day
    has null there.
    """
    def route(df: DataFrame, name: str, day) -> DataFrame:
        return df.select(day.alias("order_date"), F.lit(name).alias("route"), "total_amount")

    stacked = (
        route(control, "pg", F.to_date("created_at"))
        .unionByName(route(warehouse, "cdc", F.to_date("created_at")))
        .unionByName(route(lake, "s3", F.col("order_date")))
    )
    measures = []
    for name in ("pg", "cdc", "s3"):
        here = F.col("route") == name
        n = F.count_if(here)
        measures.append(F.when(n > 0, n).alias(f"{name}_orders"))
        measures.append(
            F.sum(F.when(here, F.col("total_amount"))).cast("decimal(18,2)").alias(f"{name}_revenue")
        )
    by_day = stacked.groupBy("order_date").agg(*measures)
    gap = S.signed_gap("cdc_orders", "pg_orders")
    verdict = (
        F.when(F.col("pg_orders").isNull(), "not in source")
        .when(F.col("cdc_orders").isNull(), "missing from warehouse")
        .when(F.col("cdc_orders") == F.col("pg_orders"), "exact")
        .when(F.abs(gap) <= tolerance, "within tolerance")
        .otherwise("DIVERGED")
    )
    report = by_day.select(
        "order_date", "pg_orders", "cdc_orders", "s3_orders",
        gap.alias("cdc_minus_pg"),
        "pg_revenue", "cdc_revenue", "s3_revenue",
        (F.col("cdc_revenue") - F.col("pg_revenue")).cast("decimal(18,2)").alias("revenue_gap"),
        verdict.alias("verdict"),
    )
    return stamped(report, "checked_at", checked_at) if checked_at else report
