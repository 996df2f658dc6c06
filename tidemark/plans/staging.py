"""Staging models: one current row per key, with the columns every reader would recompute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalar as S
from tidemark.operators.state import latest_by_update, latest_state
from tidemark.schemas import KEYS
from tidemark.sources.lake import read_lake

# States that count as sold.
COMPLETE = ("delivered", "paid")
ITEM_TIEBREAK = ["product_id", "quantity", "unit_price"]


def order_columns(as_boolean: bool = False) -> dict[str, Column]:
    """Derived columns of an order."""
    cancelled = F.col("status") == "cancelled"
    complete = F.col("status").isin(*COMPLETE)
    return {
        "is_cancelled": cancelled if as_boolean else cancelled.cast("int"),
        "is_complete": complete if as_boolean else complete.cast("int"),
        "order_date": F.to_date("created_at"),
        "order_hour": F.hour("created_at"),
        "age_seconds": S.age_seconds("created_at", "updated_at"),
    }


def stg_orders(log: DataFrame, columns: list[str] | None = None, day: str | None = None) -> DataFrame:
    """Current orders with flags, date, hour and age. ``columns`` narrows the whole plan.

    ``day`` keeps the orders created on one day. An order's creation time is the
    same in all its versions, tombstones included, so the filter is applied to
    the log and only that day's versions are read and collapsed.
    """
    out = [
        "order_id", "customer_id", "status", "is_cancelled", "is_complete", "total_amount",
        "created_at", "updated_at", "order_date", "order_hour", "age_seconds", "source_lsn", "source_ts",
    ]
    wanted = columns or out
    sources = {
        "is_cancelled": ["status"], "is_complete": ["status"], "order_date": ["created_at"],
        "order_hour": ["created_at"], "age_seconds": ["created_at", "updated_at"],
    }
    need = [s for c in wanted for s in sources.get(c, [c])]
    derived = {k: v for k, v in order_columns().items() if k in wanted}
    if day:
        log = log.filter(S.in_day("created_at", day))
    current = latest_state(log, KEYS["orders"], columns=list(dict.fromkeys(["order_id", *need])))
    return current.withColumns(derived).select(*wanted)


def stg_order_items(
    log: DataFrame, columns: list[str] | None = None, of_orders: DataFrame | None = None
) -> DataFrame:
    """Current order lines with the amount of the line.

    A line never moves to another order. The collapse therefore works on
    (order, line), which a log bucketed by order satisfies without a shuffle,
    and ``of_orders`` may limit the log to some orders before the collapse.
    """
    out = ["order_item_id", "order_id", "product_id", "quantity", "unit_price", "line_total",
           "source_lsn", "source_ts"]
    wanted = columns or out
    need = [s for c in wanted for s in (["quantity", "unit_price"] if c == "line_total" else [c])]
    if of_orders is not None:
        log = log.join(of_orders.select("order_id"), "order_id", "left_semi")
    keys = ["order_id", *KEYS["order_items"]]
    current = latest_state(log, keys, columns=list(dict.fromkeys([*keys, *need])), tiebreak=ITEM_TIEBREAK)
    if "line_total" in wanted:
        current = current.withColumn("line_total", S.line_total("quantity", "unit_price"))
    return current.select(*wanted)


def stg_customers(log: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Current customers with their signup date."""
    out = ["customer_id", "email", "full_name", "country_code", "created_at", "updated_at",
           "signup_date", "source_lsn", "source_ts"]
    wanted = columns or out
    need = ["created_at" if c == "signup_date" else c for c in wanted]
    current = latest_state(log, KEYS["customers"], columns=list(dict.fromkeys(["customer_id", *need])))
    if "signup_date" in wanted:
        current = current.withColumn("signup_date", F.to_date("created_at"))
    return current.select(*wanted)


# Column names of the product model.
PRODUCT_NAMES = {"name": "product_name", "price": "current_price"}


def stg_products(log: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Current products; the price is named for what it is, the price now."""
    out = ["product_id", "sku", "product_name", "category", "current_price", "is_active",
           "updated_at", "source_lsn", "source_ts"]
    wanted = columns or out
    back = {v: k for k, v in PRODUCT_NAMES.items()}
    need = [back.get(c, c) for c in wanted]
    current = latest_state(log, KEYS["products"], columns=list(dict.fromkeys(["product_id", *need])))
    return current.withColumnsRenamed(PRODUCT_NAMES).select(*wanted)


def stage_lake_rows(raw: DataFrame, staged_at: str | None = None) -> DataFrame:
    """Raw lake orders as staged ones: newest export per order, plus the derived columns.

    ``staged_at`` fixes the processing time, for repeatable output.
    """
    stamp = F.lit(staged_at).cast("timestamp_ntz") if staged_at else F.localtimestamp()
    return latest_by_update(raw, ["order_id"]).withColumns(
        {**order_columns(as_boolean=True), "staged_at": stamp}
    )


def stg_lake_orders(spark: SparkSession, root: str) -> DataFrame:
    """Staged lake orders with their partition date."""
    return read_lake(spark, root, "orders").select(
        "order_id", "customer_id", "status", "is_cancelled", "is_complete", "total_amount",
        "created_at", "updated_at", "order_date", "order_hour", "age_seconds", "dt", "staged_at",
    )
