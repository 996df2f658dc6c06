"""Current state, versions, staging models and snapshot changes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tidemark.catalog import ORACLES, query
from tidemark.catalog.base import Inputs, sql
from tidemark.operators import changes as C
from tidemark.operators import sequences as Q
from tidemark.operators import asof
from tidemark.operators import digests as D
from tidemark.operators import state as E
from tidemark.schemas import ALLOWED_TRANSITIONS, KEYS
from tidemark.sources.control import CONTROL_COLUMNS, ControlSource, read_control
from tidemark.sources.lake import write_verified

ORDER_LOG = ["order_id", "customer_id", "status", "total_amount", "created_at", "updated_at", "op",
             "source_lsn", "is_deleted"]
ITEM_LOG = ["order_item_id", "order_id", "product_id", "quantity", "unit_price", "op", "source_lsn",
            "is_deleted"]
CUSTOMER_LOG = ["customer_id", "email", "full_name", "country_code", "created_at", "updated_at", "op",
                "source_lsn", "is_deleted"]
PRODUCT_LOG = ["product_id", "sku", "name", "category", "price", "is_active", "updated_at", "op",
               "source_lsn", "is_deleted"]


def _latest_sql(view: str, key: str, cols: list[str], tie: str = "") -> str:
    return sql(f"""
SELECT {', '.join(cols)} FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY source_lsn DESC{tie}) AS rn FROM {view}) q
WHERE rn = 1 AND is_deleted = 0""", view)


@query("latest_state_orders", _latest_sql("orders_log", "order_id", ORDER_LOG))
def _(x: Inputs):
    return E.latest_state(x.log("orders"), KEYS["orders"], columns=ORDER_LOG)


@query("latest_state_order_items", _latest_sql(
    "order_items_log", "order_item_id", ITEM_LOG, ", product_id DESC, quantity DESC, unit_price DESC"))
def _(x: Inputs):
    return E.latest_state(x.log("order_items"), KEYS["order_items"], columns=ITEM_LOG,
                          tiebreak=["product_id", "quantity", "unit_price"])


@query("latest_state_customers", _latest_sql("customers_log", "customer_id", CUSTOMER_LOG))
def _(x: Inputs):
    return E.latest_state(x.log("customers"), KEYS["customers"], columns=CUSTOMER_LOG)


@query("latest_state_products", _latest_sql("products_log", "product_id", PRODUCT_LOG))
def _(x: Inputs):
    return E.latest_state(x.log("products"), KEYS["products"], columns=PRODUCT_LOG)


@query("latest_by_update_lake", sql("""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC) AS rn FROM lake_raw) q
WHERE rn = 1""", "lake_raw"))
def _(x: Inputs):
    return E.latest_by_update(x.lake_raw(), ["order_id"])


@query("version_report", sql("""
SELECT 'orders' AS "table", (SELECT count(*) FROM orders_log) AS source_rows,
  (SELECT count(*) FROM cur_orders) AS staged_rows,
  (SELECT count(*) FROM orders_log) - (SELECT count(*) FROM cur_orders) AS collapsed
UNION ALL SELECT 'order_items', (SELECT count(*) FROM order_items_log), (SELECT count(*) FROM cur_items),
  (SELECT count(*) FROM order_items_log) - (SELECT count(*) FROM cur_items)
UNION ALL SELECT 'customers', (SELECT count(*) FROM customers_log), (SELECT count(*) FROM cur_customers),
  (SELECT count(*) FROM customers_log) - (SELECT count(*) FROM cur_customers)
UNION ALL SELECT 'products', (SELECT count(*) FROM products_log), (SELECT count(*) FROM cur_products),
  (SELECT count(*) FROM products_log) - (SELECT count(*) FROM cur_products)""",
    "cur_orders", "cur_items", "cur_customers", "cur_products"))
def _(x: Inputs):
    return E.version_report({n: (x.log(n), KEYS[n]) for n in KEYS})


@query("state_as_of_half_log", sql("""
SELECT order_id, status, total_amount, source_lsn FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY source_lsn DESC) AS rn FROM orders_log
  WHERE source_lsn <= (SELECT max(source_lsn) // 2 FROM orders_log)) q
WHERE rn = 1 AND is_deleted = 0""", "orders_log"))
def _(x: Inputs):
    log = x.log("orders")
    half = log.agg(F.call_function("div", F.max("source_lsn"), F.lit(2))).scalar()
    return E.state_as_of(log, ["order_id"], half, columns=["order_id", "status", "total_amount", "source_lsn"])


@query("invalid_status_transitions", sql("""
SELECT order_id, source_lsn, from_status, to_status FROM (
  SELECT order_id, source_lsn, status AS to_status,
    lag(status) OVER (PARTITION BY order_id ORDER BY source_lsn) AS from_status FROM orders_log) q
WHERE from_status <> to_status AND (from_status, to_status) NOT IN
  (('pending', 'paid'), ('pending', 'cancelled'), ('paid', 'shipped'), ('shipped', 'delivered'))""",
    "orders_log"))
def _(x: Inputs):
    return Q.invalid_transitions(x.log("orders"), ALLOWED_TRANSITIONS)


@query("tombstones_customers", sql("""
SELECT customer_id, email, full_name, country_code, source_lsn FROM customers_log WHERE is_deleted = 1""",
    "customers_log"))
def _(x: Inputs):
    return E.tombstones(x.log("customers")).select(
        "customer_id", "email", "full_name", "country_code", "source_lsn")


@query("history_of_one_order", sql("""
SELECT op, status, total_amount, source_lsn, is_deleted FROM orders_log WHERE order_id = 100""", "orders_log"))
def _(x: Inputs):
    return E.history(x.log("orders"), "order_id", 100).select(
        "op", "status", "total_amount", "source_lsn", "is_deleted")


@query("stg_orders", sql("""
SELECT order_id, customer_id, status, is_cancelled, is_complete, total_amount, created_at, updated_at,
  order_date, order_hour, age_seconds, source_lsn, source_ts FROM cur_orders""", "cur_orders"))
def _(x: Inputs):
    return x.orders()


@query("stg_order_items", sql("""
SELECT order_item_id, order_id, product_id, quantity, unit_price, line_total, source_lsn, source_ts
FROM cur_items""", "cur_items"))
def _(x: Inputs):
    return x.items()


@query("stg_customers", sql("""
SELECT customer_id, email, full_name, country_code, created_at, updated_at, signup_date, source_lsn, source_ts
FROM cur_customers""", "cur_customers"))
def _(x: Inputs):
    return x.customers()


@query("stg_products", sql("SELECT * FROM cur_products", "cur_products"))
def _(x: Inputs):
    return x.products()


def _control(x: Inputs) -> ControlSource:
    root = x.scratch("control")
    write_verified(x.control(), f"{root}/orders")
    write_verified(x.customers().select(*CONTROL_COLUMNS["customers"]), f"{root}/customers")
    return ControlSource("parquet", root)


@query("stg_control_orders", sql("SELECT * FROM orders_control", "orders_control"))
def _(x: Inputs):
    return read_control(x.spark, _control(x), "orders")


@query("stg_control_customers", sql("""
SELECT customer_id, email, full_name, country_code, created_at, updated_at FROM cur_customers""", "cur_customers"))
def _(x: Inputs):
    return read_control(x.spark, _control(x), "customers")


@query("orders_on_day", sql("""
SELECT order_id, status, total_amount FROM cur_orders
WHERE created_at >= TIMESTAMP '1997-03-15' AND created_at < TIMESTAMP '1997-03-16'""", "cur_orders"))
def _(x: Inputs):
    return x.orders_of("1997-03-15", "order_id", "status", "total_amount")


@query("orders_by_bound_parameters", sql("""
SELECT order_id, status, total_amount FROM cur_orders
WHERE order_date = DATE '1997-03-15' AND (status IN ('paid', 'delivered') OR total_amount > 100000)
  AND age_seconds IS NOT NULL AND order_hour < 20""", "cur_orders"))
def _(x: Inputs):
    return x.spark.sql(
        """SELECT order_id, status, total_amount FROM {orders}
           WHERE order_date = DATE(:day) AND (status IN (:a, :b) OR total_amount > :amount)
             AND age_seconds IS NOT NULL AND order_hour < :hour""",
        args={"day": "1997-03-15", "a": "paid", "b": "delivered", "amount": 100000, "hour": 20},
        orders=x.orders(),
    )


@query("snapshot_then_live_changes", _latest_sql(
    "products_log", "product_id", ["product_id", "category", "price", "op"]))
def _(x: Inputs):
    """Snapshot rows enter as changes below every live position; the live log then wins."""
    log = x.log("products")
    cols = ["product_id", "category", "price", "op", "source_lsn", "source_ts", "is_deleted"]
    first = log.filter(F.col("op") == "r").select("product_id", "category", "price")
    snapshot = C.snapshot_as_changes(first, lsn=-1, ts="1994-12-31 00:00:00")
    live = log.filter(F.col("op") != "r")
    both = snapshot.select(*cols).unionByName(live.select(*cols))
    return E.latest_state(both, ["product_id"], columns=["product_id", "category", "price", "op"])


@query("diff_of_two_snapshots", sql("""
SELECT coalesce(n.product_id, o.product_id) AS product_id,
  coalesce(n.category, o.category) AS category, coalesce(n.price, o.price) AS price,
  CASE WHEN o.product_id IS NULL THEN 'c' WHEN n.product_id IS NULL THEN 'd' ELSE 'u' END AS op,
  CAST(7 AS BIGINT) AS source_lsn, CASE WHEN n.product_id IS NULL THEN 1 ELSE 0 END AS is_deleted
FROM (SELECT product_id, category, price FROM products_log WHERE op = 'r' AND product_id % 50 <> 3) o
FULL JOIN (SELECT product_id, category, current_price AS price FROM cur_products) n ON n.product_id = o.product_id
WHERE o.product_id IS NULL OR n.product_id IS NULL OR o.category IS DISTINCT FROM n.category
  OR o.price IS DISTINCT FROM n.price""", "products_log", "cur_products"))
def _(x: Inputs):
    log = x.log("products")
    cols = ["product_id", "category", "price"]
    old = log.filter((F.col("op") == "r") & (F.col("product_id") % 50 != 3)).select(*cols)
    new = E.latest_state(log, ["product_id"], columns=cols)
    return C.diff_snapshots(old, new, ["product_id"], lsn=7)


def _by_order_id(x: Inputs, df, label: str):
    """``df`` as a table in key order."""
    path = x.scratch(label)
    df.repartitionByRange("order_id").sortWithinPartitions("order_id").write.parquet(path)
    return x.spark.read.schema(df.schema).parquet(path)


def _order_ranges(*tables) -> D.ByRange:
    lo, hi = reduce(lambda a, b: a.union(b), [t.select("order_id") for t in tables]).agg(
        F.min("order_id"), F.max("order_id")).first()
    return D.ByRange("order_id", lo, hi)


@query("orders_changed_by_digest", sql("""
SELECT coalesce(n.order_id, o.order_id) AS order_id,
  CASE WHEN n.order_id IS NULL THEN o.status ELSE n.status END AS status,
  CASE WHEN n.order_id IS NULL THEN o.total_amount ELSE n.total_amount END AS total_amount,
  CASE WHEN o.order_id IS NULL THEN 'c' WHEN n.order_id IS NULL THEN 'd' ELSE 'u' END AS op,
  CAST(9 AS BIGINT) AS source_lsn, CASE WHEN n.order_id IS NULL THEN 1 ELSE 0 END AS is_deleted
FROM (SELECT order_id, status, total_amount FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY source_lsn DESC) AS rn FROM orders_log
    WHERE source_lsn <= (SELECT max(source_lsn) // 2 FROM orders_log)) q WHERE rn = 1 AND is_deleted = 0) o
FULL JOIN cur_orders n ON n.order_id = o.order_id
WHERE o.order_id IS NULL OR n.order_id IS NULL OR o.status IS DISTINCT FROM n.status
  OR o.total_amount IS DISTINCT FROM n.total_amount""", "orders_log", "cur_orders"))
def _(x: Inputs):
    """Half the log against all of it: ranges of orders that the second half left alone are not joined."""
    log, cols = x.log("orders"), ["order_id", "status", "total_amount"]
    half = log.agg(F.call_function("div", F.max("source_lsn"), F.lit(2))).first()[0]
    old = _by_order_id(x, E.state_as_of(log, ["order_id"], half, columns=cols), "old-orders")
    new = _by_order_id(x, E.latest_state(log, ["order_id"], columns=cols), "new-orders")
    return D.diff_by_digest(old, new, ["order_id"], 9, _order_ranges(old, new))


@query("control_compared_by_digest", ORACLES["compare_control_with_warehouse"])
def _(x: Inputs):
    cols = ["order_id", "status", "total_amount"]
    control = _by_order_id(x, x.control().select(*cols), "control")
    warehouse = _by_order_id(x, x.orders(*cols), "warehouse")
    return D.compare_by_digest(control, warehouse, ["order_id"], cols[1:], _order_ranges(control, warehouse))


@query("insert_absent_customers", sql("""
SELECT customer_id, email, 1 AS arrival FROM cur_customers WHERE customer_id % 3 <> 0""", "cur_customers"))
def _(x: Inputs):
    cur = x.customers("customer_id", "email")
    existing = cur.filter(F.col("customer_id") % 3 == 0)
    again = cur.withColumns({"email": F.concat(F.lit("a later "), "email"), "arrival": F.lit(2)})
    return E.insert_absent(existing, again.unionAll(cur.withColumn("arrival", F.lit(1))), ["customer_id"], "arrival")


@query("mart_rows_by_version", sql("""
SELECT day, category, CASE WHEN day >= DATE '1998-01-01' THEN revenue + 1 ELSE revenue END AS revenue,
  CASE WHEN day >= DATE '1998-01-01' THEN 2 ELSE 1 END AS run FROM daily_sales""", "daily_sales"))
def _(x: Inputs):
    """A recomputed day replaces its rows instead of adding to them."""
    mart = x.daily_sales.select("day", "category", "revenue")
    first = mart.withColumn("run", F.lit(1))
    again = mart.filter(F.col("day") >= "1998-01-01").select(
        "day", "category", (F.col("revenue") + 1).cast("decimal(18,2)").alias("revenue"), F.lit(2).alias("run"))
    return E.merge_versions(first, again, ["day", "category"], "run")


@query("order_validity", sql("""
SELECT order_id, valid_from, valid_to, status, total_amount FROM (
  SELECT order_id, source_lsn AS valid_from, lead(source_lsn) OVER (PARTITION BY order_id ORDER BY source_lsn) AS valid_to,
    status, total_amount, is_deleted FROM orders_log) q WHERE is_deleted = 0""", "orders_log"))
def _(x: Inputs):
    return asof.validity(x.log("orders"), ["order_id"], ["status", "total_amount"])


@query("order_as_of_each_line", sql("""
SELECT i.order_item_id, i.order_id, i.position, CASE WHEN o.is_deleted = 0 THEN o.status END AS status,
  CASE WHEN o.is_deleted = 0 THEN o.total_amount END AS total_amount
FROM (SELECT order_item_id, order_id, order_id * 10 - 1 + order_item_id % 6 AS position FROM order_items_log) i
ASOF LEFT JOIN orders_log o ON o.order_id = i.order_id AND o.source_lsn <= i.position""", "order_items_log", "orders_log"))
def _(x: Inputs):
    """One question per order line: the order as a reader of the log up to some position saw it."""
    lines = x.log("order_items").select(
        "order_item_id", "order_id", (F.col("order_id") * 10 - 1 + F.col("order_item_id") % 6).alias("position"))
    return asof.as_of_join(lines, x.log("orders"), ["order_id"], "position", ["status", "total_amount"])
