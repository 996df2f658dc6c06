"""Inputs of the registered queries and the same inputs as SQL for the oracle."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tidemark import fixtures as X
from tidemark.plans import marts, staging
from tidemark.session import shared_dir

AS_OF = "1999-01-01"
STAGED_AT = "2000-01-01 00:00:00"


class Inputs:
    """Logs, staging models and marts of one data folder, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return X.table(self.spark, self.sf_dir, name)

    def log(self, entity: str) -> DataFrame:
        return X.log(self.spark, self.sf_dir, entity)

    def orders(self, *columns: str) -> DataFrame:
        return staging.stg_orders(self.log("orders"), list(columns) or None)

    def orders_of(self, day: str, *columns: str) -> DataFrame:
        return staging.stg_orders(self.log("orders"), list(columns) or None, day)

    def items(self, *columns: str) -> DataFrame:
        return staging.stg_order_items(self.log("order_items"), list(columns) or None)

    def customers(self, *columns: str) -> DataFrame:
        return staging.stg_customers(self.log("customers"), list(columns) or None)

    def products(self, *columns: str) -> DataFrame:
        return staging.stg_products(self.log("products"), list(columns) or None)

    @cached_property
    def daily_sales(self) -> DataFrame:
        return marts.daily_sales(
            self.items("order_item_id", "order_id", "product_id", "quantity", "unit_price"),
            self.orders("order_id", "status", "created_at"),
            self.products("product_id", "category"),
        )

    @cached_property
    def summary(self) -> DataFrame:
        return marts.customer_summary(
            self.customers("customer_id", "country_code", "signup_date"),
            self.orders("order_id", "customer_id", "status", "total_amount", "created_at"),
            self.items("order_item_id", "order_id", "quantity"),
            AS_OF,
        )

    def control(self) -> DataFrame:
        return X.orders_control(self.orders())

    def lake_raw(self) -> DataFrame:
        return X.lake_orders(self.spark, self.sf_dir)

    def lake_staged(self) -> DataFrame:
        return staging.stage_lake_rows(self.lake_raw(), STAGED_AT)

    @cached_property
    def recon(self) -> DataFrame:
        return marts.reconcile(
            self.control(), self.orders("order_id", "total_amount", "created_at"), self.lake_staged()
        )

    def samples(self) -> DataFrame:
        return X.samples(self.spark, self.sf_dir)

    def names(self) -> DataFrame:
        return X.dotted_names(self.spark, self.sf_dir)

    def scratch(self, label: str) -> str:
        return shared_dir(self.spark, label)


# name -> (names it reads, SQL)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "orders_log": ((), """
SELECT order_id, customer_id,
  CASE WHEN v >= 2 THEN final_status ELSE 'pending' END AS status,
  CASE WHEN v = 0 THEN CAST(0 AS DECIMAL(12,2)) ELSE amt END AS total_amount,
  created_at,
  CASE v WHEN 0 THEN created_at WHEN 1 THEN created_at + INTERVAL '1' MINUTE
    ELSE created_at + INTERVAL '1' HOUR * (order_id % 72 + v) END AS updated_at,
  CASE v WHEN 0 THEN 'c' WHEN 3 THEN 'd' ELSE 'u' END AS op,
  order_id * 10 + v AS source_lsn,
  CASE WHEN v = 3 THEN 1 ELSE 0 END AS is_deleted
FROM (SELECT o_orderkey AS order_id, o_custkey AS customer_id,
        CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'paid'
          ELSE CASE o_orderkey % 3 WHEN 0 THEN 'cancelled' WHEN 1 THEN 'pending' ELSE 'shipped' END
        END AS final_status,
        CAST(o_totalprice AS DECIMAL(12,2)) AS amt,
        o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 24) AS created_at,
        unnest([0, 1, 2, 3]) AS v
      FROM orders) b
WHERE v < 2 OR (v = 2 AND final_status <> 'pending') OR (v = 3 AND order_id % 50 = 0)"""),
    "order_items_log": ((), """
SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id,
  l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity,
  CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price, 'c' AS op,
  CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) * 1000000000000 + l_partkey AS source_lsn,
  0 AS is_deleted, l_shipdate AS source_ts
FROM lineitem"""),
    "customers_log": ((), """
SELECT customer_id, concat('user', CAST(customer_id AS VARCHAR), '@example.com') AS email,
  concat('Customer ', CAST(customer_id AS VARCHAR)) AS full_name,
  lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS country_code,
  t0 + INTERVAL '1' DAY * (customer_id % 365) AS created_at,
  t0 + INTERVAL '1' DAY * (customer_id % 365 + v) AS updated_at,
  CASE v WHEN 0 THEN 'r' ELSE 'd' END AS op, c_custkey * 10 + v AS source_lsn, v AS is_deleted
FROM (SELECT c_custkey, c_custkey AS customer_id, c_nationkey FROM customer
      UNION ALL SELECT c_custkey, -c_custkey - 1, c_nationkey FROM customer WHERE c_custkey % 25 = 0) b,
     (SELECT min(o_orderdate) AS t0 FROM orders) lo, (VALUES (0), (1)) AS vv(v)
WHERE v = 0 OR customer_id % 40 = 0"""),
    "products_log": ((), """
SELECT p_partkey AS product_id, concat('SKU-', CAST(p_partkey AS VARCHAR)) AS sku,
  p_name AS name, lower(p_type) AS category,
  CAST(CAST(p_retailprice AS DECIMAL(12,2)) + v AS DECIMAL(12,2)) AS price, 1 AS is_active,
  t0 + INTERVAL '1' DAY * v AS updated_at,
  CASE v WHEN 0 THEN 'r' WHEN 1 THEN 'u' ELSE 'd' END AS op, p_partkey * 10 + v AS source_lsn,
  CASE WHEN v = 2 THEN 1 ELSE 0 END AS is_deleted
FROM part, (SELECT min(o_orderdate) AS t0 FROM orders) lo, (VALUES (0), (1), (2)) AS vv(v)
WHERE v = 0 OR (v = 1 AND p_partkey % 5 = 0) OR (v = 2 AND p_partkey % 200 = 7)"""),
    "cur_orders": (("orders_log",), """
SELECT * EXCLUDE (rn, is_deleted, op), CAST(created_at AS DATE) AS order_date,
  CASE WHEN status = 'cancelled' THEN 1 ELSE 0 END AS is_cancelled,
  CASE WHEN status IN ('delivered', 'paid') THEN 1 ELSE 0 END AS is_complete,
  CAST(hour(created_at) AS INT) AS order_hour,
  CASE WHEN updated_at > created_at THEN CAST(epoch(updated_at) - epoch(created_at) AS BIGINT) END AS age_seconds,
  updated_at AS source_ts
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY source_lsn DESC) AS rn FROM orders_log) q
WHERE rn = 1 AND is_deleted = 0"""),
    "cur_items": (("order_items_log",), """
SELECT * EXCLUDE (rn, is_deleted, op), CAST(quantity * unit_price AS DECIMAL(18,2)) AS line_total
FROM (SELECT *, row_number() OVER (PARTITION BY order_item_id
        ORDER BY source_lsn DESC, product_id DESC, quantity DESC, unit_price DESC) AS rn FROM order_items_log) q
WHERE rn = 1 AND is_deleted = 0"""),
    "cur_customers": (("customers_log",), """
SELECT * EXCLUDE (rn, is_deleted, op), CAST(created_at AS DATE) AS signup_date, updated_at AS source_ts
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY source_lsn DESC) AS rn FROM customers_log) q
WHERE rn = 1 AND is_deleted = 0"""),
    "cur_products": (("products_log",), """
SELECT product_id, sku, name AS product_name, category, price AS current_price, is_active, updated_at,
  source_lsn, updated_at AS source_ts
FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY source_lsn DESC) AS rn FROM products_log) q
WHERE rn = 1 AND is_deleted = 0"""),
    "orders_control": (("cur_orders",), """
SELECT order_id, customer_id, status, total_amount, created_at, updated_at FROM cur_orders
WHERE order_id % 97 <> 0 AND NOT (month(created_at) = 2 AND day(created_at) = 1)
  AND (day(created_at) <> 15 OR order_id % 7 = 0)
UNION ALL
SELECT -order_id, customer_id, status, total_amount,
  created_at + INTERVAL '3650' DAY, updated_at + INTERVAL '3650' DAY
FROM cur_orders WHERE order_id % 1000 = 1"""),
    "lake_raw": (("orders_log",), """
SELECT order_id, customer_id, status, total_amount, created_at, updated_at, CAST(created_at AS DATE) AS dt
FROM orders_log WHERE is_deleted = 0 AND source_lsn % 10 >= 1"""),
    "lake_staged": (("lake_raw",), """
SELECT * EXCLUDE (rn), CAST(created_at AS DATE) AS order_date, CAST(hour(created_at) AS INT) AS order_hour,
  status = 'cancelled' AS is_cancelled, status IN ('delivered', 'paid') AS is_complete,
  CASE WHEN updated_at > created_at THEN CAST(epoch(updated_at) - epoch(created_at) AS BIGINT) END AS age_seconds,
  TIMESTAMP '2000-01-01 00:00:00' AS staged_at
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC) AS rn FROM lake_raw) q
WHERE rn = 1"""),
    "daily_sales": (("cur_items", "cur_orders", "cur_products"), """
SELECT o.order_date AS day, p.category, count(DISTINCT i.order_id) AS orders,
  CAST(sum(i.quantity) AS BIGINT) AS items, CAST(sum(i.line_total) AS DECIMAL(18,2)) AS revenue
FROM cur_items i JOIN cur_orders o ON o.order_id = i.order_id AND o.is_cancelled = 0
JOIN cur_products p ON p.product_id = i.product_id
GROUP BY o.order_date, p.category"""),
    "customer_summary": (("cur_customers", "cur_orders", "cur_items"), """
SELECT c.customer_id, c.country_code, c.signup_date,
  count(o.order_id) AS orders_placed,
  CAST(coalesce(sum(o.is_cancelled), 0) AS BIGINT) AS orders_cancelled,
  CAST(coalesce(sum(o.is_complete), 0) AS BIGINT) AS orders_completed,
  CAST(coalesce(sum(CASE WHEN o.is_cancelled = 0 THEN o.total_amount ELSE 0 END), 0) AS DECIMAL(18,2)) AS lifetime_value,
  CAST(coalesce(sum(CASE WHEN o.is_cancelled = 0 THEN i.items ELSE 0 END), 0) AS BIGINT) AS items_bought,
  min(o.order_date) AS first_order_date, max(o.order_date) AS last_order_date,
  CASE WHEN count(o.order_id) > 0 THEN CAST(date_diff('day', max(o.order_date), DATE '1999-01-01') AS BIGINT) END
    AS days_since_last_order
FROM cur_customers c LEFT JOIN cur_orders o ON o.customer_id = c.customer_id
LEFT JOIN (SELECT order_id, sum(quantity) AS items FROM cur_items GROUP BY order_id) i ON i.order_id = o.order_id
GROUP BY c.customer_id, c.country_code, c.signup_date"""),
    "recon": (("orders_control", "cur_orders", "lake_staged"), """
SELECT d.order_date, pg.n AS pg_orders, w.n AS cdc_orders, l.n AS s3_orders, w.n - pg.n AS cdc_minus_pg,
  pg.r AS pg_revenue, w.r AS cdc_revenue, l.r AS s3_revenue, CAST(w.r - pg.r AS DECIMAL(18,2)) AS revenue_gap,
  CASE WHEN pg.n IS NULL THEN 'not in source' WHEN w.n IS NULL THEN 'missing from warehouse'
    WHEN w.n = pg.n THEN 'exact' WHEN abs(w.n - pg.n) <= 5 THEN 'within tolerance' ELSE 'DIVERGED' END AS verdict
FROM (SELECT CAST(created_at AS DATE) AS order_date FROM orders_control
      UNION SELECT order_date FROM cur_orders UNION SELECT order_date FROM lake_staged) d
LEFT JOIN (SELECT CAST(created_at AS DATE) AS order_date, count(*) AS n, CAST(sum(total_amount) AS DECIMAL(18,2)) AS r
           FROM orders_control GROUP BY 1) pg ON pg.order_date = d.order_date
LEFT JOIN (SELECT order_date, count(*) AS n, CAST(sum(total_amount) AS DECIMAL(18,2)) AS r
           FROM cur_orders GROUP BY 1) w ON w.order_date = d.order_date
LEFT JOIN (SELECT order_date, count(*) AS n, CAST(sum(total_amount) AS DECIMAL(18,2)) AS r
           FROM lake_staged GROUP BY 1) l ON l.order_date = d.order_date"""),
    "samples": ((), """
SELECT ts, concat('events_', event_type) AS metric, CAST(user_id % 4 AS VARCHAR) AS instance,
  CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS job, CAST(floor(value) AS DOUBLE) AS value
FROM events"""),
    "names": ((), """
SELECT event_id, CASE event_id % 10
  WHEN 0 THEN concat('airflow.other_', event_type)
  WHEN 1 THEN concat('superset.DashboardRestApi.get.', event_type)
  WHEN 2 THEN 'superset.ChartDataRestApi.data'
  WHEN 3 THEN 'superset.health'
  WHEN 4 THEN 'superset.execute_sql'
  WHEN 5 THEN concat('superset.new.', event_type)
  WHEN 6 THEN 'airflow.dag.etl.load.duration'
  WHEN 7 THEN concat('airflow.dagrun.schedule_delay.dag', CAST(user_id % 3 AS VARCHAR))
  ELSE concat('airflow.ti.finish.dag', CAST(user_id % 3 AS VARCHAR), '.task', CAST(event_id % 4 AS VARCHAR), '.', event_type)
  END AS name
FROM events"""),
}


def sql(main: str, *views: str) -> str:
    """``main`` with the named views, and what they read, as common table expressions."""
    order: list[str] = []

    def add(name: str) -> None:
        for dep in VIEWS[name][0]:
            add(dep)
        if name not in order:
            order.append(name)

    for name in views:
        add(name)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1].strip()})" for n in order)
    return (f"WITH {ctes}\n" if ctes else "") + main.strip()
