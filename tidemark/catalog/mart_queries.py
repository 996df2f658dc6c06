"""Marts, joins, aggregates, ordered results, set operations and charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.catalog.base import AS_OF, Inputs, sql
from tidemark.functions import scalar as S
from tidemark.functions.metric_layer import DATASETS, aggregate_query, raw_query
from tidemark.operators import aggregates as A
from tidemark.operators import joins as J
from tidemark.operators import topk as K
from tidemark.plans import charts, marts
from tidemark.plans.layout import lay_out

MART = "day, category, orders, items, revenue"

MART_SQL_TEXT = """
SELECT to_date(o.created_at) AS day, p.category, count(DISTINCT o.order_id) AS orders,
  CAST(sum(i.quantity) AS BIGINT) AS items,
  CAST(sum(CAST(i.quantity * i.unit_price AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS revenue
FROM {items} i JOIN {orders} o ON o.order_id = i.order_id JOIN {products} p ON p.product_id = i.product_id
WHERE o.status <> 'cancelled'
GROUP BY to_date(o.created_at), p.category
"""


@query("daily_sales_by_category", sql(f"SELECT {MART} FROM daily_sales", "daily_sales"))
def _(x: Inputs):
    return x.daily_sales


@query("daily_sales_of_laid_out_orders", sql(f"SELECT {MART} FROM daily_sales", "daily_sales"))
def _(x: Inputs):
    """Lines and orders laid out once in common buckets: their join shuffles neither side."""
    root = x.scratch("layout")
    laid = lay_out(
        x.items("order_item_id", "order_id", "product_id", "quantity", "unit_price"),
        x.orders("order_id", "status", "created_at").filter("status <> 'cancelled'"),
        "order_id", "order_item_id", 16, root, root.rsplit("/", 1)[-1].replace("-", "_"),
        rows_per_split=4)  # the orders here are small; this splits every one with more than four lines
    sold = laid.join(x.spark).join(x.products("product_id", "category"), "product_id")
    return sold.groupBy(F.col("created_at").cast("date").alias("day"), "category").agg(
        F.count_distinct("order_id").alias("orders"), F.sum("quantity").cast("bigint").alias("items"),
        F.sum(S.line_total("quantity", "unit_price")).cast("decimal(18,2)").alias("revenue"))


@query("daily_sales_one_day", sql(f"SELECT {MART} FROM daily_sales WHERE day = DATE '1997-03-15'", "daily_sales"))
def _(x: Inputs):
    return marts.daily_sales_of_day({n: x.log(n) for n in ("orders", "order_items", "products")}, "1997-03-15")


@query("daily_sales_filtered_to_a_day", sql(
    f"SELECT {MART} FROM daily_sales WHERE day = DATE '1997-03-16'", "daily_sales"))
def _(x: Inputs):
    """The same from current staging models, where the day filter comes after the collapse."""
    return marts.daily_sales(
        x.items("order_item_id", "order_id", "product_id", "quantity", "unit_price"),
        x.orders("order_id", "status", "created_at"), x.products("product_id", "category"), "1997-03-16")


def sql_mart(x: Inputs, written: dict[str, DataFrame] | None = None):
    """The sales mart a second time, as SQL text over the same staging models, or over those already written."""
    if written is not None:
        return x.spark.sql(
            MART_SQL_TEXT, items=written["stg_order_items"], orders=written["stg_orders"], products=written["stg_products"])
    return x.spark.sql(
        MART_SQL_TEXT,
        items=x.items("order_item_id", "order_id", "product_id", "quantity", "unit_price"),
        orders=x.orders("order_id", "status", "created_at"), products=x.products("product_id", "category"))


@query("daily_sales_as_sql_text", sql(f"SELECT {MART} FROM daily_sales", "daily_sales"))
def _(x: Inputs):
    return sql_mart(x)


@query("customer_order_summary", sql("SELECT * FROM customer_summary", "customer_summary"))
def _(x: Inputs):
    return x.summary


@query("recon_orders_by_source", sql("SELECT * FROM recon", "recon"))
def _(x: Inputs):
    return x.recon


@query("customer_order_summary_stamped", sql(
    "SELECT *, TIMESTAMP '1999-01-02 03:04:05' AS computed_at FROM customer_summary", "customer_summary"))
def _(x: Inputs):
    return marts.customer_summary(
        x.customers("customer_id", "country_code", "signup_date"),
        x.orders("order_id", "customer_id", "status", "total_amount", "created_at"),
        x.items("order_item_id", "order_id", "quantity"), AS_OF, computed_at="1999-01-02 03:04:05")


@query("recon_orders_stamped", sql("SELECT *, TIMESTAMP '1999-01-02 03:04:05' AS checked_at FROM recon", "recon"))
def _(x: Inputs):
    return marts.reconcile(x.control(), x.orders("order_id", "total_amount", "created_at"), x.lake_staged(),
                       checked_at="1999-01-02 03:04:05")


# joins

@query("items_with_orders", sql("""
SELECT i.order_item_id, i.order_id, o.order_date, i.line_total
FROM cur_items i JOIN cur_orders o ON o.order_id = i.order_id""", "cur_items", "cur_orders"))
def _(x: Inputs):
    return x.items("order_item_id", "order_id", "line_total").join(
        x.orders("order_id", "order_date"), "order_id")


@query("items_with_category", sql("""
SELECT i.order_item_id, p.category, i.line_total
FROM cur_items i JOIN cur_products p ON p.product_id = i.product_id""", "cur_items", "cur_products"))
def _(x: Inputs):
    return x.items("order_item_id", "product_id", "line_total").join(
        x.products("product_id", "category"), "product_id").drop("product_id")


@query("customers_with_first_order", sql("""
SELECT c.customer_id, o.first_order FROM cur_customers c
LEFT JOIN (SELECT customer_id, min(order_date) AS first_order FROM cur_orders GROUP BY 1) o USING (customer_id)""",
    "cur_customers", "cur_orders"))
def _(x: Inputs):
    """Aggregate first, then left-join, so that no customer row is repeated."""
    first = x.orders("customer_id", "order_date").groupBy("customer_id").agg(F.min("order_date").alias("first_order"))
    return x.customers("customer_id").join(first, "customer_id", "left")


@query("customers_without_orders", sql("""
SELECT customer_id, email FROM cur_customers
WHERE customer_id NOT IN (SELECT customer_id FROM cur_orders)""", "cur_customers", "cur_orders"))
def _(x: Inputs):
    return J.without(x.customers("customer_id", "email"), x.orders("customer_id"), ["customer_id"])


@query("orders_with_lines", sql("""
SELECT order_id, status FROM cur_orders WHERE order_id IN (SELECT order_id FROM cur_items)""",
    "cur_orders", "cur_items"))
def _(x: Inputs):
    return J.with_match(x.orders("order_id", "status"), x.items("order_id"), ["order_id"])


@query("spine_of_daily_totals", sql("""
SELECT order_date, pg_orders, pg_revenue, cdc_orders, cdc_revenue, s3_orders, s3_revenue FROM recon""", "recon"))
def _(x: Inputs):
    day = F.to_date("created_at")
    return J.spine_join({
        "pg": marts.day_totals(x.control(), day, "pg"),
        "cdc": marts.day_totals(x.orders("order_id", "total_amount", "created_at"), day, "cdc"),
        "s3": marts.day_totals(x.lake_staged(), day, "s3"),
    }, ["order_date"])


@query("compare_control_with_warehouse", sql("""
SELECT order_id, a_status, b_status, a_total_amount, b_total_amount, diff FROM (
  SELECT coalesce(a.order_id, b.order_id) AS order_id, a.status AS a_status, b.status AS b_status,
    a.total_amount AS a_total_amount, b.total_amount AS b_total_amount,
    CASE WHEN b.order_id IS NULL THEN 'only in a' WHEN a.order_id IS NULL THEN 'only in b'
      WHEN a.status IS DISTINCT FROM b.status OR a.total_amount IS DISTINCT FROM b.total_amount THEN 'differs' END AS diff
  FROM orders_control a FULL JOIN cur_orders b ON a.order_id = b.order_id) q
WHERE diff IS NOT NULL""", "orders_control", "cur_orders"))
def _(x: Inputs):
    return J.compare(x.control(), x.orders("order_id", "status", "total_amount"), ["order_id"],
                     ["status", "total_amount"])


@query("compare_two_mart_versions", sql(f"""
SELECT day, category, orders AS a_orders, CASE WHEN items > 100 THEN orders + 1 ELSE orders END AS b_orders,
  revenue AS a_revenue, revenue AS b_revenue, 'differs' AS diff FROM daily_sales WHERE items > 100""", "daily_sales"))
def _(x: Inputs):
    """The two implementations compared after one of them was disturbed on busy rows."""
    disturbed = sql_mart(x).withColumn(
        "orders", F.when(F.col("items") > 100, F.col("orders") + 1).otherwise(F.col("orders")))
    return J.compare(x.daily_sales, disturbed, ["day", "category"], ["orders", "revenue"])


# aggregates

@query("distinct_categories", sql("SELECT count(DISTINCT category) AS categories FROM cur_products", "cur_products"))
def _(x: Inputs):
    return x.products("category").agg(F.count_distinct("category").alias("categories"))


@query("conditional_counts_by_country", sql("""
SELECT country_code, count(*) AS customers, count(CASE WHEN orders_placed > 0 THEN 1 END) AS buyers,
  CAST(sum(CASE WHEN orders_cancelled > 0 THEN lifetime_value END) AS DECIMAL(38,2)) AS value_after_cancel
FROM customer_summary GROUP BY country_code""", "customer_summary"))
def _(x: Inputs):
    return x.summary.groupBy("country_code").agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(F.col("orders_placed") > 0).alias("buyers"),
        F.sum(F.when(F.col("orders_cancelled") > 0, F.col("lifetime_value"))).cast("decimal(38,2)")
        .alias("value_after_cancel"))


@query("average_order_value_by_category", sql("""
SELECT category, CAST(sum(revenue) AS DOUBLE) / NULLIF(CAST(sum(orders) AS DOUBLE), 0) AS avg_order_value
FROM daily_sales GROUP BY category""", "daily_sales"))
def _(x: Inputs):
    return x.daily_sales.groupBy("category").agg(S.ratio_of_sums("revenue", "orders").alias("avg_order_value"))


@query("order_extremes_by_status", sql("""
SELECT status, min(total_amount) AS lowest, max(total_amount) AS highest, count(*) AS n, count(age_seconds) AS moved,
  CAST(sum(total_amount) AS DECIMAL(38,2)) AS total FROM cur_orders GROUP BY status""", "cur_orders"))
def _(x: Inputs):
    return x.orders("status", "total_amount", "age_seconds").groupBy("status").agg(
        F.min("total_amount").alias("lowest"), F.max("total_amount").alias("highest"),
        F.count(F.lit(1)).alias("n"), F.count("age_seconds").alias("moved"),
        F.sum("total_amount").cast("decimal(38,2)").alias("total"))


@query("total_revenue_of_day", sql("""
SELECT CAST(sum(revenue) AS DECIMAL(38,2)) AS revenue FROM daily_sales WHERE day = DATE '1997-03-15'""", "daily_sales"))
def _(x: Inputs):
    return x.daily_sales.filter(S.in_day("day", "1997-03-15")).agg(
        F.sum("revenue").cast("decimal(38,2)").alias("revenue"))


@query("duplicate_line_keys", sql("""
SELECT order_item_id, count(*) AS n FROM order_items_log GROUP BY 1 HAVING count(*) > 1""", "order_items_log"))
def _(x: Inputs):
    from tidemark.operators.quality import duplicates

    return duplicates(x.log("order_items"), ["order_item_id"])


@query("largest_copy_per_group", sql("""
SELECT "group", max(v) AS value, count(*) AS replicas FROM (
  SELECT event_type AS "group", user_id % 4 AS replica, max(event_id) AS v FROM events GROUP BY 1, 2) q GROUP BY 1"""))
def _(x: Inputs):
    copies = x.table("events").select(
        F.col("event_type").alias("group"), (F.col("user_id") % 4).alias("replica"), "event_id")
    return A.dedup_then_sum(copies, "group", "replica", "event_id")


@query("total_without_copies", sql("""
SELECT CAST(sum(v) AS BIGINT) AS value FROM (SELECT event_type, max(event_id) AS v FROM events GROUP BY 1) q"""))
def _(x: Inputs):
    copies = x.table("events").select("event_type", (F.col("user_id") % 4).alias("replica"), "event_id")
    return A.total_over_groups(copies, "event_type", "replica", "event_id")


@query("status_breakdown", sql("SELECT status, count(*) AS n FROM cur_orders GROUP BY status", "cur_orders"))
def _(x: Inputs):
    return A.status_breakdown(x.orders("status"))


@query("table_counts", sql("""
SELECT 'customers' AS "table", count(*) AS rows FROM cur_customers UNION ALL SELECT 'products', count(*) FROM cur_products
UNION ALL SELECT 'orders', count(*) FROM cur_orders UNION ALL SELECT 'order_items', count(*) FROM cur_items""",
    "cur_customers", "cur_products", "cur_orders", "cur_items"))
def _(x: Inputs):
    return A.table_counts({
        "customers": x.customers("customer_id"), "products": x.products("product_id"),
        "orders": x.orders("order_id"), "order_items": x.items("order_item_id")})


@query("day_last_change", sql("""
SELECT order_date AS day, max(updated_at) AS last_changed_at FROM cur_orders GROUP BY 1""", "cur_orders"))
def _(x: Inputs):
    return A.day_last_change(x.orders("order_date", "updated_at"))


@query("closed_days", sql("""
SELECT order_date AS day, max(updated_at) AS last_changed_at FROM cur_orders GROUP BY 1
HAVING max(updated_at) < TIMESTAMP '1997-07-01'""", "cur_orders"))
def _(x: Inputs):
    return A.closed_days(x.orders("order_date", "updated_at"), F.lit("1997-07-01").cast("timestamp_ntz"))


@query("ingest_progress", sql("""
SELECT "table", count(*) AS consumers, CAST(sum(m) AS BIGINT) AS messages_read, max(p) AS last_poll FROM (
  SELECT event_type AS "table", user_id % 8 AS consumer, max(event_id) AS m, max(ts) AS p FROM events GROUP BY 1, 2) q
GROUP BY 1"""))
def _(x: Inputs):
    polls = x.table("events").select(
        F.col("event_type").alias("table"), (F.col("user_id") % 8).alias("consumer"), "event_id", "ts")
    return A.ingest_progress(polls, "table", "event_id", "ts", "consumer")


@query("order_age_quantiles", sql("""
SELECT status,
  min(CASE WHEN r >= ceil(0.5::DOUBLE * n) THEN age_seconds END) AS p50,
  min(CASE WHEN r >= ceil(0.9::DOUBLE * n) THEN age_seconds END) AS p90,
  min(CASE WHEN r >= ceil(0.99::DOUBLE * n) THEN age_seconds END) AS p99
FROM (SELECT status, age_seconds, row_number() OVER (PARTITION BY status ORDER BY age_seconds) AS r,
        count(*) OVER (PARTITION BY status) AS n FROM cur_orders WHERE age_seconds IS NOT NULL) q
GROUP BY status""", "cur_orders"))
def _(x: Inputs):
    return A.quantiles(x.orders("status", "age_seconds"), "age_seconds", ["status"])


@query("event_value_quantiles", sql("""
SELECT event_type,
  min(CASE WHEN r >= ceil(0.5::DOUBLE * n) THEN value END) AS p50,
  min(CASE WHEN r >= ceil(0.9::DOUBLE * n) THEN value END) AS p90,
  min(CASE WHEN r >= ceil(0.99::DOUBLE * n) THEN value END) AS p99
FROM (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS r,
        count(*) OVER (PARTITION BY event_type) AS n FROM events) q
GROUP BY event_type"""))
def _(x: Inputs):
    return A.quantiles(x.table("events"), "value", ["event_type"])


# ordered results and samples

@query("mart_of_one_day", sql(f"SELECT {MART} FROM daily_sales WHERE day = DATE '1997-03-15'", "daily_sales"))
def _(x: Inputs):
    return K.mart_day(x.daily_sales, "1997-03-15")


@query("mart_newest_rows", sql(
    f"SELECT {MART} FROM daily_sales ORDER BY day DESC, revenue DESC, category LIMIT 20", "daily_sales"))
def _(x: Inputs):
    return K.mart_recent(x.daily_sales)


@query("top_customers", sql("""
SELECT customer_id, country_code, lifetime_value FROM customer_summary
ORDER BY lifetime_value DESC, customer_id LIMIT 25""", "customer_summary"))
def _(x: Inputs):
    return K.top_customers(x.summary)


@query("recon_newest_days", sql("SELECT * FROM recon ORDER BY order_date DESC LIMIT 30", "recon"))
def _(x: Inputs):
    return K.recon_recent(x.recon)


@query("top_categories_per_day", sql("""
SELECT day, category, revenue, CAST(rank AS INT) AS rank FROM (SELECT day, category, revenue,
  row_number() OVER (PARTITION BY day ORDER BY revenue DESC, category) AS rank FROM daily_sales) q
WHERE rank <= 2""", "daily_sales"))
def _(x: Inputs):
    return K.topk(x.daily_sales.select("day", "category", "revenue"), 2, "revenue", ["day"], ["category"])


@query("latest_day_with_orders", sql("SELECT max(order_date) AS day FROM cur_orders", "cur_orders"))
def _(x: Inputs):
    return K.latest_day(x.orders("created_at"))


@query("sample_of_products", sql("""
SELECT product_id, category FROM cur_products
ORDER BY md5(concat(CAST(product_id AS VARCHAR), ':', '7')), product_id LIMIT 50""", "cur_products"))
def _(x: Inputs):
    return K.sample_k(x.products("product_id", "category"), 50, "product_id", seed=7)


# set operations

@query("all_order_days", sql("""
SELECT CAST(created_at AS DATE) AS order_date FROM orders_control UNION SELECT order_date FROM cur_orders
UNION SELECT order_date FROM lake_staged""", "orders_control", "cur_orders", "lake_staged"))
def _(x: Inputs):
    day = F.to_date("created_at").alias("order_date")
    return (
        x.control().select(day).union(x.orders("order_date")).union(x.lake_staged().select(day)).distinct()
    )


@query("all_routes_stacked", sql("""
SELECT 'pg' AS route, order_id, total_amount FROM orders_control
UNION ALL SELECT 'cdc', order_id, total_amount FROM cur_orders""", "orders_control", "cur_orders"))
def _(x: Inputs):
    cols = ["order_id", "total_amount"]
    return x.control().select(F.lit("pg").alias("route"), *cols).unionByName(
        x.orders(*cols).select(F.lit("cdc").alias("route"), *cols))


# metric layer

def _metrics_sql(view: str, exprs: str) -> str:
    return sql(f"SELECT {exprs} FROM {view}", view)


@query("sales_metrics", _metrics_sql("daily_sales", """
CAST(sum(revenue) AS DECIMAL(38,2)) AS revenue, CAST(sum(orders) AS BIGINT) AS orders,
CAST(sum(items) AS BIGINT) AS items,
CAST(sum(revenue) AS DOUBLE) / NULLIF(CAST(sum(orders) AS DOUBLE), 0) AS avg_order_value"""))
def _(x: Inputs):
    name = "daily_sales_by_category"
    out = aggregate_query(x.daily_sales, name, list(DATASETS[name]))
    return out.withColumn("revenue", F.col("revenue").cast("decimal(38,2)"))


@query("customer_metrics", _metrics_sql("customer_summary", """
count(*) AS customers, CAST(sum(lifetime_value) AS DECIMAL(38,2)) AS lifetime_value,
count(CASE WHEN orders_placed > 0 THEN 1 END) AS buyers"""))
def _(x: Inputs):
    name = "customer_order_summary"
    out = aggregate_query(x.summary, name, list(DATASETS[name]))
    return out.withColumn("lifetime_value", F.col("lifetime_value").cast("decimal(38,2)"))


@query("recon_metrics", _metrics_sql("recon", """
count(*) AS days_checked, count(CASE WHEN verdict = 'DIVERGED' THEN 1 END) AS days_diverged"""))
def _(x: Inputs):
    name = "recon_orders_by_source"
    return aggregate_query(x.recon, name, list(DATASETS[name]))


@query("revenue_by_month", sql("""
SELECT CAST(date_trunc('month', day) AS DATE) AS day, CAST(sum(revenue) AS DECIMAL(38,2)) AS revenue
FROM daily_sales GROUP BY 1""", "daily_sales"))
def _(x: Inputs):
    out = aggregate_query(x.daily_sales, "daily_sales_by_category", ["revenue"], time_column="day", grain="P1M")
    return out.withColumn("revenue", F.col("revenue").cast("decimal(38,2)"))


@query("raw_rows_newest_orders", sql("""
SELECT order_id, status, total_amount FROM cur_orders ORDER BY created_at DESC, order_id LIMIT 100""", "cur_orders"))
def _(x: Inputs):
    rows = raw_query(x.orders("order_id", "status", "total_amount", "created_at"),
                     ["order_id", "status", "total_amount", "created_at"],
                     [("created_at", True), ("order_id", False)], limit=100)
    return rows.drop("created_at")


CHART_SQL = {
    "Revenue": ("daily_sales", "SELECT CAST(sum(revenue) AS DECIMAL(38,2)) AS revenue FROM daily_sales"),
    "Orders": ("daily_sales", "SELECT CAST(sum(orders) AS BIGINT) AS orders FROM daily_sales"),
    "Average order value": ("daily_sales", """
SELECT CAST(sum(revenue) AS DOUBLE) / NULLIF(CAST(sum(orders) AS DOUBLE), 0) AS avg_order_value FROM daily_sales"""),
    "Customers who have ordered": ("customer_summary", """
SELECT count(CASE WHEN orders_placed > 0 THEN 1 END) AS buyers FROM customer_summary"""),
    "Revenue by day": ("daily_sales", """
SELECT day, CAST(sum(revenue) AS DECIMAL(38,2)) AS revenue FROM daily_sales GROUP BY day"""),
    "Revenue by category": ("daily_sales", """
SELECT category, CAST(sum(revenue) AS DECIMAL(38,2)) AS revenue FROM daily_sales GROUP BY category"""),
    "Top customers": ("customer_summary", """
SELECT customer_id, country_code, CAST(lifetime_value AS DECIMAL(38,2)) AS lifetime_value FROM customer_summary
ORDER BY lifetime_value DESC, customer_id LIMIT 25"""),
    "Warehouse against its source": ("recon", """
SELECT order_date, pg_orders, cdc_orders, s3_orders, cdc_minus_pg, verdict FROM recon ORDER BY order_date DESC LIMIT 30"""),
}
MART_OF = {"daily_sales_by_category": "daily_sales", "customer_order_summary": "summary", "recon_orders_by_source": "recon"}


def _register_chart(title: str, view: str, text: str) -> None:
    @query("chart_" + title.lower().replace(" ", "_"), sql(text, view))
    def _(x: Inputs):
        dataset = charts.CHARTS[title]["dataset"]
        out = charts.chart(title, {dataset: getattr(x, MART_OF[dataset])})
        for c in ("revenue", "lifetime_value"):
            if c in out.columns:
                out = out.withColumn(c, F.col(c).cast("decimal(38,2)"))
        return out


for _title, (_view, _text) in CHART_SQL.items():
    _register_chart(_title, _view, _text)


# scalar functions

@query("scalar_functions_of_orders", sql("""
SELECT order_id, CAST(CAST(total_amount AS VARCHAR) AS DECIMAL(12,2)) AS amount_again,
  date_trunc('millisecond', updated_at) AS updated_ms, CASE WHEN is_cancelled = 1 THEN 'no' ELSE 'yes' END AS counts,
  CASE WHEN total_amount < 1000 THEN 'small' WHEN total_amount < 100000 THEN 'medium' ELSE 'large' END AS size,
  order_date, order_hour, age_seconds, CAST(date_diff('day', order_date, DATE '1999-01-01') AS INT) AS days_ago,
  CAST(year(created_at) * 100 + month(created_at) AS INT) AS month_key, order_id // 1000000 AS id_block,
  abs(order_id - customer_id) AS distance, customer_id - order_id AS signed_gap,
  concat(CAST(customer_id AS VARCHAR), '/', CAST(order_id AS VARCHAR)) AS identity,
  greatest(order_hour, 6) AS hour_from_six,
  CAST(total_amount AS DOUBLE) / NULLIF(CAST(order_hour AS DOUBLE), 0.0) AS per_hour,
  CAST(order_date AS VARCHAR) AS dt_text, TRY_CAST(CAST(order_date AS VARCHAR) AS DATE) AS dt_of_path,
  CAST(NULL AS DATE) AS dt_of_bad_path, CAST(year(order_date) AS VARCHAR) AS year_text,
  order_hour > 12 AS late_poll, epoch_ms(source_ts) AS source_ms
FROM cur_orders""", "cur_orders"))
def _(x: Inputs):
    path = F.concat(F.lit("lake/orders/dt="), F.col("order_date").cast("string"), F.lit("/part-0.parquet"))
    midnight = S.ntz(F.col("order_date").cast("timestamp"))
    polls = F.array(midnight, midnight + F.make_dt_interval(hours=F.col("order_hour")))
    return x.orders().select(
        "order_id",
        S.money(F.col("total_amount").cast("string")).alias("amount_again"),
        S.ntz(S.iso_timestamp(F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))).alias("updated_ms"),
        F.when(F.col("is_cancelled") == 1, "no").otherwise("yes").alias("counts"),
        F.when(F.col("total_amount") < 1000, "small").when(F.col("total_amount") < 100000, "medium")
        .otherwise("large").alias("size"),
        "order_date", "order_hour", "age_seconds",
        S.days_since("order_date", F.lit("1999-01-01").cast("date")).alias("days_ago"),
        S.month_key("created_at").alias("month_key"),
        S.id_block("order_id").alias("id_block"),
        F.abs(F.col("order_id") - F.col("customer_id")).alias("distance"),
        S.signed_gap("customer_id", "order_id").alias("signed_gap"),
        S.identity("customer_id", "order_id").alias("identity"),
        S.at_least("order_hour", 6).alias("hour_from_six"),
        S.ratio("total_amount", "order_hour").alias("per_hour"),
        F.regexp_extract(path, r"dt=([^/]+)/", 1).alias("dt_text"),
        S.dt_from_path(path).alias("dt_of_path"),
        S.dt_from_path(F.regexp_replace(path, "dt=", "day=")).alias("dt_of_bad_path"),
        S.first_group(path, r"dt=(\d{4})").alias("year_text"),
        S.any_after(polls, midnight + F.expr("INTERVAL '14' HOUR"), "2 HOURS").alias("late_poll"),
        F.unix_millis(S.millis_timestamp(F.unix_millis(F.col("source_ts").cast("timestamp")))).alias("source_ms"),
    )


@query("placement_keeps_keys_together", sql("""
SELECT count(DISTINCT order_id) AS keys, CAST(16 AS BIGINT) AS buckets, true AS balanced FROM cur_items""", "cur_items"))
def _(x: Inputs):
    """The placement hash uses all sixteen buckets; none holds less than half or more than twice its share of keys."""
    per_bucket = x.items("order_id").select("order_id").distinct().groupBy(S.placement("order_id", 16).alias("b")).agg(
        F.count(F.lit(1)).alias("n"))
    share = F.sum("n") / 16
    return per_bucket.agg(F.sum("n").alias("keys"), F.count(F.lit(1)).alias("buckets"),
                          ((F.min("n") * 2 >= share) & (F.max("n") <= share * 2)).alias("balanced"))


@query("array_functions_of_consumers", sql("""
SELECT event_type, 'error ' || CAST(event_id AS VARCHAR) AS err FROM events WHERE event_type = 'error'
UNION ALL SELECT event_type, 'late ' || CAST(event_id AS VARCHAR) FROM events WHERE event_type = 'error' AND value > 50"""))
def _(x: Inputs):
    """One row per element of an array column; rows with an empty array give none."""
    eid = F.col("event_id").cast("string")
    texts = F.filter(F.array(
        F.when(F.col("event_type") == "error", F.concat(F.lit("error "), eid)),
        F.when((F.col("event_type") == "error") & (F.col("value") > 50), F.concat(F.lit("late "), eid)),
    ), lambda t: t.isNotNull())
    rows = x.table("events").select("event_type", texts.alias("texts")).filter(F.size("texts") > 0)
    return rows.select("event_type", F.explode("texts").alias("err"))
