"""Lake export, promotion, single-day rewrites, retention and the daily chain."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.catalog.base import STAGED_AT, Inputs, sql
from tidemark.plans import jobs, marts
from tidemark.plans.staging import stg_lake_orders, stg_orders
from tidemark.schemas import KEYS
from tidemark.sources import lake

DAYS = ["1997-03-14", "1997-03-15", "1997-03-16"]
DAY = DAYS[1]
EXPORT = "order_id, customer_id, status, total_amount, created_at, updated_at"
STAGED = """order_id, customer_id, status, is_cancelled, is_complete, total_amount, created_at, updated_at,
  order_date, order_hour, age_seconds, dt, staged_at"""


def _export(x: Inputs) -> str:
    """A raw layer holding every day of the current orders."""
    root = x.scratch("raw")
    jobs.export_all(x.orders(*jobs.EXPORT_COLUMNS), root)
    return root


@query("export_all_days", sql(f"SELECT {EXPORT}, order_date AS dt FROM cur_orders", "cur_orders"))
def _(x: Inputs):
    return lake.read_lake(x.spark, _export(x), "orders")


@query("promote_all_days", sql(f"SELECT {STAGED} FROM lake_staged", "lake_staged"))
def _(x: Inputs):
    """Every day raw to staged, each write read back and counted, then the staged model."""
    raw, staged = x.scratch("raw"), x.scratch("staged")
    lake.write_all(x.lake_raw(), raw, "orders")
    jobs.promote(x.spark, raw, staged, staged_at=STAGED_AT)
    return stg_lake_orders(x.spark, staged)


@query("promote_one_day", sql(f"""
SELECT order_id, status, CAST(created_at AS DATE) AS order_date, status = 'cancelled' AS is_cancelled,
  age_seconds, order_hour, order_date AS dt FROM cur_orders WHERE order_date = DATE '{DAY}'""", "cur_orders"))
def _(x: Inputs):
    raw, staged = _export(x), x.scratch("staged")
    jobs.promote(x.spark, raw, staged, day=DAY, staged_at=STAGED_AT)
    return lake.read_lake(x.spark, staged, "orders").select(
        "order_id", "status", "order_date", "is_cancelled", "age_seconds", "order_hour", "dt")


@query("export_one_day", sql(f"SELECT {EXPORT} FROM cur_orders WHERE order_date = DATE '{DAY}'", "cur_orders"))
def _(x: Inputs):
    root = x.scratch("raw")
    jobs.export_day(x.orders_of(DAY, *jobs.EXPORT_COLUMNS), root, DAY)
    return lake.read_lake(x.spark, root, "orders", [DAY]).drop("dt")


@query("export_dry_run", sql(f"SELECT {EXPORT} FROM cur_orders WHERE order_date = DATE '{DAY}'", "cur_orders"))
def _(x: Inputs):
    return jobs.export_day(x.orders_of(DAY, *jobs.EXPORT_COLUMNS), "", DAY, dry_run=True)


@query("export_empty_day", sql(
    "SELECT count(*) AS rows, 'empty' AS status FROM cur_orders WHERE order_date = DATE '1980-01-01'", "cur_orders"))
def _(x: Inputs):
    root = x.scratch("raw")
    done = jobs.export_day(x.orders_of("1980-01-01", *jobs.EXPORT_COLUMNS), root, "1980-01-01")
    return lake.read_lake(x.spark, root, "orders", ["1980-01-01"]).agg(F.count(F.lit(1)).alias("rows"), F.lit(done.status).alias("status"))


@query("lake_days_pruned", sql(f"""
SELECT {EXPORT}, order_date AS dt FROM cur_orders WHERE order_date IN (DATE '{DAYS[0]}', DATE '{DAYS[2]}')""", "cur_orders"))
def _(x: Inputs):
    return lake.read_lake(x.spark, _export(x), "orders", [DAYS[0], DAYS[2]])


@query("lake_dates_from_paths", sql("SELECT order_id, order_date AS dt FROM cur_orders", "cur_orders"))
def _(x: Inputs):
    return lake.read_lake_files(x.spark, _export(x), "orders").select("order_id", "dt")


@query("replace_one_lake_day", sql(f"""
SELECT order_id, status, order_date AS dt FROM cur_orders
WHERE order_date <> DATE '{DAY}' OR status = 'delivered'""", "cur_orders"))
def _(x: Inputs):
    """One day is written again with fewer rows; all other days stay as they were."""
    root = _export(x)
    rows = jobs.export_rows(x.orders_of(DAY, *jobs.EXPORT_COLUMNS), DAY).filter(F.col("status") == "delivered")
    lake.write_partition(rows, root, "orders", DAY)
    return lake.read_lake(x.spark, root, "orders").select("order_id", "status", "dt")


@query("materialized_table", sql("SELECT status, count(*) AS n FROM cur_orders GROUP BY 1", "cur_orders"))
def _(x: Inputs):
    table = jobs.materialize(x.orders(), "stg_orders_table", "table", x.scratch("models"))
    return table.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("materialized_view", sql("SELECT status, count(*) AS n FROM cur_orders GROUP BY 1", "cur_orders"))
def _(x: Inputs):
    view = jobs.materialize(x.orders("status"), "stg_orders_view", "view")
    return view.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("retention_plan", sql("""
SELECT concat('raw/orders/dt=', CAST(order_date AS VARCHAR)) AS path,
  CASE WHEN date_diff('day', order_date, DATE '1998-12-31') > 30 THEN 'expire' ELSE 'keep' END AS action
FROM (SELECT DISTINCT order_date FROM cur_orders) q
UNION ALL
SELECT concat('raw/orders/dt=', CAST(order_date AS VARCHAR), '?version=old'),
  CASE WHEN date_diff('day', CAST(superseded AS DATE), DATE '1998-12-31') > 7 THEN 'expire' ELSE 'keep' END
FROM (SELECT order_date, max(updated_at) AS superseded FROM cur_orders GROUP BY 1) q""", "cur_orders"))
def _(x: Inputs):
    by_day = x.orders("order_date", "updated_at").groupBy(F.col("order_date").alias("dt")).agg(
        F.to_date(F.max("updated_at")).alias("superseded_at"))
    path = F.concat(F.lit("raw/orders/dt="), F.col("dt").cast("string"))
    current = by_day.select(path.alias("path"), "dt", F.lit(None).cast("date").alias("superseded_at"))
    old = by_day.select(F.concat(path, F.lit("?version=old")).alias("path"), "dt", "superseded_at")
    return lake.retention_plan(current.unionByName(old), "1998-12-31")


@query("rows_per_lake_day", sql("SELECT dt, count(*) AS rows FROM lake_raw GROUP BY dt", "lake_raw"))
def _(x: Inputs):
    return lake.day_report(x.lake_raw())


@query("rows_over_partitions", sql(
    "SELECT CAST(count(*) AS BIGINT) AS rows, CAST(7 AS BIGINT) AS partitions, true AS even FROM cur_orders", "cur_orders"))
def _(x: Inputs):
    """Seven partitions dealt by turns hold all rows, none more than a tenth above its share."""
    spread = lake.partition_report(x.orders("order_id").repartition(7))
    return spread.agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("partitions"),
                      (F.max("rows") * 70 <= F.sum("rows") * 11).alias("even"))


def _sales(x: Inputs, day: str):
    return marts.daily_sales_of_day({n: x.log(n) for n in KEYS}, day)


@query("mart_day_recomputed", sql(f"""
SELECT day, category, orders, items, revenue FROM daily_sales
WHERE day <> DATE '{DAY}' OR items > 50""", "daily_sales"))
def _(x: Inputs):
    """Writing a day of the whole mart again leaves no row of its first result and all other days."""
    root = x.scratch("curated")
    jobs.rebuild_mart(x.daily_sales, root)
    jobs.upsert_mart_day(_sales(x, DAY).filter(F.col("items") > 50), root, DAY)
    return jobs.read_mart(x.spark, root)


CHAIN_SQL = """
SELECT 'export' AS step, count(*) AS rows, '{s}' AS status FROM cur_orders WHERE order_date = DATE '{d}'
{staged}UNION ALL SELECT 'mart', count(*), '{s}' FROM daily_sales WHERE day = DATE '{d}'"""


@query("daily_chain", sql(CHAIN_SQL.format(
    s="verified", d=DAY,
    staged=f"UNION ALL SELECT 'staged', count(*), 'verified' FROM cur_orders WHERE order_date = DATE '{DAY}'\n"
    "UNION ALL SELECT 'checks', 8, 'passed'\n"),
    "cur_orders", "daily_sales"))
def _(x: Inputs):
    return jobs.run_day(x.spark, {n: x.log(n) for n in KEYS}, x.scratch("chain"), DAY)


@query("daily_chain_dry_run", sql(CHAIN_SQL.format(
    s="dry run", d=DAY, staged=f"UNION ALL SELECT 'staged', count(*), 'dry run' FROM cur_orders WHERE order_date = DATE '{DAY}'\n"), "cur_orders", "daily_sales"))
def _(x: Inputs):
    return jobs.run_day(x.spark, {n: x.log(n) for n in KEYS}, "", DAY, dry_run=True)


@query("rebuilt_mart", sql("SELECT day, category, orders, items, revenue FROM daily_sales", "daily_sales"))
def _(x: Inputs):
    root = x.scratch("curated")
    jobs.rebuild_mart(x.daily_sales, root)
    return jobs.read_mart(x.spark, root)


@query("mart_after_three_ranges", sql("SELECT day, category, orders, items, revenue FROM daily_sales", "daily_sales"))
def _(x: Inputs):
    """The mart of an older position, brought forward twice: only days that the new versions touch are made again."""
    root, logs = x.scratch("curated"), {n: x.log(n) for n in ("orders", "order_items", "products")}
    last = logs["orders"].agg(F.max("source_lsn")).first()[0]
    steps = [last - last // 200, last - last // 400, last]

    def upto(position: int):
        return {**logs, "orders": logs["orders"].filter(F.col("source_lsn") <= position)}

    first = upto(steps[0])
    orders = stg_orders(first["orders"], ["order_id", "status", "created_at"])
    jobs.rebuild_mart(marts.daily_sales(x.items(), orders, x.products("product_id", "category")), root)
    for old, new in zip(steps, steps[1:]):
        jobs.refresh_mart(x.spark, upto(new), root, {"orders": old})
    return jobs.read_mart(x.spark, root)


@query("failed_publication", sql("SELECT order_id, status, order_date AS dt, true AS refused FROM cur_orders", "cur_orders"))
def _(x: Inputs):
    """A day whose new rows fail their check is not published: all days read as before."""
    root = _export(x)

    def delivered_only(back):
        if not back.filter("status <> 'delivered'").isEmpty():
            raise lake.VerificationError("orders that are not delivered")

    try:
        lake.write_partition(jobs.export_rows(x.orders_of(DAY, *jobs.EXPORT_COLUMNS), DAY).withColumn("status", F.lit("lost")),
                             root, "orders", DAY, [delivered_only])
        refused = False
    except lake.VerificationError:
        refused = True
    return lake.read_lake(x.spark, root, "orders").select("order_id", "status", "dt", F.lit(refused).alias("refused"))


@query("retention_of_rewritten_lake", sql("""
SELECT order_date AS dt, false AS replaced,
  CASE WHEN date_diff('day', order_date, DATE '1998-12-31') > 30 THEN 'expire' ELSE 'keep' END AS action, true AS has_bytes
FROM (SELECT DISTINCT order_date FROM cur_orders) q
UNION ALL
SELECT order_date, true, CASE WHEN year(order_date) = 1997 THEN 'expire' ELSE 'keep' END, true
FROM (SELECT DISTINCT order_date FROM cur_orders WHERE year(order_date) IN (1997, 1998)) q""", "cur_orders"))
def _(x: Inputs):
    """A lake written once and two years of it again, eleven days and one day ago: its own folders as the plan's input."""
    root, orders = x.scratch("raw"), jobs.dated(x.orders(*jobs.EXPORT_COLUMNS))
    days = {y: [str(r.dt) for r in orders.filter(F.year("dt") == y).select("dt").distinct().collect()] for y in (1997, 1998)}
    lake.write_all(orders, root, "orders", at_ms=_millis("1998-12-01"))
    lake.write_days(orders.filter(F.year("dt") == 1997), root, "orders", days[1997], _millis("1998-12-20"))
    lake.write_days(orders.filter(F.year("dt") == 1998), root, "orders", days[1998], _millis("1998-12-30"))
    named = lake.lake_versions(x.spark, root, "orders")
    return named.join(lake.retention_plan(named, "1998-12-31"), "path").select(
        "dt", F.col("superseded_at").isNotNull().alias("replaced"), "action", (F.col("bytes") > 0).alias("has_bytes"))


def _millis(day: str) -> int:
    return int(dt.datetime.fromisoformat(day + "T12:00:00+00:00").timestamp() * 1000)


@query("compacted_lake_day_files", sql("""
SELECT order_date AS dt, count(*) AS rows, true AS fewer, true AS bounded FROM cur_orders GROUP BY order_date""", "cur_orders"))
def _(x: Inputs):
    """Every day in four files first, then packed: the same rows in fewer groups, none above twice the target."""
    root, orders = x.scratch("raw"), jobs.dated(x.orders(*jobs.EXPORT_COLUMNS))
    spread = orders.repartition(4, F.col("order_id"))
    lake.manifest.publish(spread, lake.entity_path(root, "orders"), "dt")
    groups = lake.compaction_groups(lake.lake_files(x.spark, root, "orders"), target_bytes=1 << 20)
    packed = groups.groupBy("dt").agg(
        (F.count_distinct("group") <= F.count(F.lit(1))).alias("fewer"),
        (F.sum("length") <= (F.max("group") + 2) * (1 << 20)).alias("bounded"))
    return lake.day_report(lake.read_lake(x.spark, root, "orders")).join(packed, "dt").select("dt", "rows", "fewer", "bounded")
