"""Batch jobs: export, staging of the lake, mart refresh, and a day's chain of them."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalar as S
from tidemark.operators.quality import landed, summary
from tidemark.plans import checks, marts, staging
from tidemark.session import shared_dir
from tidemark.sources import lake, manifest
from tidemark.sources.lake import VerificationError, WriteReport

EXPORT_COLUMNS = ["order_id", "customer_id", "status", "total_amount", "created_at", "updated_at"]


def materialize(df: DataFrame, name: str, kind: str, root: str | None = None) -> DataFrame:
    """A model as a view (recomputed by every reader) or as a table (computed once)."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    path = f"{root.rstrip('/')}/{name}"
    lake.write_verified(df, path)
    return df.sparkSession.read.parquet(path)


def export_rows(orders: DataFrame, day: str) -> DataFrame:
    """Current orders of one day as the raw layer holds them."""
    return orders.select(*EXPORT_COLUMNS).filter(S.in_day("created_at", day))


def export_day(orders: DataFrame, root: str, day: str, dry_run: bool = False):
    """Write one day of current orders to the raw layer, sorted by key inside each file.

    A day without orders writes an empty partition. A dry run returns the rows.
    """
    rows = export_rows(orders, day)
    if dry_run:
        return rows
    return lake.write_partition(rows.sortWithinPartitions("order_id"), root, "orders", day)


def dated(orders: DataFrame) -> DataFrame:
    """Current orders as the raw layer holds them, with their day."""
    return orders.select(*EXPORT_COLUMNS).withColumn("dt", F.to_date("created_at"))


def export_all(orders: DataFrame, root: str) -> WriteReport:
    """Write every day of current orders to the raw layer."""
    return lake.write_all(dated(orders), root, "orders")


def promote(
    spark: SparkSession, raw_root: str, staged_root: str, entity: str = "orders",
    day: str | None = None, staged_at: str | None = None, dry_run: bool = False,
):
    """Raw to staged: newest export per order with derived columns, for one day or all.

    With ``day`` only that directory is read and only that one replaced; an
    order exported under two days is then collapsed within the day.
    """
    raw = lake.read_lake(spark, raw_root, entity, [day] if day else None)
    staged = staging.stage_lake_rows(raw, staged_at)
    if dry_run:
        return staged
    if day:
        return lake.write_partition(staged, staged_root, entity, day)
    return lake.write_all(staged, staged_root, entity)


def materialize_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, root: str) -> DataFrame:
    """A table laid out by key hash: joins and collapses on the keys then need no shuffle.

    Worth it for a log that is joined on the same key again and again. A key
    with a large share of the rows makes its bucket large, so keep to the plain
    layout for such data.
    """
    writer = df.write.mode("overwrite").format("parquet").option("path", f"{root.rstrip('/')}/{name}")
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def mart_path(root: str, name: str = "daily_sales_by_category") -> str:
    return f"{root.rstrip('/')}/{name}"


def upsert_mart_day(
    rows: DataFrame, root: str, day: str, checks: Iterable[Callable[[DataFrame], None]] = ()
) -> WriteReport:
    """Replace a day of the sales mart as a whole, once its rows are verified.

    A category that no longer sells, and a day that is now empty, leave no old
    rows behind; other days are not touched.
    """
    path = mart_path(root)
    published = manifest.publish(rows.withColumn("day", F.lit(day).cast("date")), path, "day", [day], checks)
    return lake.report(path, published, [day])


def rebuild_mart(rows: DataFrame, root: str) -> WriteReport:
    """Write every day of the sales mart; readers see the old mart until all of it is verified."""
    path = mart_path(root)
    return lake.report(path, manifest.publish(rows.hint("rebalance", "day"), path, "day"))


def read_mart(spark: SparkSession, root: str, days: list[str] | None = None) -> DataFrame:
    return manifest.read(spark, mart_path(root), days)


def touched_days(logs: dict[str, DataFrame], after: dict[str, int]) -> DataFrame:
    """Days whose sales a change behind the given positions can move: ``day``.

    An order's own versions, versions of its lines (the order a line left and
    the one it went to), and versions of products that its lines name.
    """
    def changed(entity: str, column: str) -> DataFrame:
        log = logs[entity]
        return (log.filter(F.col("source_lsn") > after[entity]) if entity in after else log.limit(0)).select(column).distinct()

    moved = logs["order_items"].join(changed("order_items", "order_item_id"), "order_item_id", "left_semi").select("order_id")
    sold = logs["order_items"].join(changed("products", "product_id"), "product_id", "left_semi").select("order_id")
    orders = changed("orders", "order_id").unionByName(moved).unionByName(sold).distinct()
    return logs["orders"].join(orders, "order_id", "left_semi").select(F.to_date("created_at").alias("day")).filter(
        "day IS NOT NULL").distinct()


def refresh_mart(spark: SparkSession, logs: dict[str, DataFrame], root: str, after: dict[str, int]) -> WriteReport:
    """Bring the sales mart up to the logs: only days touched by versions behind ``after`` are made again and replaced.

    ``logs`` hold the versions up to the new position, ``after`` has the old
    position of each log that grew. A touched day is computed as a whole, so
    its distinct orders are right and a category that no longer sells leaves
    no row; days that nothing touched are neither computed nor read.
    """
    days = sorted(str(r.day) for r in touched_days(logs, after).collect())  # one row per day
    if not days:
        return WriteReport(mart_path(root), 0, 0, "empty")
    wanted = spark.createDataFrame([(d,) for d in days], "day string").select(F.col("day").cast("date").alias("day"))
    dated_log = logs["orders"].withColumn("_day", F.to_date("created_at"))
    orders_log = dated_log.join(wanted, F.col("_day") == F.col("day"), "left_semi").drop("_day")
    orders = staging.stg_orders(orders_log, ["order_id", "status", "created_at"])
    # A line that left one of these orders still has its newest version elsewhere: its whole history is collapsed.
    ids = logs["order_items"].join(orders.select("order_id"), "order_id", "left_semi").select("order_item_id").distinct()
    items = staging.stg_order_items(
        logs["order_items"].join(ids, "order_item_id", "left_semi"),
        ["order_item_id", "order_id", "product_id", "quantity", "unit_price"])
    products = staging.stg_products(logs["products"], ["product_id", "category"])
    rows = marts.daily_sales(items, orders, products)
    return lake.report(mart_path(root), manifest.publish(rows, mart_path(root), "day", days), days)


def run_day(
    spark: SparkSession, logs: dict[str, DataFrame], root: str, day: str, dry_run: bool = False,
    computed_at: str | None = None,
) -> DataFrame:
    """Export, stage, and recompute the mart of one day: ``step, rows, status`` per step."""
    orders = staging.stg_orders(logs["orders"], EXPORT_COLUMNS, day)
    sales = marts.daily_sales_of_day(logs, day)
    if computed_at:
        sales = sales.withColumn("computed_at", F.lit(computed_at).cast("timestamp_ntz"))

    if dry_run:
        exported = export_day(orders, "", day, dry_run=True)
        staged = staging.stage_lake_rows(exported.withColumn("dt", F.lit(day).cast("date")))
        steps = [("export", exported), ("staged", staged), ("mart", sales)]
        lines = [
            df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(s).alias("step"), "rows",
                                                          F.lit("dry run").alias("status"))
            for s, df in steps
        ]
        return reduce(DataFrame.unionByName, lines)

    raw_root, staged_root, curated = (f"{root.rstrip('/')}/{layer}" for layer in lake.LAYERS)
    done = [("export", export_day(orders, raw_root, day))]
    done.append(("staged", promote(spark, raw_root, staged_root, day=day)))
    # Evaluated once: what is written is also what must be found again, however the logs grow meanwhile.
    computed = shared_dir(spark, "mart-day")
    sales.write.parquet(computed)
    sales = spark.read.schema(sales.schema).parquet(computed)

    def arrived(back: DataFrame) -> None:
        if not landed(back, sales, ["day", "category"]).isEmpty():
            raise VerificationError(f"mart rows of {day} are missing")

    done.append(("mart", upsert_mart_day(sales, curated, day, [arrived])))
    # Then the declared checks of what was published; a failed one fails the run, as a wrong count does.
    checked = checks.report({
        "stg_lake_orders": lake.read_lake(spark, staged_root, "orders", [day]),
        "daily_sales_by_category": read_mart(spark, curated, [day])})
    outcome = summary(checked).first()
    if outcome.failed:
        raise VerificationError(f"checks of {day}: {outcome.failed} failed")
    lines = [(step, r.read_back, r.status) for step, r in done]
    lines.append(("checks", outcome.passed + outcome.warned, outcome.outcome))
    return spark.createDataFrame(lines, "step string, rows bigint, status string")
