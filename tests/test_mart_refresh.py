import datetime as dt
from decimal import Decimal

from tables import rows
from tidemark.plans import jobs, marts, staging
from tidemark.sources import manifest

T = dt.datetime
ORDERS = "order_id bigint, status string, created_at timestamp_ntz, source_lsn bigint, is_deleted int"
ITEMS = "order_item_id bigint, order_id bigint, product_id bigint, quantity int, unit_price decimal(12,2), source_lsn bigint, is_deleted int"
PRODUCTS = "product_id bigint, category string, source_lsn bigint, is_deleted int"
D1, D2, D3, D4 = (T(2024, 1, d, 9) for d in (1, 2, 3, 4))


def logs(spark, upto):
    orders = [(1, "paid", D1, 1, 0), (2, "paid", D1, 2, 0), (3, "paid", D2, 3, 0), (4, "paid", D3, 4, 0), (5, "paid", D4, 5, 0),
              (2, "cancelled", D1, 101, 0), (4, "paid", D3, 102, 1), (6, "pending", D2, 201, 0)]
    items = [(i, o, p, q, Decimal("2.00"), i, 0) for i, o, p, q in
             ((11, 1, 7, 1), (12, 2, 7, 2), (13, 3, 8, 3), (14, 4, 8, 4), (15, 5, 9, 5))]
    items += [(13, 1, 8, 3, Decimal("2.00"), 110, 0), (16, 6, 7, 6, Decimal("2.00"), 210, 0), (11, 1, 7, 1, Decimal("2.00"), 211, 1)]
    products = [(7, "a", 1, 0), (8, "b", 2, 0), (9, "c", 3, 0), (9, "d", 220, 0)]
    return {name: spark.createDataFrame(data, schema).filter(f"source_lsn <= {upto}")
            for name, data, schema in (("orders", orders, ORDERS), ("order_items", items, ITEMS), ("products", products, PRODUCTS))}


def full(log):
    return marts.daily_sales(
        staging.stg_order_items(log["order_items"], ["order_item_id", "order_id", "product_id", "quantity", "unit_price"]),
        staging.stg_orders(log["orders"], ["order_id", "status", "created_at"]),
        staging.stg_products(log["products"], ["product_id", "category"]))


def test_refreshed_mart_equals_the_full_one(spark, tmp_path):
    """A cancelled and a deleted order, a line that moved and one that was deleted, a late order, a product's new category."""
    root = str(tmp_path)
    jobs.rebuild_mart(full(logs(spark, 100)), root)
    for old, new, days in ((100, 200, {"2024-01-01", "2024-01-02", "2024-01-03"}), (200, 300, {"2024-01-01", "2024-01-02", "2024-01-04"})):
        log, before = logs(spark, new), manifest.load(spark, jobs.mart_path(root))
        after = {n: old for n in log}
        assert {str(r.day) for r in jobs.touched_days(log, after).collect()} == days
        jobs.refresh_mart(spark, log, root, after)
        assert rows(jobs.read_mart(spark, root).select("day", "category", "orders", "items", "revenue")) == rows(
            full(log).select("day", "category", "orders", "items", "revenue"))
        # Folders of other days are the same as before.
        now = manifest.load(spark, jobs.mart_path(root))
        assert {e for e in before.entries if e.partition not in days} <= set(now.entries)
    version = manifest.versions(spark, jobs.mart_path(root))
    assert jobs.refresh_mart(spark, logs(spark, 300), root, {n: 300 for n in after}).status == "empty"
    assert manifest.versions(spark, jobs.mart_path(root)) == version
