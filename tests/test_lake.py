import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tables import rows
from tidemark.plans import jobs
from tidemark.session import shared_dir
from tidemark.sources import lake, manifest

T = dt.datetime


def orders(spark, status="paid"):
    return spark.createDataFrame([
        (1, 1, status, Decimal("1.00"), T(2024, 1, 1), T(2024, 1, 1, 2)),
        (2, 1, status, Decimal("2.00"), T(2024, 1, 1, 23, 59), T(2024, 1, 3)),
        (3, 2, status, Decimal("3.00"), T(2024, 1, 2), T(2024, 1, 2)),
    ], "order_id int, customer_id int, status string, total_amount decimal(12,2), created_at timestamp_ntz, updated_at timestamp_ntz")


def test_rewriting_one_day_leaves_the_others(spark, tmp_path):
    root = str(tmp_path)
    for day in ("2024-01-01", "2024-01-02"):
        done = jobs.export_day(orders(spark), root, day)
        assert done.written == done.read_back
    jobs.export_day(orders(spark, "cancelled"), root, "2024-01-01")
    got = rows(lake.read_lake(spark, root, "orders").select("order_id", "status", F.col("dt").cast("string")))
    assert got == [(1, "cancelled", "2024-01-01"), (2, "cancelled", "2024-01-01"), (3, "paid", "2024-01-02")]
    folder = next(e.path for e in manifest.load(spark, f"{root}/orders").entries if e.partition == "2024-01-01")
    assert "dt" not in spark.read.parquet(f"{root}/orders/{folder}").columns


def test_date_list_prunes_directories(spark, tmp_path):
    jobs.export_all(orders(spark), str(tmp_path))
    one = lake.read_lake(spark, str(tmp_path), "orders", ["2024-01-02"])
    assert [r.order_id for r in one.collect()] == [3]
    assert one.inputFiles() and all("dt=2024-01-02" in f for f in one.inputFiles())


def test_empty_day_is_a_fact(spark, tmp_path):
    done = jobs.export_day(orders(spark), str(tmp_path), "2023-12-31")
    assert (done.written, done.status) == (0, "empty")


def test_dry_run_writes_nothing(spark, tmp_path):
    assert jobs.export_day(orders(spark), str(tmp_path), "2024-01-01", dry_run=True).count() == 2
    assert list(tmp_path.iterdir()) == []


def test_count_mismatch_is_an_error(spark, tmp_path):
    path = str(tmp_path / "x")
    spark.range(3).write.parquet(path)
    with pytest.raises(lake.VerificationError):
        lake.write_verified(spark.range(2), path, mode="append")


def test_success_marker_without_rows_is_a_failure(spark, tmp_path):
    empty, full = str(tmp_path / "e"), str(tmp_path / "f")
    spark.range(0).write.parquet(empty)
    spark.range(1).write.parquet(full)
    lake.assert_nonempty(spark, full)
    with pytest.raises(lake.VerificationError):
        lake.assert_nonempty(spark, empty)
    bare = tmp_path / "bare"
    bare.mkdir()
    (bare / "_SUCCESS").write_text("")
    with pytest.raises(Exception):
        lake.assert_nonempty(spark, str(bare))


def test_promotion_keeps_the_newest_export(spark, tmp_path):
    raw, staged = str(tmp_path / "raw"), str(tmp_path / "staged")
    first = orders(spark).withColumn("dt", F.to_date("created_at"))
    later = first.withColumns({"status": F.lit("delivered"), "updated_at": F.col("updated_at") + F.expr("INTERVAL 1 HOUR")})
    lake.write_all(first.unionByName(later), raw, "orders")
    jobs.promote(spark, raw, staged, staged_at="2024-02-01 00:00:00")
    got = lake.read_lake(spark, staged, "orders")
    assert rows(got.select("order_id", "status", "is_complete", "age_seconds")) == [
        (1, "delivered", True, 10800), (2, "delivered", True, 86460 + 3600), (3, "delivered", True, 3600)]


def test_dates_from_paths(spark, tmp_path):
    jobs.export_rows(orders(spark), "2024-01-02").write.parquet(str(tmp_path / "orders" / "dt=2024-01-02"))
    spark.range(1).select(F.lit(9).alias("order_id")).write.parquet(str(tmp_path / "orders" / "undated"))
    got = lake.read_lake_files(spark, str(tmp_path), "orders").select("order_id", F.col("dt").cast("string"))
    assert rows(got) == [(3, "2024-01-02"), (9, None)]


def test_mart_day_is_replaced_as_a_whole(spark, tmp_path):
    def sales(*lines):
        return spark.createDataFrame([(dt.date(2024, 1, d), c, n) for d, c, n in lines], "day date, category string, orders bigint")
    root = str(tmp_path)
    jobs.rebuild_mart(sales((1, "a", 1), (1, "b", 1), (2, "a", 5)), root)
    jobs.upsert_mart_day(sales((1, "a", 7)), root, "2024-01-01")
    assert rows(jobs.read_mart(spark, root).select("category", "orders")) == [("a", 5), ("a", 7)]
    jobs.upsert_mart_day(sales((1, "a", 7)).limit(0), root, "2024-01-01")
    assert rows(jobs.read_mart(spark, root).select("category", "orders")) == [("a", 5)]


def test_retention(spark):
    data = [("p1", dt.date(2024, 1, 1), None), ("p2", dt.date(2024, 1, 2), None),
            ("p3", dt.date(2024, 1, 30), dt.date(2024, 1, 24)), ("p4", dt.date(2023, 1, 1), dt.date(2024, 1, 25))]
    parts = spark.createDataFrame(data, "path string, dt date, superseded_at date")
    assert rows(lake.retention_plan(parts, "2024-02-01")) == [
        ("p1", "expire"), ("p2", "keep"), ("p3", "expire"), ("p4", "keep")]


def test_shared_dir_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_dir(spark, "a"), shared_dir(spark, "a")
    assert one.startswith(base) and one != two


def test_view_and_table(spark, tmp_path):
    view = jobs.materialize(orders(spark), "orders_view", "view")
    table = jobs.materialize(orders(spark), "orders_table", "table", str(tmp_path))
    assert rows(view) == rows(table)
    assert lake.partition_report(table).agg(F.sum("rows")).first()[0] == 3


def test_an_empty_date_list_reads_nothing(spark, tmp_path):
    from tidemark.sources.lake import read_lake, write_all

    df = spark.sql("SELECT 1 AS id, DATE '2020-01-01' AS dt UNION ALL SELECT 2, DATE '2020-01-02'")
    write_all(df, str(tmp_path), "things")
    assert read_lake(spark, str(tmp_path), "things", []).count() == 0
    assert read_lake(spark, str(tmp_path), "things").count() == 2


def test_failed_check_leaves_the_old_day_readable(spark, tmp_path):
    root = str(tmp_path)
    jobs.export_all(orders(spark), root)
    before = rows(lake.read_lake(spark, root, "orders"))

    def refuse(back):
        assert back.count() == 2
        raise lake.VerificationError("no")

    with pytest.raises(lake.VerificationError):
        lake.write_partition(orders(spark, "lost").limit(2), root, "orders", "2024-01-01", [refuse])
    assert rows(lake.read_lake(spark, root, "orders")) == before and manifest.versions(spark, f"{root}/orders") == [1]


def test_readers_see_the_old_table_or_the_new_one(spark, tmp_path):
    root = str(tmp_path)
    jobs.export_all(orders(spark), root)
    old = lake.read_lake(spark, root, "orders")
    jobs.export_all(orders(spark, "cancelled"), root)
    assert {r.status for r in old.collect()} == {"paid"}
    assert {r.status for r in lake.read_lake(spark, root, "orders").collect()} == {"cancelled"}
    assert {r.status for r in manifest.read(spark, f"{root}/orders", version=1).collect()} == {"paid"}


def test_writers_of_different_days_do_not_lose_each_other(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    root = str(tmp_path)
    days = [f"2024-01-{d:02d}" for d in range(1, 9)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda day: lake.write_partition(orders(spark).limit(1), root, "orders", day), days))
    assert sorted(str(r.dt) for r in lake.read_lake(spark, root, "orders").collect()) == days
    assert manifest.versions(spark, f"{root}/orders") == list(range(1, 9))


def test_rows_of_another_partition_are_refused(spark, tmp_path):
    table, dated = str(tmp_path / "t"), jobs.dated(orders(spark))
    manifest.publish(dated, table, "dt")
    with pytest.raises(lake.VerificationError):
        manifest.publish(dated, table, "dt", ["2024-01-01", "2024-01-03"])
    manifest.publish(dated.filter("dt = '2024-01-02'"), table, "dt", ["2024-01-01", "2024-01-02"])
    assert rows(manifest.read(spark, table).select("order_id")) == [(3,)]
    assert {r.partition for r in manifest.superseded(spark, table).collect()} == {"2024-01-01", "2024-01-02"}


def test_exported_files_are_sorted_by_key(spark, tmp_path):
    many = spark.range(5_000).selectExpr(
        "cast(hash(id) as int) AS order_id", "1 AS customer_id", "'paid' AS status", "cast(1 as decimal(12,2)) AS total_amount",
        "timestamp_ntz'2024-01-01 05:00:00' AS created_at", "timestamp_ntz'2024-01-01 06:00:00' AS updated_at").repartition(3)
    jobs.export_day(many, str(tmp_path), "2024-01-01")
    files = list(tmp_path.rglob("*.parquet"))
    assert len(files) == 3
    for f in files:
        ids = [r[0] for r in spark.read.parquet(str(f)).select("order_id").collect()]
        assert ids == sorted(ids) and len(ids) > 1_000


def test_small_files_are_grouped_to_the_target(spark):
    files = spark.createDataFrame([("2024-01-01", f"f{i:02d}", 30) for i in range(10)] + [("2024-01-02", "a", 500), ("2024-01-02", "b", 1)],
                                  "dt string, path string, length bigint")
    got = rows(lake.compaction_groups(files, 100).groupBy("dt", "group").agg(F.sum("length")))
    assert got == [("2024-01-01", 0, 120), ("2024-01-01", 1, 90), ("2024-01-01", 2, 90), ("2024-01-02", 0, 500), ("2024-01-02", 5, 1)]
