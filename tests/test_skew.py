"""A third of the rows share one key; results stay whole and the work is split."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tables import rows
from tidemark.operators import quality as Q
from tidemark.operators import sequences as S
from tidemark.operators import timeseries as TS
from tidemark.plans import marts

N = 60000


@pytest.fixture
def split_joins(spark):
    """Settings under which test-sized partitions count as skewed."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def lines(spark):
    hot = F.col("id") % 3 == 0
    return spark.range(0, N, 1, 8).select(
        F.col("id").alias("order_item_id"),
        F.when(hot, 0).otherwise(F.col("id") % 5000).alias("order_id"),
        (F.col("id") % 40).alias("product_id"),
        F.lit(1).alias("quantity"),
        F.lit(Decimal("2.00")).cast("decimal(12,2)").alias("unit_price"))


def orders(spark):
    return spark.range(5000).select(
        F.col("id").alias("order_id"), (F.col("id") % 10).alias("customer_id"), F.lit("paid").alias("status"),
        F.lit(Decimal("1.00")).cast("decimal(12,2)").alias("total_amount"),
        F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("created_at"))


def test_hot_order_is_split_in_the_join(spark, split_joins):
    products = spark.range(40).select(F.col("id").alias("product_id"), F.lit("c").alias("category"))
    mart = marts.daily_sales(lines(spark), orders(spark), products)
    got = mart.collect()
    assert [(r.orders, r.items, r.revenue) for r in got] == [(5000, N, Decimal(2 * N))]
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan


def test_hot_customer_shrinks_before_the_join(spark, split_joins):
    customers = spark.range(10).select(F.col("id").alias("customer_id"), F.lit("DE").alias("country_code"),
                                       F.lit("2024-01-01").cast("date").alias("signup_date"))
    hot = orders(spark).withColumn("customer_id", F.when(F.col("order_id") % 3 == 0, 1).otherwise(F.col("customer_id")))
    got = marts.customer_summary(customers, hot, lines(spark), "2024-01-02")
    assert got.agg(F.sum("orders_placed"), F.sum("items_bought")).first() == (5000, N)


def test_hot_reference_is_counted_before_the_join(spark):
    child = lines(spark).select("order_id")
    got = Q.dangling(child, "order_id", spark.range(1, 5000), "id")
    assert rows(got) == [(0, N // 3 + sum(1 for i in range(N) if i % 3 and i % 5000 == 0))]


def test_hot_series_spans_many_chunks(spark):
    hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 50).cast("string")))
    ts = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 10)
    df = spark.range(20000).select(hot.alias("series"), ts.alias("ts"), (F.col("id") % 1000).cast("double").alias("value"))
    grown = TS.increase(df, ["series"], 3600, 600)
    plain = TS.over_windows(TS.counter_deltas(df, ["series"], chunk=F.lit(0)), ["series"], "delta", 3600, 600)
    assert rows(grown) == rows(plain)
    chunks = df.filter("series = 'hot'").select(S.hour_chunk()).distinct().count()
    assert chunks > 50
