import re

from pyspark.sql import functions as F

from tables import rows
from tidemark.plans import layout as L
from test_skew import N, lines, orders, split_joins  # noqa: F401


def test_hot_order_is_split_and_the_join_needs_no_shuffle(spark, tmp_path, split_joins):  # noqa: F811
    laid = L.lay_out(lines(spark), orders(spark), "order_id", "order_item_id", 8, str(tmp_path), "skewed", 1000)
    got = laid.join(spark)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and not re.search("Exchange", plan)
    assert got.count() == N
    kept = ["order_id", "order_item_id", "product_id", "customer_id"]
    plain = lines(spark).join(orders(spark), "order_id")
    assert got.select(*kept).exceptAll(plain.select(*kept)).isEmpty()
    sizes = spark.table("skewed_many").groupBy("order_id", "sub_bucket").count()
    assert sizes.agg(F.max("count")).first()[0] < 1200
    assert spark.table("skewed_one").filter("order_id = 0").count() == 21


def test_keys_without_partner_or_value_are_left_out(spark, tmp_path):
    many = spark.sql("SELECT * FROM VALUES (1, 10), (1, 11), (2, 12), (null, 13), (9, 14) AS v(k, m)")
    one = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b'), (3, 'c') AS v(k, name)")
    laid = L.lay_out(many, one, "k", "m", 2, str(tmp_path), "small", 1)
    assert rows(laid.join(spark).select("k", "m", "name")) == [(1, 10, "a"), (1, 11, "a"), (2, 12, "b")]
    assert rows(spark.table("small_one").groupBy("k").count()) == [(1, 2), (2, 1), (3, 1)]
