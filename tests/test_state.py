import itertools
import random
from decimal import Decimal

from pyspark.sql import functions as F

from tables import rows
from tidemark.operators import state as E

SCHEMA = "k string, status string, amount decimal(12,2), op string, source_lsn bigint, is_deleted int"
VERSIONS = [
    ("pending", Decimal("10.00"), "c", 100, 0),
    ("paid", Decimal("42.00"), "u", 200, 0),
    ("paid", Decimal("42.00"), "d", 300, 1),
    ("pending", Decimal("5.00"), "c", 400, 0),
]


def log(spark, versions_by_key):
    data = [(k, *v) for k, vs in versions_by_key.items() for v in vs]
    return spark.createDataFrame(data, SCHEMA)


def test_newest_version_wins_and_deletes_disappear(spark):
    df = log(spark, {"two": VERSIONS[:2], "deleted": VERSIONS[:3], "back": VERSIONS})
    got = rows(E.latest_state(df, ["k"]).select("k", "status", "amount", "source_lsn"))
    assert got == [("back", "pending", Decimal("5.00"), 400), ("two", "paid", Decimal("42.00"), 200)]


def test_arrival_order_does_not_matter(spark):
    orders = {f"p{i}": list(p) for i, p in enumerate(itertools.permutations(VERSIONS))}
    got = E.latest_state(log(spark, orders).repartition(3), ["k"])
    assert {(r.status, r.source_lsn) for r in got.collect()} == {("pending", 400)}
    assert got.count() == 24


def test_shuffled_and_repeated_log_gives_the_same_state(spark):
    rnd = random.Random(5)
    data = [
        (f"k{rnd.randrange(40)}", rnd.choice("abc"), Decimal(rnd.randrange(100)), "u", lsn, int(rnd.random() < 0.2))
        for lsn in range(400)
    ]
    want = {}
    for k, *rest in data:
        want[k] = rest
    want = {k: v for k, v in want.items() if not v[4]}
    noisy = data + rnd.sample(data, 200)
    rnd.shuffle(noisy)
    got = E.latest_state(spark.createDataFrame(noisy, SCHEMA), ["k"])
    assert {r.k: [r.status, r.amount, r.op, r.source_lsn, r.is_deleted] for r in got.collect()} == want


def test_ties_are_broken_by_the_remaining_columns(spark):
    df = spark.createDataFrame([("a", "2020-01-01", 1), ("a", "2020-01-01", 3), ("a", "2020-01-01", 2)],
                               "k string, updated_at string, v int")
    for seed in range(3):
        assert rows(E.latest_by_update(df.orderBy(F.rand(seed)), ["k"])) == [("a", "2020-01-01", 3)]


def test_wanted_columns_only(spark):
    df = log(spark, {"two": VERSIONS[:2]})
    assert E.latest_state(df, ["k"], columns=["amount", "k"]).columns == ["amount", "k"]


def test_state_as_of_a_position(spark):
    df = log(spark, {"x": VERSIONS})
    at = {lsn: rows(E.state_as_of(df, ["k"], lsn).select("status", "source_lsn")) for lsn in (50, 150, 250, 350, 450)}
    assert at == {50: [], 150: [("pending", 100)], 250: [("paid", 200)], 350: [], 450: [("pending", 400)]}


def test_version_report_history_and_tombstones(spark):
    df = log(spark, {"two": VERSIONS[:2], "gone": VERSIONS[:3]})
    assert rows(E.version_report({"t": (df, ["k"])})) == [("t", 5, 1, 4)]
    assert [r.source_lsn for r in E.history(df, "k", "gone").collect()] == [100, 200, 300]
    assert rows(E.tombstones(df).select("k", "amount")) == [("gone", Decimal("42.00"))]


def test_insert_absent_ignores_existing_and_repeated_keys(spark):
    have = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "x", 1), (3, "z", 2), (3, "a", 1), (3, "zz", 3), (4, "z", 1)], "id int, v string, at int")
    assert rows(E.insert_absent(have, new, ["id"], "at").select("id", "v")) == [(3, "a"), (4, "z")]


def test_null_delete_flag_means_not_deleted(spark):
    df = spark.createDataFrame([(1, 1, 0), (1, 2, None), (2, 1, None), (2, 2, 1)], "id int, source_lsn long, is_deleted int")
    assert rows(E.latest_state(df, ["id"]).select("id", "source_lsn")) == [(1, 2)]


def test_merge_versions_replaces(spark):
    old = spark.createDataFrame([("d1", 10, 1), ("d2", 20, 1)], "day string, v int, run int")
    new = spark.createDataFrame([("d2", 25, 2)], "day string, v int, run int")
    assert rows(E.merge_versions(old, new, ["day"], "run")) == [("d1", 10, 1), ("d2", 25, 2)]


def test_collapse_happens_before_the_shuffle(spark):
    """A hot key leaves one row per input partition, not all its versions."""
    hot = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("source_lsn"), F.lit(0).alias("is_deleted"))
    plan = E.latest_state(hot, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    top = E.latest_state(hot, ["k"]).filter("k = 'hot'").first()
    assert top.source_lsn == 19998
