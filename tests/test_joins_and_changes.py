from pyspark.sql import functions as F

from tables import rows
from tidemark.operators import aggregates as A
from tidemark.operators import changes as C
from tidemark.operators import joins as J
from tidemark.operators import state as E
from tidemark.operators import topk as K


def test_compare_finds_every_kind_of_difference(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None), (5, "q")], "id int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "z"), (3, None), (4, "w")], "id int, v string")
    assert rows(J.compare(a, b, ["id"], ["v"])) == [
        (2, "y", "z", "differs"), (4, None, "w", "only in b"), (5, "q", None, "only in a")]


def test_semi_and_anti_do_not_multiply(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    right = spark.createDataFrame([(1,), (1,), (3,)], "id int")
    assert rows(J.with_match(left, right, ["id"])) == [(1,), (3,)]
    assert rows(J.without(left, right, ["id"])) == [(2,)]


def test_spine_join_keeps_keys_of_every_part(spark):
    a = spark.createDataFrame([(1, 10)], "d int, a int")
    b = spark.createDataFrame([(2, 20)], "d int, b int")
    assert rows(J.spine_join({"a": a, "b": b}, ["d"])) == [(1, 10, None), (2, None, 20)]


def test_ratio_on_is_null_for_zero(spark):
    n = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 1.0)], "i string, value double")
    d = spark.createDataFrame([("a", 6.0), ("b", 0.0)], "i string, value double")
    assert rows(J.ratio_on(n, d, ["i"], scale=100.0)) == [("a", 50.0), ("b", None)]


def test_diff_of_snapshots_replays_to_the_new_one(spark):
    schema = "id int, v string, n int"
    old = spark.createDataFrame([(1, "a", 1), (2, None, 2), (3, "c", 3), (4, None, 4)], schema)
    new = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (4, None, 4), (5, "e", 5)], schema)
    diff = C.diff_snapshots(old, new, ["id"], lsn=9)
    assert rows(diff.select("id", "op", "v", "is_deleted")) == [(2, "u", "b", 0), (3, "d", "c", 1), (5, "c", "e", 0)]
    base = C.snapshot_as_changes(old, lsn=1, ts="2020-01-01 00:00:00").drop("source_ts")
    both = base.unionByName(diff.select(base.columns))
    assert rows(E.latest_state(both, ["id"], columns=["id", "v", "n"])) == rows(new)


def test_copies_are_counted_once(spark):
    df = spark.createDataFrame([("s1", "r1", 5), ("s1", "r2", 7), ("s2", "r1", 3)], "shard string, rep string, n int")
    assert rows(A.dedup_then_sum(df, "shard", "rep", "n")) == [("s1", 7, 2), ("s2", 3, 1)]
    assert rows(A.total_over_groups(df, "shard", "rep", "n")) == [(10,)]


def test_quantiles_are_nearest_rank(spark):
    data = [("a", v) for v in range(1, 101)] + [("b", 7), (None, -5), (None, 5), ("c", None)]
    df = spark.createDataFrame(data, "g string, v bigint")
    got = rows(A.quantiles(df, "v", ["g"]))
    assert got == [("a", 50, 90, 99), ("b", 7, 7, 7), (None, -5, 5, 5)]
    skewed = spark.createDataFrame([("x", 1.5)] * 900 + [("x", 1000.25)] * 100, "g string, v double")
    assert rows(A.quantiles(skewed, "v", ["g"])) == [("x", 1.5, 1.5, 1000.25)]


def test_topk_and_repeatable_sample(spark):
    df = spark.createDataFrame([(t, f"s{i}", float(i)) for t in (1, 2) for i in range(20)], "t int, s string, v double")
    top = rows(K.topk(df, 2, "v", ["t"], ["s"]).select("t", "s", "rank"))
    assert top == [(1, "s18", 2), (1, "s19", 1), (2, "s18", 2), (2, "s19", 1)]
    ids = spark.range(1000)
    one, two = rows(K.sample_k(ids, 10, "id", 3)), rows(K.sample_k(ids.repartition(7), 10, "id", 3))
    assert one == two and one != rows(K.sample_k(ids, 10, "id", 4))


def test_quantiles_of_close_large_values(spark):
    df = spark.range(200_000).selectExpr("900000000000 + id AS v", "'g' AS g")
    got = A.quantiles(df, "v", ["g"], most=1_000).first()
    assert (got.p50, got.p90, got.p99) == (900000099999, 900000179999, 900000197999)


def test_quantiles_bracket_whatever_the_values(spark, monkeypatch):
    """Outliers, values a double cannot tell apart, two values only, NaN and null groups; no window above its bound."""
    df = spark.range(300_000).selectExpr(
        "CASE id WHEN 7 THEN 1e10 WHEN 9 THEN 1e18 ELSE 5 + id / 1e9 END AS close",
        "cast(9007199254740993000 + pmod(hash(id), 300000) AS bigint) AS large",
        "cast(CASE WHEN id % 10 < 5 THEN 1 ELSE 2 END AS decimal(30, 10)) AS two",
        "CASE WHEN id % 3 = 0 THEN double('NaN') WHEN id % 3 = 1 THEN double('-Infinity') ELSE id END AS odd",
        "CASE WHEN id % 2 = 0 THEN 'g' END AS g")
    held, inside = [], A._inside

    def watched(rows, parts):
        out = inside(rows, parts)
        held[:] = [out]
        return out

    monkeypatch.setattr(A, "_inside", watched)
    for column in ("close", "large", "two", "odd"):
        want = {}
        for r in df.groupBy("g").agg(F.sort_array(F.collect_list(column)).alias("v"), F.count(F.lit(1)).alias("n")).collect():
            want[r.g] = [str(r.v[-(-r.n * p // 100) - 1]) for p in (50, 90, 99)]
        got = {r.g: [str(r.p50), str(r.p90), str(r.p99)] for r in A.quantiles(df, column, ["g"], most=5_000).collect()}
        assert got == want
        last = held[0].groupBy("_g", "_rank").agg(F.count_distinct("_v").alias("n")).agg(F.max("n")).first()[0]
        assert last <= 6_000, (column, last)
    assert A.quantiles(df, "close", []).count() == 1 and A.quantiles(df.filter("false"), "close", ["g"]).count() == 0
