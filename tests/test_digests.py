import pytest
from pyspark.sql import functions as F

from tables import rows
from tidemark.operators import changes as C
from tidemark.operators import digests as D
from tidemark.operators import joins as J


def _sides(spark):
    a = spark.range(20_000).select(
        F.col("id"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("v"), (F.col("id") % 13).cast("string"))).alias("v"),
        (F.col("id") * 3).alias("n"))
    b = a.filter("id <> 5000").withColumn("n", F.when(F.col("id").between(9000, 9010), -1).otherwise(F.col("n")))
    return a, b.union(spark.sql("SELECT 20005L, 'new', 1L"))


PLACES = [D.ByRange("id", 0, 19_999, 2), D.ByRange("id", 100, 15_000, 2), D.ByRange("id", 0, 19_999, 1),
          D.ByHash(("id",), 2), D.ByRange("id", 0, 50, 2)]


@pytest.mark.parametrize("places", PLACES)
def test_same_rows_as_the_full_comparison(spark, places):
    a, b = _sides(spark)
    got = D.compare_by_digest(a, b, ["id"], ["v", "n"], places)
    assert rows(got) == rows(J.compare(a, b, ["id"], ["v", "n"]))
    assert got.count() == 13
    assert rows(D.diff_by_digest(a, b, ["id"], 3, places)) == rows(C.diff_snapshots(a, b, ["id"], 3))


def test_rows_of_equal_ranges_are_not_joined(spark):
    a, b = _sides(spark)
    left, right = D.unequal_ranges(a, b, ["id"], ["v", "n"], D.ByRange("id", 0, 20_479, 2))
    # Leaves of five keys: one around 5000, three around 9000, one around 20005.
    assert left.count() <= 5 * 5 and right.count() <= 5 * 5
    left, _ = D.unequal_ranges(a, a, ["id"], ["v", "n"], D.ByRange("id", 0, 20_479, 2))
    assert left.count() == 0


def test_the_differing_ranges_reach_the_scan(spark, tmp_path):
    a, b = _sides(spark)
    for name, df in (("a", a), ("b", b)):
        df.orderBy("id").write.parquet(str(tmp_path / name))
    a, b = spark.read.parquet(str(tmp_path / "a")), spark.read.parquet(str(tmp_path / "b"))
    left, _ = D.unequal_ranges(a, b, ["id"], ["v", "n"], D.ByRange("id", 0, 20_479, 2))
    plan = left._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(id," in pushed and "LessThan(id," in pushed


def test_more_differences_than_the_driver_names(spark):
    a = spark.range(40_960).select("id", F.lit(1).alias("v"))
    b = a.withColumn("v", F.when(F.col("id") % 10 == 0, 2).otherwise(1))
    for places in (D.ByRange("id", 0, 40_959, 2), D.ByHash(("id",), 3)):
        got = D.compare_by_digest(a, b, ["id"], ["v"], places)
        assert got.count() == 4096


def test_nulls_keep_their_place_and_null_keys_never_match(spark):
    kind = "id int, x string, y string"
    a = spark.createDataFrame([(1, None, "q"), (2, "a", "b"), (None, "k", "k")], kind)
    b = spark.createDataFrame([(1, "q", None), (2, "a", "b"), (None, "k", "k")], kind)
    for places in (D.ByRange("id", 0, 9, 1), D.ByHash(("id",), 1)):
        got = D.compare_by_digest(a, b, ["id"], ["x", "y"], places)
        assert rows(got) == rows(J.compare(a, b, ["id"], ["x", "y"]))
        assert got.count() == 3
    empty = a.limit(0)
    assert D.compare_by_digest(empty, empty, ["id"], ["x"], D.ByHash(("id",), 1)).count() == 0
    assert D.compare_by_digest(a, empty, ["id"], ["x"], D.ByHash(("id",), 1)).count() == 3


def test_types_must_agree(spark):
    a = spark.sql("SELECT 1 AS id, 1 AS v")
    with pytest.raises(ValueError, match="v"):
        D.compare_by_digest(a, a.withColumn("v", F.col("v").cast("bigint")), ["id"], ["v"], D.ByHash(("id",)))


def test_a_kept_tree_is_used(spark):
    a, b = _sides(spark)
    places = D.ByRange("id", 0, 19_999, 2)
    kept = D.write_tree(D.digest_tree(a, ["id"], ["v", "n"], places))
    got = D.compare_by_digest(a, b, ["id"], ["v", "n"], places, tree_a=kept)
    assert got.count() == 13
    root = kept.filter("level = 0").first()
    assert (root["node"], root["rows"]) == (0, 20_000)
