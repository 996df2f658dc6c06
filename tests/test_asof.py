import random

from pyspark.sql import functions as F

from tables import rows
from tidemark.operators import asof

LOG = "k bigint, source_lsn bigint, v string, is_deleted int"
ASK = "id int, k bigint, at bigint, v string"


def brute(log, questions):
    out = []
    for i, k, at, v in questions:
        seen = [r for r in log if r[0] == k and k is not None and at is not None and r[1] <= at]
        best = max(seen, key=lambda r: (r[1], r[2]), default=None)
        out.append((i, k, at, best[2] if best and not best[3] else None))
    return out


def asked(spark, questions):
    return spark.createDataFrame(questions, ASK).withColumnRenamed("v", "note")


def test_as_of_join_equals_brute_force(spark):
    draw = random.Random(7)
    log = [(draw.choice([1, 1, 1, 2, 3, 4]), draw.randint(1, 400), f"v{i}", int(draw.random() < 0.2)) for i in range(300)]
    log = list({(r[0], r[1]): r for r in log}.values()) + [(None, 5, "lost", 0)]
    questions = [(i, draw.choice([1, 1, 2, 3, 5, None]), draw.choice([None, *range(0, 420)]), "q") for i in range(500)]
    got = asof.as_of_join(asked(spark, questions), spark.createDataFrame(log, LOG).repartition(3), ["k"], "at", ["v"])
    assert rows(got.select("id", "k", "at", "v")) == sorted(brute(log, questions), key=lambda t: tuple((x is None, str(x)) for x in t))
    assert got.columns == ["id", "k", "at", "note", "v"]


def test_a_hot_key_is_cut_into_pieces(spark, monkeypatch, tmp_path):
    """Nearly all versions and questions are of one key: no window holds a third of them, and the answers are right."""
    monkeypatch.setattr(asof, "shared_dir", lambda spark, label: str(tmp_path / label))
    log = spark.range(40_000).selectExpr("IF(id % 50 = 0, id, 7) AS k", "id * 10 AS source_lsn", "string(id) AS v", "0 AS is_deleted")
    questions = spark.range(40_000).selectExpr("int(id) AS id", "7L AS k", "id * 10 + 15 AS at")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        got = asof.as_of_join(questions, log, ["k"], "at", ["v"])
    finally:
        spark.conf.set(coalesce, "true")
    newest = F.least(F.col("id") + 1, F.lit(39_999))
    want = F.when(newest % 50 == 0, newest - 1).otherwise(newest)
    assert got.count() == 40_000 and got.filter(~F.col("v").eqNullSafe(want.cast("string"))).count() == 0
    pieces = spark.read.parquet(str(tmp_path / "as-of")).groupBy("_piece", "_key").count()
    assert pieces.agg(F.max("count")).first()[0] < 80_000 / 3


def test_as_of_join_on_odd_tables(spark):
    log = spark.createDataFrame([(1, 5, "a", None), (1, 5, "a", None)], LOG)
    questions = asked(spark, [(1, 1, 5, ""), (1, 1, 5, ""), (2, 1, 4, ""), (3, None, 5, "")])
    assert rows(asof.as_of_join(questions, log, ["k"], "at", ["v"]).select("id", "v")) == [(1, "a"), (1, "a"), (2, None), (3, None)]
    assert asof.as_of_join(questions.filter("false"), log, ["k"], "at", ["v"]).count() == 0
    assert rows(asof.as_of_join(questions, log.filter("false"), ["k"], "at", ["v"]).select("v")) == [(None,)] * 4


def test_intervals_close_at_the_next_version(spark):
    log = spark.createDataFrame([(1, 100, "a", 0), (1, 200, "b", 0), (1, 200, "b", 0), (1, 300, "b", 1), (1, 400, "c", 0), (2, 50, "x", 1)], LOG)
    got = rows(asof.validity(log, ["k"], ["v"], chunk=F.floor(F.col("source_lsn") / 150)))
    assert got == [(1, 100, 200, "a"), (1, 200, 300, "b"), (1, 400, None, "c")]
