import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tables import rows
from tidemark.operators import sequences as Q
from tidemark.schemas import ALLOWED_TRANSITIONS

T0 = dt.datetime(2024, 1, 1)


def samples(spark, n=600, seed=1):
    """Three series; one holds most of the samples."""
    rnd = random.Random(seed)
    data, t = [], 0
    for _ in range(n):
        t += rnd.choice([30, 600, 4000])
        data.append((rnd.choice(["hot"] * 6 + ["b", "c"]), T0 + dt.timedelta(seconds=t), rnd.random() < 0.6))
    return spark.createDataFrame(data, "k string, ts timestamp_ntz, s boolean"), data


def test_pairs_equal_a_plain_window(spark):
    df, _ = samples(spark)
    w = Window.partitionBy("k").orderBy("ts")
    want = df.select("k", "ts", "s", F.lag("ts").over(w).alias("prev_ts"), F.lag("s").over(w).alias("prev_s"))
    for chunk in (Q.hour_chunk(), F.lit(0), F.col("ts")):
        assert rows(Q.adjacent_pairs(df, ["k"], ["ts"], ["s"], chunk)) == rows(want)


def brute_runs(data, gap):
    out = []
    for key in {k for k, _, _ in data}:
        cur = None
        for _, t, s in sorted(d for d in data if d[0] == key):
            if cur and cur[1] == s and (gap is None or (t - cur[3]).total_seconds() <= gap):
                cur[3], cur[4] = t, cur[4] + 1
            else:
                if cur:
                    out.append(tuple(cur))
                cur = [key, s, t, t, 1]
        out.append(tuple(cur))
    return sorted(out, key=str)


def test_runs_equal_brute_force(spark):
    df, data = samples(spark)
    for gap in (None, 700):
        for chunk in (Q.hour_chunk(), F.to_date("ts"), F.col("ts")):
            got = rows(Q.runs(df, ["k"], "ts", "s", gap, chunk))
            assert sorted(got, key=str) == brute_runs(data, gap)


def test_run_spanning_many_chunks_is_one(spark):
    data = [("a", T0 + dt.timedelta(hours=6 * i), True) for i in range(40)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, s boolean")
    assert rows(Q.runs(df, ["k"], "ts", "s")) == [("a", True, T0, data[-1][1], 40)]


def test_false_chunk_between_true_chunks_separates_them(spark):
    states = [True, True, False, True]
    data = [("a", T0 + dt.timedelta(hours=i), s) for i, s in enumerate(states)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, s boolean")
    got = [(r.s, r.n) for r in Q.runs(df, ["k"], "ts", "s").orderBy("start").collect()]
    assert got == [(True, 2), (False, 1), (True, 1)]


def test_status_moves_outside_the_graph(spark):
    far = 2 ** Q.WAL_SEGMENT_BITS
    log = spark.createDataFrame([
        (1, 10, "pending"), (1, 20, "paid"), (1, far, "shipped"), (1, far * 3, "delivered"),
        (2, 10, "pending"), (2, far * 2, "shipped"), (2, far * 2 + 1, "shipped"),
        (3, 5, "delivered"), (3, 9, "pending"),
    ], "order_id int, source_lsn bigint, status string")
    assert rows(Q.invalid_transitions(log, ALLOWED_TRANSITIONS)) == [
        (2, far * 2, "pending", "shipped"), (3, 9, "delivered", "pending")]
