import datetime as dt

from pyspark.sql import functions as F

from tables import rows
from tidemark.operators import timeseries as TS
from tidemark.streaming import islands as I

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "ts timestamp_ntz, metric string, value double"
KEYS = ["metric"]


def _series():
    """Every 20 seconds for two hours, with spells above 5, dips and pauses."""
    out = []
    for i in range(360):
        if 100 <= i < 130 or 200 <= i < 204:
            continue
        high = 20 <= i < 60 or 62 <= i < 80 or 150 <= i < 156 or i >= 300
        out.append((T0 + dt.timedelta(seconds=20 * i), "a", 9.0 if high else 1.0))
        if i % 2:
            out.append((T0 + dt.timedelta(seconds=20 * i + 7), "b", float(i % 50)))
    return out


def _streamed(spark, tmp_path, build):
    """``build`` over files that arrive out of order, closed by a late heartbeat."""
    data, root = _series(), tmp_path / "samples"
    blocks = [[r for r in data if (r[0] - T0).total_seconds() // 1200 == b] for b in (1, 0, 3, 2, 5, 4)]
    blocks.append([(T0 + dt.timedelta(days=1), None, 0.0)])
    for n, block in enumerate(blocks):
        spark.createDataFrame(block, SCHEMA).coalesce(1).write.parquet(str(root / str(n)))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(root / "*"))
    dst = str(tmp_path / "out")
    build(stream).writeStream.format("parquet").outputMode("append").option("path", dst).option(
        "checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(dst)


def _alerts(gap, hold):
    def build(samples):
        return I.alert_islands(I.evaluations(samples, KEYS, 60, "1 hour"), KEYS, F.col("value") > 5, gap, hold)
    return build


def test_streamed_stretches_equal_held_for(spark, tmp_path):
    got = _streamed(spark, tmp_path, _alerts(60, 300))
    grid = I.evaluations(spark.createDataFrame(_series(), SCHEMA), KEYS, 60, "1 hour").select(
        "metric", I._time(F.col("_at")).alias("t"), (F.col("value") > 5).alias("above"))
    expected = TS.held_for(grid, KEYS, "above", 300, max_gap_seconds=60)
    assert rows(got.select("metric", "start", "end", "fire_at")) == rows(expected)
    fired = got.filter("metric = 'a' AND fire_at IS NOT NULL")
    assert fired.count() >= 2 and got.filter("fire_at IS NULL").count() > 0


def test_a_wider_gap_bridges_dips(spark):
    batch = spark.createDataFrame(_series(), SCHEMA)
    narrow, wide = (_alerts(g, 300)(batch).filter("metric = 'a'").count() for g in (60, 3600))
    assert (narrow, wide) == (3, 1)


def test_streamed_silences_name_every_pause(spark, tmp_path):
    def build(samples):
        return I.silences(I.evaluations(samples, KEYS, 60, "1 hour"), KEYS, 120)

    got = _streamed(spark, tmp_path, build)
    seen = sorted({(r[1], r[0]) for r in _series()})
    expected = []
    for m in ("a", "b"):
        # Evaluation times that have samples.
        at = sorted({T0 + dt.timedelta(seconds=((t - T0).total_seconds() // 60 + 1) * 60) for k, t in seen if k == m})
        for t, after in zip(at, [*at[1:], dt.datetime.max]):
            if after - t > dt.timedelta(seconds=120):
                expected.append((m, t, t + dt.timedelta(seconds=120)))
    assert rows(got) == expected and len(expected) == 4


def test_gap_and_hold_by_rule_and_their_transitions(spark):
    data = [(T0 + dt.timedelta(seconds=s), m, 9.0) for m in ("a", "b") for s in (5, 65, 125, 305)]
    rules = spark.createDataFrame([("a", 60, 60), ("b", 600, 600)], "metric string, gap int, hold int")
    grid = I.evaluations(spark.createDataFrame(data, SCHEMA), KEYS, 60, "1 hour").join(rules, "metric")
    by = ["metric", "gap", "hold"]
    found = I.alert_islands(grid, by, F.col("value") > 5, "gap", "hold")

    def at(minute):
        return T0 + dt.timedelta(minutes=minute)

    assert rows(found.select("metric", "start", "end", "fire_at", "over_at", "n"), "metric", "start") == [
        ("a", at(1), at(3), at(2), at(4), 3), ("a", at(6), at(6), None, at(7), 1), ("b", at(1), at(6), None, at(16), 4)]
    assert rows(I.transitions(found, ["metric"]), "metric", "at") == [
        ("a", at(1), "pending"), ("a", at(2), "firing"), ("a", at(4), "resolved"), ("a", at(6), "pending"),
        ("a", at(7), "dropped"), ("b", at(1), "pending"), ("b", at(16), "dropped")]
