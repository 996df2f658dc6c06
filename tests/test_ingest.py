import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tables import rows
from tidemark.operators.state import history, latest_state, tombstones
from tidemark.schemas import KEYS, row_schema, wire_schema
from tidemark.sources import changes as C
from tidemark.streaming import ingest, monitor


def message(lsn, op="u", deleted="false", **row):
    base = {"customer_id": 7, "email": "a@example.com", "full_name": "A", "country_code": "DE",
            "created_at": "2025-03-09T07:41:12.251999Z", "updated_at": "2025-03-10T22:05:30.718204Z"}
    base.update(row)
    base.update({"__op": op, "__deleted": deleted, "__source_lsn": lsn, "__source_ts_ms": 1741644330718,
                 "__table": "customers", "not_declared": [1, 2]})
    return json.dumps(base)


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_typing_of_wire_values(spark):
    line = json.dumps({
        "order_id": 88, "customer_id": 31, "status": "paid", "total_amount": "73.40",
        "created_at": "2025-03-09T07:41:12.251999Z", "updated_at": "2025-03-10T22:05:30.718204Z",
        "__deleted": "true", "__op": "d", "__source_lsn": 904411, "__source_ts_ms": 1741644330718, "__table": "orders"})
    raw = spark.createDataFrame([(line,)], "value string")
    typed = C.type_orders(C.parse_strict(raw, "orders"))
    got = typed.withColumns({c: F.col(c).cast("string") for c in ("created_at", "source_ts")}).first()
    assert (got.total_amount, got.is_deleted, got.op) == (Decimal("73.40"), 1, "d")
    assert got.created_at == "2025-03-09 07:41:12.251"
    assert got.source_ts == "2025-03-10 22:05:30.718"
    assert dict(typed.dtypes)["total_amount"] == "decimal(12,2)"


def test_products_flag_becomes_a_number(spark):
    line = json.dumps({"product_id": 1, "sku": "s", "name": "n", "category": "audio", "price": "9.90",
                       "is_active": True, "updated_at": "2026-01-01T00:00:00Z", "__deleted": "false"})
    typed = C.type_products(C.parse_strict(spark.createDataFrame([(line,)], "value string"), "products"))
    assert (typed.first().is_active, typed.first().price) == (1, Decimal("9.90"))


def test_unparseable_message_stops_a_strict_read(spark):
    raw = spark.createDataFrame([(message(1),), ('{"customer_id": 1, ',)], "value string")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        C.type_customers(C.parse_strict(raw, "customers")).collect()


def test_value_that_does_not_convert_stops_a_strict_read(spark):
    raw = spark.createDataFrame([(message(1, created_at="yesterday"),)], "value string")
    with pytest.raises(Exception):
        C.type_customers(C.parse_strict(raw, "customers")).collect()


def test_dead_letters_are_set_aside_whole(spark):
    bad = ['{"customer_id": 1, ', "not json", message(3, created_at="yesterday"), message(None)]
    raw = spark.createDataFrame([(m,) for m in [message(1), message(2, full_name=None), *bad]], "value string")
    good, dead = C.split_dead_letters(raw, "customers")
    assert [r.source_lsn for r in good.orderBy("source_lsn").collect()] == [1, 2]
    assert sorted(r.value for r in dead.collect()) == sorted(bad)


def test_dead_letters_are_parsed_once_for_both_results(spark):
    raw = spark.createDataFrame([(message(1),), ("{broken",)], "value string")
    for part in C.split_dead_letters(raw, "customers"):
        assert "from_json" not in part._jdf.queryExecution().optimizedPlan().toString() and part.count() == 1


def test_messages_in_compressed_files_are_read_like_text(spark, tmp_path):
    sent = [(message(i),) for i in range(300)]
    raw = spark.createDataFrame(sent, "value string").coalesce(1)
    raw.write.text(str(tmp_path / "text"))
    raw.write.option("compression", "zstd").parquet(str(tmp_path / "queue"))
    assert sorted(map(tuple, C.read_messages(spark, str(tmp_path / "queue"), fmt="parquet").collect())) == sorted(sent)
    ingest.start_ingest(spark, str(tmp_path / "queue"), str(tmp_path / "log"), "customers", str(tmp_path / "ckpt"),
                        fmt="parquet").awaitTermination()
    assert ingest.read_log(spark, str(tmp_path / "log")).count() == 300
    size = {n: sum(f.stat().st_size for f in (tmp_path / n).glob("part-*")) for n in ("text", "queue")}
    assert size["queue"] * 4 < size["text"]


def test_envelope_delete_keeps_the_old_row_and_nulls_stay_null(spark):
    row = {n: None for n in row_schema("customers").names}
    envelopes = [
        {"before": None, "after": {**row, "customer_id": 1, "full_name": "new"}, "op": "c",
         "source": {"lsn": 1, "ts_ms": 5, "table": "customers"}, "ts_ms": 6},
        {"before": {**row, "customer_id": 1, "full_name": "new"}, "after": {**row, "customer_id": 1}, "op": "u",
         "source": {"lsn": 2, "ts_ms": 5, "table": "customers"}, "ts_ms": 6},
        {"before": {**row, "customer_id": 1, "full_name": "old"}, "after": None, "op": "d",
         "source": {"lsn": 3, "ts_ms": 5, "table": "customers"}, "ts_ms": 6},
    ]
    raw = spark.createDataFrame([(json.dumps(e),) for e in envelopes], "value string")
    flat = C.unwrap_envelope(raw, "customers")
    assert flat.columns == wire_schema("customers").names
    got = rows(flat.select("__source_lsn", "full_name", "__op", "__deleted"))
    assert got == [(1, "new", "c", "false"), (2, None, "u", "false"), (3, "old", "d", "true")]


def test_one_row_through_three_micro_batches(spark, tmp_path):
    """An insert arrives, an update wins, a delete disappears; the tombstone keeps the row."""
    src, dst, ckpt = tmp_path / "in", tmp_path / "log", tmp_path / "ckpt"
    steps = [message(10, "c"), message(20, "u", full_name="B"), message(30, "d", "true", full_name="B")]
    seen = []
    for i, line in enumerate(steps):
        put(src, f"{i}.json", [line])
        ingest.start_ingest(spark, str(src), str(dst), "customers", str(ckpt)).awaitTermination()
        log = ingest.read_log(spark, str(dst))
        seen.append([r.full_name for r in latest_state(log, KEYS["customers"]).collect()])
    assert seen == [["A"], ["B"], []]
    assert [r.op for r in history(log, "customer_id", 7).collect()] == ["c", "u", "d"]
    assert tombstones(log).first().email == "a@example.com"
    ingest.replay(lambda c: ingest.start_ingest(spark, str(src), str(dst), "customers", c),
                  str(tmp_path / "again")).awaitTermination()
    log = ingest.read_log(spark, str(dst))
    assert log.count() == 6 and latest_state(log, KEYS["customers"]).isEmpty()


def test_malformed_line_halts_the_stream(spark, tmp_path):
    put(tmp_path / "in", "a.json", [message(1), "{broken"])
    query = ingest.start_ingest(spark, str(tmp_path / "in"), str(tmp_path / "log"), "customers", str(tmp_path / "c"))
    with pytest.raises(Exception):
        query.awaitTermination()


def test_dead_letter_stream_goes_on(spark, tmp_path):
    put(tmp_path / "in", "a.json", [message(1), "{broken", message(2)])
    ingest.start_ingest_with_dead_letters(
        spark, str(tmp_path / "in"), str(tmp_path / "log"), "customers", str(tmp_path / "c")
    ).awaitTermination()
    assert ingest.read_log(spark, str(tmp_path / "log")).count() == 2
    assert [r.value for r in ingest.read_dead_letters(spark, str(tmp_path / "log")).collect()] == ["{broken"]
    plan = C.flag_dead_letters(C.read_messages(spark, str(tmp_path / "in")), "customers")._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("FileScan text") == 1


def test_upserted_state_survives_repeats_and_late_versions(spark, tmp_path):
    src, state, ckpt = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "ckpt")
    batches = [
        [message(30, full_name="newest"), message(5, customer_id=8, full_name="other")],
        [message(10, "c", full_name="late"), message(30, full_name="newest")],
        [message(40, "d", "true", customer_id=8)],
    ]
    for i, lines in enumerate(batches):
        put(src, f"{i}.json", lines)
        ingest.start_upsert(spark, str(src), state, "customers", ckpt).awaitTermination()
    want = [(7, "newest")]
    assert rows(ingest.read_state(spark, state, "customers").select("customer_id", "full_name")) == want
    folded = ingest.compact_state(spark, state, "customers", str(tmp_path / "compact"))
    assert rows(folded.select("customer_id", "full_name")) == want
    assert spark.read.parquet(str(tmp_path / "compact")).count() == 2


def test_current_state_as_a_streaming_aggregation(spark, tmp_path):
    put(tmp_path / "in", "a.json", [message(30, full_name="newest"), message(10, "c"), message(4, customer_id=8)])
    typed = C.type_customers(C.read_changes(spark, str(tmp_path / "in"), "customers", streaming=True))
    query = (
        ingest.current_state_stream(typed, ["customer_id"]).writeStream.outputMode("complete")
        .format("memory").queryName("current_customers").trigger(availableNow=True).start())
    query.awaitTermination()
    assert rows(spark.table("current_customers").select("customer_id", "source_lsn", "full_name")) == [
        (7, 30, "newest"), (8, 4, "A")]


def test_windowed_stream_equals_the_batch(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    data = [(t0 + dt.timedelta(seconds=40 * i), f"m{i % 2}", float(i)) for i in range(200)]
    df = spark.createDataFrame(data, "ts timestamp_ntz, metric string, value double")
    df.write.parquet(str(tmp_path / "samples"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "samples"))
    out = monitor.windowed_stream(stream, "5 minutes", "1 minute", "10 minutes")
    query = out.writeStream.outputMode("complete").format("memory").queryName("windows").trigger(availableNow=True).start()
    query.awaitTermination()
    batch = monitor.windowed_stream(df, "5 minutes", "1 minute", "10 minutes")
    assert rows(spark.table("windows")) == rows(batch)


def test_freshness_uses_the_source_clock(spark):
    def log(ts):
        return spark.createDataFrame([(dt.datetime.fromisoformat(ts),)], "source_ts timestamp_ntz")
    empty = spark.createDataFrame([], "source_ts timestamp_ntz")
    got = monitor.freshness({"a": log("2024-01-01 11:45:00"), "b": log("2024-01-01 11:00:00"),
                             "c": log("2024-01-01 09:00:00"), "d": empty}, "2024-01-01 12:00:00")
    assert rows(got.select("source", "status")) == [("a", "pass"), ("b", "warn"), ("c", "error"), ("d", "error")]


def test_a_replay_of_the_state_does_not_overwrite_the_first_run(spark, tmp_path):
    src, state = tmp_path / "in", str(tmp_path / "state")
    put(src, "a.json", [message(10, "c"), message(11, customer_id=9)])
    ingest.start_upsert(spark, str(src), state, "customers", str(tmp_path / "one")).awaitTermination()
    (src / "a.json").unlink()
    put(src, "b.json", [message(20, full_name="B")])
    ingest.start_upsert(spark, str(src), state, "customers", str(tmp_path / "two")).awaitTermination()
    got = rows(ingest.read_state(spark, state, "customers").select("customer_id", "full_name"))
    assert got == [(7, "B"), (9, "A")]
