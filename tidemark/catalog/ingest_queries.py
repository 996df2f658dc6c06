"""Change messages, batch and streaming ingest, dead letters, lag and freshness."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import fixtures as X
from tidemark.catalog import query
from tidemark.catalog.base import Inputs, sql
from tidemark.operators import timeseries as TS
from tidemark.operators.state import latest_state
from tidemark.schemas import KEYS
from tidemark.sources import changes as C
from tidemark.streaming import ingest, levels, monitor
from tidemark.streaming import islands as I


def _messages(x: Inputs, entity: str):
    """The entity's log as JSON messages with one field the schema does not declare."""
    wire = X.to_wire(x.log(entity), entity)
    return wire.select(F.regexp_replace("value", r"\}$", ',"unknown_field":1}').alias("value"))


def _written(x: Inputs, entity: str) -> str:
    path = x.scratch(f"{entity}-messages")
    _messages(x, entity).write.text(path)
    return path


def _plain(df):
    """Zoned timestamps as wall clock, for comparison."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n, t in df.dtypes if t == "timestamp"})


def _register_typed(entity: str, columns: str, view: str, source_ts: str = "updated_at") -> None:
    @query(f"typed_{entity}", sql(
        f"SELECT {columns}, op, source_lsn, {source_ts} AS source_ts, is_deleted FROM {view}", view))
    def _(x: Inputs):
        wire = C.read_changes(x.spark, _written(x, entity), entity)
        return _plain(C.type_changes(wire, entity))


_register_typed("orders", "order_id, customer_id, status, total_amount, created_at, updated_at", "orders_log")
_register_typed("order_items", "order_item_id, order_id, product_id, quantity, unit_price", "order_items_log",
                "source_ts")
_register_typed("customers", "customer_id, email, full_name, country_code, created_at, updated_at", "customers_log")
_register_typed("products", "product_id, sku, name, category, price, is_active, updated_at", "products_log")


@query("unwrapped_envelopes", sql("""
SELECT order_id, status, total_amount, op AS __op, CASE WHEN is_deleted = 1 THEN 'true' ELSE 'false' END AS __deleted,
  source_lsn AS __source_lsn, epoch_ms(updated_at) AS __source_ts_ms, 'orders' AS __table FROM orders_log""", "orders_log"))
def _(x: Inputs):
    flat = C.unwrap_envelope(X.to_envelopes(x.log("orders"), "orders"), "orders")
    return flat.select("order_id", "status", F.col("total_amount").cast("decimal(12,2)").alias("total_amount"),
                       "__op", "__deleted", "__source_lsn", "__source_ts_ms", "__table")


def _all_messages(x: Inputs):
    out = None
    for entity in KEYS:
        part = X.to_wire(x.log(entity), entity)
        out = part if out is None else out.unionByName(part)
    return out


@query("messages_per_topic", sql("""
SELECT 'cdc.public.orders' AS topic, count(*) AS messages FROM orders_log
UNION ALL SELECT 'cdc.public.order_items', count(*) FROM order_items_log
UNION ALL SELECT 'cdc.public.customers', count(*) FROM customers_log
UNION ALL SELECT 'cdc.public.products', count(*) FROM products_log""",
    "orders_log", "order_items_log", "customers_log", "products_log"))
def _(x: Inputs):
    return C.topic_counts(_all_messages(x))


@query("routed_changes", sql("""
SELECT 'orders' AS entity, op, count(*) AS n FROM orders_log GROUP BY op
UNION ALL SELECT 'customers', op, count(*) FROM customers_log GROUP BY op""", "orders_log", "customers_log"))
def _(x: Inputs):
    """Two captured tables out of a mixed stream; the others are left out."""
    parts = C.route_changes(_all_messages(x), ("orders", "customers"))
    both = None
    for entity, raw in parts.items():
        typed = C.type_changes(C.parse_strict(raw, entity), entity).select(F.lit(entity).alias("entity"), "op")
        both = typed if both is None else both.unionByName(typed)
    return both.groupBy("entity", "op").agg(F.count(F.lit(1)).alias("n"))


@query("deleted_messages", sql("""
SELECT order_id, source_lsn FROM orders_log WHERE is_deleted = 1""", "orders_log"))
def _(x: Inputs):
    raw = C.deleted_messages(_messages(x, "orders"))
    return C.parse_strict(raw, "orders").select("order_id", F.col("__source_lsn").alias("source_lsn"))


def _damaged(x: Inputs):
    """Some messages cut short, some with an amount that is no number."""
    raw = _messages(x, "orders").withColumn("oid", F.get_json_object("value", "$.order_id").cast("bigint"))
    oid = F.col("oid")
    return raw.select(
        F.when(oid % 100 == 7, F.substring("value", 1, 40))
        .when(oid % 100 == 8, F.regexp_replace("value", r'"total_amount":"[^"]*"', '"total_amount":"n/a"'))
        .otherwise(F.col("value")).alias("value"))


DEAD_SQL = sql("""
SELECT 'good' AS kind, count(*) AS n FROM orders_log WHERE order_id % 100 NOT IN (7, 8)
UNION ALL SELECT 'dead', count(*) FROM orders_log WHERE order_id % 100 IN (7, 8)""", "orders_log")


def _good_and_dead(good, bad):
    n = F.count(F.lit(1)).alias("n")
    return good.agg(n).select(F.lit("good").alias("kind"), "n").unionByName(
        bad.agg(n).select(F.lit("dead").alias("kind"), "n"))


@query("dead_letters", DEAD_SQL)
def _(x: Inputs):
    return _good_and_dead(*C.split_dead_letters(_damaged(x), "orders"))


@query("dead_letters_streamed", DEAD_SQL)
def _(x: Inputs):
    src, dst = x.scratch("messages"), x.scratch("log")
    _damaged(x).write.text(src)
    ingest.start_ingest_with_dead_letters(x.spark, src, dst, "orders", x.scratch("ckpt")).awaitTermination()
    return _good_and_dead(ingest.read_log(x.spark, dst), ingest.read_dead_letters(x.spark, dst))


def _out_of_order(x: Inputs, entity: str) -> str:
    """Messages in folders by version so that late versions come first, one folder twice.

    As text they would be most of what a query writes; in compressed Parquet a
    file is still split among tasks.
    """
    log, root = x.log(entity), x.scratch(f"{entity}-queue")
    for folder, part in (("0", 2), ("1", 0), ("2", 1), ("3", 2)):
        rows = log.filter(F.col("source_lsn") % 3 == part)
        X.to_wire(rows, entity).write.option("compression", "zstd").parquet(f"{root}/{folder}")
    return root


CURRENT_SQL = sql("""
SELECT order_id, customer_id, status, total_amount, created_at, updated_at, source_lsn FROM cur_orders""", "cur_orders")
CURRENT = ["order_id", "customer_id", "status", "total_amount", "created_at", "updated_at", "source_lsn"]


@query("streamed_ingest_current_orders", CURRENT_SQL)
def _(x: Inputs):
    """Redelivered and out-of-order messages end in the same current rows."""
    dst = x.scratch("log")
    ingest.start_ingest(
        x.spark, _out_of_order(x, "orders") + "/*", dst, "orders", x.scratch("ckpt"), fmt="parquet").awaitTermination()
    return _plain(latest_state(ingest.read_log(x.spark, dst), ["order_id"], columns=CURRENT))


@query("replayed_ingest_versions", sql("""
SELECT CAST(2 * count(*) AS BIGINT) AS stored, count(DISTINCT source_lsn) AS versions FROM orders_log""", "orders_log"))
def _(x: Inputs):
    """A second read from the start stores every version once more."""
    src, dst = _written(x, "orders"), x.scratch("log")

    def start(checkpoint: str):
        return ingest.start_ingest(x.spark, src, dst, "orders", checkpoint)

    start(x.scratch("ckpt")).awaitTermination()
    ingest.replay(start, x.scratch("ckpt")).awaitTermination()
    log = ingest.read_log(x.spark, dst)
    return log.agg(F.count(F.lit(1)).alias("stored"), F.count_distinct("source_lsn").alias("versions"))


@query("upserted_state_customers", sql("""
SELECT customer_id, email, country_code, source_lsn FROM cur_customers""", "cur_customers"))
def _(x: Inputs):
    state = x.scratch("state")
    ingest.start_upsert(
        x.spark, _out_of_order(x, "customers") + "/*", state, "customers", x.scratch("ckpt"), fmt="parquet").awaitTermination()
    return ingest.read_state(x.spark, state, "customers").select(
        "customer_id", "email", "country_code", "source_lsn")


@query("compacted_state_products", sql("""
SELECT product_id, category, current_price AS price, source_lsn FROM cur_products""", "cur_products"))
def _(x: Inputs):
    state = x.scratch("state")
    ingest.start_upsert(
        x.spark, _out_of_order(x, "products") + "/*", state, "products", x.scratch("ckpt"), fmt="parquet").awaitTermination()
    return ingest.compact_state(x.spark, state, "products", x.scratch("compacted")).select(
        "product_id", "category", "price", "source_lsn")


def _levelled(x: Inputs) -> str:
    table = x.scratch("levels")
    levels.start_levelled_upsert(
        x.spark, _out_of_order(x, "orders") + "/*", table, "orders", x.scratch("ckpt"), fmt="parquet",
        options={"maxFilesPerTrigger": "4"}).awaitTermination()
    return table


@query("levelled_state_orders", CURRENT_SQL)
def _(x: Inputs):
    """Several batches, late and repeated versions among them, merged by levels."""
    return _plain(levels.read_levels(x.spark, _levelled(x), KEYS["orders"], columns=CURRENT))


@query("levelled_state_lookup", sql("""
SELECT order_id, status, total_amount, source_lsn FROM cur_orders WHERE order_id % 1500 = 7""", "cur_orders"))
def _(x: Inputs):
    """A few keys out of the levels: only files whose range holds one of them are opened."""
    wanted = [r[0] for r in x.orders("order_id").filter("order_id % 1500 = 7").collect()]
    return levels.read_levels(x.spark, _levelled(x), KEYS["orders"], lookup=wanted,
                              columns=["order_id", "status", "total_amount", "source_lsn"])


# lag, freshness and progress

LAG_SQL = """
SELECT '{name}' AS entity, min(CASE WHEN r >= ceil(0.5::DOUBLE * n) THEN lag END) AS p50,
  min(CASE WHEN r >= ceil(0.99::DOUBLE * n) THEN lag END) AS p99, max(lag) AS "max"
FROM (SELECT lag, row_number() OVER (ORDER BY lag) AS r, count(*) OVER () AS n FROM (
  SELECT CAST(source_lsn % 5000 + 500 AS BIGINT) AS lag FROM {view}) a) q"""


@query("ingest_latency", sql(
    "\nUNION ALL ".join(LAG_SQL.format(name=n, view=f"{n}_log") for n in KEYS), *[f"{n}_log" for n in KEYS]))
def _(x: Inputs):
    return reduce(DataFrame.unionByName, [monitor.ingest_latency(x.log(n), n) for n in KEYS])


@query("batch_lag_per_day", sql("""
SELECT dt, min(CASE WHEN r >= ceil(0.5::DOUBLE * n) THEN lag END) AS p50,
  min(CASE WHEN r >= ceil(0.99::DOUBLE * n) THEN lag END) AS p99, max(lag) AS "max"
FROM (SELECT dt, lag, row_number() OVER (PARTITION BY dt ORDER BY lag) AS r, count(*) OVER (PARTITION BY dt) AS n
  FROM (SELECT dt, epoch_ms(staged_at) - epoch_ms(updated_at) AS lag FROM lake_staged) a) q
GROUP BY dt""", "lake_staged"))
def _(x: Inputs):
    return monitor.batch_lag(x.lake_staged())


FRESH_AT = "2001-08-05 01:00:00"


@query("source_freshness", sql(f"""
SELECT source, newest, CAST(epoch(TIMESTAMP '{FRESH_AT}') - epoch(newest) AS BIGINT) AS age_seconds,
  CASE WHEN epoch(TIMESTAMP '{FRESH_AT}') - epoch(newest) > 7200 THEN 'error'
    WHEN epoch(TIMESTAMP '{FRESH_AT}') - epoch(newest) > 1800 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT 'orders' AS source, max(updated_at) AS newest FROM orders_log
  UNION ALL SELECT 'order_items', max(source_ts) FROM order_items_log
  UNION ALL SELECT 'customers', max(updated_at) FROM customers_log
  UNION ALL SELECT 'products', max(updated_at) FROM products_log) q""",
    "orders_log", "order_items_log", "customers_log", "products_log"))
def _(x: Inputs):
    return monitor.freshness({n: x.log(n) for n in KEYS}, FRESH_AT)


@query("consumer_lag", sql("""
SELECT consumergroup, CAST(sum(end_offset - committed) AS BIGINT) AS lag FROM (
  SELECT event_type AS consumergroup, user_id % 6 AS part, max(event_id) AS end_offset,
    max(CASE WHEN event_id % 3 = 0 THEN event_id ELSE 0 END) AS committed FROM events GROUP BY 1, 2) q GROUP BY 1"""))
def _(x: Inputs):
    offsets = x.table("events").groupBy(
        F.col("event_type").alias("consumergroup"), (F.col("user_id") % 6).alias("part")
    ).agg(
        F.max("event_id").alias("end_offset"),
        F.max(F.when(F.col("event_id") % 3 == 0, F.col("event_id")).otherwise(0)).alias("committed"))
    return monitor.consumer_lag(offsets)


@query("consumers_with_recent_errors", sql("""
SELECT event_id FROM events WHERE event_type = 'error' AND ts + INTERVAL '1' MINUTE > TIMESTAMP '2024-01-29 23:58:00'"""))
def _(x: Inputs):
    consumers = x.table("events").filter(F.col("event_type") == "error").select(
        "event_id", F.array("ts", F.col("ts") + F.expr("INTERVAL '1' MINUTE")).alias("exception_times"))
    return monitor.recent_errors(consumers, "2024-01-30 00:00:00").select("event_id")


@query("consumer_exceptions", sql("""
SELECT event_type AS "table", unnest(['first ' || CAST(event_id AS VARCHAR), 'second ' || CAST(event_id AS VARCHAR)]) AS err
FROM events WHERE event_type = 'error'"""))
def _(x: Inputs):
    eid, none = F.col("event_id").cast("string"), F.array().cast("array<string>")
    texts = F.array(F.concat(F.lit("first "), eid), F.concat(F.lit("second "), eid))
    return monitor.exceptions(x.table("events").select(
        F.col("event_type").alias("table"),
        F.when(F.col("event_type") == "error", texts).otherwise(none).alias("exception_texts")))


@query("capture_lag_alerts", sql("""
SELECT k, min(ts) AS start, max(ts) AS "end",
  CASE WHEN epoch_us(max(ts)) - epoch_us(min(ts)) >= 172800000000 THEN min(ts) + INTERVAL '48' HOUR END AS fire_at
FROM (SELECT *, sum(CASE WHEN prev IS NOT DISTINCT FROM above AND prev_ts IS NOT NULL THEN 0 ELSE 1 END)
    OVER (PARTITION BY k ORDER BY ts, above ROWS UNBOUNDED PRECEDING) AS run
  FROM (SELECT *, lag(above) OVER w AS prev, lag(ts) OVER w AS prev_ts
    FROM (SELECT customer_id % 10 AS k, updated_at AS ts, source_lsn % 5000 + 500 > 1500 AS above FROM orders_log) a
    WINDOW w AS (PARTITION BY k ORDER BY ts, above)) b) c
WHERE above GROUP BY k, run""", "orders_log"))
def _(x: Inputs):
    lags = x.log("orders").select(
        (F.col("customer_id") % 10).alias("k"), F.col("source_ts").alias("ts"),
        monitor.lag_millis("ingested_at", "source_ts").cast("double").alias("value"))
    return monitor.capture_lag_alerts(lags, ["k"], 1500, 48 * 3600)


# alerts as sessions of a stream

EVALUATED = 900  # seconds between evaluations
SERIES = ["metric", "instance"]


def _out_of_order_samples(x: Inputs) -> tuple[DataFrame, str]:
    """A stream of the samples in six time blocks, each two swapped, and the lateness that covers it.

    A heartbeat long after the last sample closes every session.
    """
    root = x.scratch("samples")
    samples = TS.with_labels(x.samples(), "instance").select("ts", *SERIES, "value")
    first, last = samples.agg(F.min("ts"), F.max("ts")).first()
    block = (last - first) / 6
    for n, k in enumerate((1, 0, 3, 2, 5, 4)):
        part = samples.filter((F.col("ts") >= first + block * k) if k else F.lit(True))
        part.filter((F.col("ts") < first + block * (k + 1)) if k < 5 else F.lit(True)).write.parquet(f"{root}/{n}")
    # Of a series of its own, whose session stays open; under a metric that the rules know, because a filter on
    # other columns than the time is moved below the watermark.
    beat = samples.limit(1).select(F.lit(last + block * 6).cast("timestamp_ntz").alias("ts"), "metric",
                                   F.lit("heartbeat").alias("instance"), "value")
    beat.write.parquet(f"{root}/9")
    stream = x.spark.readStream.schema(samples.schema).option("maxFilesPerTrigger", 4).parquet(f"{root}/*")
    return stream, f"{int(block.total_seconds() * 3)} seconds"


def _collected(x: Inputs, stream: DataFrame) -> DataFrame:
    dst = x.scratch("sessions")
    stream.writeStream.format("parquet").outputMode("append").option("path", dst).option(
        "checkpointLocation", x.scratch("ckpt")).trigger(availableNow=True).start().awaitTermination()
    return x.spark.read.schema(stream.schema).parquet(dst)


def _evaluated(x: Inputs) -> DataFrame:
    """Evaluations with a rule for every metric: seconds to hold, and to go on without a breach."""
    samples, lateness = _out_of_order_samples(x)
    rules = x.spark.createDataFrame(
        [("events_click", 3600, 1800), ("events_view", 1800, 900), ("events_purchase", 7200, 3600), ("events_error", 7200, 7200),
         ("events_signup", 3600, 2700)], "metric string, hold int, gap int")
    return I.evaluations(samples, SERIES, EVALUATED, lateness).join(rules, "metric")


EVALUATED_SQL = f"""rules AS (SELECT * FROM (VALUES ('events_click', 3600, 1800), ('events_view', 1800, 900),
  ('events_purchase', 7200, 3600), ('events_error', 7200, 7200), ('events_signup', 3600, 2700)) v(metric, hold, gap)),
evaluated AS (SELECT metric, instance, no * {EVALUATED} AS tick, value, hold, gap FROM (
  SELECT metric, instance, epoch_us(ts) // {EVALUATED * 1_000_000} + 1 AS no, value,
    row_number() OVER (PARTITION BY metric, instance, epoch_us(ts) // {EVALUATED * 1_000_000} ORDER BY ts DESC, value DESC) AS rn
  FROM samples) q JOIN rules USING (metric) WHERE rn = 1)"""


def _sessions_sql(where: str, main: str) -> str:
    return sql(f"""
{main} FROM (SELECT metric, instance, hold, gap, run, min(tick) AS a, max(tick) AS b, count(*) AS n
  FROM (SELECT *, sum(CASE WHEN tick - prev <= gap THEN 0 ELSE 1 END)
      OVER (PARTITION BY metric, instance ORDER BY tick ROWS UNBOUNDED PRECEDING) AS run
    FROM (SELECT *, lag(tick) OVER (PARTITION BY metric, instance ORDER BY tick) AS prev FROM evaluated WHERE {where}) l) r
  GROUP BY ALL) s""", "samples").replace("\nSELECT metric, instance, make", f",\n{EVALUATED_SQL}\nSELECT metric, instance, make", 1)


def _second(s: str) -> str:
    return f"make_timestamp(({s}) * 1000000)"


@query("alert_stretches_streamed", _sessions_sql("value > 30", f"""SELECT metric, instance, {_second('a')} AS start, {_second('b')} AS "end",
  CASE WHEN b - a >= hold THEN {_second('a + hold')} END AS fire_at, {_second('b + gap')} AS over_at, n"""))
def _(x: Inputs):
    by = [*SERIES, "hold", "gap"]
    return _collected(x, I.alert_islands(_evaluated(x), by, F.col("value") > 30, "gap", "hold")).drop("hold", "gap")


@query("silent_series_streamed", _sessions_sql("true", f"""SELECT metric, instance, {_second('b')} AS last_seen, {_second('b + gap')} AS stale_at"""))
def _(x: Inputs):
    return _collected(x, I.silences(_evaluated(x), [*SERIES, "gap"], "gap")).drop("gap")
