"""The commerce change logs and metric samples, derived from the base tables.

Each function is a plan over the given Parquet tables: no join, no window and
no shuffle, so it scales with the scan. The same definitions as SQL text are in
``FIXTURES.md`` and, for the oracle, in ``tidemark.catalog.base``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import scalar as S
from tidemark.schemas import row_schema, wire_schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _plus(ts: Column, n: Column, unit: str) -> Column:
    return ts + F.make_dt_interval(**{unit: n.cast("int")})


def _versions(n: int) -> Column:
    return F.explode(F.array(*[F.lit(i) for i in range(n)]))


def _source_ts(df: DataFrame, ts: str) -> DataFrame:
    """Source time, and an arrival half a second to five and a half seconds later."""
    delay = ((F.col("source_lsn") % 5000 + 500) / 1000).cast("decimal(18,6)")
    return df.withColumns({
        "source_ts": F.col(ts),
        "ingested_at": F.col(ts) + F.make_dt_interval(secs=delay),
    })


def orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create, total update, final status, and a delete for one order in fifty."""
    key = F.col("order_id")
    third = key % 3
    final = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "paid")
        .when(third == 0, "cancelled")
        .when(third == 1, "pending")
        .otherwise("shipped")
    )
    base = (
        table(spark, sf_dir, "orders")
        .withColumn("order_id", F.col("o_orderkey"))
        .select(
            "order_id",
            F.col("o_custkey").alias("customer_id"),
            final.alias("final_status"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("amt"),
            _plus(F.col("o_orderdate"), key % 24, "hours").alias("created_at"),
        )
        .withColumn("v", _versions(4))
    )
    v = F.col("v")
    kept = (
        (v < 2)
        | ((v == 2) & (F.col("final_status") != "pending"))
        | ((v == 3) & (key % 50 == 0))
    )
    log = base.filter(kept).select(
        "order_id",
        "customer_id",
        F.when(v >= 2, F.col("final_status")).otherwise("pending").alias("status"),
        F.when(v == 0, F.lit(0).cast("decimal(12,2)")).otherwise(F.col("amt")).alias("total_amount"),
        "created_at",
        F.when(v == 0, F.col("created_at"))
        .when(v == 1, F.col("created_at") + F.expr("INTERVAL '1' MINUTE"))
        .otherwise(_plus(F.col("created_at"), key % 72 + v, "hours"))
        .alias("updated_at"),
        F.when(v == 0, "c").when(v == 3, "d").otherwise("u").alias("op"),
        (key * 10 + v).alias("source_lsn"),
        S.flag(v == 3).alias("is_deleted"),
    )
    return _source_ts(log, "updated_at")


def order_items_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines; repeated line keys are versions of one line, ordered by ship date."""
    days = F.unix_date(F.to_date("l_shipdate")).cast("bigint")
    log = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
        F.lit("c").alias("op"),
        (days * F.lit(10**12) + F.col("l_partkey")).alias("source_lsn"),
        F.lit(0).alias("is_deleted"),
        F.col("l_shipdate").alias("ship_ts"),
    )
    return _source_ts(log, "ship_ts").drop("ship_ts")


def _first_day(spark: SparkSession, sf_dir: str) -> Column:
    return table(spark, sf_dir, "orders").agg(F.min("o_orderdate")).scalar()


def customers_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot rows, a delete for one in forty, a never-ordering copy (negative id) of one in 25."""
    key = F.col("c_custkey")
    ids = F.when(key % 25 == 0, F.array(key, -key - 1)).otherwise(F.array(key))
    cid, v = F.col("customer_id"), F.col("v")
    log = (
        table(spark, sf_dir, "customer")
        .select("c_nationkey", "c_custkey", F.explode(ids).alias("customer_id"))
        .withColumn("v", _versions(2))
        .filter((v == 0) | (cid % 40 == 0))
        .withColumn("t0", _first_day(spark, sf_dir))
        .select(
            "customer_id",
            F.concat(F.lit("user"), cid.cast("string"), F.lit("@example.com")).alias("email"),
            F.concat(F.lit("Customer "), cid.cast("string")).alias("full_name"),
            F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("country_code"),
            _plus(F.col("t0"), cid % 365, "days").alias("created_at"),
            _plus(F.col("t0"), cid % 365 + v, "days").alias("updated_at"),
            F.when(v == 0, "r").otherwise("d").alias("op"),
            (key * 10 + v).alias("source_lsn"),
            v.alias("is_deleted"),
        )
    )
    return _source_ts(log, "updated_at")


def products_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot rows, a new price for one in five, a few deletes."""
    key, v = F.col("p_partkey"), F.col("v")
    price = F.col("p_retailprice").cast("decimal(12,2)") + v.cast("decimal(12,2)")
    log = (
        table(spark, sf_dir, "part")
        .withColumn("v", _versions(3))
        .filter((v == 0) | ((v == 1) & (key % 5 == 0)) | ((v == 2) & (key % 200 == 7)))
        .withColumn("t0", _first_day(spark, sf_dir))
        .select(
            key.alias("product_id"),
            F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
            F.col("p_name").alias("name"),
            F.lower("p_type").alias("category"),
            price.cast("decimal(12,2)").alias("price"),
            F.lit(1).alias("is_active"),
            _plus(F.col("t0"), v, "days").alias("updated_at"),
            F.when(v == 0, "r").when(v == 1, "u").otherwise("d").alias("op"),
            (key * 10 + v).alias("source_lsn"),
            S.flag(v == 2).alias("is_deleted"),
        )
    )
    return _source_ts(log, "updated_at")


LOGS = {
    "orders": orders_log,
    "order_items": order_items_log,
    "customers": customers_log,
    "products": products_log,
}


def log(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return LOGS[entity](spark, sf_dir)


def orders_control(current_orders: DataFrame) -> DataFrame:
    """The live source: current orders with gaps planted so that every verdict occurs."""
    cur = current_orders.select(
        "order_id", "customer_id", "status", "total_amount", "created_at", "updated_at"
    )
    key, ts = F.col("order_id"), F.col("created_at")
    kept = cur.filter(
        (key % 97 != 0)
        & ~((F.month(ts) == 2) & (F.day(ts) == 1))
        & ((F.day(ts) != 15) | (key % 7 == 0))
    )
    ten_years = F.expr("INTERVAL '3650' DAY")
    extra = cur.filter(key % 1000 == 1).withColumns({
        "order_id": -key,
        "created_at": ts + ten_years,
        "updated_at": F.col("updated_at") + ten_years,
    })
    return kept.unionByName(extra)


def lake_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake export of all days, with superseded versions left in."""
    return (
        orders_log(spark, sf_dir)
        .filter(
            (F.col("is_deleted") == 0)
            & (F.col("source_lsn") % 10 >= 1)
        )
        .select(
            "order_id", "customer_id", "status", "total_amount", "created_at", "updated_at",
            F.to_date("created_at").alias("dt"),
        )
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole units of the measured event values, four instances per event type; read as a counter, each fall is a reset."""
    return table(spark, sf_dir, "events").select(
        "ts",
        F.concat(F.lit("events_"), F.col("event_type")).alias("metric"),
        F.create_map(
            F.lit("instance"), (F.col("user_id") % 4).cast("string"),
            F.lit("job"), F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd"),
        ).alias("labels"),
        F.floor("value").cast("double").alias("value"),
    )


def dotted_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dotted metric names of the two prefixes; some are dropped, some fall to the catch-all."""
    eid, uid, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    task = F.concat(
        F.lit("airflow.ti.finish.dag"), (uid % 3).cast("string"),
        F.lit(".task"), (eid % 4).cast("string"), F.lit("."), kind,
    )
    name = (
        F.when(eid % 10 == 0, F.concat(F.lit("airflow.other_"), kind))
        .when(eid % 10 == 1, F.concat(F.lit("superset.DashboardRestApi.get."), kind))
        .when(eid % 10 == 2, F.lit("superset.ChartDataRestApi.data"))
        .when(eid % 10 == 3, F.lit("superset.health"))
        .when(eid % 10 == 4, F.lit("superset.execute_sql"))
        .when(eid % 10 == 5, F.concat(F.lit("superset.new."), kind))
        .when(eid % 10 == 6, F.lit("airflow.dag.etl.load.duration"))
        .when(eid % 10 == 7, F.concat(F.lit("airflow.dagrun.schedule_delay.dag"), (uid % 3).cast("string")))
        .otherwise(task)
    )
    return table(spark, sf_dir, "events").select("event_id", name.alias("name"))


# Fixed value: samples of the rule metrics are packed twenty times closer than the
# events they come from, counted from this moment (2024-01-01 UTC).
PACK = 20
EPOCH_MICROS = 1_704_067_200_000_000


def packed_ts() -> Column:
    micros = S.epoch_micros("ts") - F.lit(EPOCH_MICROS)
    return S.from_micros(F.call_function("div", micros, F.lit(PACK).cast("bigint")) + F.lit(EPOCH_MICROS))


# So many events in a row are one reading of the measured load, and a series is at its high level while
# the mean event value of the reading is above its own limit, 46 to 54.
READING = 200
LEAST_LOAD, LOADS = 46, 9


def rule_samples(spark: SparkSession, sf_dir: str, specs: list) -> DataFrame:
    """One sample per event and series specification (see ``tidemark.catalog.specs``).

    Levels and counters follow ``events.value``: what is measured decides which rules fire.
    """
    shapes = F.array(*[
        F.struct(
            F.lit(s.metric).alias("metric"),
            F.array(*[F.lit(k) for k, _ in s.labels]).alias("names"),
            F.array(*[F.lit(v) for _, v in s.labels]).alias("texts"),
            F.lit(s.mode).alias("mode"), F.lit(float(s.low)).alias("low"),
            F.lit(float(s.high)).alias("high"), F.lit(s.period).alias("period"),
        )
        for s in specs
    ])
    # Spread the events before they multiply, by time: as scrapes arrive, a task then holds all samples of its steps.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    reading = Window.partitionBy(F.call_function("div", F.col("event_id"), F.lit(READING).cast("bigint")))
    # Whole cents, so that a sum does not depend on its order.
    cents = F.round(F.col("value") * 100).cast("bigint")
    events = table(spark, sf_dir, "events").select(
        packed_ts().alias("ts"), "event_id", F.floor("value").cast("double").alias("measured"),
        F.sum(cents).over(reading).alias("cents"), F.count(F.lit(1)).over(reading).alias("n"))
    # A join with the few specifications, so that what is asked of a metric or its labels is asked of them.
    series = spark.range(1).select(F.inline(shapes)).withColumn("labels", F.map_from_arrays("names", "texts"))
    rows = events.repartitionByRange(tasks, "ts").crossJoin(series)
    block = F.call_function("div", F.col("event_id"), F.col("period").cast("bigint"))
    limit = F.lit(LEAST_LOAD) + F.col("period") % LOADS
    level = F.when(F.col("cents") > limit * 100 * F.col("n"), F.col("high")).otherwise(F.col("low"))
    value = (
        F.when(F.col("mode") == "reset", F.col("measured"))
        .when(F.col("mode") == "steps", block.cast("double"))
        .when(F.col("mode") == "seen", F.unix_timestamp("ts").cast("double") - level)
        .otherwise(level)
    )
    return rows.select("ts", "metric", "labels", value.alias("value"))


def to_wire(typed_log: DataFrame, entity: str) -> DataFrame:
    """A typed log as flattened JSON messages, one ``value`` string per row."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    cols = []
    for name, dtype in typed_log.dtypes:
        if name in ("op", "source_lsn", "source_ts", "is_deleted", "ingested_at"):
            continue
        if dtype.startswith("decimal"):
            cols.append(F.col(name).cast("string").alias(name))
        elif dtype.startswith("timestamp"):
            cols.append(F.date_format(name, iso).alias(name))
        elif name == "is_active":
            cols.append((F.col(name) == 1).alias(name))
        else:
            cols.append(F.col(name))
    meta = [
        F.col("op").alias("__op"),
        F.when(F.col("is_deleted") == 1, "true").otherwise("false").alias("__deleted"),
        F.col("source_lsn").alias("__source_lsn"),
        F.unix_millis(F.col("source_ts").cast("timestamp")).alias("__source_ts_ms"),
        F.lit(entity).alias("__table"),
    ]
    return typed_log.select(F.to_json(F.struct(*cols, *meta)).alias("value"))


def to_envelopes(typed_log: DataFrame, entity: str) -> DataFrame:
    """A typed log as nested envelopes: deletes carry ``before``, the others ``after``."""
    flat = to_wire(typed_log, entity).select(F.from_json("value", wire_schema(entity)).alias("m"))
    row = F.struct(*[F.col(f"m.{n}") for n in row_schema(entity).names])
    deleted = F.col("m.__op") == "d"
    return flat.select(
        F.to_json(F.struct(
            F.when(deleted, row).alias("before"),
            F.when(~deleted, row).alias("after"),
            F.struct(
                F.col("m.__source_lsn").alias("lsn"),
                F.col("m.__source_ts_ms").alias("ts_ms"),
                F.col("m.__table").alias("table"),
            ).alias("source"),
            F.col("m.__op").alias("op"),
            F.col("m.__source_ts_ms").alias("ts_ms"),
        )).alias("value")
    )

