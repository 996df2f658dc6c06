"""Change messages: reading, unwrapping, routing and typing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalar as S
from tidemark.schemas import ENTITIES, envelope_schema, row_schema, wire_schema
from tidemark.session import shared_dir

TOPIC_PREFIX = "cdc.public."


def read_messages(
    spark: SparkSession, path: str, streaming: bool = False, fmt: str = "text",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Raw messages as one ``value`` string column.

    ``fmt="text"`` reads files of JSON lines, ``fmt="parquet"`` files that hold
    the messages in a column ``value``, compressed and still read by many
    tasks. ``fmt="kafka"`` treats ``path`` as the topic and needs the connector
    jar on the class path; a first start reads from the earliest offset.
    """
    reader = spark.readStream if streaming else spark.read
    options = dict(options or {})
    if fmt == "kafka":
        options = {"startingOffsets": "earliest", "subscribe": path, **options}
        return reader.format("kafka").options(**options).load().select(
            F.col("value").cast("string").alias("value")
        )
    return reader.format(fmt).schema("value string").options(**options).load(path).select("value")


def read_changes(
    spark: SparkSession, path: str, entity: str, streaming: bool = False, fmt: str = "text",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Flattened change messages of one entity as wire columns.

    Fields the schema does not declare are ignored. A message that is not
    valid JSON fails the read; use ``split_dead_letters`` to set it aside.
    """
    return parse_strict(read_messages(spark, path, streaming, fmt, options), entity)


def parse_strict(raw: DataFrame, entity: str) -> DataFrame:
    """Parse messages; the first unparseable one stops the job."""
    parsed = F.from_json("value", wire_schema(entity), {"mode": "FAILFAST"})
    return raw.select(parsed.alias("m")).select("m.*")


def flag_dead_letters(raw: DataFrame, entity: str) -> DataFrame:
    """Typed log rows with ``dead`` (1 for a message that could not be parsed or typed) and, of those, the message."""
    schema = wire_schema(entity).add("_corrupt", "string")
    parsed = raw.select(
        "value",
        F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
        .alias("m"),
    ).select("value", "m.*")
    typed = parsed.select("value", "_corrupt", *_typed_columns(entity, strict=False))
    broken = F.col("_corrupt").isNotNull()
    for name in _must_have(entity):
        broken = broken | F.col(name).isNull()
    dead = S.flag(broken)
    return typed.withColumn("dead", dead).withColumn("message", F.when(F.col("dead") == 1, F.col("value"))).drop("value", "_corrupt")


def good_and_dead(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(typed log rows, ``value`` of damaged messages) of flagged rows."""
    good = flagged.filter("dead = 0").drop("dead", "message")
    return good, flagged.filter("dead = 1").select(F.col("message").alias("value"))


def split_dead_letters(raw: DataFrame, entity: str) -> tuple[DataFrame, DataFrame]:
    """(typed log rows, messages that could not be parsed or typed).

    The flagged rows of a batch are written once below the shared folder: a
    filter on the flag would be pushed below the parsing and repeat it for
    every column the flag looks at, once more for each of the two results.
    """
    flagged = flag_dead_letters(raw, entity)
    if not raw.isStreaming:
        path = shared_dir(raw.sparkSession, f"{entity}-flagged")
        flagged.write.parquet(path)
        flagged = raw.sparkSession.read.schema(flagged.schema).parquet(path)
    return good_and_dead(flagged)


def _must_have(entity: str) -> list[str]:
    """Columns that are null only when a message is damaged."""
    return [n for n in row_schema(entity).names if n not in ("full_name", "sku", "name")] + ["source_lsn"]


def unwrap_envelope(raw: DataFrame, entity: str) -> DataFrame:
    """Nested change envelopes as flat wire rows; a delete keeps its old row and is flagged."""
    parsed = raw.select(F.from_json("value", envelope_schema(entity), {"mode": "FAILFAST"}).alias("e"))
    deleted = F.col("e.op") == "d"
    row = F.when(deleted, F.col("e.before")).otherwise(F.col("e.after"))
    return parsed.withColumn("_row", row).select(
        *[F.col(f"_row.{n}").alias(n) for n in row_schema(entity).names],
        F.col("e.op").alias("__op"),
        F.when(deleted, "true").otherwise("false").alias("__deleted"),
        F.col("e.source.lsn").alias("__source_lsn"),
        F.col("e.source.ts_ms").alias("__source_ts_ms"),
        F.col("e.source.table").alias("__table"),
    )


def route_changes(messages: DataFrame, tables: tuple[str, ...] = ENTITIES) -> dict[str, DataFrame]:
    """Messages per captured table; tables that are not listed are left out."""
    name = F.get_json_object("value", "$.__table")
    return {t: messages.filter(name == t).select("value") for t in tables}


def topic_counts(messages: DataFrame) -> DataFrame:
    """Messages per topic."""
    topic = F.concat(F.lit(TOPIC_PREFIX), F.get_json_object("value", "$.__table"))
    return messages.groupBy(topic.alias("topic")).agg(F.count(F.lit(1)).alias("messages"))


def deleted_messages(messages: DataFrame) -> DataFrame:
    """Raw messages flagged as deletes."""
    return messages.filter(F.get_json_object("value", "$.__deleted") == "true")


def _typed_columns(entity: str, strict: bool) -> list[Column]:
    """Wire columns of an entity converted to log types, with the change metadata."""
    money = {"orders": ["total_amount"], "order_items": ["unit_price"], "products": ["price"]}
    out: list[Column] = []
    for name in row_schema(entity).names:
        if name in money.get(entity, ()):
            out.append(S.money(name, strict).alias(name))
        elif name.endswith("_at"):
            out.append(S.iso_timestamp(name, strict).alias(name))
        elif name == "is_active":
            out.append(S.bool_to_int(name).alias(name))
        else:
            out.append(F.col(name))
    return out + [
        F.col("__op").alias("op"),
        F.col("__source_lsn").alias("source_lsn"),
        S.millis_timestamp("__source_ts_ms").alias("source_ts"),
        S.flag(F.col("__deleted") == "true").alias("is_deleted"),
    ]


def type_changes(wire: DataFrame, entity: str) -> DataFrame:
    """Wire rows of any entity as typed log rows; a value that does not convert is an error."""
    return wire.select(*_typed_columns(entity, strict=True))


def type_orders(wire: DataFrame) -> DataFrame:
    return type_changes(wire, "orders")


def type_order_items(wire: DataFrame) -> DataFrame:
    return type_changes(wire, "order_items")


def type_customers(wire: DataFrame) -> DataFrame:
    return type_changes(wire, "customers")


def type_products(wire: DataFrame) -> DataFrame:
    return type_changes(wire, "products")
