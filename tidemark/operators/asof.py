"""Versions as validity intervals, and the version each of many questions would have seen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import sequences
from tidemark.session import shared_dir


def validity(
    log: DataFrame, keys: list[str], columns: list[str], version: str = "source_lsn", deleted: str | None = "is_deleted",
    chunk: Column | None = None,
) -> DataFrame:
    """``keys, valid_from, valid_to, columns``: each version from its position up to the next one's, exclusive.

    The newest version of a key is open (``valid_to`` is null). A delete closes
    the version before it and has no interval itself; repeated deliveries of a
    position count once. Neighbours are found in chunks of positions, so a key
    with very many versions is not gathered in one task.
    """
    marker = [deleted] if deleted else []
    values = [c for c in dict.fromkeys([*columns, *marker])]
    once = log.groupBy(*keys, version).agg(F.max(F.struct(*values)).alias("_v"))
    once = once.select(*keys, F.col(version), *[F.col(f"_v.{c}").alias(c) for c in values])
    chunk = sequences.wal_segment(version) if chunk is None else chunk
    pairs = sequences.adjacent_pairs(once, keys, [version], values, chunk)
    # A pair closes its earlier version; the last version of each key closes nothing.
    closed = pairs.filter(F.col(f"prev_{version}").isNotNull()).select(
        *keys, F.col(f"prev_{version}").alias("valid_from"), F.col(version).alias("valid_to"),
        *[F.col(f"prev_{c}").alias(c) for c in values])
    open_ = once.groupBy(*keys).agg(F.max(F.struct(version, *values)).alias("_v")).select(
        *keys, F.col(f"_v.{version}").alias("valid_from"), F.lit(None).cast(log.schema[version].dataType).alias("valid_to"),
        *[F.col(f"_v.{c}").alias(c) for c in values])
    out = closed.unionByName(open_)
    if deleted:
        out = out.filter(F.coalesce(F.col(deleted), F.lit(0)) == 0)
    return out.select(*keys, "valid_from", "valid_to", *columns)


def as_of_join(
    questions: DataFrame, log: DataFrame, keys: list[str], at: str, columns: list[str], version: str = "source_lsn",
    deleted: str | None = "is_deleted",
) -> DataFrame:
    """Every question (``keys``, position ``at``, further columns) with ``columns`` of its key's newest version up to ``at``.

    They are null where there is no such version or it is a delete, where the
    position is null, and where a key is null. Questions keep their number.

    Versions and questions are dealt together by ranges of (key, position), so
    a key that holds most of them is cut into many pieces of equal size. Inside
    a piece a window carries the last version forward; what a key's earlier
    pieces end with arrives as one row per piece.
    """
    marker = [deleted] if deleted else []
    fields = list(dict.fromkeys([version, *columns, *marker]))
    asked = questions.select(
        *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], F.col(f"`{at}`").alias("_at"), F.lit(1).alias("_kind"),
        F.lit(None).cast(log.select(F.struct(*fields)).schema[0].dataType).alias("_v"),
        F.struct(*[F.col(f"`{c}`") for c in questions.columns]).alias("_q"))
    known = log.select(
        *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], F.col(version).alias("_at"), F.lit(0).alias("_kind"),
        F.struct(*fields).alias("_v"), F.lit(None).cast(asked.schema["_q"].dataType).alias("_q"))
    both = known.unionByName(asked).withColumn("_key", F.struct(*[f"_k{i}" for i in range(len(keys))])).drop(
        *[f"_k{i}" for i in range(len(keys))])
    # Written, so that a piece stays the same piece when a task runs again.
    path = shared_dir(log.sparkSession, "as-of")
    both.repartitionByRange("_key", "_at", "_kind").withColumn("_piece", F.spark_partition_id()).write.parquet(path)
    rows = log.sparkSession.read.schema(both.withColumn("_piece", F.lit(0)).schema).parquet(path)

    # A key goes on in a later piece only if it is the last key of this one and the first of that one.
    edges = rows.groupBy("_piece").agg(F.min("_key").alias("_first"), F.max("_key").alias("_last"))
    ends = rows.select("_piece", "_key", "_v").join(
        edges.select("_piece", F.explode(F.array_distinct(F.array("_first", "_last"))).alias("_key")), ["_piece", "_key"]
    ).groupBy("_piece", "_key").agg(F.max("_v").alias("_end"))
    earlier = Window.partitionBy("_key").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_piece", "_key", F.max("_end").over(earlier).alias("_carried")).filter("_carried IS NOT NULL")

    inside = Window.partitionBy("_piece", "_key").orderBy("_at", "_kind", "_v").rowsBetween(Window.unboundedPreceding, 0)
    seen = rows.withColumn("_seen", F.last("_v", ignorenulls=True).over(inside)).filter("_kind = 1")
    found = seen.join(carried, ["_piece", "_key"], "left").withColumn("_seen", F.coalesce("_seen", "_carried"))
    there = F.col("_seen").isNotNull() & F.col("_q").getField(at).isNotNull()
    if deleted:
        there = there & (F.coalesce(F.col(f"_seen.{deleted}"), F.lit(0)) == 0)
    for i, k in enumerate(keys):
        there = there & F.col("_key").getField(f"_k{i}").isNotNull()
    return found.select("_q.*", *[F.when(there, F.col("_seen").getField(c)).alias(c) for c in columns])
