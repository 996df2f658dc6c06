"""Continuous ingest of change messages and upkeep of the current state."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.state import latest_state
from tidemark.schemas import KEYS
from tidemark.sources import changes


def run_folder(root: str, checkpoint: str) -> str:
    """Where the query of one checkpoint writes, so that batch numbers of two never meet."""
    return f"{root.rstrip('/')}/run={hashlib.md5(checkpoint.encode()).hexdigest()[:12]}"


def start_ingest(
    spark: SparkSession, src: str, dst: str, entity: str, checkpoint: str,
    available_now: bool = True, fmt: str = "text", options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Queue to append-only typed log. Progress lives in ``checkpoint``; a new one replays all.

    Every checkpoint writes into its own folder of ``dst``: the file sink skips
    batch numbers it has seen in a folder, so a replay must not share one. Read
    the log with ``read_log``. An unparseable message stops the query.
    """
    typed = changes.type_changes(
        changes.read_changes(spark, src, entity, streaming=True, fmt=fmt, options=options), entity
    ).withColumn("ingested_at", F.current_timestamp())
    writer = typed.writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint).option("path", run_folder(dst, checkpoint))
    return _start(writer, available_now)


def read_log(spark: SparkSession, dst: str) -> DataFrame:
    """The typed log of all runs without damaged messages; rows of a replay repeat earlier ones."""
    log = spark.read.parquet(dst)
    return (changes.good_and_dead(log)[0] if "dead" in log.columns else log).drop("run", "batch")


def read_dead_letters(spark: SparkSession, dst: str) -> DataFrame:
    """Messages of all runs that could not be parsed or typed."""
    return changes.good_and_dead(spark.read.parquet(dst))[1]


def start_ingest_with_dead_letters(
    spark: SparkSession, src: str, dst: str, entity: str, checkpoint: str, available_now: bool = True,
    fmt: str = "text", options: dict[str, str] | None = None,
) -> StreamingQuery:
    """As ``start_ingest``, but damaged messages are set aside and the stream goes on.

    A batch is parsed once and written once, damaged messages in a partition
    of their own; nothing is cached. ``options`` limit the rate of the source,
    such as ``maxFilesPerTrigger`` or ``maxOffsetsPerTrigger``. Each batch
    writes into its own folder, so a retried batch replaces itself.
    """
    raw = changes.read_messages(spark, src, streaming=True, fmt=fmt, options=options)

    def save(batch: DataFrame, batch_id: int) -> None:
        flagged = changes.flag_dead_letters(batch, entity)
        flagged.write.mode("overwrite").partitionBy("dead").parquet(f"{run_folder(dst, checkpoint)}/batch={batch_id}")

    return _start(raw.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint), available_now)


def _start(writer, available_now: bool) -> StreamingQuery:
    return writer.trigger(availableNow=True).start() if available_now else writer.start()


def replay(start: Callable[[str], StreamingQuery], new_checkpoint: str) -> StreamingQuery:
    """Read everything again from the earliest message: the same start with a fresh checkpoint."""
    return start(new_checkpoint)


def current_state_stream(typed: DataFrame, keys: list[str], version: str = "source_lsn") -> DataFrame:
    """The newest version of every key as a streaming aggregation (update or complete mode).

    The state holds one row per key. Order of arrival and repeats do not
    matter, and no watermark drops late versions. Tombstones stay in the
    output, flagged, so that a sink can remove the key. With many keys, run it
    on the RocksDB state store, which keeps the state off the heap.
    """
    rest = [c for c in typed.columns if c not in (*keys, version)]
    newest = typed.groupBy(*keys).agg(F.max(F.struct(version, *rest)).alias("_n"))
    return newest.select(*keys, *[F.col(f"_n.{c}").alias(c) for c in (version, *rest)])


def start_upsert(
    spark: SparkSession, src: str, state: str, entity: str, checkpoint: str, available_now: bool = True,
    fmt: str = "text", options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Keep the current state of an entity on disk; ``levels`` does the same with merges as it goes.

    Every micro-batch appends the keys it moved, one row each, in a folder
    named by the batch id, so a retried batch overwrites its own output.
    ``read_state`` collapses the batches. ``compact_state`` folds them into a
    new folder, to be run between queries when there are many.
    """
    typed = changes.type_changes(
        changes.read_changes(spark, src, entity, streaming=True, fmt=fmt, options=options), entity)

    def save(batch: DataFrame, batch_id: int) -> None:
        newest = latest_state(batch, KEYS[entity], deleted=None)
        newest.write.mode("overwrite").parquet(f"{run_folder(state, checkpoint)}/batch={batch_id}")

    return _start(typed.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint), available_now)


def read_state(spark: SparkSession, state: str, entity: str) -> DataFrame:
    """Current rows out of the appended batches."""
    return latest_state(spark.read.parquet(state).drop("run", "batch"), KEYS[entity])


def compact_state(spark: SparkSession, state: str, entity: str, dst: str) -> DataFrame:
    """Fold all batches into one row per key, tombstones kept so that older repeats stay dead."""
    folded = latest_state(spark.read.parquet(state).drop("run", "batch"), KEYS[entity], deleted=None)
    folded.write.mode("overwrite").parquet(f"{run_folder(dst, state)}/batch=0")
    return read_state(spark, dst, entity)
