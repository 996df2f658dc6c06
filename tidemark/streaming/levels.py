"""Current state on disk in levels, so that upserts stay small and a lookup reads few files.

Each batch becomes a run: one row per key it moved, in files of disjoint key
ranges. When a level holds ``FANOUT`` runs they are merged into one run of the
next level, so a row is written about log(batches) times and there are at most
``FANOUT`` runs per level. A manifest names the files with their key ranges; a
lookup opens, of each run, the files whose range holds one of its keys.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.state import latest_state
from tidemark.schemas import KEYS
from tidemark.sources import changes, manifest
from tidemark.sources.manifest import Entry, VerificationError

FANOUT = 4


def _write_run(
    rows: DataFrame, table: str, key: str, level: int, collapse: Callable[[DataFrame], DataFrame] = lambda dealt: dealt,
) -> list[Entry]:
    """Write rows by ranges of the key and say what each file holds; ``collapse`` works within the ranges."""
    spark, run, seen = rows.sparkSession, manifest.run_folder(), Observation()
    # Counted after the ranges are dealt: finding them reads the rows once more.
    dealt = collapse(rows.repartitionByRange(key)).sortWithinPartitions(key)
    dealt.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("keyless")).write.parquet(
        f"{table}/{run}")
    if seen.get["keyless"]:
        raise VerificationError(f"rows without {key}")
    back = spark.read.schema(rows.schema).parquet(f"{table}/{run}")
    # One row per file; a run has as many files as ranges.
    files = back.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n")).collect()
    if sum(f.n for f in files) != int(seen.get["rows"]):
        raise VerificationError(f"{table}/{run}: wrote {seen.get['rows']} rows, read back {sum(f.n for f in files)}")
    return [Entry(None, f"{run}/{f.file}", f.n, level, f.low, f.high) for f in files]


def _runs(entries, level: int) -> dict[str, list[Entry]]:
    found: dict[str, list[Entry]] = {}
    for e in entries:
        if e.level == level:
            found.setdefault(e.path.split("/")[0], []).append(e)
    return found


def _rows(spark: SparkSession, table: str, entries, schema) -> DataFrame:
    with manifest.many_folders(spark):
        return spark.read.schema(schema).parquet(*[f"{table}/{e.path}" for e in entries])


def add_batch(
    batch: DataFrame, table: str, keys: list[str], version: str = "source_lsn", settled: int | None = None,
    fanout: int = FANOUT,
) -> manifest.Manifest:
    """Publish a batch of versions and merge the levels that are full.

    Rows without their first key cannot be looked up and are an error. A batch
    that arrives twice changes nothing: the newest version of a key wins in
    whatever order versions come. ``settled`` is a position up to which no
    version will be delivered again; tombstones up to it are dropped when they
    reach the last level. Without it they are kept, so that a late repeat of an
    older version stays dead.
    """
    spark = batch.sparkSession
    newest = latest_state(batch, keys, version=version, deleted=None)
    entries = _write_run(newest, table, keys[0], 0)
    schema = newest.schema

    def change(old):
        return schema.json(), None, [*(old.entries if old else ()), *entries]

    now = manifest.swap(spark, table, change)
    level = 0
    while any(e.level >= level for e in now.entries):
        if len(_runs(now.entries, level)) >= fanout:
            now = _merge(spark, table, now, level, keys, version, schema, settled)
        level += 1
    return now


def _merge(spark, table, now, level, keys, version, schema, settled) -> manifest.Manifest:
    """All runs of a level as one run of the next one."""
    old_files = [e for e in now.entries if e.level == level]
    last = not any(e.level > level for e in now.entries)

    def collapse(dealt: DataFrame) -> DataFrame:
        merged = latest_state(dealt, keys, version=version, deleted=None)
        if last and settled is not None:
            # Nothing older lies below and nothing older will come: these keys are gone.
            merged = merged.filter((F.coalesce(F.col("is_deleted"), F.lit(0)) == 0) | (F.col(version) > settled))
        return merged

    # A run holds a key once, so few rows share one: the ranges serve the collapse too, and the rows travel once.
    new = _write_run(_rows(spark, table, old_files, schema), table, keys[0], level + 1, collapse)
    gone = {e.path for e in old_files}

    def change(current):
        return schema.json(), None, [*[e for e in current.entries if e.path not in gone], *new]

    return manifest.swap(spark, table, change)


def files_of(spark: SparkSession, table: str, lookup: list | None = None) -> list[Entry]:
    """Files of the newest manifest that can hold one of the keys; all of them without a list."""
    now = manifest.load(spark, table)
    if now is None:
        return []
    if lookup is None:
        return list(now.entries)
    ordered = sorted(lookup)

    def wanted(e: Entry) -> bool:
        at = bisect.bisect_left(ordered, e.low)
        return at < len(ordered) and ordered[at] <= e.high

    return [e for e in now.entries if wanted(e)]


def read_levels(
    spark: SparkSession, table: str, keys: list[str], version: str = "source_lsn", lookup: list | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Current rows, or those of some first keys; only files whose range can hold them are opened.

    ``columns`` names what the caller needs, all by default: the others are neither read nor shuffled.
    """
    now = manifest.load(spark, table)
    if now is None:
        raise FileNotFoundError(f"nothing is published at {table}")
    schema = manifest.schema_of(now)
    files = files_of(spark, table, lookup)
    rows = _rows(spark, table, files, schema) if files else spark.createDataFrame([], schema)
    if lookup is not None:
        rows = rows.filter(F.col(keys[0]).isin(*lookup)) if lookup else rows.limit(0)
    return latest_state(rows, keys, version=version, columns=columns)


def start_levelled_upsert(
    spark: SparkSession, src: str, table: str, entity: str, checkpoint: str, available_now: bool = True,
    fmt: str = "text", options: dict[str, str] | None = None, settled: int | None = None,
) -> StreamingQuery:
    """Keep an entity's current state in levels, from files or any other source of messages."""
    typed = changes.type_changes(
        changes.read_changes(spark, src, entity, streaming=True, fmt=fmt, options=options), entity)

    def save(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            add_batch(batch, table, KEYS[entity], settled=settled)

    writer = typed.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if available_now else writer.start()
