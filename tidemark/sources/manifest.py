"""Partitioned tables published by manifest: ``<root>/<table>/_manifests/<version>`` names every partition's folder.

A writer puts its rows into a run folder of its own, reads them back and checks
them, and only then publishes: the next manifest, with the written partitions
in place of the old ones, appears under its version number in one rename. Until
then, and if any check fails, readers see the old partitions; no file that a
manifest names is ever changed, so a reader keeps what it resolved. Two writers
of the same next version: one wins, the other lists again and publishes on top.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from contextlib import contextmanager
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOLDER = "_manifests"
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"  # folder name of a null partition value


class VerificationError(RuntimeError):
    """What was read back is not what was written."""


@dataclass(frozen=True)
class Entry:
    """A published folder or file: ``partition`` is the value of the partition column, or None without one.

    Files that are sorted by a key carry their key range and the level of their run.
    """

    partition: str | None
    path: str
    rows: int
    level: int = 0
    low: int | str | None = None
    high: int | str | None = None


@dataclass(frozen=True)
class Manifest:
    version: int
    published_ms: int
    schema: str
    by: str | None
    entries: tuple[Entry, ...]


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def versions(spark: SparkSession, table: str) -> list[int]:
    """Published versions, oldest first."""
    fs, folder = _fs(spark, f"{table}/{FOLDER}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit())


def load(spark: SparkSession, table: str, version: int | None = None) -> Manifest | None:
    """The newest manifest or one version of it; None where nothing is published."""
    if version is None:
        found = versions(spark, table)
        if not found:
            return None
        version = found[-1]
    lines = spark.read.text(f"{table}/{FOLDER}/{version:012d}", wholetext=True).first()[0].splitlines()
    head = json.loads(lines[0])
    return Manifest(version, head["published_ms"], head["schema"], head["by"],
                    tuple(Entry(**json.loads(line)) for line in lines[1:]))


def swap(
    spark: SparkSession, table: str, change: Callable[[Manifest | None], tuple[str, str | None, Iterable[Entry]]],
    at_ms: int | None = None,
) -> Manifest:
    """Publish the next version as ``change`` makes it of the newest one, again if another writer was first."""
    context = spark._jvm.org.apache.hadoop.fs.FileContext
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    while True:
        old = load(spark, table)
        schema, by, entries = change(old)
        new = Manifest((old.version if old else 0) + 1, at_ms or int(time.time() * 1000), schema, by, tuple(entries))
        head = {"published_ms": new.published_ms, "schema": schema, "by": by}
        text = "\n".join(json.dumps(line) for line in [head, *map(asdict, new.entries)])
        fs, draft = _fs(spark, f"{table}/{FOLDER}/_draft-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        _, final = _fs(spark, f"{table}/{FOLDER}/{new.version:012d}")
        if not fs.exists(final):
            options = spark.sparkContext._gateway.new_array(rename, 1)
            options[0] = rename.NONE
            try:
                context.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, final, options)
                return new
            except Exception:
                if not fs.exists(final):
                    raise
        fs.delete(draft, False)


@contextmanager
def many_folders(spark: SparkSession):
    """Work on thousands of small folders costs by their number, not by their bytes: keep all cores on it.

    Small data would be written by one task, file after file, and listed by one task per folder.
    """
    cores = spark.sparkContext.defaultParallelism
    wanted = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
              "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * cores)}
    old = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_folder() -> str:
    return f"run={uuid.uuid4().hex[:16]}"


def publish(
    df: DataFrame, table: str, by: str | None = None, replace: list[str] | None = None,
    checks: Iterable[Callable[[DataFrame], None]] = (), at_ms: int | None = None,
) -> Manifest:
    """Write, read back, check, publish.

    ``by`` names the partition column, whose values are dates or plain words.
    With ``replace`` exactly these partitions change: one that has no rows now
    is published as empty, and rows of any other partition are an error.
    Without it the whole table is replaced. ``checks`` get the rows as read
    back and raise ``VerificationError``; then nothing changes for readers.
    Rows keep their order within files when one partition is replaced.
    ``at_ms`` is the time of publication, now by default.
    """
    spark, run = df.sparkSession, run_folder()
    path, seen = f"{table}/{run}", Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if by and replace is not None and len(replace) == 1:
        # Straight into its folder: partitionBy would sort the rows anew.
        counted.drop(by).write.parquet(f"{path}/{by}={replace[0]}")
    elif by:
        with many_folders(spark):
            counted.write.partitionBy(by).parquet(path)
    else:
        counted.write.parquet(path)
    written = int(seen.get["rows"])
    with many_folders(spark):
        back = spark.read.schema(df.schema).parquet(path)
    if by:
        counts = {str(r[0] or HIVE_NULL): r[1] for r in back.groupBy(F.col(by).cast("string")).count().collect()}  # one row per partition
        entries = [Entry(p, f"{run}/{by}={p}", n) for p, n in sorted(counts.items()) if n]
    else:
        entries = [Entry(None, run, back.count())]
    if sum(e.rows for e in entries) != written:
        raise VerificationError(f"{path}: wrote {written} rows, read back {sum(e.rows for e in entries)}")
    if replace is not None:
        other = {e.partition for e in entries} - set(replace)
        if other:
            raise VerificationError(f"{path}: rows of {sorted(map(str, other))[:5]} beside {replace[:5]}")
        entries += [Entry(p, "", 0) for p in replace if p not in {e.partition for e in entries}]
    for check in checks:
        check(back)

    def change(old: Manifest | None) -> tuple[str, str | None, list[Entry]]:
        if replace is None or old is None:
            return df.schema.json(), by, entries
        return df.schema.json(), by, [e for e in old.entries if e.partition not in set(replace)] + entries

    return swap(spark, table, change, at_ms)


def schema_of(found: Manifest) -> T.StructType:
    return T.StructType.fromJson(json.loads(found.schema))


def read(
    spark: SparkSession, table: str, partitions: list[str] | None = None, version: int | None = None
) -> DataFrame:
    """Rows of the newest version or of one; only the named partitions' folders are listed."""
    found = load(spark, table, version)
    if found is None:
        raise AnalysisException(f"nothing is published at {table}")
    schema = schema_of(found)
    wanted = [e for e in found.entries if e.rows and (partitions is None or e.partition in set(partitions))]
    if not wanted:
        return spark.createDataFrame([], schema)
    with many_folders(spark):
        rows = spark.read.schema(schema).option("basePath", table).parquet(*[f"{table}/{e.path}" for e in wanted])
    return rows.select(*schema.names)


def superseded(spark: SparkSession, table: str) -> DataFrame:
    """(path, partition, rows, superseded_at): folders that older manifests name and the newest does not."""
    last_seen: dict[str, tuple[Entry, int]] = {}
    current: set[str] = set()
    for version in versions(spark, table):
        manifest = load(spark, table, version)
        now = {e.path for e in manifest.entries if e.rows}
        for path in current - now:
            last_seen[path] = (last_seen[path][0], manifest.published_ms)
        for e in manifest.entries:
            if e.rows:
                last_seen[e.path] = (e, 0)
        current = now
    rows = [(f"{table}/{p}", e.partition, e.rows, at) for p, (e, at) in last_seen.items() if p not in current]
    frame = spark.createDataFrame(rows, "path string, partition string, rows bigint, at_ms bigint")
    return frame.select("path", "partition", "rows", F.timestamp_millis("at_ms").alias("superseded_at"))
