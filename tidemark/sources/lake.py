"""The partitioned lake: days of an entity in Parquet, published by manifest.

``<root>/<entity>/run=…/dt=YYYY-MM-DD/`` holds the rows and a manifest names the
folder of each day, so a day is replaced only after its new rows are verified.
A folder without a manifest is read as a plain ``dt=`` layout.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import scalar as S
from tidemark.sources import manifest
from tidemark.sources.manifest import VerificationError

# Days the raw layer and superseded file versions are kept.
RAW_KEEP_DAYS = 30
SUPERSEDED_KEEP_DAYS = 7

LAYERS = ("raw", "staged", "curated")


@dataclass(frozen=True)
class WriteReport:
    path: str
    written: int
    read_back: int
    status: str = "verified"


def entity_path(root: str, entity: str) -> str:
    return f"{root.rstrip('/')}/{entity}"


def read_lake(spark: SparkSession, root: str, entity: str, dates: list[str] | None = None) -> DataFrame:
    """All days of an entity, or some of them; a date list prunes directories, an empty one reads nothing."""
    if manifest.versions(spark, entity_path(root, entity)):
        return manifest.read(spark, entity_path(root, entity), dates)
    df = spark.read.parquet(entity_path(root, entity))
    if dates is not None:
        df = df.filter(F.col("dt").isin(*[F.lit(d).cast("date") for d in dates]))
    return df


def read_lake_files(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """Rows of every file with the date taken from its path instead of from discovery."""
    current = manifest.load(spark, entity_path(root, entity))
    paths = [entity_path(root, entity)] if current is None else [
        f"{entity_path(root, entity)}/{e.path}" for e in current.entries if e.rows]
    with manifest.many_folders(spark):
        files = spark.read.option("recursiveFileLookup", "true").parquet(*paths)
    return files.withColumn("dt", S.dt_from_path("_metadata.file_path"))


def write_verified(
    df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite"
) -> WriteReport:
    """Write, read the same path back, and raise unless the counts agree.

    The written count is taken while writing, so the plan runs once. With
    ``mode="append"`` the path must be new to this call.
    """
    spark = df.sparkSession
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    written = int(seen.get["rows"])
    read_back = spark.read.schema(df.schema).parquet(path).count()
    if written != read_back:
        raise VerificationError(f"{path}: wrote {written} rows, read back {read_back}")
    return WriteReport(path, written, read_back, "verified" if written else "empty")


def report(path: str, published: manifest.Manifest, partitions: list[str] | None = None) -> WriteReport:
    rows = sum(e.rows for e in published.entries if partitions is None or e.partition in partitions)
    return WriteReport(path, rows, rows, "verified" if rows else "empty")


def write_partition(
    df: DataFrame, root: str, entity: str, day: str, checks: Iterable[Callable[[DataFrame], None]] = ()
) -> WriteReport:
    """Replace exactly one day, once its new rows are verified; the day is in the path and not in the files."""
    path = entity_path(root, entity)
    rows = df.withColumn("dt", F.lit(day).cast("date"))
    return report(path, manifest.publish(rows, path, "dt", [day], checks), [day])


def write_all(
    df: DataFrame, root: str, entity: str, checks: Iterable[Callable[[DataFrame], None]] = (), at_ms: int | None = None
) -> WriteReport:
    """Rebuild every day of an entity; readers see all old days or all new ones.

    The rebalance step gathers a day's rows into few files and splits a day
    that is too large for one task.
    """
    path = entity_path(root, entity)
    return report(path, manifest.publish(df.hint("rebalance", "dt"), path, "dt", None, checks, at_ms))


def write_days(df: DataFrame, root: str, entity: str, days: list[str], at_ms: int | None = None) -> WriteReport:
    """Replace some days at once: readers see all of them as they were or all as they are now."""
    path = entity_path(root, entity)
    return report(path, manifest.publish(df.hint("rebalance", "dt"), path, "dt", days, at_ms=at_ms), days)


def assert_nonempty(spark: SparkSession, path: str) -> None:
    """A success marker without rows counts as a failure."""
    if spark.read.parquet(path).isEmpty():
        raise VerificationError(f"{path}: no rows")


def retention_plan(
    partitions: DataFrame, today: str, keep_days: int = RAW_KEEP_DAYS,
    superseded_days: int = SUPERSEDED_KEEP_DAYS,
) -> DataFrame:
    """``(path, action)`` for partitions ``(path, dt, superseded_at)``; nothing is deleted here.

    A current partition expires by its date; a superseded version by the day it
    was replaced.
    """
    day = F.lit(today).cast("date")
    action = (
        F.when(
            F.col("superseded_at").isNotNull(),
            F.when(F.datediff(day, "superseded_at") > superseded_days, "expire").otherwise("keep"),
        )
        .when(F.datediff(day, "dt") > keep_days, "expire")
        .otherwise("keep")
    )
    return partitions.select("path", action.alias("action"))


def lake_versions(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """``(path, dt, superseded_at, bytes, files)`` of every folder that a manifest of the entity names or named.

    What ``retention_plan`` needs, from the manifests and the files themselves.
    """
    table = entity_path(root, entity)
    current = manifest.load(spark, table)
    here = spark.createDataFrame(
        [(f"{table}/{e.path}", e.partition, e.rows) for e in (current.entries if current else ()) if e.rows],
        "path string, partition string, rows bigint").withColumn("superseded_at", F.lit(None).cast("timestamp"))
    named = here.unionByName(manifest.superseded(spark, table))
    if named.isEmpty():
        return named.select("path", F.col("partition").cast("date").alias("dt"), F.to_date("superseded_at").alias("superseded_at"),
                            F.lit(0).cast("bigint").alias("bytes"), F.lit(0).cast("bigint").alias("files"))
    sizes = _files(spark, table).groupBy("folder").agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"))
    named = named.withColumn("folder", F.regexp_extract("path", FOLDER, 1))
    return named.join(sizes, "folder").select(
        "path", F.col("partition").cast("date").alias("dt"), F.to_date("superseded_at").alias("superseded_at"), "bytes", "files")


# The run folder, and the day's below it, at the end of a folder's path.
FOLDER = r"(run=[^/]+(?:/dt=[^/]+)?)$"


def _files(spark: SparkSession, table: str) -> DataFrame:
    """Every data file below a table, of all versions: path, length and the folder it lies in."""
    with manifest.many_folders(spark):
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
            "pathGlobFilter", "*.parquet").load(table).select("path", "length")
    return listed.withColumn("folder", F.regexp_extract(F.regexp_extract("path", r"^(.*)/[^/]*$", 1), FOLDER, 1))


def lake_files(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """``(dt, path, length)`` of the files that the newest manifest of the entity names."""
    table = entity_path(root, entity)
    current = manifest.load(spark, table)
    folders = spark.createDataFrame(
        [(e.path, e.partition) for e in (current.entries if current else ()) if e.rows], "folder string, dt string")
    if folders.isEmpty():
        return spark.createDataFrame([], "dt date, path string, length bigint")
    return _files(spark, table).join(folders, "folder").select(F.col("dt").cast("date").alias("dt"), "path", "length")


def compaction_groups(files: DataFrame, target_bytes: int = 128 << 20) -> DataFrame:
    """``(path, group)``: neighbouring small files of a day that together fill about ``target_bytes``.

    ``files`` has ``(dt, path, length)``. A file's group is where its first
    byte falls in the day's running total, so days are grouped independently
    and a file above the target is alone with what starts beside it.
    """
    before = F.coalesce(F.sum("length").over(
        Window.partitionBy("dt").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return files.select("dt", "path", "length", F.floor(before / target_bytes).alias("group"))


def partition_report(df: DataFrame) -> DataFrame:
    """Rows per Spark partition."""
    return (
        df.groupBy(F.spark_partition_id().alias("partition"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def day_report(df: DataFrame, day: str = "dt") -> DataFrame:
    """Rows per day."""
    return df.groupBy(F.col(day).alias("dt")).agg(F.count(F.lit(1)).alias("rows"))
