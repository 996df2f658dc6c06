"""Current state of a version log and the questions asked about its versions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_state(
    log: DataFrame,
    keys: list[str],
    version: str = "source_lsn",
    deleted: str | None = "is_deleted",
    columns: list[str] | None = None,
    tiebreak: list[str] | tuple[str, ...] = (),
) -> DataFrame:
    """One row per key: the highest version, gone if that version is a delete.

    ``max(struct(version, ...))`` collapses versions before the shuffle, so a
    key with very many versions costs one row per input partition. Versions
    that tie are ordered by ``tiebreak`` and then by the remaining columns.
    ``columns`` names what the caller needs; a struct is not pruned otherwise.
    Tombstones are removed only after the newest version is known, so a key
    deleted and inserted again is kept. A null delete flag means not deleted.
    """
    wanted = [c for c in (columns or log.columns) if c not in keys]
    marker = [deleted] if deleted else []
    fields = list(dict.fromkeys([version, *tiebreak, *wanted, *marker]))
    newest = log.groupBy(*keys).agg(F.max(F.struct(*fields)).alias("_newest"))
    if deleted:
        newest = newest.filter(F.coalesce(F.col(f"_newest.{deleted}"), F.lit(0)) == 0)
    out = [c for c in (columns or log.columns)]
    return newest.select(*[c if c in keys else F.col(f"_newest.{c}").alias(c) for c in out])


def latest_by_update(df: DataFrame, keys: list[str], version: str = "updated_at") -> DataFrame:
    """Latest row per key of re-exported files, which carry no log position or tombstone."""
    return latest_state(df, keys, version=version, deleted=None)


def state_as_of(log: DataFrame, keys: list[str], lsn: int | Column, version: str = "source_lsn",
                **kwargs) -> DataFrame:
    """Current state as it was once the log had been read up to ``lsn``."""
    limit = lsn if isinstance(lsn, Column) else F.lit(lsn)
    return latest_state(log.filter(F.col(version) <= limit), keys, version=version, **kwargs)


def version_report(
    logs: dict[str, tuple[DataFrame, list[str]]],
    version: str = "source_lsn",
    deleted: str = "is_deleted",
) -> DataFrame:
    """Stored versions, current rows and the difference, one line per table."""
    parts = []
    for name, (log, keys) in logs.items():
        per_key = log.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.max_by(deleted, version).alias("gone")
        )
        parts.append(per_key.agg(
            F.lit(name).alias("table"),
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("source_rows"),
            F.count_if(F.coalesce("gone", F.lit(0)) == 0).cast("bigint").alias("staged_rows"),
        ))
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("collapsed", F.col("source_rows") - F.col("staged_rows"))


def tombstones(log: DataFrame, deleted: str = "is_deleted") -> DataFrame:
    """Delete versions with all their columns."""
    return log.filter(F.col(deleted) == 1)


def history(log: DataFrame, key: str, value, version: str = "source_lsn") -> DataFrame:
    """Every stored version of one key, oldest first."""
    return log.filter(F.col(key) == F.lit(value)).orderBy(version)


def merge_versions(existing: DataFrame, new: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Existing rows with the recomputed ones on top: the newest version of each key stays."""
    return latest_state(existing.unionByName(new), keys, version=version, deleted=None)


def insert_absent(existing: DataFrame, new: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Rows of ``new`` whose key is not there yet; of a key that arrives more than once, the first by ``version``."""
    others = [c for c in new.columns if c not in keys]
    once = new.groupBy(*keys).agg(F.min_by(F.struct(*others), version).alias("_first"))
    first = once.select(*[c if c in keys else F.col(f"_first.{c}").alias(c) for c in new.columns])
    return first.join(existing.select(*keys).distinct(), keys, "left_anti")
