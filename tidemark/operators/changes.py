"""Building a change log out of table snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def snapshot_as_changes(df: DataFrame, lsn: int, ts: str) -> DataFrame:
    """A table snapshot as log rows with op ``r``."""
    return df.withColumns({
        "op": F.lit("r"),
        "source_lsn": F.lit(lsn).cast("bigint"),
        "source_ts": F.lit(ts).cast("timestamp_ntz"),
        "is_deleted": F.lit(0),
    })


def diff_snapshots(old: DataFrame, new: DataFrame, keys: list[str], lsn: int) -> DataFrame:
    """Insert, update and delete events that turn one snapshot into the next.

    Columns are compared null-safely. A delete carries the whole old row.
    """
    cols = [c for c in new.columns if c not in keys]
    before = old.select(*keys, F.struct(*cols).alias("_old"))
    after = new.select(*keys, F.struct(*cols).alias("_new"))
    changed = F.lit(False)
    for c in cols:
        changed = changed | ~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    op = (
        F.when(F.col("_old").isNull(), "c")
        .when(F.col("_new").isNull(), "d")
        .when(changed, "u")
    )
    joined = before.join(after, keys, "full_outer").withColumn("op", op)
    row = F.when(F.col("op") == "d", F.col("_old")).otherwise(F.col("_new"))
    return (
        joined.filter(F.col("op").isNotNull())
        .withColumn("_row", row)
        .select(
            *keys,
            *[F.col(f"_row.{c}").alias(c) for c in cols],
            "op",
            F.lit(lsn).cast("bigint").alias("source_lsn"),
            F.when(F.col("op") == "d", 1).otherwise(0).alias("is_deleted"),
        )
    )
