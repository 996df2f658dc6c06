"""Neighbouring rows and runs inside long ordered sequences.

A plain window over (key, order) puts a whole key into one task. These
operators cut each sequence into chunks by a value of the row itself (an hour, a
log segment), work inside (key, chunk), and then link only the chunk borders.
The result is the same as that of the plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import scalar as S

# One write-ahead-log segment is 16 MiB, so 24 bits bound the versions in a chunk.
WAL_SEGMENT_BITS = 24


def wal_segment(lsn: str = "source_lsn") -> Column:
    """Chunk of a log position."""
    return F.shiftright(F.col(lsn), WAL_SEGMENT_BITS)


def hour_chunk(ts: str = "ts") -> Column:
    """Chunk of a timestamp: 240 samples of a series scraped every 15 seconds.

    A single series with far more rows per hour needs a finer chunk.
    """
    return F.date_trunc("HOUR", F.col(ts))


def adjacent_pairs(
    df: DataFrame, keys: list[str], order: list[str], values: list[str], chunk: Column
) -> DataFrame:
    """Each row beside its predecessor: ``keys, order, values, prev_<order>, prev_<value>``.

    The first row of a key has null ``prev_`` columns. ``chunk`` must not
    decrease along ``order``. Order columns must not be null.
    """
    cols = [*order, *values]
    rows = df.select(*keys, *cols, chunk.alias("_chunk"))
    # The leading hash orders most rows by one comparison of numbers, whatever the keys are.
    inside = Window.partitionBy(F.xxhash64(*keys, "_chunk"), *keys, "_chunk").orderBy(*order)
    here = F.struct(*cols)
    marked = rows.select(
        *keys, *cols, "_chunk",
        F.lag(here).over(inside).alias("_prev"),
        F.lead(F.lit(True)).over(inside).isNull().alias("_last"),
    )
    linked = marked.filter(F.col("_prev").isNotNull()).select(*keys, *cols, "_prev")

    # One row per (key, chunk): its first row and its last row.
    borders = (
        marked.filter(F.col("_prev").isNull() | F.col("_last"))
        .groupBy(*keys, "_chunk")
        .agg(F.min(here).alias("_first"), F.max(here).alias("_end"))
    )
    across = Window.partitionBy(*keys).orderBy("_chunk")
    first_rows = borders.select(
        *keys,
        *[F.col(f"_first.{c}").alias(c) for c in cols],
        F.lag("_end").over(across).alias("_prev"),
    )
    return linked.unionByName(first_rows).select(
        *keys, *cols, *[F.col(f"_prev.{c}").alias(f"prev_{c}") for c in cols]
    )


def runs(
    df: DataFrame,
    keys: list[str],
    ts: str,
    state: str,
    max_gap_seconds: float | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Stretches of equal consecutive states: ``keys, state, start, end, n``.

    A gap longer than ``max_gap_seconds`` ends a run. Runs are first formed
    inside (key, chunk); only the runs touching a chunk border, at most two per
    chunk, are then stitched along the whole key.
    """
    chunk = hour_chunk(ts) if chunk is None else chunk
    rows = df.select(*keys, F.col(ts).alias("_t"), F.col(state).alias("_s"), chunk.alias("_chunk"))

    def same(prev_s: Column, s: Column, prev_t: Column, t: Column) -> Column:
        joined = prev_s.eqNullSafe(s) & prev_t.isNotNull()
        if max_gap_seconds is not None:
            limit = int(max_gap_seconds * 1_000_000)
            joined = joined & (S.epoch_micros(t) - S.epoch_micros(prev_t) <= F.lit(limit))
        return F.coalesce(joined, F.lit(False))

    inside = Window.partitionBy(*keys, "_chunk").orderBy("_t", "_s")
    prev_t, prev_s = F.lag("_t").over(inside), F.lag("_s").over(inside)
    flagged = rows.select(
        "*",
        S.flag(~same(prev_s, F.col("_s"), prev_t, F.col("_t"))).alias("_break"),
        prev_t.isNull().alias("_opens"),
        F.lead("_t").over(inside).isNull().alias("_closes"),
    )
    numbered = flagged.withColumn(
        "_run", F.sum("_break").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    )
    local = numbered.groupBy(*keys, "_chunk", "_run").agg(
        F.first("_s").alias("_s"),
        F.min("_t").alias("_start"),
        F.max("_t").alias("_end"),
        F.count(F.lit(1)).alias("_n"),
        F.max("_opens").alias("_opens"),
        F.max("_closes").alias("_closes"),
    )
    border = F.col("_opens") | F.col("_closes")
    done = local.filter(~border)

    along = Window.partitionBy(*keys).orderBy("_chunk", "_run")
    follows = F.col("_opens") & same(
        F.lag("_s").over(along), F.col("_s"), F.lag("_end").over(along), F.col("_start")
    )
    stitched = (
        local.filter(border)
        .withColumn("_break", S.flag(~F.coalesce(follows, F.lit(False))))
        .withColumn("_whole", F.sum("_break").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_whole")
        .agg(
            F.first("_s").alias("_s"),
            F.min("_start").alias("_start"),
            F.max("_end").alias("_end"),
            F.sum("_n").alias("_n"),
        )
    )
    shape = [*keys, "_s", "_start", "_end", "_n"]
    return done.select(*shape).unionByName(stitched.select(*shape)).select(
        *keys,
        F.col("_s").alias(state),
        F.col("_start").alias("start"),
        F.col("_end").alias("end"),
        F.col("_n").cast("bigint").alias("n"),
    )


def invalid_transitions(
    log: DataFrame,
    allowed: list[tuple[str, str]],
    key: str = "order_id",
    status: str = "status",
    version: str = "source_lsn",
) -> DataFrame:
    """Status changes between neighbouring versions that the allowed moves do not contain."""
    pairs = adjacent_pairs(log, [key], [version], [status], wal_segment(version))
    before, after = F.col(f"prev_{status}"), F.col(status)
    moved = before.isNotNull() & (before != after)
    legal = F.lit(False)
    for src, dst in allowed:
        legal = legal | ((before == src) & (after == dst))
    return pairs.filter(moved & ~legal).select(
        key, version, before.alias("from_status"), after.alias("to_status")
    )
