"""Alert stretches and silent series as closed sessions of a stream.

A session stays open while rows keep coming within its gap; the watermark that
passes its end closes it, which serves as the timer. State per open session is
one small aggregate, however long it lasts. Every function works on a batch as
well, with the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalar as S
from tidemark.operators.timeseries import MICROS


def evaluations(samples: DataFrame, keys: list[str], step: int, lateness: str) -> DataFrame:
    """The newest value of each series at every evaluation time ``t`` that has samples in ``[t - step, t)``.

    ``ts`` is an event time; samples more than ``lateness`` behind the newest
    are left out by the watermark. Of equal times the larger value counts.
    """
    timed = samples.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    newest = timed.groupBy(F.window("ts", f"{step} seconds").alias("_w"), *keys).agg(
        F.max(F.struct("ts", "value")).alias("_last"))
    # The window's own time keeps the watermark, which the sessions below need.
    return newest.select(*keys, F.window_time("_w").alias("_at"), F.col("_last.value").alias("value"))


def _time(at: Column) -> Column:
    """Window times lie one microsecond before the evaluation time."""
    return S.from_micros(F.unix_micros(at) + 1)


def _sessions(evaluated: DataFrame, keys: list[str], gap: str | int) -> DataFrame:
    seconds = F.col(gap) if isinstance(gap, str) else F.lit(gap)
    length = F.concat(seconds.cast("string"), F.lit(" seconds"))
    return evaluated.groupBy(F.session_window("_at", length).alias("_s"), *keys).agg(
        F.min("_at").alias("_first"), F.max("_at").alias("_final"), F.count(F.lit(1)).alias("n"))


def alert_islands(evaluated: DataFrame, keys: list[str], condition: Column, gap: str | int, hold: str | int) -> DataFrame:
    """``keys, start, end, fire_at, over_at, n`` of every stretch of evaluations that meet the condition.

    ``gap`` seconds without such an evaluation end a stretch: with the
    evaluation step, the first evaluation that does not meet it or is missing;
    with more, shorter dips are bridged. ``fire_at`` is null if the stretch
    ended before ``hold`` seconds, ``over_at`` is the time from which it was
    known to be over. ``gap`` and ``hold`` may name columns among ``keys``.
    """
    held = _sessions(evaluated.filter(condition), keys, gap)
    seconds = (F.col(hold) if isinstance(hold, str) else F.lit(hold)).cast("bigint")
    start, end = _time(F.col("_first")), _time(F.col("_final"))
    due = S.from_micros(F.unix_micros("_first") + 1 + seconds * MICROS)
    return held.select(*keys, start.alias("start"), end.alias("end"), F.when(end >= due, due).alias("fire_at"),
                       _time(F.col("_s.end")).alias("over_at"), "n")


def silences(evaluated: DataFrame, keys: list[str], gap: str | int) -> DataFrame:
    """``keys, last_seen, stale_at``: every time a series had sent nothing for ``gap`` seconds.

    The same series appears again each time it comes back and falls silent.
    """
    return _sessions(evaluated, keys, gap).select(
        *keys, _time(F.col("_final")).alias("last_seen"), _time(F.col("_s.end")).alias("stale_at"))


def transitions(islands: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, at, state``: each stretch as pending, firing (if it came to that) and resolved."""
    steps = F.array(*[
        F.struct(at.alias("at"), F.lit(state).alias("state"))
        for at, state in ((F.col("start"), "pending"), (F.col("fire_at"), "firing"),
                          (F.when(F.col("fire_at").isNotNull(), F.col("over_at")), "resolved"),
                          (F.when(F.col("fire_at").isNull(), F.col("over_at")), "dropped"))
    ])
    return islands.select(*keys, F.explode(F.filter(steps, lambda s: s["at"].isNotNull())).alias("_t")).select(
        *keys, "_t.at", "_t.state")
