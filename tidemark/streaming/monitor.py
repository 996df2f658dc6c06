"""How far behind the pipeline is, and whether it still moves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalar as S
from tidemark.operators import timeseries as TS
from tidemark.operators.aggregates import quantiles

# Minutes without a new source change before a warning and an error.
WARN_MINUTES = 30
ERROR_MINUTES = 120


def lag_millis(later, earlier):
    """Milliseconds between two timestamps."""
    return F.unix_millis(F.col(later).cast("timestamp")) - F.unix_millis(F.col(earlier).cast("timestamp"))


def _lag_report(df: DataFrame, by: str) -> DataFrame:
    worst = df.groupBy(by).agg(F.max("lag_ms").alias("max"))
    return quantiles(df, "lag_ms", [by]).drop("p90").join(worst, by)


def ingest_latency(log: DataFrame, entity: str) -> DataFrame:
    """From the change in the source to its row here: median, 0.99 quantile and maximum."""
    lags = log.select(F.lit(entity).alias("entity"), lag_millis("ingested_at", "source_ts").alias("lag_ms"))
    return _lag_report(lags, "entity")


def batch_lag(lake: DataFrame, by: str = "dt") -> DataFrame:
    """From an order's last change to its staging, per partition date."""
    lags = lake.select(by, lag_millis("staged_at", "updated_at").alias("lag_ms"))
    return _lag_report(lags, by)


def freshness(
    logs: dict[str, DataFrame], as_of: str, warn_minutes: int = WARN_MINUTES, error_minutes: int = ERROR_MINUTES
) -> DataFrame:
    """Age of the newest change per source, by the source's own clock: pass, warn or error."""
    now = F.lit(as_of).cast("timestamp_ntz")
    parts = [
        df.agg(F.max("source_ts").alias("newest")).select(F.lit(name).alias("source"), "newest")
        for name, df in logs.items()
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    age = F.unix_timestamp(now) - F.unix_timestamp("newest")
    status = (
        F.when(F.col("newest").isNull() | (age > error_minutes * 60), "error")
        .when(age > warn_minutes * 60, "warn")
        .otherwise("pass")
    )
    return report.select("source", "newest", age.alias("age_seconds"), status.alias("status"))


def consumer_lag(offsets: DataFrame) -> DataFrame:
    """Messages a consumer group has yet to read, over its partitions."""
    return offsets.groupBy("consumergroup").agg(
        F.sum(F.col("end_offset") - F.col("committed")).cast("bigint").alias("lag")
    )


def recent_errors(consumers: DataFrame, as_of: str, minutes: int = 2) -> DataFrame:
    """Consumers with an exception in the last minutes; old ones do not count."""
    now = F.lit(as_of).cast("timestamp_ntz")
    return consumers.filter(S.any_after("exception_times", now, f"{minutes} MINUTES"))


def exceptions(consumers: DataFrame) -> DataFrame:
    """One row per recorded exception text."""
    return consumers.filter(F.size("exception_texts") > 0).select(
        "table", F.explode("exception_texts").alias("err")
    )


def capture_lag_alerts(
    lags: DataFrame, keys: list[str], limit_ms: float, seconds: int, max_gap_seconds: float | None = None
) -> DataFrame:
    """Stretches in which the capture lag ``(ts, value)`` stayed above a limit, and when they fired."""
    above = lags.withColumn("above", TS.breaches(F.col("value"), ">", limit_ms))
    return TS.held_for(above, keys, "above", seconds, ts="ts", max_gap_seconds=max_gap_seconds)


def windowed_stream(samples: DataFrame, window: str, slide: str, lateness: str) -> DataFrame:
    """Sliding event-time windows per metric, in batch or as a stream with a watermark."""
    timed = samples.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    return TS.unfold_windows(
        timed, ["metric"], window, slide,
        F.count(F.lit(1)).alias("samples"), F.sum("value").alias("total"), F.max("value").alias("highest"),
    )
