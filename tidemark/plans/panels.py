"""The monitoring overview's panels as queries over metric samples."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import timeseries as TS
from tidemark.operators.topk import topk


@dataclass(frozen=True)
class Panel:
    """``how``: up, value or rate; then summed ``by`` labels, averaged idle CPU, or the ``top`` k."""

    metric: str
    how: str = "value"
    agg: str = ""
    by: tuple[str, ...] = ()
    where: tuple[str, str, bool] | None = None
    window: int = 300
    top: int = 0
    scale: float = 1.0
    offset: float = 0.0


NAMED = ("name", ".+", False)

# Panel titles and what they read.
PANELS: dict[str, Panel] = {
    "Brokers up": Panel("up", "up", where=("job", "kafka-jmx", False)),
    "Active controllers": Panel("kafka_controller_kafkacontroller_activecontrollercount", agg="sum"),
    "Under-replicated partitions": Panel("kafka_server_replicamanager_underreplicatedpartitions", agg="sum"),
    "Offline partitions": Panel("kafka_controller_kafkacontroller_offlinepartitionscount", agg="sum"),
    "Bytes in per second": Panel("kafka_server_brokertopicmetrics_bytesinpersec_count", "rate", "sum", ("broker",)),
    "Bytes out per second": Panel("kafka_server_brokertopicmetrics_bytesoutpersec_count", "rate", "sum", ("broker",)),
    "Messages in per second": Panel(
        "kafka_server_brokertopicmetrics_messagesinpersec_count", "rate", "sum", ("broker",)),
    "Consumer lag by group": Panel("kafka_consumergroup_lag", agg="sum", by=("consumergroup",)),
    "JVM heap used": Panel("kafka_jvm_memory_heap_used_bytes"),
    "Broker state": Panel("kafka_server_brokerstate"),
    "CPU used": Panel("node_cpu_seconds_total", "rate", "avg", where=("mode", "idle", False),
                      scale=-100, offset=100),
    "Memory available": Panel("node_memory_MemAvailable_bytes"),
    "Disk free": Panel("node_filesystem_avail_bytes", where=("fstype", "tmpfs|overlay|squashfs", True)),
    "Memory by container": Panel("container_memory_usage_bytes", where=NAMED, top=10),
    "CPU by container": Panel("container_cpu_usage_seconds_total", "rate", where=NAMED, top=10),
    "CPU throttled": Panel("container_cpu_cfs_throttled_seconds_total", "rate", where=NAMED),
    "Network received": Panel("container_network_receive_bytes_total", "rate", where=NAMED, top=10),
}


def panel(name: str, samples: DataFrame, step: int = TS.STEP, lookback: int = TS.LOOKBACK) -> DataFrame:
    """One panel as ``(labels or series), t, value``; top-k panels also carry ``rank``."""
    p = PANELS[name]
    chosen = samples.filter(F.col("metric") == p.metric)
    if p.where:
        chosen = chosen.filter(TS.label_matches(*p.where))
    if p.how == "up":
        return TS.count_up(chosen, p.where[1], step, lookback)
    keyed = TS.with_labels(chosen, *p.by).withColumn("series", TS.series_key())
    keys = [*p.by, "series"]
    if p.how == "rate":
        series = TS.rate(keyed, keys, p.window, step)
    else:
        series = TS.instant(keyed, keys, step, lookback)
    if p.agg:
        series = TS.across(series, p.agg, p.by)
    if p.top:
        series = topk(series, p.top, "value", ["t"], ["series"])
    value: Column = F.lit(p.offset) + F.lit(p.scale) * F.col("value")
    return series.withColumn("value", value) if (p.offset or p.scale != 1.0) else series
