"""The platform's alert rules as data."""

from __future__ import annotations

from dataclasses import dataclass, field

M, H = 60, 3600


@dataclass(frozen=True)
class Rule:
    """One alert: a measured value, a comparison, a hold time and a severity.

    ``kind`` says how the value is measured:
    gauge (newest sample), rate / increase / changes (over ``window`` seconds),
    up (targets of a job that answer), ratio (``metric`` over ``other`` per
    ``on``), stale (seconds since the timestamp the sample holds, or absent).
    ``agg`` combines the series of one evaluation time. ``where`` lists
    (label, operator, text) with the operators = != =~ !~.
    """

    name: str
    kind: str
    metric: str
    op: str
    limit: float
    hold: int
    severity: str
    where: tuple[tuple[str, str, str], ...] = ()
    window: int = 0
    agg: str = ""
    other: str = ""
    on: tuple[str, ...] = ()
    scale: float = 1.0
    offset: float = 0.0
    floor: float | None = None
    group: str = field(default="")


NAMED = (("name", "!=", ""),)
REAL_DISK = (("fstype", "!~", "tmpfs|overlay|squashfs"),)

# The rules by group, with their limits and hold times.
RULES: list[Rule] = [
    # source database
    Rule("PostgresDown", "gauge", "pg_up", "==", 0, 1 * M, "critical"),
    Rule("PostgresConnectionsHigh", "ratio", "pg_stat_activity_count", ">", 80, 5 * M, "warning",
         other="pg_settings_max_connections", on=("instance",), scale=100),
    Rule("PostgresInactiveReplicationSlot", "gauge", "pg_replication_slots_active", "==", 0, 10 * M, "warning"),
    Rule("PostgresLongRunningTransaction", "gauge", "pg_stat_activity_max_tx_duration", ">", 300, 5 * M,
         "warning", where=(("state", "=", "active"),)),
    Rule("PostgresDeadlocks", "rate", "pg_stat_database_deadlocks", ">", 0, 5 * M, "warning",
         where=(("datname", "!~", "template.*|postgres"),), window=5 * M),
    # change capture
    Rule("ConnectTaskFailed", "gauge", "connect_connector_failed_tasks", ">", 0, 1 * M, "critical"),
    Rule("ConnectConnectorNotRunning", "gauge", "connect_connector_running_tasks", "==", 0, 2 * M, "critical"),
    Rule("DebeziumDisconnected", "gauge", "debezium_connected", "==", 0, 2 * M, "critical"),
    Rule("DebeziumLagHigh", "gauge", "debezium_milliseconds_behind_source", ">", 60000, 5 * M, "warning"),
    Rule("DebeziumQueueNearlyFull", "gauge", "debezium_queue_remaining_capacity", "<", 512, 5 * M, "warning"),
    # warehouse
    Rule("ClickHouseNodeMissing", "up", "up", "<", 8, 2 * M, "critical", where=(("job", "=", "clickhouse"),)),
    Rule("ClickHouseReplicaReadOnly", "gauge", "ClickHouseMetrics_ReadonlyReplica", ">", 0, 2 * M, "critical"),
    Rule("ClickHouseReplicationLag", "gauge", "ClickHouseAsyncMetrics_ReplicasMaxAbsoluteDelay", ">", 60,
         5 * M, "warning"),
    Rule("ClickHouseReplicationQueueGrowing", "gauge", "ClickHouseAsyncMetrics_ReplicasMaxQueueSize", ">", 100,
         10 * M, "warning"),
    Rule("ClickHouseRejectedInserts", "increase", "ClickHouseProfileEvents_RejectedInserts", ">", 0, 0,
         "critical", window=10 * M),
    Rule("ClickHouseDistributedInsertsStuck", "gauge", "ClickHouseMetrics_DistributedFilesToInsert", ">", 100,
         10 * M, "warning"),
    Rule("KeeperQuorumAtRisk", "up", "up", "<", 3, 2 * M, "warning", where=(("job", "=", "clickhouse-keeper"),)),
    Rule("KeeperQuorumLost", "up", "up", "<", 2, 1 * M, "critical", where=(("job", "=", "clickhouse-keeper"),)),
    Rule("ClickHouseKafkaIngestionStalled", "increase", "ClickHouseProfileEvents_KafkaMessagesRead", "==", 0,
         5 * M, "critical", window=10 * M, agg="sum"),
    Rule("ClickHouseKafkaErrors", "increase", "ClickHouseProfileEvents_KafkaConsumerErrors", ">", 0, 0,
         "warning", window=5 * M),
    # batch jobs
    Rule("AirflowMetricsMissing", "gauge", "up", "==", 0, 2 * M, "warning", where=(("job", "=", "airflow"),)),
    Rule("AirflowSchedulerNotHeartbeating", "rate", "airflow_scheduler_heartbeat", "==", 0, 5 * M, "critical",
         window=5 * M),
    Rule("AirflowTaskFailed", "increase", "airflow_task_finish_total", ">", 0, 0, "warning", window=15 * M,
         where=(("state", "=", "failed"), ("dag_id", "!=", "00_docker_smoke"))),
    Rule("AirflowScheduleDelayHigh", "gauge", "airflow_dagrun_schedule_delay_seconds", ">", 300, 10 * M, "warning"),
    Rule("AirflowDagImportErrors", "gauge", "airflow_dag_processing_import_errors", ">", 0, 5 * M, "warning"),
    Rule("AirflowTasksStarving", "gauge", "airflow_scheduler_tasks_starving", ">", 0, 15 * M, "warning"),
    # object storage
    Rule("MinioMetricsMissing", "gauge", "up", "==", 0, 2 * M, "warning", where=(("job", "=", "minio"),)),
    Rule("MinioUnhealthy", "gauge", "minio_cluster_health_status", "!=", 1, 2 * M, "critical"),
    Rule("MinioLowDiskSpace", "ratio", "minio_cluster_capacity_usable_free_bytes", "<", 15, 10 * M, "warning",
         other="minio_cluster_capacity_usable_total_bytes", scale=100),
    Rule("MinioDiskSpaceCritical", "ratio", "minio_cluster_capacity_usable_free_bytes", "<", 5, 2 * M, "critical",
         other="minio_cluster_capacity_usable_total_bytes", scale=100),
    Rule("MinioDrivesOffline", "gauge", "minio_cluster_drive_offline_total", ">", 0, 2 * M, "critical"),
    Rule("MinioS3Errors", "rate", "minio_s3_requests_errors_total", ">", 0.1, 5 * M, "warning", window=5 * M),
    Rule("MinioLifecycleBacklog", "gauge", "minio_node_ilm_expiry_pending_tasks", ">", 1000, 30 * M, "warning"),
    Rule("MinioLifecycleMissedTasks", "increase", "minio_node_ilm_expiry_missed_tasks", ">", 0, 0, "warning",
         window=1 * H),
    Rule("MinioMissedFreeVersions", "increase", "minio_node_ilm_expiry_missed_freeversions", ">", 0, 0,
         "warning", window=1 * H),
    Rule("MinioVersionsGrowing", "ratio", "minio_cluster_usage_version_total", ">", 10, 30 * M, "warning",
         other="minio_cluster_usage_object_total", floor=1),
    # targets, broker, host, containers
    Rule("TargetDown", "gauge", "up", "==", 0, 1 * M, "critical"),
    Rule("KafkaBrokerMissing", "up", "up", "<", 4, 2 * M, "critical", where=(("job", "=", "kafka-jmx"),)),
    Rule("KafkaUnderReplicatedPartitions", "gauge", "kafka_server_replicamanager_underreplicatedpartitions",
         ">", 0, 2 * M, "warning", agg="sum"),
    Rule("KafkaOfflinePartitions", "gauge", "kafka_controller_kafkacontroller_offlinepartitionscount",
         ">", 0, 1 * M, "critical", agg="sum"),
    Rule("KafkaControllerCountWrong", "gauge", "kafka_controller_kafkacontroller_activecontrollercount",
         "!=", 1, 2 * M, "critical", agg="sum"),
    Rule("KafkaBrokerNotRunning", "gauge", "kafka_server_brokerstate", "!=", 3, 5 * M, "warning"),
    Rule("HostHighCpu", "rate", "node_cpu_seconds_total", ">", 85, 10 * M, "warning", window=5 * M,
         where=(("mode", "=", "idle"),), agg="avg", scale=-100, offset=100),
    Rule("HostLowMemory", "ratio", "node_memory_MemAvailable_bytes", "<", 10, 5 * M, "warning",
         other="node_memory_MemTotal_bytes", scale=100),
    Rule("HostLowDisk", "ratio", "node_filesystem_avail_bytes", "<", 15, 5 * M, "warning", where=REAL_DISK,
         other="node_filesystem_size_bytes", scale=100),
    Rule("ContainerNearMemoryLimit", "ratio", "container_memory_usage_bytes", ">", 90, 5 * M, "warning",
         where=NAMED, other="container_spec_memory_limit_bytes", scale=100),
    Rule("ContainerCpuThrottled", "rate", "container_cpu_cfs_throttled_seconds_total", ">", 1, 10 * M, "warning",
         where=NAMED, window=5 * M),
    Rule("ContainerRestarting", "changes", "container_start_time_seconds", ">", 2, 0, "warning", where=NAMED,
         window=15 * M),
    # dashboards
    Rule("SupersetDown", "stale", "container_last_seen", ">", 120, 2 * M, "critical",
         where=(("name", "=", "superset"),)),
    Rule("SupersetMetricsMissing", "gauge", "up", "==", 0, 5 * M, "warning", where=(("job", "=", "superset-statsd"),)),
    Rule("SupersetApiErrors", "rate", "superset_api", ">", 0.05, 10 * M, "warning", window=10 * M,
         where=(("outcome", "!=", "success"),), agg="sum"),
    Rule("SupersetSlowQueries", "gauge", "superset_execute_sql", ">", 10000, 15 * M, "warning",
         where=(("quantile", "=", "0.9"),)),
    Rule("SupersetSlowRendering", "gauge", "superset_load_into_dataframe", ">", 5000, 15 * M, "warning",
         where=(("quantile", "=", "0.9"),)),
    Rule("SupersetMetadataDatabaseDown", "stale", "container_last_seen", ">", 120, 2 * M, "critical",
         where=(("name", "=", "superset-postgres"),)),
    Rule("SupersetCacheDown", "stale", "container_last_seen", ">", 300, 10 * M, "warning",
         where=(("name", "=", "superset-redis"),)),
]
