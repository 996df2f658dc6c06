"""Session settings the rest of the package relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Only settings that change results or skew handling. Sizing (shuffle
# partitions, executor memory, split size) belongs to the deployment.
RUNTIME_CONF = {
    # Timestamps are compared and truncated in UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    # A bad cast raises; the dead-letter path uses try_* functions instead.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join on a hot key is split even where a later operator would have
    # reused the join's partitioning and now needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the runtime settings applied; extra settings by keyword dict."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


_LOCAL_BASE: dict[str, str] = {}


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach, below ``spark.checkpoint.dir``.

    A machine-local folder is only chosen when the setting is absent and the
    session itself is local.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_BASE:
            _LOCAL_BASE[app] = tempfile.mkdtemp(prefix="run-")
        base = _LOCAL_BASE[app]
    return os.path.join(base.rstrip("/"), f"{label}-{uuid.uuid4().hex[:12]}")
