"""Session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every martwise session needs for correct results.  UTC makes the
# parse of offset timestamps and the timestamp_ntz columns agree; ANSI makes
# bad casts fail loudly, so coercions use try_* on purpose.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Static settings, only effective when the session is created.  Capturing
# the Python call site of every Column costs several JVM round trips per
# expression, and the builders create thousands of expressions.
STATIC_CONF = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "martwise", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the martwise settings.

    On a cluster, call with ``master=None`` so the launcher decides; the
    shuffle partition count should then be sized to the data (about
    128-256 MB per partition after AQE coalescing).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {**CORE_CONF, **STATIC_CONF}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in CORE_CONF.items():
        spark.conf.set(k, v)
    spark.sparkContext.setLogLevel(os.environ.get("MARTWISE_LOG_LEVEL", "ERROR"))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder name in storage that all executors share: below the
    session's ``spark.checkpoint.dir``.  Only a local master may do without one."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder in shared storage")
        root = tempfile.mkdtemp(prefix="martwise-")
    return f"{root}/gold-{uuid.uuid4().hex}"
