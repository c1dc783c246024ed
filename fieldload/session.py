"""Session helpers.

The engine needs two session settings:

* ``spark.sql.session.timeZone = UTC``: unzoned timestamp text is read as
  UTC, and zoned instants become UTC wall-clock ``timestamp_ntz`` values.
* a reliable checkpoint directory for lineage cuts.  It is read from the
  session (``spark.checkpoint.dir`` or the context); only when nothing is set
  (local tests) a scratch directory is created.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app: str = "fieldload",
) -> SparkSession:
    """Local session for tests and the bench (AQE on, UI off, UTC)."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # max(id) of existing parts is answered from Parquet footers.
        .config("spark.sql.parquet.aggregatePushdown", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


# Largest measured stage output AQE may broadcast.
ADAPTIVE_BROADCAST_BYTES = 32 * 1024 * 1024


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the engine's semantics and skew safety depend on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # An aggregate must be partitioned on *all* its keys: otherwise a
    # distinct over (project, timeseries) downstream of a join on project
    # runs without a shuffle, and one project listing a third of all
    # timeseries would be deduplicated inside one task.
    spark.conf.set("spark.sql.requireAllClusterKeysForDistribution", "true")
    # Broadcast only what has a proven size: no broadcast from planner
    # *estimates* (they can be far off for derived frames); AQE still turns a
    # join into a broadcast when the measured size of a finished stage is
    # small, and the engine's explicit broadcasts check their bound first.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(ADAPTIVE_BROADCAST_BYTES))
    # The exports' JSON may repeat a key.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, creating one only in tests."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        # Only a plain local master shares its disk with its executors.
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at shared storage"
            )
        configured = tempfile.mkdtemp(prefix="fieldload-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
