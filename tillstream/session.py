"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on; they replace the cluster's own. A keyword of build_session changes one.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split into several tasks once its partition is this large.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256MB",
    # Streaming sessions of one visitor are merged before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # Without it every column expression records its Python call site.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "tillstream", **settings: str) -> SparkSession:
    """Create or reuse a session; ``settings`` use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local master may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if configured is None and current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="tillstream-checkpoint-")
    if current is None:
        context.setCheckpointDir(configured)
    return configured or current


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
