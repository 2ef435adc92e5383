"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that can be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets `row_number() <= 5000` be cut down inside each map task; the default stops at 1000.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}

# Settings fixed when the session is built.
STATIC_CONF = {
    # Python call sites in error messages cost several round trips per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, app: str = "tidemark", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **STATIC_CONF, **STREAM_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by the cluster.

    A temporary folder will do on one machine only; on a cluster its parts would lie on different disks.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir names no shared folder")
        shared = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
    sc.setCheckpointDir(shared)
