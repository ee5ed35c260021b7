"""Session defaults and the scratch location used by jobs that write and read back."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job relies on. All of them can be changed on a live session.
RUNTIME_CONF = {
    # All naive times in the feeds are UTC; local dates are derived explicitly.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keyed state of the stall detector lives off-heap and is uploaded as change logs.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "fleetpulse", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the local benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Without ``spark.checkpoint.dir`` only a local master (tests, a laptop) gets a folder, on its own
    disk; on a cluster the executors would not see each other's files, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="fleetpulse-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
