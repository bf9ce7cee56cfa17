"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution does the runtime work the operators rely on: coalescing small
# shuffle partitions and splitting skewed join partitions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # State of streams, such as two months of claims that wait for labels, lives on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; ``conf`` keys use ``_`` for ``.`` if needed."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a private one only for a local session."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    local = tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"
