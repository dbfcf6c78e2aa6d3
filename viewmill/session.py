"""Session settings the engine relies on, and scratch space that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# UTC keeps calendar keys independent of where a job runs. The adaptive settings let one plan serve
# a 10-second micro-batch and a full backfill: start from many shuffle partitions, merge the small
# ones and split the skewed ones at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The same for tables that are kept in memory, which every job on them reads partition by partition.
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    # The JVM never compiles methods beyond 8,000 bytes, and the fused code of all enrichments is
    # longer than that. With this limit Spark generates it operator by operator instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # So many equal values of a column are compared with row groups one by one (see operators/stored_ids.py).
    "spark.sql.parquet.pushdown.inFilterThreshold": "200",
    # Keyed state of streams is kept on executors' disks, with changes in the checkpoint.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def apply_settings(spark: SparkSession) -> None:
    """Give an existing session :data:`SETTINGS`, all of which may change at run time."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)


def build_session(app: str = "viewmill", master: str | None = None, **extra: str) -> SparkSession:
    """A session with :data:`SETTINGS`; ``extra`` holds further ``spark.…`` settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``.

    Where that is unset, a session with local threads gets a temporary folder; any other is refused, since its
    executors would write where nobody else can read.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"run-{name}-")
