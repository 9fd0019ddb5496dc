"""Session helpers: a local session for tests/bench, and shared scratch space.

Library functions never build a session themselves; callers pass one in. The
helpers here exist for tests, the benchmark and the entry module.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at any scale: adaptive execution re-plans joins from
# measured shuffle sizes, coalesces small partitions and splits skewed ones.
# It may turn a join into a broadcast join once the shuffle has *measured* a
# side below 64 MB (the same bound as the library's checked broadcasts).
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
}

# No broadcast from static estimates: those come from compressed file sizes,
# which understate rows in memory and ignore filters, so they bound nothing.
# Broadcasts then come only from a measured check (operators.enrich) or from
# adaptive execution's measured shuffle sizes.
BROADCAST_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}

# Streaming state in RocksDB (off the JVM heap, incremental checkpoints of
# changed keys only). Takes effect for new checkpoints; a restarted query
# keeps the provider its checkpoint was created with.
STREAMING_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "lakestream", extra: dict | None = None,
                  task_attempts: int | None = None) -> SparkSession:
    """A local session configured like the tests and the benchmark expect.

    ``task_attempts`` > 1 retries a failed task like a cluster does (local
    mode otherwise fails the job on the first task failure).
    """
    master = f"local[{cores},{task_attempts}]" if task_attempts else f"local[{cores}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LAKESTREAM_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
    )
    for k, v in {**ADAPTIVE_CONF, **BROADCAST_CONF, **STREAMING_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession, measured_broadcasts_only: bool = True) -> None:
    """Apply the adaptive-execution and state-store settings the caller has not set.

    ``measured_broadcasts_only`` also turns off broadcasts planned from static
    size estimates (that setting always has a value, so it is set explicitly).
    """
    for k, v in {**ADAPTIVE_CONF, **STREAMING_CONF}.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    if measured_broadcasts_only:
        for k, v in BROADCAST_CONF.items():
            spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this setting names durable shared storage, so streaming
    checkpoints and intermediate tables written under it survive executor
    loss; a cluster session without it is an error. Only a local session
    (tests) with it unset gets a private temp folder, registered as the
    checkpoint directory.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        current = sc.getCheckpointDir()
        local = sc.master.startswith("local") and not sc.master.startswith("local-cluster")
        # a folder that the caller set must be one that every machine of a cluster sees
        if current and (local or "://" in current and not current.startswith("file:")):
            return current
        if not local:
            # a machine-local folder would vanish with its executor; never guess one
            raise RuntimeError("set spark.checkpoint.dir to shared storage (e.g. an HDFS or "
                               "object-store folder) for streaming checkpoints and scratch tables")
        base = tempfile.mkdtemp(prefix="lakestream-ckpt-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        sc.setCheckpointDir(base)
        return sc.getCheckpointDir() or base
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint directory."""
    return f"{shared_dir(spark)}/lakestream/{name}-{uuid.uuid4().hex[:12]}"
