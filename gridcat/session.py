"""Spark session defaults shared by the library, tests and the bench."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Streaming state off-heap in RocksDB with changelog checkpoints: bounded
# executor memory however many jobs/keys the gates and dedupes track.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A partition of a join keeps four stores; their logs take the disk they fill, none in advance.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
# Settings every gridcat job relies on; a cluster may override the sizing ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # The planner may broadcast a side it has measured below this; no code forces more.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    **STATE_CONF,
}


def get_session(master: str | None = None, app: str = "gridcat",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with gridcat defaults.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster the
    submitter's settings win because ``getOrCreate`` reuses the live session.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``.  Where it is unset a ``local`` master gets a
    temporary folder; on a cluster that is an error, since each executor would
    write to its own disk."""
    conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) \
        or spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="gridcat-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", conf_dir)
        except Exception:  # some deployments refuse core confs at runtime
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint location for written intermediate
    tables (lineage cuts, versioned catalog tables in tests)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` to a fresh shared folder and read it back."""
    path = scratch_dir(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Sizing for a cluster run: enough shuffle partitions that one holds
    about ``target_partition_bytes`` before AQE coalesces them, scan splits of
    512 MiB, and AQE's skew handling on.  Pass the result as ``extra`` to
    ``get_session`` (or to spark-submit)."""
    slots = executors * cores_per_executor
    partitions = max(slots * 2, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(int(partitions)),
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
