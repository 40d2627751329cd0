"""Session helpers: a configured SparkSession and lineage cutting.

The library never creates a session behind the caller's back; jobs pass one
in. ``local_session`` is for tests, the bench and the smoke entry point.
"""

from __future__ import annotations

import contextlib
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this library assumes. Adaptive execution re-plans
# joins (broadcast by measured size, skew splitting) and coalesces shuffle
# partitions at run time, so the static shuffle width only has to be an upper
# bound for the largest stage.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerline",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is honoured as is.
    Only when it is unset (local tests) do we pick a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system); "
                               "a machine-local scratch folder does not survive executor loss")
        configured = tempfile.mkdtemp(prefix="ledgerline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder.

    Reliable checkpoints survive executor loss (unlike local checkpoints),
    and they keep plans of iterative jobs from growing without bound.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def input_bytes(spark: SparkSession, paths) -> int:
    """Bytes under the given paths, from the file system's own summary."""
    total = 0
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(p):
            total += fs.getContentSummary(p).getLength()
    return total


@contextlib.contextmanager
def sized(spark: SparkSession, paths):
    """The session with ``scale_conf`` for the inputs at ``paths``, for one run;
    the former settings come back afterwards."""
    cores = spark.sparkContext.defaultParallelism
    conf = {k: v for k, v in scale_conf(input_bytes(spark, paths), cores).items() if spark.conf.isModifiable(k)}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield spark
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def scale_conf(input_bytes: int, executor_cores_total: int, target_partition_bytes: int = 256 << 20,
               max_broadcast_bytes: int = 64 << 20, shuffle_fraction: float = 0.25,
               max_shuffle_partitions: int = 100_000) -> dict[str, str]:
    """Settings sized from the input volume (not a fixed 200 partitions).

    The static shuffle width gives each shuffle partition about
    ``target_partition_bytes`` of the expected shuffle volume (``shuffle_fraction``
    of the input, after projection and partial aggregation), at least two waves
    of tasks and at most ``max_shuffle_partitions`` (map-status size grows with
    mappers x reducers); adaptive execution then coalesces small partitions and splits skewed
    ones at run time. Scans read ``target_partition_bytes`` splits. Automatic
    broadcast stays capped at ``max_broadcast_bytes`` of *measured* size, so a
    dimension that grows past it falls back to a sort-merge join by itself.
    """
    wanted = -(-int(input_bytes * shuffle_fraction) // target_partition_bytes)
    parts = min(max(2 * executor_cores_total, wanted), max_shuffle_partitions)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 2),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(max_broadcast_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(max_broadcast_bytes),
        # stream dedupe / window state on local disk with changelog checkpoints
        # to the shared checkpoint location, instead of executor heap
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
