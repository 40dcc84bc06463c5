"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC session zone (calendar days are computed
# with an explicit zone argument), AQE for runtime coalescing / skew splits.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rank limits up to this many rows per group are applied before the shuffle
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # incremental state checkpoints (changelog) instead of full snapshots
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # files of checkpoints that nothing refers to any more are deleted (set before the session
    # starts; on a cluster, in its own settings)
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster, use the cluster's session and
    call :func:`configure` on it instead."""
    # Python workers (transformWithState processors) must import this
    # package; locally they inherit the driver's environment.  On a
    # cluster ship it with --py-files / spark.submit.pyFiles instead.
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *paths])
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


SHUFFLE_PARTITION_BYTES = 1 << 30


def scale_settings(input_bytes: int, shuffle_partition_bytes: int = SHUFFLE_PARTITION_BYTES) -> dict:
    """SQL settings sized to the input volume of a job.

    Shuffle partitions of about 1 GiB of input (columns pruned and rows
    pre-aggregated, so a shuffled partition is smaller and sorts within an
    executor's memory): about 100k for 100 TB.  AQE starts from that many,
    coalesces small ones, and splits a partition more than 4x the median and
    above 1 GiB in skewed joins.
    """
    parts = max(200, int(input_bytes // shuffle_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        # Joins of full rows with per-bucket tables: when the bucket table
        # is too big to broadcast, AQE turns the sort-merge join into a
        # shuffled hash join once every build-side partition measures below
        # this size, so the big side is sorted once (for the window after
        # the join) instead of twice.  Not set for small local runs, where
        # broadcasting wins.
        "spark.sql.join.preferSortMergeJoin": "false",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(256 << 20),
    }


def table_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below ``path``, from the file system alone (0 if there is none)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.getContentSummary(folder).getLength() if fs.exists(folder) else 0


def widen_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Raise the session's shuffle partitions to one per GiB of input, which AQE
    never does by itself; what the session set is never lowered."""
    parts = int(input_bytes // SHUFFLE_PARTITION_BYTES)
    if parts > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))


def configure(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply runtime SQL settings to an existing session (idempotent);
    with ``input_bytes``, also the volume-derived settings of
    :func:`scale_settings`."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql.") and k != "spark.sql.execution.arrow.pyspark.enabled":
            spark.conf.set(k, v)
    if input_bytes:
        for k, v in scale_settings(input_bytes).items():
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must already be set to shared storage.  Only when it is
    unset (local runs, tests) do we create a scratch folder under /tmp.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster's "
                               "distributed file system) before running lineage-cutting operators")
        d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint dir (for streaming
    checkpoints and lineage-cutting tables)."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{os.urandom(6).hex()}")


def reliable_checkpoint(df):
    """Materialise ``df`` into the shared checkpoint folder and cut its
    lineage.  The input is cached only while the checkpoint is written, so
    it is computed once (``checkpoint`` alone runs it twice: once to count,
    once to write)."""
    checkpoint_dir(df.sparkSession)
    cached = df.persist()
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()
