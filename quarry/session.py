"""Session construction and the shared scratch location.

Every intermediate that has to be materialised (partitioned copies, staged
upserts, streaming checkpoints) lives under the folder the cluster names in
``spark.checkpoint.dir``.  That folder is shared storage on a real cluster, so
written tables there survive the loss of any executor.  Only when the setting
is absent (a bare local session, as in tests) do we create one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from .sources.scan import read_split_settings

# Settings that matter at scale.  AQE re-plans joins and coalesces shuffle
# partitions from runtime sizes; skew-join splitting handles hot keys in the
# anti-joins of the upsert; partition overwrite is dynamic so an upsert only
# replaces the key buckets it touches.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
}


def cluster_settings(input_bytes: int, target_partition_bytes: int = 256 * 1024 * 1024,
                     executors_cores: int | None = None, reducer_bytes: int = 2 << 30) -> dict:
    """Sizing for a large input: read splits and the initial shuffle width
    so each task handles about ``target_partition_bytes``; AQE then
    coalesces small shuffle partitions and splits skewed ones.  (Split
    packing is a session setting: Spark's file sources ignore a per-read
    ``maxPartitionBytes`` option.)"""
    # Reducers are sized apart from read splits: maps times reducers is the number
    # of shuffle blocks, and a wide shuffle of small blocks is slow.
    parts = max(1, -(-int(input_bytes) // int(reducer_bytes)))
    if executors_cores:
        parts = max(parts, 2 * executors_cores)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.files.openCostInBytes": str(8 * 1024 * 1024),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
    }


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "quarry", extra: dict | None = None, split_bytes: int | None = None) -> SparkSession:
    """``split_bytes``: small files are packed into read splits of this size."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in SCALE_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    if split_bytes:
        for k, v in read_split_settings(split_bytes, open_cost_bytes=min(split_bytes, 8 << 20)).items():
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        value = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # pragma: no cover - conf lookups differ across deployments
        value = None
    if value:
        return value
    try:
        return spark.sparkContext.getConf().get("spark.checkpoint.dir")
    except Exception:  # pragma: no cover - no SparkContext (Connect)
        return None


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediates.

    Read from the session (``spark.checkpoint.dir``, or the checkpoint dir
    already registered on the SparkContext); only when neither is set (tests,
    a bare local session) is a folder created and registered, once.
    """
    root = _configured_checkpoint_dir(spark)
    registered = None
    try:
        registered = spark.sparkContext.getCheckpointDir()
    except Exception:  # pragma: no cover - no SparkContext (Connect)
        pass
    if not root:
        root = registered
    if not root:
        if not str(getattr(spark.sparkContext, "master", "local")).startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: a cluster needs a folder that all executors share")
        root = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    elif not registered:
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:  # pragma: no cover
            pass
    return root.rstrip("/")


def run_path(spark: SparkSession, name: str) -> str:
    """A fresh, run-unique path below the scratch root (not created: the
    first write creates it)."""
    root = scratch_root(spark)
    return f"{root}/quarry/{name}-{uuid.uuid4().hex[:12]}"
