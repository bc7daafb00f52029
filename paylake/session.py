"""Session construction and the shared work folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every paylake job relies on. AQE re-plans joins from measured
# sizes, coalesces small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_conf(input_bytes: int, executor_cores: int, partition_mb: int = 128) -> dict:
    """Sizing for a cluster run: shuffle partitions from the input size so
    each post-shuffle task handles about ``partition_mb`` (AQE then coalesces
    small ones and splits skewed ones), and file splits of the same size."""
    parts = max(executor_cores * 2, input_bytes // (partition_mb << 20))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{partition_mb}m",
        "spark.sql.files.maxPartitionBytes": f"{partition_mb}m",
    }


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "paylake", extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with paylake's defaults.

    On a cluster pass ``master=None`` and let the submitter decide; tests and
    the bench pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """Folder on shared storage for written tables and stream checkpoints.

    Taken from the cluster's ``spark.checkpoint.dir``. Only a local-mode
    session without that setting (tests, the bench) gets a fresh temporary
    folder of its own; a cluster without it is a configuration error, since a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="paylake-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    path = base.rstrip("/")
    for p in parts:
        path = f"{path}/{p}"
    return path


def fresh_dir(spark: SparkSession, prefix: str) -> str:
    """A new, unique sub-folder of :func:`shared_dir` (never reused)."""
    import uuid

    return shared_dir(spark, f"{prefix}-{uuid.uuid4().hex[:12]}")
