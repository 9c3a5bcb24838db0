"""Session helpers: a tuned local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package is written for.  AQE re-plans joins at run time
# (broadcast when the measured side is small, split skewed partitions, coalesce tiny
# ones); UTC keeps timestamp -> date conversions identical to the SQL oracle.
# Partition sizes: scan splits and post-shuffle partitions of ~128-256 MB fit an
# executor core's memory share without spilling, whatever the total input size.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows sent to Python per Arrow batch: pages and prompts are whole texts, so a batch
    # of 10,000 (the default) can hold gigabytes in one Python worker
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # evaluator replies are parsed into VARIANT: a repeated key keeps its last value, as
    # a JSON reader in Python does, instead of making the whole reply unreadable
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Bytes of shuffle data one post-shuffle partition should hold before AQE coalescing.
TARGET_SHUFFLE_PARTITION_BYTES = 200 * 1024 * 1024


def shuffle_partitions_for(shuffle_bytes: int, cores: int) -> int:
    """Initial ``spark.sql.shuffle.partitions`` for a cluster: enough partitions that each
    holds ~200 MB of the largest shuffle, and at least 3 waves of the cluster's cores (AQE
    coalesces the small ones back together). There is no upper limit: fewer partitions
    would be larger than the target and spill."""
    by_size = -(-shuffle_bytes // TARGET_SHUFFLE_PARTITION_BYTES)
    return int(max(3 * cores, by_size))


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "casegauge", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the recommended settings.

    ``shuffle_partitions`` defaults to the core count of ``local[N]`` masters. On a
    cluster master it is left to the cluster's configuration unless given (size it with
    :func:`shuffle_partitions_for`); it is never forced down to a local-sized number.
    """
    master = master or os.environ.get("CASEGAUGE_MASTER", "local[8]")
    local = master.startswith("local")
    if shuffle_partitions is None and local:
        cores = master[master.find("[") + 1:-1] if master.startswith("local[") else ""
        shuffle_partitions = int(cores) if cores.isdigit() else os.cpu_count() or 8
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if local:
        builder = builder.config("spark.driver.memory",
                                 os.environ.get("CASEGAUGE_DRIVER_MEMORY", "16g"))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session without one (tests) gets a private temporary folder; a
    cluster session without one is an error, never a machine-local folder -- lineage cuts
    and stream checkpoints must survive the loss of the executor that wrote them.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder "
                               "(e.g. on the cluster's distributed file system)")
        root = tempfile.mkdtemp(prefix="casegauge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique sub-folder of the shared scratch root (never reused between runs)."""
    return f"{scratch_root(spark)}/casegauge/{purpose}-{uuid.uuid4().hex}"
