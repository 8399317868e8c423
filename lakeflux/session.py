"""Session construction and the shared work folder.

Intermediate tables (landing files, sinks written by a job and read back,
streaming checkpoints) live under the folder named by ``spark.checkpoint.dir``.
On a cluster this is the shared store the cluster names; only when it is unset
(local tests) do we pick one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Set on a session where nothing else has set them (spark-submit, spark-defaults, the caller).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    defaults: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session.

    Only what the caller names is set outright. Master, application name and shuffle
    partitions are otherwise those of the submission; ``defaults`` (see
    ``recommended_conf``) and ``BASE_CONF`` fill runtime settings that nothing has set.
    """
    builder = SparkSession.builder
    if master:
        builder = builder.master(master)
    if app_name:
        builder = builder.appName(app_name)
    given = dict(extra_conf or {})
    if shuffle_partitions:
        given["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in given.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    submitted = spark.sparkContext.getConf()
    for key, value in {**BASE_CONF, **(defaults or {})}.items():
        if key not in given and submitted.get(key) is None:
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def recommended_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster run.

    Shuffle partitions are sized so one partition holds about
    ``target_partition_bytes`` of the input, and never fewer than 2x the
    cores. AQE then coalesces small ones and splits skewed ones at run time.
    File splits stay at the same target so scan tasks fit executor memory.
    """
    by_size = -(-max(1, input_bytes) // target_partition_bytes)
    partitions = max(2 * total_cores, by_size)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 2),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder. Only a local-mode session (tests)
    with none configured gets a temporary one; a cluster session must name a
    shared folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder is not visible to other executors
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...) for cluster runs")
        configured = tempfile.mkdtemp(prefix="lakeflux-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def work_root(spark: SparkSession) -> str:
    """This application's folder for intermediate tables, under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/lakeflux-work/{spark.sparkContext.applicationId}"


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one table of a job run; ``remove_work`` takes it away."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove_work(spark: SparkSession) -> bool:
    """Delete this application's intermediate tables, wherever the checkpoint folder is; results must be written by then."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(work_root(spark))
    return bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side file checks in tests."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.normpath(path)
