"""Session helpers: a local session for tests and a checkpoint folder that
always comes from the cluster's own ``spark.checkpoint.dir`` when it is set."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "marketpulse") -> SparkSession:
    """Session for tests and the local bench (``local[N]``, AQE on, UI off)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("MP_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """All instants in this library are naive UTC; pin the session zone."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and streaming state.

    On a cluster this is the folder the cluster names in ``spark.checkpoint.dir``.
    Only a local-mode session without that setting (tests, the bench) gets a
    fresh scratch folder of its own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running lineage-cutting operators")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="mp-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (stream sinks, state)."""
    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and its Path class."""
    cls = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return cls(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), cls


def cluster_settings(input_bytes: int, executor_cores: int, executors: int,
                     target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input.

    Shuffle partitions are sized so a partition holds about
    ``target_partition_bytes`` of the largest shuffle (bounded below by three
    waves of the cluster's cores); AQE coalesces small ones and splits skewed
    ones at run time.  Scan splits match the same size."""
    cores = max(1, executor_cores * executors)
    partitions = max(3 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": UTC,
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
