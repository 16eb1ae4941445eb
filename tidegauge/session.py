"""Session settings and the shared folder that every written intermediate goes to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Spark's default when a plan has no size statistics; anything near it means "unknown".
_UNKNOWN_SIZE = 1 << 62


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. Clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidegauge")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process, which a ``local-cluster`` master is not."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a fresh temporary folder, kept
    for the life of the session.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not is_local(spark):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by driver and executors")
        root = tempfile.mkdtemp(prefix="tidegauge-")
        spark.conf.set(CHECKPOINT_CONF, root)
    return root.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark)}/tidegauge/{label}-{uuid.uuid4().hex}"


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan, or None where it has none (no job is run)."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return None if size >= _UNKNOWN_SIZE else size


def broadcast_limit(spark: SparkSession) -> int:
    """The session's own broadcast bound in bytes; 0 where broadcasts are switched off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if text.strip().startswith("-"):
        return 0
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))
