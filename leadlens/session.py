"""Session defaults and durable lineage cuts.

The session time zone is pinned to UTC (the contract's calendar is UTC), and lineage is cut
with ``checkpoint()`` or a written table in the shared folder named by
``spark.checkpoint.dir``; a machine-local folder is used only by a local session without it.
"""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings the engine relies on (all runtime-settable).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "leadlens",
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and local benches (UI off, UTC, AQE on)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         # checkpoint files of a query are removed once its frames are garbage-collected
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in {**RUNTIME_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session(spark)
    return spark


def ensure_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the engine's semantics depend on (idempotent)."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, reading ``spark.checkpoint.dir``.

    Only a local-mode session (tests) without the setting gets a folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="leadlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder and cut its lineage.

    Used where a plan feeds two consumers that must see identical rows (e.g. the
    range-partitioned frame of the distributed rank) and where recomputation after an
    executor loss must not change results.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/leadlens/{name}-{uuid.uuid4().hex[:12]}"


def hadoop_fs(spark: SparkSession, path: str):
    """Hadoop FileSystem handle for ``path`` (works for local, HDFS and object stores)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


__all__ = ["build_session", "ensure_session", "ensure_checkpoint_dir", "durable", "scratch_path",
           "hadoop_fs"]
