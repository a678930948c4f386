"""Session helpers: one place that knows how a citylake job talks to Spark."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for a laptop-sized run. On a cluster these come from spark-defaults / the launcher
# and are never overridden here (getOrCreate keeps an existing session as it is).
LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files (rank numbering, extended dictionary, ...) are removed once unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "citylake", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session. Settings only apply when this call creates the session."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(LOCAL_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage with ``DataFrame.checkpoint()``.

    On a cluster it is named by ``spark.checkpoint.dir`` and read from the session. Only when it is
    unset (a local test run) do we pick a private folder ourselves.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="citylake-ckpt-", dir=os.environ.get("CITYLAKE_TMP", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df):
    """Reliable checkpoint (survives executor loss); used where a small derived table is reused."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df, name: str, path: str | None = None):
    """``df`` written as Parquet to the checkpoint folder and read back: unlike a checkpoint it has its real size in bytes, so that the
    engine can broadcast it when it is small. A caller that gives the ``path`` (of ``fresh_path``) can drop it again."""
    path = path or fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this session wrote, once nothing reads it any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession):
    """A job started inside leaves no shuffle files when it has ended; else they stay on the executors' disks until the driver happens to
    collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
