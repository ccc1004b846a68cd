"""Session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job wants: AQE re-plans joins and partition counts at run time
# and splits skewed join partitions; the UI server stays off.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", app: str = "playlog", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the cluster's session as given."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    # one process; local-cluster[...] has executors of its own
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Uses ``spark.checkpoint.dir`` (or the context's checkpoint dir) when the
    cluster names one. Only a local session without one gets a fresh
    temporary folder; a cluster session without one is an error, because a
    machine-local folder is not visible to the executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    local_dir = tempfile.mkdtemp(prefix="playlog-ckpt-")
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a written intermediate table that nothing reads any more."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def folder_state(spark: SparkSession, path: str) -> tuple:
    """(full path, then name, bytes and time of every entry) of a folder in any file system."""
    fs, p = _file_system(spark, path)
    entries = []
    for s in fs.listStatus(p) if fs.exists(p) else []:
        size = fs.getContentSummary(s.getPath()).getLength() if s.isDirectory() else s.getLen()
        entries.append((s.getPath().getName(), size, s.getModificationTime()))
    return (fs.makeQualified(p).toString(), *sorted(entries))


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"
