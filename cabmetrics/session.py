"""Session construction and the shared scratch location."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session options the library relies on. AQE re-plans shuffles at run time
# (coalescing small partitions, splitting skewed ones); UTC makes calendar
# fields independent of the machine.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "cabmetrics", **conf) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` is only set for local runs; on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Pin the session zone: hour/day fields must not depend on the machine."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for written tables: the cluster's ``spark.checkpoint.dir``.

    Without that setting a private folder is made for a local master only: on a
    cluster the driver and the executors would see different disks.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cabmetrics-"))
        d = sc.getCheckpointDir()
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of the JVM for any scheme."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system; what goes wrong there is raised."""
    fs, jpath = _hadoop(spark, path)
    return bool(fs.exists(jpath))


def content_stamp(spark: SparkSession, path: str) -> tuple:
    """(name, bytes, modification time) of a table's files: changes when its contents do."""
    fs, jpath = _hadoop(spark, path)
    if not fs.exists(jpath):
        return ()
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(jpath)))


__all__ = ["get_session", "use_utc", "shared_dir", "scratch_path", "path_exists", "content_stamp", "DEFAULT_CONF"]
