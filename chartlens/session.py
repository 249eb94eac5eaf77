"""Session settings and the shared folder for written tables.

Operators never build a session; this module is for tests, the bench and
scripts. On a cluster the session comes from ``spark-submit`` and its
``spark.checkpoint.dir`` names a shared folder; we only pick a local one
when that setting is missing (local tests).
"""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every chartlens job wants, whatever the cluster size.
#  - AQE re-plans joins and partition counts from real shuffle sizes and
#    splits skewed join partitions (a popular artist or title).
#  - UTC keeps date arithmetic independent of the machine.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # checkpoint files of finished plans are removed when no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "chartlens") -> SparkSession:
    """A local session for tests and the bench (one JVM, ``cores`` threads)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("CHARTLENS_DRIVER_MEMORY", "8g")
    conf["spark.sql.execution.arrow.pyspark.enabled"] = "true"
    conf["spark.ui.showConsoleProgress"] = "false"
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Read from ``spark.checkpoint.dir``; set to a fresh local folder only when
    the session has none and runs in one local JVM (tests). Elsewhere a
    session without one is an error: executors do not see a folder of the
    driver's machine.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share (master: {master})")
        # spark.checkpoint.dir is fixed at start-up; the context setter is
        # the only runtime way to name one.
        current = tempfile.mkdtemp(prefix="chartlens-ckpt-")
        spark.sparkContext.setCheckpointDir(current)
    return current


def app_dir(spark: SparkSession) -> str:
    """This application's folder under the shared folder.

    Every table chartlens writes for its own use (materialized
    intermediates, round trips) goes here, so one application's scratch
    data can be removed in one step when the job is done.
    """
    return f"{shared_dir(spark).rstrip('/')}/chartlens-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in this application's folder under the shared folder.

    Inside ``scratch`` it lies in that block's own folder.
    """
    base = getattr(_scope, "folder", None) or app_dir(spark)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


_scope = threading.local()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder through Spark's file systems, if it is there."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def replace(spark: SparkSession, staged: str, path: str) -> None:
    """Puts the folder ``staged`` in the place of ``path``; what was there goes once the new one stands.

    Two renames in one file system: a reader finds the old folder or the new one, whole.
    If the second rename fails the old folder is put back. (On object stores a rename is a
    copy of each file, so there the swap is as long as that copy.)
    """
    jvm = spark.sparkContext._jvm
    new, target = jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(path)
    old = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.replaced-{uuid.uuid4().hex[:12]}")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = fs.exists(target)
    if not there and target.getParent() is not None:
        fs.mkdirs(target.getParent())
    if there and not fs.rename(target, old):
        raise OSError(f"{path} cannot be moved aside")
    try:
        if not fs.rename(new, target):
            raise OSError(f"{staged} cannot be moved to {path}")
    except BaseException:
        if there:
            fs.rename(old, target)
        raise
    if there:
        fs.delete(old, True)


@contextmanager
def scratch(spark: SparkSession, folder: str | None = None) -> Iterator[str]:
    """Tables that chartlens writes for its own use in this block are removed at its end.

    Holds for this thread; other threads join a block by passing its
    ``folder`` (and leave its removal to the thread that opened it).
    """
    before = getattr(_scope, "folder", None)
    own = folder or f"{app_dir(spark)}/scratch-{uuid.uuid4().hex[:12]}"
    _scope.folder = own
    try:
        yield own
    finally:
        _scope.folder = before
        if folder is None:
            remove(spark, own)
