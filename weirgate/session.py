"""Session settings the operators rely on, and where intermediate tables go."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

_local_root: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings under which results are defined.

    Timestamps are rendered in UTC, JSON keys that differ only in case stay
    distinct, and of two equal keys in one object the last one counts.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.caseSensitive", "true")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def session_like(spark: SparkSession, settings: Mapping[str, str]) -> SparkSession:
    """Another session with the settings of a session, but for those given."""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key) and other.conf.get(key, None) != value:
            other.conf.set(key, value)
    for key, value in settings.items():
        other.conf.set(key, value)
    return other


def ship(spark: SparkSession) -> None:
    """Send this package to the workers of a cluster on which it is not installed; once per session.

    Functions that run in Python on the workers import the package there.
    """
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="weirgate-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = shutil.make_archive(f"{folder}/weirgate", "zip", os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(archive)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: the cluster's ``spark.checkpoint.dir``.

    Only a local master without that setting gets a temporary folder; on a
    cluster a machine-local folder would not be visible to the other nodes.
    """
    global _local_root
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="weirgate-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, below the scratch root."""
    return f"{scratch_root(spark)}/weirgate/{label}-{uuid.uuid4().hex}"


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Delete a staged table when the session's process ends, as frames may read it until then."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a staged table this engine wrote, through the file system it lives on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
