"""Shared scratch locations and one-level listings.

Intermediate tables go under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``).  Only a session that runs in one process
(``local[...]``) may leave it unset and gets a temporary folder of its own; on a
cluster a missing setting is refused.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession


class NoCheckpointFolder(RuntimeError):
    """The session names no shared folder for intermediate data."""


def checkpoint_root(spark: SparkSession) -> str:
    """The session's shared checkpoint folder: ``spark.checkpoint.dir``, or the
    one given to the SparkContext (``setCheckpointDir``); see above where neither is."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)  # DataFrame.checkpoint() reads the context's folder
    root = root or sc.getCheckpointDir()
    if not root and sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        root = tempfile.mkdtemp(prefix="opinio-ckpt-")
        sc.setCheckpointDir(root)
    if not root:
        raise NoCheckpointFolder("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/opinio-scratch/{name}-{uuid.uuid4().hex[:12]}"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of ``path`` and the path there."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """Names directly under ``path`` and whether each is a folder; an absent path has none."""
    fs, place = file_system(spark, path)
    if not fs.exists(place):
        return []
    return sorted((x.getPath().getName(), x.isDirectory()) for x in fs.listStatus(place))


def task_file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``path`` and the path there, for use inside a task."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))
