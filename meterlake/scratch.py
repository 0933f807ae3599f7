"""Shared working folders: the checkpoint folder the cluster names.

Lineage is cut with ``DataFrame.checkpoint()`` (reliable, in
``spark.checkpoint.dir``) and intermediate tables live under the same
folder, so they survive the loss of an executor.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Set only when the session has none and
    runs in local mode (tests); a cluster must name a shared folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="meterlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new, unused folder under the checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/meterlake/{tag}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder made by ``scratch_path``."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
