"""Shared folders for tables a job writes on its way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def staging_root(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate tables.

    Only a local session that names none gets a folder of its own; on a cluster
    a machine-local folder would be out of reach of the other machines.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="sluiceway-")


def remove_staged(spark: SparkSession, path: str) -> None:
    """Remove a folder that `staging_folder` named; anything else stays."""
    if "/sluiceway/" not in path:
        raise ValueError(f"{path} is no staging folder")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def staging_folder(spark: SparkSession, label: str) -> str:
    """A new folder for one use under the shared root."""
    return f"{staging_root(spark)}/sluiceway/{label}-{uuid.uuid4().hex}"
