"""Session helpers: scratch folders and cutting lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Folders of local sessions that name none, by application.
_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local-mode session may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="rivulet-")
    return _local_dirs[context.applicationId]


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Later scans of the result prune columns and survive lost executors.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]):
    """Join condition in which NULL keys match each other."""
    condition = None
    for key in keys:
        term = left[key].eqNullSafe(right[key])
        condition = term if condition is None else condition & term
    return condition
