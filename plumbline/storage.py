"""Where intermediate tables go: the shared folder the cluster names, never a machine-local one."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`; only a local session without one gets a temporary folder."""
    global _local_root
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="plumbline-")
    return _local_root


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder for one run, so that reruns and concurrent runs never share files."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def name_checkpoints(spark: SparkSession) -> None:
    """Name the folder of reliable checkpoints unless the session has one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_root(spark)}/checkpoints")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through a reliable checkpoint that survives the loss of executors."""
    name_checkpoints(df.sparkSession)
    return df.checkpoint()
