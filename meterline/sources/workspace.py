"""Scratch space that every executor can reach."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# Masters whose executors are threads of the driver; those of ``local-cluster`` are processes of their own.
_ONE_PROCESS = re.compile(r"local(\[.*\])?$")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints.

    Only a local session that names none gets a temporary folder of its own; on a cluster such a folder
    would exist on one machine only, so there a missing setting is an error.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not _ONE_PROCESS.match(spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="meterline-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A folder name under the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/meterline/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored in the shared folder, so that losing executors costs no recompute."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(fresh_folder(spark, "checkpoint"))
    return df.checkpoint(eager=True)
