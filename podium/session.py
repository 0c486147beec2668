"""Session, table and checkpoint helpers shared by every operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    The cluster names it in ``spark.checkpoint.dir``.  Only a single-machine
    session without that setting gets a temporary folder of its own; on a
    cluster an unset folder is an error, as a machine-local one would be lost
    with its executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = sc.getConf().get("spark.checkpoint.dir", None)
    local = sc.master.startswith("local[") or sc.master == "local"
    if not named:
        if not local:
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        named = tempfile.mkdtemp(prefix="podium-checkpoint-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


def durable(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, its lineage cut."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, for what a query writes and reads again."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
