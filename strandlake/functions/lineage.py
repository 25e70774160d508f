"""Cutting lineage: rows written once to the folder that driver and executors share, and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir.

    Only where none is set (a local test), one under the warehouse is taken.
    """
    found = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    return found or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"


def stored(df: DataFrame) -> DataFrame:
    """The rows, as settled(), but as a Parquet table: compressed, and each use reads only its columns."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def settled(df: DataFrame) -> DataFrame:
    """The rows, checkpointed: what is used more than once is computed once, and a lost executor loses nothing of it."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
