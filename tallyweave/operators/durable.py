"""Shared storage for relations that several outputs read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; all executors can reach it.

    Where the setting is absent, as in tests, it is a folder of the SQL warehouse, which all
    executors share as well.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    spark.sparkContext.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir')}/_tallyweave")
    return spark.sparkContext.getCheckpointDir()


def frozen(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage; survives the loss of executors."""
    context = df.sparkSession.sparkContext
    folder = shared_folder(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def new_folder(spark: SparkSession, folder: str | None = None) -> str:
    """A path that nobody else uses, in a given folder or the shared one."""
    return f"{folder or shared_folder(spark)}/tallyweave-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """The rows of df as Parquet at path. Unlike a checkpoint, later reads prune columns and push filters down."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write a wide relation as parquet in a folder of its own and read it back."""
    return written(df, f"{new_folder(df.sparkSession, folder)}/{name}")
