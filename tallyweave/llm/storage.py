"""Cutting lineage on storage that every executor reaches."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def shared_folder(df: DataFrame) -> str:
    """The folder named by spark.checkpoint.dir, or one of the SQL warehouse where that is unset, as in tests."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        spark.sparkContext.setCheckpointDir(folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    return spark.sparkContext.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """The rows of df, written once to the shared checkpoint folder and read back from there."""
    shared_folder(df)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """The rows of df as a Parquet table of the shared checkpoint folder.

    A checkpoint keeps the size estimate of the plan behind it, and a join's estimate is the product
    of its sides. In a loop the estimate's digits multiply until planning takes longer than the
    work; a table's size is that of its files.
    """
    path = f"{shared_folder(df)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
