"""Where a plan is cut: intermediate results that are read more than once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder every executor can reach.

    Taken from the running context, then from ``spark.checkpoint.dir``; it must be set.
    """
    context = spark.sparkContext
    known = context.getCheckpointDir()
    if known:
        return known
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir() or folder


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and drop its lineage; for narrow frames read several times."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a wide frame as Parquet in the shared folder and read it back.

    Later passes then read only the columns they name.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
