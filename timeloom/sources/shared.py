"""Intermediate results in the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local master, which has one machine, may do without it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"


def cut(df: DataFrame) -> DataFrame:
    """Writes the rows to the shared folder and goes on from there, so that a loop's plan does not grow."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(checkpoint_folder(df.sparkSession))
    return df.checkpoint()
