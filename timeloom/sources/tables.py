"""Parquet tables and the event view that the timeline operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOUR_US = 3_600_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def micros(column: str) -> str:
    """SQL for integer microseconds since 1970 of a timestamp without zone."""
    return f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {column})"


def events(spark: SparkSession, folder: str) -> DataFrame:
    """event_id, role, user_id, t (microseconds), hour and value of every event."""
    rows = table(spark, folder, "events").withColumn("t", F.expr(micros("ts")))
    return rows.select("event_id", F.col("event_type").alias("role"), "user_id", "t", F.expr(f"t div {HOUR_US}").alias("hour"), "value", "props")
