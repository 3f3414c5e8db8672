"""Onset groups of an endless stream: chains by session windows, head-anchored groups by a state of their own."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from timeloom.sources.shared import checkpoint_folder


def chain_groups(stream: DataFrame, keys: list[str], time: str, tolerance_us: int, late: str) -> DataFrame:
    """First and last time (microseconds) and size of each group of rows at most ``tolerance_us`` after the one before.

    ``time`` is a timestamp. State holds the groups that rows may still join:
    a group leaves it once the watermark, ``late`` behind the newest row, has
    passed its end; rows that come later still are dropped. A session ends
    where the gap is at least its width, so it is one microsecond wider.
    """
    session = F.session_window(time, f"{tolerance_us + 1} microseconds")
    grouped = stream.withWatermark(time, late).groupBy(*keys, session)
    got = grouped.agg(F.min(time).alias("_a"), F.max(time).alias("_z"), F.count("*").alias("n"))
    return got.select(*keys, F.unix_micros("_a").alias("first_us"), F.unix_micros("_z").alias("last_us"), "n")


def replay(spark: SparkSession, result: DataFrame) -> DataFrame:
    """Runs an aggregated stream over all its source has now and returns the whole result, from the shared folder.

    Each batch writes the complete result, so groups still open are in it.
    For a finite source only: complete mode keeps all groups in state. A
    batch that is run again writes the same folder again.
    """
    root = checkpoint_folder(spark)
    folder = f"{root}/stream-{uuid.uuid4().hex}"
    done = [-1]
    spark.createDataFrame([], result.schema).write.parquet(f"{folder}/out/batch=-1")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")
        done[0] = number

    result.writeStream.outputMode("complete").option("checkpointLocation", f"{folder}/state").foreachBatch(write).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{folder}/out/batch={done[0]}")


class Heads:
    """Groups of one key while its rows come: the open group, and times that rows may still come before."""

    def __init__(self, tolerance: int, waiting: list[int] | None = None, head: int | None = None, stop: int | None = None, n: int = 0) -> None:
        self.tolerance, self.waiting, self.head, self.stop, self.n = tolerance, waiting or [], head, stop, n

    def settle(self, until: int) -> list[tuple[int, int, int]]:
        """Takes waiting times up to ``until``, which no row can precede any more; the groups that this closes."""
        self.waiting.sort()
        closed, taken = [], 0
        for t in self.waiting:
            if t > until:
                break
            taken += 1
            if self.head is not None and t > self.head + self.tolerance:
                closed.append((self.head, self.stop, self.n))
                self.head = None
            if self.head is None:
                self.head, self.n = t, 0
            self.stop, self.n = t, self.n + 1
        del self.waiting[:taken]
        if self.head is not None and until >= self.head + self.tolerance:
            closed.append((self.head, self.stop, self.n))
            self.head = None
        return closed

    def open(self) -> list[tuple[int, int, int]]:
        """The groups as they would be if no more rows came."""
        rest = Heads(self.tolerance, list(self.waiting), self.head, self.stop, self.n)
        return rest.settle(1 << 62)


def head_groups(stream: DataFrame, keys: list[str], time: str, tolerance_us: int, late: str) -> DataFrame:
    """Groups that take what comes within ``tolerance_us`` of their first row: (keys, first_us, last_us, n, closed), as updates.

    ``time`` is a timestamp. A row may change heads behind it until the
    watermark, ``late`` behind the newest row, has passed; so times wait until
    then, and a group is closed once no row can join it: it comes once as
    closed. Groups still open are told anew whenever their key has rows, and
    what was told of them before no longer counts. State holds a key's waiting
    times and one open group; an event-time timer settles keys that get no more rows.
    """
    fields = stream.select(*keys).schema.fields
    columns = [*keys, "first_us", "last_us", "n", "closed"]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in fields), "first_us bigint, last_us bigint, n bigint, closed boolean"])

    def work(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        waiting, head, stop, n = state.get if state.exists else ([], None, None, 0)
        groups = Heads(tolerance_us, list(waiting), head, stop, n)
        for frame in frames:
            groups.waiting += frame["_us"].tolist()
        watermark = state.getCurrentWatermarkMs()
        closed = groups.settle(watermark * 1000)
        still = groups.open()
        if still:
            state.update((groups.waiting, groups.head, groups.stop, groups.n))
            turn = groups.head + tolerance_us if groups.head is not None else min(groups.waiting)
            state.setTimeoutTimestamp(max(-(-turn // 1000), watermark + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame([(*key, *g, True) for g in closed] + [(*key, *g, False) for g in still], columns=columns)

    timed = stream.where(F.col(time).isNotNull()).withWatermark(time, late).select(*keys, time, F.unix_micros(time).alias("_us"))
    return timed.groupBy(*keys).applyInPandasWithState(work, schema, "waiting array<bigint>, head bigint, stop bigint, n bigint", "update", GroupStateTimeout.EventTimeTimeout)


def replay_heads(spark: SparkSession, result: DataFrame, keys: list[str], folder: str | None = None) -> DataFrame:
    """Runs ``head_groups`` over all its source has now: the closed groups, and those that each key had open at the end.

    Called again with the same folder it goes on where it ended, in state and results.
    """
    folder = folder or f"{checkpoint_folder(spark)}/stream-{uuid.uuid4().hex}"
    spark.createDataFrame([], result.schema).write.mode("overwrite").parquet(f"{folder}/out/batch=-1")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    result.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/state").foreachBatch(write).trigger(availableNow=True).start().awaitTermination()
    told = spark.read.parquet(f"{folder}/out")
    newest = F.max("batch").over(Window.partitionBy(*keys))
    return told.withColumn("_newest", newest).where(F.col("closed") | (F.col("batch") == F.col("_newest"))).select(*keys, "first_us", "last_us", "n")
