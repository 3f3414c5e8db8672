"""Session helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Keep the cluster's ``spark.checkpoint.dir``; only a local master, which has one machine, may do without it."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there.

    The rows are computed once; a lost executor re-reads files rather than
    re-running what came before.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def release(collect: bool = True) -> None:
    """Hands memory that freed arrays have left back to the system, where the C library can."""
    if collect:
        gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def text_of(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only key and text, a null text read as empty, so clashing extra columns never matter."""
    return documents.select(F.col(key).alias(key), F.coalesce(F.col(text), F.lit("")).alias("text"))


def map_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, rows: int = 1000) -> DataFrame:
    """``mapInArrow`` that hands the work at most ``rows`` rows at a time; the session's settings stay as they are.

    After a partition a worker, which waits for the next one, keeps no memory.
    """

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(sliced(batches))
        release()

    return df.mapInArrow(whole, schema)


def per_group(df: DataFrame, key: str, work: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``applyInPandas`` by one key, after each group of which a worker keeps no memory."""

    def whole(group: pd.DataFrame) -> pd.DataFrame:
        made = work(group)
        del group
        release(collect=False)
        return made

    return df.groupBy(key).applyInPandas(whole, schema)


def slices(texts: list[str], chars: int = 1_000_000) -> Iterator[slice]:
    """Consecutive slices of about ``chars`` code points; a longer text is one slice of its own."""
    start = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > chars:
            yield slice(start, i)
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield slice(start, len(texts))
