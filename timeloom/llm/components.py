"""Connected components: stars per task first, then alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.llm.runtime import cut, map_arrow

EDGES = 2_000_000  # of a task, joined into stars at a time


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node but the least of its component, with that least node."""
    nodes, flat = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = flat[: len(u)], flat[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    far = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[far], nodes[root[far]]


def _contracted(edges: DataFrame) -> DataFrame:
    """Fewer edges (u, v) that connect the same nodes: the stars of each task's share."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            u, v = stars(*(np.concatenate([b.column(i).to_numpy() for b in held]) for i in (0, 1)))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= EDGES:
                yield flush()
                held, n = [], 0
        if held:
            yield flush()

    return map_arrow(edges, work, "u bigint, v bigint", 10_000)


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id`` and ``component`` (the least id reachable) of every id on an edge other than a loop.

    Tasks first join the edges that a shuffle brings together; minima are
    combined before each further shuffle. Each round is written to the shared
    checkpoint folder, and rounds end when the edges are stars.
    """
    own = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
    edge = cut(_contracted(own.repartition("v")))
    state = _state(edge)
    while state[0]:
        both = edge.unionByName(edge.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        edge = cut(small)
        last, state = state, _state(edge)
        if state == last:
            break
    return edge.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(edge.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
