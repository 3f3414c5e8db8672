"""Robust statistics by key; percentiles are exact and linearly interpolated."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timeloom.functions import slopes
from timeloom.operators.sequence import per_group, per_groups


def median_and_mad(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Median, and median absolute deviation from it."""
    centre = rows.groupBy(*keys).agg(F.median(value).alias("median"))
    return rows.join(centre, keys).groupBy(*keys).agg(F.first("median").alias("median"), F.median(F.abs(F.col(value) - F.col("median"))).alias("mad"))


def weighted_median(rows: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    """The least value whose cumulative weight reaches half; equal values are summed before the window."""
    summed = rows.groupBy(*keys, value).agg(F.sum(weight).alias("_w"))
    by = Window.partitionBy(*keys)
    run = summed.withColumn("_run", F.sum("_w").over(by.orderBy(value))).withColumn("_all", F.sum("_w").over(by))
    return run.where(F.col("_run") * 2 >= F.col("_all")).groupBy(*keys).agg(F.min(value).alias("weighted_median"))


def residual_metrics(rows: DataFrame, keys: list[str], residual: str) -> DataFrame:
    """Count, median and 95th percentile and maximum of the absolute residual, and the signed median."""
    size = F.abs(F.col(residual))
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.median(size).alias("median_abs"), F.percentile(size, 0.95).alias("p95_abs"), F.max(size).alias("max_abs"), F.median(residual).alias("signed_median"))


def _points(rows: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    return rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))


def theil_sen(rows: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Median slope over all pairs of a key's points with x1 < x2, and the number of these pairs; a key without any gives no row.

    No pairs are formed but few around the median (``slopes``): a key of n points costs n log n time and memory of n.
    ``dealt_median_slope`` takes keys that one task can't hold.
    """

    def kernel(g: pd.DataFrame, starts: np.ndarray) -> tuple[np.ndarray, dict]:
        slope, pairs = slopes.median_slopes(g["_x"].to_numpy(), g["_y"].to_numpy(), starts)
        some = np.flatnonzero(pairs)
        return some, {"slope": slope[some], "pairs": pairs[some]}

    return per_groups(_points(rows, keys, x, y), keys, ["_x", "_y"], kernel, "slope double, pairs bigint")


def best_and_margin(rows: DataFrame, keys: list[str], name: str, score: str) -> DataFrame:
    """The best row of each key and its lead over the second (null: there is none)."""
    by = Window.partitionBy(*keys).orderBy(F.desc(score), name)
    ranked = rows.withColumn("_r", F.row_number().over(by)).withColumn("_second", F.lead(score).over(by)).where("_r = 1")
    return ranked.select(*keys, F.col(name).alias("best"), F.col(score).alias("score"), (F.col(score) - F.col("_second")).alias("margin"))


def theil_sen_line(rows: DataFrame, keys: list[str], x: str, y: str, least: float = 0.0) -> DataFrame:
    """Per key the median slope over pairs with x apart by more than ``least`` (1 where there are none), the median intercept, and the residuals' median and maximum.

    As ``theil_sen``, no pairs are formed.
    """

    def kernel(g: pd.DataFrame, starts: np.ndarray) -> tuple[np.ndarray, dict]:
        a, b = g["_x"].to_numpy(), g["_y"].to_numpy()
        slope, pairs = slopes.median_slopes(a, b, starts, least)
        slope = np.where(pairs > 0, slope, 1.0)
        n = np.diff(np.append(starts, len(a)))
        own = np.repeat(np.arange(len(starts)), n)
        intercept = slopes.group_medians(b - slope[own] * a, own, len(starts))
        off = np.abs(b - (intercept[own] + slope[own] * a))
        return np.arange(len(starts)), {"slope": slope, "intercept": intercept, "n": n, "median_residual": slopes.group_medians(off, own, len(starts)), "maximum_residual": np.maximum.reduceat(off, starts)}

    return per_groups(_points(rows, keys, x, y), keys, ["_x", "_y"], kernel, "slope double, intercept double, n bigint, median_residual double, maximum_residual double")


def median_path(rows: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """One y per x of a warping path, the median of those there."""
    return rows.groupBy(*keys, x).agg(F.median(y).alias(y))


def trimmed_line(rows: DataFrame, keys: list[str], x: str, y: str, rounds: int = 3, width: float = 3.5, floor: float = 0.02) -> DataFrame:
    """The median line (slope, intercept, n, median_residual) after up to ``rounds`` trims of points farther than ``width`` MADs, ``floor`` at least, from it.

    One without two different x has slope 1.
    """

    def line(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
        slope, pairs = slopes.median_slope(a, b)
        slope = slope if pairs else 1.0
        return slope, float(np.median(b - slope * a))

    def kernel(g: pd.DataFrame) -> dict:
        a, b = g[x].to_numpy(float), g[y].to_numpy(float)
        for _ in range(rounds):
            slope, cut = line(a, b)
            off = b - (cut + slope * a)
            middle = np.median(off)
            near = np.abs(off - middle) <= max(floor, width * float(np.median(np.abs(off - middle))))
            if near.all() or not near.any():
                break
            a, b = a[near], b[near]
        slope, cut = line(a, b)
        return {"slope": [slope], "intercept": [cut], "n": [len(a)], "median_residual": [float(np.median(np.abs(b - (cut + slope * a))))]}

    known = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return per_group(known, keys, [x, y], kernel, "slope double, intercept double, n bigint, median_residual double")
