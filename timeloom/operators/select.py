"""Non-maximum suppression."""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.operators.sequence import per_group


def suppress(rows: DataFrame, keys: list[str], position: str, score: str, distance: float) -> DataFrame:
    """Keeps of each key, best score first, positions at least ``distance`` from all kept; a key should be bounded.

    Ties in score go to the lower position. Kept positions are held in order,
    so each row is compared with its two neighbours only.
    """
    kind = dict(rows.dtypes)[score]

    def kernel(g: pd.DataFrame) -> dict:
        held: list[float] = []
        kept: list[int] = []
        for i, p in enumerate(g["_p"].to_numpy(float).tolist()):
            if p == p:  # a position that is no number suppresses nothing
                at = bisect_left(held, p)
                if (at and abs(held[at - 1] - p) < distance) or (at < len(held) and abs(held[at] - p) < distance):
                    continue
                insort(held, p)
            kept.append(i)
        return {"rank": np.arange(len(kept)), "position": g["_p"].to_numpy()[kept], "score": g["_v"].to_numpy()[kept]}

    asked = rows.select(*keys, F.col(score).alias("_v"), (-F.col(score)).alias("_s"), F.col(position).cast("double").alias("_p"))
    return per_group(asked, keys, ["_s", "_p"], kernel, f"rank int, position double, score {kind}")
