"""Features of sounds as rows of frames: (keys, t, level, attack), already decoded. Percentiles are exact, by key.

Frames come from ``sources.audio`` or from a table that another tool wrote;
rows with a null level count as silence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.operators import joins


def leading_silence(frames: DataFrame, keys: list[str], time: str, peak: str, threshold: float = 0.02, longest: float = 10.0) -> DataFrame:
    """Per key the time of the first frame above the threshold, ``longest`` at most (also where none is)."""
    first = F.min(F.when((F.col(peak) > threshold) & (F.col(time) < longest), F.col(time)))
    return frames.groupBy(*keys).agg(F.coalesce(first, F.lit(float(longest))).alias("silence"))


def sustained(frames: DataFrame, keys: list[str], time: str, active: Column, width: int, share: float = 0.60) -> DataFrame:
    """Adds ``sustained``: of the ``width`` frames around a frame at least ``share`` are active."""
    before, after = width // 2, (width - 1) // 2
    by = Window.partitionBy(*keys).orderBy(time).rowsBetween(-before, after)
    needed = max(1, -(-int(width * share * 1000) // 1000))
    return frames.withColumn("sustained", F.sum(F.when(active, 1).otherwise(0)).over(by) >= needed)


def _levels(frames: DataFrame, keys: list[str], column: str, shares: dict[str, float]) -> DataFrame:
    return frames.groupBy(*keys).agg(*(F.percentile(column, p).alias(n) for n, p in shares.items()))


def activity_span(frames: DataFrame, keys: list[str], time: str, level: str, attack: str, width: int) -> DataFrame:
    """Per key first and last sustained activity (over three times the floor and an eighth of the usual level) and the first strong attack."""
    known = _levels(frames, keys, level, {"_f": 0.20, "_a": 0.75}).join(_levels(frames, keys, attack, {"_o": 0.75}), keys)
    loud = frames.join(known, keys).withColumn("_t", F.greatest(F.col("_f") * 3.0, F.col("_a") * 0.12, F.lit(1e-6)))
    flagged = sustained(loud, keys, time, F.col(level) >= F.col("_t"), width)
    on = F.when(F.col("sustained"), F.col(time))
    return flagged.groupBy(*keys).agg(F.min(on).alias("first_activity"), F.max(on).alias("last_activity"), F.min(F.when(F.col(attack) >= F.greatest(F.col("_o"), F.lit(1e-9)), F.col(time))).alias("first_attack"), F.first("_t").alias("threshold"))


def content_end(frames: DataFrame, keys: list[str], time: str, level: str, start: float, hop: float, width: int) -> DataFrame:
    """Per key the end of the last sustained frame of at least 3 % of the programme level, from ``start`` on (null: none)."""
    loud = frames.join(_levels(frames, keys, level, {"_a": 0.70}), keys)
    flagged = sustained(loud, keys, time, (F.col(level) >= F.greatest(F.col("_a") * 0.03, F.lit(1e-5))) & (F.col(time) >= start), width)
    return flagged.groupBy(*keys).agg((F.max(F.when(F.col("sustained"), F.col(time))) + hop).alias("content_end"))


def inactivity(spans: DataFrame, frames: DataFrame, keys: list[str], ident: str, span: tuple[str, str], time: str, level: str, attack: str, width: float = 16.0) -> DataFrame:
    """How quiet each span is against its key's usual levels: quiet level and quiet attacks, weighed; confirmed from 0.60."""
    known = _levels(frames, keys, level, {"_l": 0.30, "_h": 0.75}).join(_levels(frames, keys, attack, {"_o": 0.60}), keys)
    inside = joins.members_of(spans.select(*keys, ident, F.col(span[0]).alias("_s"), F.col(span[1]).alias("_e")), frames.select(*keys, F.col(time).alias("_t"), F.col(level).alias("_lv"), F.col(attack).alias("_at")), keys, "_s", "_e", "_t", width)
    means = inside.groupBy(*keys, ident).agg(F.avg("_lv").alias("_m"), F.avg("_at").alias("_d")).join(known, keys)
    clip = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    quiet = clip(1.0 - (F.col("_m") - F.col("_l")) / F.greatest(F.col("_h") - F.col("_l"), F.lit(1e-9)))
    still = clip(1.0 - F.col("_d") / F.greatest(F.col("_o"), F.lit(1e-9)))
    made = means.select(*keys, ident, quiet.alias("level_quiet"), still.alias("attack_quiet"))
    return made.withColumn("confidence", F.col("level_quiet") * 0.65 + F.col("attack_quiet") * 0.35).withColumn("confirmed", F.col("confidence") >= 0.60)


def rises(frames: DataFrame, keys: list[str], time: str, level: str, attack: str, before: float = 1.0, after: float = 0.45) -> DataFrame:
    """Adds to each frame ``confidence`` that sound sets in there: quiet before, a rise after, an attack; null where a side has no frames.

    Times are in seconds; frames are dealt in a window by key, ranges in microseconds.
    """
    us = (F.col(time) * 1e6).cast("long")
    by = Window.partitionBy(*keys).orderBy("_us")
    early, late = by.rangeBetween(-int(before * 1e6), -30_001), by.rangeBetween(0, int(after * 1e6))
    known = _levels(frames, keys, level, {"_b": 0.20, "_a": 0.70}).join(_levels(frames, keys, attack, {"_o": 0.65}), keys)
    placed = frames.join(known, keys).withColumn("_us", us)
    placed = placed.withColumn("_x", F.median(level).over(early)).withColumn("_y", F.median(level).over(late)).withColumn("_z", F.max(attack).over(late))
    room = F.greatest(F.greatest(F.col("_a"), F.col("_b")) - F.greatest(F.col("_b"), F.lit(1e-9)), F.lit(1e-9))
    clip = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    quiet, rise, hit = clip(1.0 - (F.col("_x") - F.col("_b")) / room), clip((F.col("_y") - F.col("_x")) / room), clip(F.col("_z") / F.greatest(F.col("_o"), F.lit(1e-9)))
    value = quiet * 0.42 + rise * 0.38 + hit * 0.20
    return placed.withColumn("confidence", F.when(F.col("_x").isNotNull() & F.col("_y").isNotNull(), value)).drop("_us", "_b", "_a", "_o", "_x", "_y", "_z")


def onset_matches(events: DataFrame, scored: DataFrame, keys: list[str], ident: str, predicted: str, time: str, radius: float = 6.0, least: float = 0.58, most: int = 5) -> DataFrame:
    """The ``most`` best frames of ``rises`` with sustained sound after silence, within ``radius`` of each event's predicted time.

    ``scored``: confidence and ``starts`` (the frame begins sustained sound). The limit is the operator's own.
    """
    asked = events.withColumn("_a", F.col(predicted) - radius).withColumn("_z", F.col(predicted) + radius)
    near = joins.members_of(asked, scored.where(F.col("starts") & (F.col("confidence") >= least)).select(*keys, F.col(time).alias("_t"), "confidence"), keys, "_a", "_z", "_t", 2 * radius, closed=True)
    off = F.col("_t") - F.col(predicted)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy(*keys, ident).orderBy(F.desc("confidence"), F.abs(off), "_t")))
    return ranked.where(F.col("rank") <= most).select(*keys, ident, "rank", F.col("_t").alias("time"), off.alias("residual"), "confidence")


def peak_within(events: DataFrame, frames: DataFrame, keys: list[str], ident: str, predicted: str, time: str, strength: str, radius: float = 0.45, least: float = 0.20) -> DataFrame:
    """The strongest frame within ``radius`` of each predicted time (the earliest on ties), if strong enough, and a confidence that falls with distance."""
    asked = events.withColumn("_a", F.col(predicted) - radius).withColumn("_z", F.col(predicted) + radius)
    near = joins.members_of(asked, frames.select(*keys, F.col(time).alias("_t"), F.col(strength).alias("_s")), keys, "_a", "_z", "_t", max(2 * radius, 1.0), closed=True)
    best = near.groupBy(*keys, ident, predicted).agg(F.max(F.struct("_s", (-F.col("_t")).alias("_m"))).alias("_b")).where(F.col("_b._s") >= least)
    at = -F.col("_b._m")
    sure = F.least(F.lit(1.0), F.col("_b._s")) * 0.65 + (1.0 - F.abs(at - F.col(predicted)) / radius) * 0.35
    return best.select(*keys, ident, at.alias("observed"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), sure)).alias("confidence"), F.col("_b._s").alias("peak"))


def normalised(frames: DataFrame, keys: list[str], columns: dict[str, float]) -> DataFrame:
    """Weighted sum ``novelty`` of columns scaled to 0..1 by key (a column that does not vary is 0)."""
    by = Window.partitionBy(*keys)
    parts = [F.coalesce((F.col(c) - F.min(c).over(by)) / F.when(F.max(c).over(by) > F.min(c).over(by), F.max(c).over(by) - F.min(c).over(by)), F.lit(0.0)) * w for c, w in columns.items()]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return frames.withColumn("novelty", total)


def envelopes(frames: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Columns divided by their key's 95th percentile."""
    scales = frames.groupBy(*keys).agg(*(F.percentile(c, 0.95).alias(f"_{c}") for c in columns))
    return frames.join(scales, keys).select(*[c for c in frames.columns if c not in columns], *((F.col(c) / (F.col(f"_{c}") + 1e-12)).alias(c) for c in columns))
