"""Scores, priors and ramps of evidence, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clipped(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), value))


def affine(t: Column, stretch: Column, translation: Column) -> Column:
    return translation + stretch * t


def through_two_points(t: Column, x1: Column, x2: Column, y1: Column, y2: Column) -> Column:
    """The line through (x1, y1) and (x2, y2) at t; y1 where x2 is no later than x1."""
    return F.when(x2 > x1, y1 + (t - x1) * (y2 - y1) / (x2 - x1)).otherwise(y1)


def support_weight(score: Column, coverage: Column, residual: Column) -> Column:
    """Weight of a selected candidate, 0.05 at least; nulls count as 0, 0 and a whole second."""
    s, c, r = F.coalesce(score, F.lit(0.0)), F.coalesce(coverage, F.lit(0.0)), F.coalesce(residual, F.lit(1.0))
    return F.greatest(F.lit(0.05), s * 0.55 + c * 0.30 + F.exp(-r / 0.12) * 0.15)


def temporal_prior(residual: Column, near: float = 0.45, far: float = 2.5, far_weight: float = 0.12) -> Column:
    """Two Gaussians around no residual."""
    bell = lambda sigma: F.exp((residual / max(sigma, 1e-9)) * (residual / max(sigma, 1e-9)) * -0.5)
    return bell(near) * (1 - far_weight) + bell(far) * far_weight


def calibrated_confidence(score: Column, margin: Column, residual: Column, radius: Column, events: Column) -> Column:
    """Score, margin over the next, distance from the edge of the search and number of events, weighed into 0..1."""
    edge = F.greatest(F.lit(0.0), 1.0 - F.abs(residual) / F.greatest(radius, F.lit(1e-9)))
    return clipped(score / 0.75) * 0.35 + clipped(margin / 0.18) * 0.30 + edge * 0.25 + F.least(F.lit(1.0), events / 6.0) * 0.10


def ramp(value: Column, low: float, high: float) -> Column:
    """0 up to ``low``, 1 from ``high``, a line between; a null is 0."""
    return F.coalesce(clipped((value - low) / (high - low)), F.lit(0.0))


def taper(measure: Column, start: Column, end: Column, width: int = 2) -> Column:
    """1 inside [start, end], falling to 0 over ``width`` measures at both ends; 0 outside."""
    if width <= 0:
        return F.when(measure.between(start, end), 1.0).otherwise(0.0)
    side = F.least((measure - start + 1) / (width + 1), (end - measure + 1) / (width + 1))
    return F.when(measure.between(start, end), clipped(side)).otherwise(0.0)


def direction(delta: Column, dead: float = 0.045) -> Column:
    return F.when(delta > dead, 1).when(delta < -dead, -1).otherwise(0)


def phase_units(seconds: Column, beat: Column, measure: Column) -> Column:
    """A shift in seconds, beats and measures; null where the unit is null or 0."""
    per = lambda unit: F.when(unit != 0, seconds / unit)
    return F.struct(seconds.alias("seconds"), per(beat).alias("beats"), per(measure).alias("measures"))
