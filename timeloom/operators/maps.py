"""Time maps as tables of controls, never as closures.

A map is (keys, x, y): y is where time x goes, linear between controls. A
residual map is (keys, x, r), added to a baseline that the rows carry. What
holds outside the controls is named per side:

* ``clamp``: the end's y; ``unit``: slope one; ``extend``: the end's slope;
* ``base``: the baseline alone; ``hold``: the baseline plus the end's residual.

Controls with a null are left out; of controls at one x the greatest y counts.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.operators import joins
from timeloom.operators.sequence import per_group

SIDES = ("clamp", "unit", "extend", "base", "hold")


def pieces(controls: DataFrame, keys: list[str], y: str = "y") -> DataFrame:
    """Controls with the next one, the first and last of their key and the slopes there."""
    once = controls.where(F.col("x").isNotNull() & F.col(y).isNotNull()).groupBy(*keys, F.col("x").cast("double").alias("_x")).agg(F.max(y).cast("double").alias("_y"))
    by = Window.partitionBy(*keys).orderBy("_x")
    whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    slope = (F.lead("_y").over(by) - F.col("_y")) / (F.lead("_x").over(by) - F.col("_x"))
    led = once.withColumn("_x2", F.lead("_x").over(by)).withColumn("_y2", F.lead("_y").over(by)).withColumn("_slope", slope)
    return led.withColumn("_fx", F.first("_x").over(whole)).withColumn("_fy", F.first("_y").over(whole)).withColumn("_fs", F.first("_slope", True).over(whole)).withColumn("_ls", F.last("_slope", True).over(whole)).withColumn("_o", F.when(F.col("_x") == F.col("_fx"), F.lit(float("-inf"))).otherwise(F.col("_x")))


def map_times(rows: DataFrame, controls: DataFrame, keys: list[str], time: str, out: str, before: str = "unit", after: str = "unit", base: str | None = None, width: int | None = None) -> DataFrame:
    """Adds ``out``, the mapped time; a row whose key has no controls keeps its time (or baseline).

    ``base`` names the baseline column that the modes ``base`` and ``hold`` need.
    """
    if before not in SIDES or after not in SIDES or (base is None and {before, after} & {"base", "hold"}):
        raise ValueError(f"no such sides: {before}, {after}")
    t = F.col(time).cast("double")
    b = F.col(base).cast("double") if base else t
    held = pieces(controls, keys)
    if base:  # the baseline at the ends, for residuals held beyond them
        held = held.join(_ends(rows, held, keys, time, base), keys, "left")
    else:
        held = held.withColumn("_bf", F.lit(None).cast("double")).withColumn("_bl", F.lit(None).cast("double"))
    names = ["_x", "_y", "_x2", "_y2", "_fx", "_fy", "_fs", "_ls", "_bf", "_bl"]
    placed = joins.asof(rows, held.select(*keys, "_o", *names), keys, time, "_o", names, width)
    side = {"clamp": lambda y, x, s, e: y, "unit": lambda y, x, s, e: y + (t - x), "extend": lambda y, x, s, e: y + (t - x) * F.coalesce(s, F.lit(1.0)), "base": lambda y, x, s, e: b, "hold": lambda y, x, s, e: b + (y - e)}
    early = side[before](F.col("_fy"), F.col("_fx"), F.col("_fs"), F.col("_bf"))
    late = side[after](F.col("_y"), F.col("_x"), F.col("_ls"), F.col("_bl"))
    inside = F.col("_y") + (t - F.col("_x")) * (F.col("_y2") - F.col("_y")) / (F.col("_x2") - F.col("_x"))
    made = F.when(F.col("_x").isNull(), b).when(t < F.col("_fx"), early).when(F.col("_x2").isNull(), F.when(t == F.col("_x"), F.col("_y")).otherwise(late)).otherwise(inside)
    return placed.withColumn(out, made).drop(*names)


def _ends(rows: DataFrame, held: DataFrame, keys: list[str], time: str, base: str) -> DataFrame:
    """The baseline at a key's first and last control: at the row nearest to each."""
    ends = held.groupBy(*keys).agg(F.min("_x").alias("_a"), F.max("_x").alias("_z"))
    near = rows.select(*keys, F.col(time).alias("_t"), F.col(base).cast("double").alias("_b")).join(ends, keys)
    at = lambda c: F.min_by("_b", F.struct(F.abs(F.col("_t") - F.col(c)), "_t"))
    shift = lambda c: F.min_by(F.col(c) - F.col("_t"), F.struct(F.abs(F.col("_t") - F.col(c)), "_t"))
    return near.groupBy(*keys).agg((at("_a") + shift("_a")).alias("_bf"), (at("_z") + shift("_z")).alias("_bl"))


def add_residuals(rows: DataFrame, controls: DataFrame, keys: list[str], time: str, base: str, out: str, before: str = "hold", after: str = "hold", width: int | None = None) -> DataFrame:
    """Adds ``out``: the baseline plus the residual r interpolated at the time; outside, the end's residual (``hold``) or none (``base``)."""
    held = pieces(controls, keys, "r")
    names = ["_x", "_y", "_x2", "_y2", "_fx", "_fy"]
    placed = joins.asof(rows, held.select(*keys, "_o", *names), keys, time, "_o", names, width)
    t = F.col(time).cast("double")
    end = lambda mode, y: F.col(y) if mode == "hold" else F.lit(0.0)
    line = F.col("_y") + (t - F.col("_x")) * (F.col("_y2") - F.col("_y")) / (F.col("_x2") - F.col("_x"))
    residual = F.when(F.col("_x").isNull(), 0.0).when(t < F.col("_fx"), end(before, "_fy")).when(F.col("_x2").isNull(), F.when(t == F.col("_x"), F.col("_y")).otherwise(end(after, "_y"))).otherwise(line)
    return placed.withColumn(out, F.col(base) + residual).drop(*names)


def map_spans(rows: DataFrame, controls: DataFrame, keys: list[str], start: str, end: str, shortest: float = 0.0, width: int | None = None, **sides: str) -> DataFrame:
    """Adds ``t`` and ``d``: start and length of each span by its mapped ends, ``shortest`` at least."""
    opened = map_times(rows, controls, keys, start, "_s", width=width, **sides)
    closed = map_times(opened, controls, keys, end, "_e", width=width, **sides)
    return closed.withColumn("t", F.col("_s")).withColumn("d", F.greatest(F.lit(float(shortest)), F.col("_e") - F.col("_s"))).drop("_s", "_e")


def scaled_curve(curve: Column, ratio: Column) -> Column:
    """Points (t, v) of a curve inside a note whose length changed by ``ratio``."""
    return F.transform(curve, lambda p: p.withField("t", p["t"] * ratio))


def map_nested(documents: DataFrame, controls: DataFrame, keys: list[str], rows: str, offset: float = 0.0, shortest: float = 0.0, **sides: str) -> DataFrame:
    """Maps the fields t and d of an array of structs in each document (one row per keys), which keeps its order.

    Rows without d keep it null. Documents without rows stay as they are.
    """
    flat = documents.select(*keys, F.posexplode(rows).alias("_i", "_r")).withColumn("_a", F.col("_r.t") + offset)
    flat = flat.withColumn("_z", F.col("_a") + F.coalesce("_r.d", F.lit(0.0)))
    done = map_spans(flat, controls, keys, "_a", "_z", shortest, **sides)
    made = F.col("_r").withField("t", F.col("t")).withField("d", F.when(F.col("_r.d").isNotNull(), F.col("d")))
    nested = done.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", made.alias("r")))), lambda s: s["r"]).alias("_new"))
    return documents.join(nested, keys, "left").withColumn(rows, F.coalesce("_new", F.col(rows))).drop("_new")


def rewrite_documents(documents: DataFrame, controls: DataFrame, keys: list[str], kind: str, timed: dict[str, list[str]], **sides: str) -> DataFrame:
    """Retimes each document by its kind: ``timed`` lists the array columns of a kind that hold times; other kinds stay."""
    out = [documents.where(~F.coalesce(F.col(kind).isin(*timed), F.lit(False)))]
    for name, columns in timed.items():
        out.append(reduce(lambda d, c: map_nested(d, controls, keys, c, **sides), columns, documents.where(F.col(kind) == name)))
    return reduce(DataFrame.unionByName, out)


def rewrite_tempos(rows: DataFrame, controls: DataFrame, keys: list[str], time: str, bpm: str, **sides: str) -> DataFrame:
    """Maps times and divides each tempo by how much the stretch to the next row grew (the last one's by the stretch before)."""
    by = Window.partitionBy(*keys).orderBy(time)
    done = map_times(rows, controls, keys, time, "_new", **sides)
    growth = (F.lead("_new").over(by) - F.col("_new")) / (F.lead(time).over(by) - F.col(time))
    grown = done.withColumn("_g", F.when(growth > 0, growth))
    ratio = F.coalesce("_g", F.last("_g", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(1.0))
    return grown.withColumn(bpm, F.col(bpm) / ratio).withColumn(time, F.col("_new")).drop("_new", "_g")


def simple_map(events: DataFrame, observed: DataFrame, keys: list[str], time: str, mode: str = "linear") -> DataFrame:
    """Per key offset and scale from the first (and last) event and observation: ``identity``, ``offset`` or ``linear``.

    A key without observations, or with events at one time, has scale one.
    """
    if mode not in ("identity", "offset", "linear"):
        raise ValueError(f"no such mode: {mode}")
    a = events.groupBy(*keys).agg(F.min(time).alias("score_first"), F.max(time).alias("score_last"))
    both = a.join(observed.groupBy(*keys).agg(F.min(time).alias("audio_first"), F.max(time).alias("audio_last")), keys, "left")
    span = (F.col("audio_last") - F.col("audio_first")) / (F.col("score_last") - F.col("score_first"))
    scale = F.coalesce(F.when(F.col("score_last") > F.col("score_first"), span), F.lit(1.0)) if mode == "linear" else F.lit(1.0)
    start = F.lit(0.0) if mode == "identity" else F.coalesce(F.col("audio_first") - F.col("score_first") * F.col("scale"), F.lit(0.0))
    return both.withColumn("scale", scale).withColumn("offset", start)


def reanchored(t: Column, scale: Column, score_start: Column, audio_start: Column) -> Column:
    """A measured scale through a start that is known by other means."""
    return audio_start + scale * (t - score_start)


def guarded_scale(score_start: Column, score_end: Column, audio_start: Column, audio_end: Column, least: float = 0.95, most: float = 1.05) -> Column:
    """(scale, accepted): the ratio of the spans if it is plausible, else 1."""
    ratio = F.when(score_end > score_start, (audio_end - audio_start) / (score_end - score_start))
    fits = F.coalesce(ratio.between(least, most), F.lit(False))
    return F.struct(F.when(fits, ratio).otherwise(1.0).alias("scale"), fits.alias("accepted"))


def opening_prior(t: Column, score: Column, audio: Column, scale: Column) -> Column:
    """Identity until both sides of the opening are known, then the line through it."""
    return F.when(score.isNotNull() & audio.isNotNull(), audio + F.coalesce(scale, F.lit(1.0)) * (t - score)).otherwise(t)


def exact_layer(baseline_ends: DataFrame, manual: DataFrame, keys: list[str]) -> DataFrame:
    """Controls of the baseline's ends and of exact manual anchors (x, y, id), which win at the same x.

    Adds ``monotonic``: whether y rises strictly over all controls of the key.
    """
    both = baseline_ends.select(*keys, "x", "y", F.lit(1).alias("_p"), F.lit("baseline").alias("kind")).unionByName(manual.select(*keys, "x", "y", F.lit(0).alias("_p"), F.col("id").cast("string").alias("kind")))
    best = both.groupBy(*keys, "x").agg(F.min_by(F.struct("y", "kind"), F.struct("_p", "kind")).alias("_b")).select(*keys, "x", "_b.*")
    by = Window.partitionBy(*keys)
    rises = F.coalesce(F.col("y") > F.col("_q"), F.lit(True))
    return best.withColumn("_q", F.lag("y").over(by.orderBy("x"))).withColumn("monotonic", F.min(rises).over(by)).drop("_q")


def resolve_manual(anchors: DataFrame, bars: DataFrame, keys: list[str], padding: float = 0.0) -> DataFrame:
    """Nominal and padded times of manual anchors, with the reasons why one does not resolve.

    Anchors: id, playback_bar or source_bar and occurrence, beat, beat_fraction, time, basis (original or padded).
    Bars: measure, source_bar, occurrence, t_gp, ts_num, and end (null: not known). A bar ends where the next begins.
    """
    by = Window.partitionBy(*keys).orderBy("measure")
    ended = bars.withColumn("_end", F.coalesce(F.lead("t_gp").over(by), F.col("end")))
    a = anchors.alias("a")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    by_bar = reduce(lambda p, q: p & q, [*same, F.col("a.playback_bar") == F.col("b.measure")])
    by_source = reduce(lambda p, q: p & q, [*same, F.col("a.playback_bar").isNull(), F.col("a.source_bar") == F.col("b.source_bar"), F.coalesce(F.col("a.occurrence") == F.col("b.occurrence"), F.lit(True))])
    fields = [F.col(f"a.{c}") for c in anchors.columns]
    bar = [F.col(f"b.{c}").alias(f"_{c}") for c in ("measure", "t_gp", "ts_num", "_end")]
    met = a.join(ended.alias("b"), by_bar, "left").select(*fields, *bar).where("playback_bar is not null").unionByName(a.where("playback_bar is null").alias("a").join(ended.alias("b"), by_source, "left").select(*fields, *bar))
    counted = met.groupBy(*anchors.columns).agg(F.count("_measure").alias("bars"), F.first(F.struct("_measure", "_t_gp", "_ts_num", "__end")).alias("_b"))
    place = F.col("beat") - 1 + F.coalesce("beat_fraction", F.lit(0.0))
    meter = F.greatest(F.lit(1), F.coalesce(F.col("_b._ts_num"), F.lit(4)))
    nominal = F.when(place == 0, F.col("_b._t_gp").cast("double")).otherwise(F.col("_b._t_gp") + place / meter * (F.col("_b.__end") - F.col("_b._t_gp")))
    reasons = {
        "not_one_bar": F.col("bars") != 1, "fraction_outside_beat": ~F.coalesce("beat_fraction", F.lit(0.0)).between(0, 0.999999999), "beat_outside_meter": (place < 0) | (place >= meter),
        "final_bar_without_end": (place != 0) & F.col("_b.__end").isNull(), "invalid_time": F.col("time").isNull() | (F.col("time") < 0), "invalid_basis": ~F.col("basis").isin("original", "padded"),
    }
    listed = F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in reasons.items())), lambda r: r.isNotNull())
    made = counted.withColumn("reasons", listed).withColumn("nominal_time", F.when(F.size("reasons") == 0, nominal)).withColumn("padded_time", F.when(F.size("reasons") == 0, F.col("time") + F.when(F.col("basis") == "original", padding).otherwise(0.0))).withColumn("measure", F.col("_b._measure")).drop("_b")
    order = Window.partitionBy(*keys).orderBy("nominal_time")
    falls = (F.col("nominal_time") <= F.lag("nominal_time").over(order)) | (F.col("padded_time") <= F.lag("padded_time").over(order))
    return made.withColumn("rises", ~F.coalesce(falls, F.lit(False)))


def assess_manual(anchors: DataFrame, bars: DataFrame, keys: list[str], padding: float = 0.0, radius: int = 2) -> DataFrame:
    """Residual of each anchor against its baseline, the bar nearby that fits best, warnings and a confidence band.

    Anchors: id, measure, padded_time, expected, basis; bars: measure, expected.
    """
    near = joins.members_of(anchors.withColumn("_lo", F.col("measure") - radius).withColumn("_hi", F.col("measure") + radius), bars.select(*keys, F.col("measure").alias("near_measure"), F.col("expected").alias("_e")), keys, "_lo", "_hi", "near_measure", 8.0, closed=True)
    off = F.abs(F.col("padded_time") - F.col("_e"))
    best = near.groupBy(*keys, "id").agg(F.min(F.struct(off.alias("d"), "near_measure")).alias("_b"))
    residual = F.col("padded_time") - F.col("expected")
    other = residual + F.when(F.col("basis") == "padded", float(padding)).otherwise(-float(padding))
    warnings = F.filter(F.array(F.when((F.col("_b.near_measure") != F.col("measure")) & (F.col("_b.d") + 0.1 < F.abs(residual)), F.lit("nearby_bar_fits_better")), F.when(F.abs(other) + 0.1 < F.abs(residual), F.lit("possible_time_basis_error"))), lambda w: w.isNotNull())
    band = F.when(F.abs(residual) <= 0.1, "high").when(F.abs(residual) <= 0.25, "moderate").when(F.abs(residual) <= 0.6, "warning").otherwise("suspicious")
    return anchors.join(best, [*keys, "id"], "left").withColumn("residual", residual).withColumn("best_measure", F.col("_b.near_measure")).withColumn("warnings", warnings).withColumn("confidence", band).drop("_b")


def piecewise_correction(t: Column, controls: Column) -> Column:
    """Value at t of a short array of (x, y) structs: linear between, the end's y outside, 0 without controls."""
    c = F.array_sort(controls)
    last = F.element_at(F.filter(c, lambda p: p["x"] <= t), -1)
    first = F.get(F.filter(c, lambda p: p["x"] > t), F.lit(0))
    line = last["y"] + (t - last["x"]) / (first["x"] - last["x"]) * (first["y"] - last["y"])
    some = F.size(c) > 0
    return F.when(some & F.exists(c, lambda p: p["x"] <= t) & F.exists(c, lambda p: p["x"] > t), line).when(some & F.exists(c, lambda p: p["x"] <= t), last["y"]).when(some, first["y"]).otherwise(0.0)


def full_mapping(downbeats: DataFrame, base: str, correction: Column) -> DataFrame:
    """Downbeats with the correction in milliseconds and the proposed time."""
    return downbeats.withColumn("correction_ms", correction).withColumn("proposed_time", F.col(base) + F.col("correction_ms") / 1000.0)


def proposal_map(mapped: DataFrame, keys: list[str], base: str, proposed: str = "proposed_time") -> DataFrame:
    """Controls of a proposal's mapping, and ``strict``: whether both clocks rise all along."""
    by = Window.partitionBy(*keys).orderBy(base)
    rises = (F.col(base) > F.lag(base).over(by)) & (F.col(proposed) > F.lag(proposed).over(by))
    made = mapped.select(*keys, F.col(base).alias("x"), F.col(proposed).alias("y"), F.coalesce(rises, F.lit(True)).alias("_r"))
    return made.withColumn("strict", F.min("_r").over(Window.partitionBy(*keys))).drop("_r")


def step_map(base: Column, last: Column, shift: Column, edge: float = 0.001) -> Column:
    """Controls (x, y) of a displacement that begins at ``base`` and stays."""
    early = F.greatest(F.lit(0.0), base - edge)
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(point(F.lit(0.0), F.lit(0.0)), point(early, early), point(base, base + shift), point(last + 60, last + 60 + shift))


def resampled(rows: DataFrame, grid: DataFrame, keys: list[str], time: str, value: str, out: str) -> DataFrame:
    """Values at the grid's times, linear between samples and 0 outside them."""
    found = map_times(grid, rows.select(*keys, F.col(time).alias("x"), F.col(value).alias("y")), keys, time, out, "clamp", "clamp")
    ends = rows.groupBy(*keys).agg(F.min(time).alias("_a"), F.max(time).alias("_z"))
    return found.join(ends, keys, "left").withColumn(out, F.when(F.col(time).between(F.col("_a"), F.col("_z")), F.col(out)).otherwise(0.0)).drop("_a", "_z")


def transition_stretches(start: Column, end: Column, base_at, start_offset: Column, end_offset: Column, samples: int = 12) -> Column:
    """Slopes of a baseline (a column function of time) plus an offset that goes from one value to another, over equal steps."""
    points = F.transform(F.sequence(F.lit(0), F.lit(samples)), lambda i: base_at(start + (end - start) * i / samples) + start_offset + (end_offset - start_offset) * i / samples)
    return F.when(end > start, F.transform(F.sequence(F.lit(1), F.lit(samples)), lambda i: (F.get(points, i) - F.get(points, i - 1)) * samples / (end - start)))


def checkpoint_map(candidates: DataFrame, ends: DataFrame, keys: list[str], gap: float = 0.5, least_ms: float = 10.0, share: float = 0.5, most_ms: float = 50.0, fewest: int = 3, slopes: tuple[float, float] = (0.98, 1.02)) -> DataFrame:
    """Residual controls from checkpoint evidence, conservative: every merged region is returned with what became of it.

    Candidates: nominal, residual_ms, kind (onset, silence, chroma), quality, strong (of an onset). ``ends``: first and last time of the
    key. Regions merge where a candidate follows the one before within ``gap``. Tier A has two kinds within 50 ms, B silence or a strong
    onset. Accepted regions get a share of their weighted residual; of a pair whose slope (baseline of slope one) leaves ``slopes`` the weaker is dropped, and a key
    with fewer than ``fewest`` left has status ``fallback``. Keys hold as many rows as checkpoints of a song.
    """
    by = Window.partitionBy(*keys).orderBy("nominal", "kind", "residual_ms")
    new = F.coalesce((F.col("nominal") - F.lag("nominal").over(by) > gap).cast("int"), F.lit(1))
    numbered = candidates.withColumn("_n", new).withColumn("region", F.sum("_n").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy(*keys, "region").agg(
        F.median("nominal").alias("nominal"), F.array_sort(F.collect_set("kind")).alias("kinds"), (F.max("residual_ms") - F.min("residual_ms")).alias("spread_ms"),
        (F.sum(F.col("residual_ms") * F.col("quality")) / F.sum("quality")).alias("measured_ms"), F.max(F.coalesce("strong", F.lit(False)) & (F.col("kind") == "onset")).alias("_strong"),
    )
    tier = F.when((F.size("kinds") >= 2) & (F.col("spread_ms") <= 50), "A").when(F.array_contains("kinds", "silence") | F.col("_strong"), "B").otherwise("C")
    placed = merged.withColumn("tier", tier).join(ends, keys)
    reasons = {"disagreement": F.col("spread_ms") > 50, "negligible": F.abs("measured_ms") < least_ms, "exterior": (F.col("nominal") <= F.col("first") + 1e-6) | (F.col("nominal") >= F.col("last") - 1e-6), "diagnostic_tier": F.col("tier") == "C"}
    listed = F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in reasons.items())), lambda r: r.isNotNull())
    judged = placed.withColumn("reasons", listed).withColumn("applied_ms", F.when(F.size("reasons") == 0, F.greatest(F.lit(-most_ms), F.least(F.lit(most_ms), F.col("measured_ms") * share)))).drop("_strong")

    def kernel(g: pd.DataFrame) -> dict:
        alive = np.flatnonzero(g["applied_ms"].notna().to_numpy())
        enough = len(alive) >= fewest
        while enough and len(alive):
            x = np.concatenate(([g["first"].iat[0]], g["nominal"].to_numpy(float)[alive], [g["last"].iat[0]]))
            r = np.concatenate(([0.0], g["applied_ms"].to_numpy(float)[alive], [0.0])) / 1000
            with np.errstate(divide="ignore", invalid="ignore"):
                slope = 1 + np.diff(r) / np.diff(x)
            bad = np.flatnonzero(~((slope >= slopes[0]) & (slope <= slopes[1])))
            if not len(bad):
                break
            pair = [i for i in (bad[0] - 1, bad[0]) if 0 <= i < len(alive)]
            weaker = min(pair, key=lambda i: (g["tier"].iat[alive[i]] != "B", abs(g["applied_ms"].iat[alive[i]])))
            alive = np.delete(alive, weaker)
            enough = len(alive) >= fewest
        kept = np.isin(np.arange(len(g)), alive) & enough
        return {"region": g["region"], "x": g["nominal"], "r": np.where(kept, g["applied_ms"].to_numpy(float) / 1000, np.nan), "tier": g["tier"], "kept": kept, "reasons": g["reasons"].map(list), "status": "applied" if enough else "fallback"}

    return per_group(judged, keys, ["region"], kernel, "region bigint, x double, r double, tier string, kept boolean, reasons array<string>, status string")


def smoothed_residuals(bars: DataFrame, keys: list[str], order: str, raw: str, confidence: str, half: int = 2, most: float = 2.0, step: float = 0.12) -> DataFrame:
    """Adds ``fitted``: the weighted median residual of each bar and ``half`` bars around, gaps interpolated, jumps limited both ways.

    A key holds a song's bars. Bars with a null residual or no confidence take part only by their place.
    """

    def kernel(g: pd.DataFrame) -> dict:
        v, w = g[raw].to_numpy(float), np.nan_to_num(g[confidence].to_numpy(float))
        n, known = len(g), np.isfinite(v) & (w > 0)
        out = np.full(n, np.nan)
        for i in np.flatnonzero(np.convolve(known, np.ones(2 * half + 1), "same") > 0):
            near = np.arange(max(0, i - half), min(n, i + half + 1))
            near = near[known[near]]
            near = near[np.argsort(v[near], kind="stable")]
            run = np.cumsum(w[near])
            out[i] = v[near[np.searchsorted(run, run[-1] / 2)]]
        have = np.isfinite(out)
        line = np.clip(np.interp(np.arange(n), np.flatnonzero(have), out[have]), -most, most) if have.any() else np.zeros(n)
        for way in (1, -1):
            run = line[::way]
            for i in range(1, n):
                run[i] = min(max(run[i], run[i - 1] - step), run[i - 1] + step)
        return {order: g[order], "fitted": line}

    kind = dict(bars.dtypes)[order]
    return bars.join(per_group(bars, keys, [order], kernel, f"{order} {kind}, fitted double"), [*keys, order])


def bar_map(bars: DataFrame, keys: list[str], order: str, time: str, base: str, raw: str, confidence: str, stretch: tuple[float, float] = (0.9, 1.1), fewest: int = 4, **smoothing) -> DataFrame:
    """Controls from per-bar residuals: smoothed, each step's stretch against the baseline clamped; too few observed bars keep the baseline."""
    fitted = smoothed_residuals(bars, keys, order, raw, confidence, **smoothing)

    def kernel(g: pd.DataFrame) -> dict:
        b = g[base].to_numpy(float)
        y = b + g["fitted"].to_numpy(float)
        for i in range(1, len(y)):
            step = b[i] - b[i - 1]
            y[i] = min(max(y[i], y[i - 1] + stretch[0] * step), y[i - 1] + stretch[1] * step)
        enough = int((g[raw].notna() & (g[confidence] > 0)).sum()) >= fewest
        return {"x": g[time], "y": y if enough else b, "applied": enough}

    return per_group(fitted, keys, [order], kernel, "x double, y double, applied boolean")
