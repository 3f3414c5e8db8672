"""Grouping in time: chains, head-anchored groups, merged intervals, gaps, runs and spacing.

Rows with a null time belong to no group and are left out. Rows at equal
times are ordered by the given columns; where none are given their order is
free, which no result here depends on.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.operators import dealt, joins, tempo
from timeloom.operators.sequence import per_group, per_groups

ISLANDS = 256  # islands of one key that a kernel call takes together


def chain_groups(rows: DataFrame, keys: list[str], time: str, tolerance: float, order: list[str] | None = None, width: float | None = None) -> DataFrame:
    """Adds ``group_no``: a new group starts where a row is more than ``tolerance`` after the one before.

    With ``width`` a key is dealt out in stretches of that much time; a table
    of one row a stretch carries the last time and the number of groups on.
    """
    timed = rows.where(F.col(time).isNotNull())
    if not width:
        by = Window.partitionBy(*keys).orderBy(time, *(order or []))
        starts = F.coalesce((F.col(time) - F.lag(time).over(by) > tolerance).cast("int"), F.lit(1))
        return timed.withColumn("_starts", starts).withColumn("group_no", F.sum("_starts").over(by)).drop("_starts")
    dealt = timed.withColumn("_stretch", F.floor(F.col(time) / width).cast("long"))
    by = Window.partitionBy(*keys, "_stretch").orderBy(time, *(order or []))
    own = dealt.withColumn("_gap", F.col(time) - F.lag(time).over(by)).withColumn("_new", F.coalesce((F.col("_gap") > tolerance).cast("int"), F.lit(0)))
    ends = own.groupBy(*keys, "_stretch").agg(F.min(time).alias("_a"), F.max(time).alias("_z"), F.sum("_new").alias("_n"))
    along = Window.partitionBy(*keys).orderBy("_stretch")
    opens = F.coalesce((F.col("_a") - F.lag("_z").over(along) > tolerance).cast("int"), F.lit(1))
    carried = ends.withColumn("_opens", opens)
    before = F.sum(F.col("_n") + F.col("_opens")).over(along) - F.col("_n")
    carried = carried.select(*keys, "_stretch", before.alias("_before"))
    numbered = own.withColumn("_run", F.sum("_new").over(by))
    return numbered.join(carried, [*keys, "_stretch"]).withColumn("group_no", F.col("_before") + F.col("_run")).drop("_stretch", "_gap", "_new", "_run", "_before")


def _heads(t: np.ndarray, tolerance: float) -> np.ndarray:
    """Index of the head of each of the sorted times."""
    out, at = np.zeros(len(t), np.int64), 0
    while at < len(t):
        end = int(np.searchsorted(t, t[at] + tolerance, side="right"))
        out[at : max(end, at + 1)] = at
        at = max(end, at + 1)
    return out


def heads(t: np.ndarray, tolerance: float) -> np.ndarray:
    """Index of the head of each of the sorted times of one key; a gap wider than the tolerance ends every group."""
    edges = np.append(np.flatnonzero(np.concatenate((np.ones(min(1, len(t)), bool), np.diff(t) > tolerance))), len(t))
    head = np.repeat(edges[:-1], np.diff(edges))
    for k in np.flatnonzero(~(t[edges[1:] - 1] <= t[edges[:-1]] + tolerance)):  # the others are one group each
        a, b = edges[k], edges[k + 1]
        head[a:b] = a + _heads(t[a:b], tolerance)
    return head


def _head_times(rows: DataFrame, keys: list[str], time: str, tolerance: float, width: float | None) -> DataFrame:
    """(keys, time, n, head) of every distinct time.

    A gap wider than the tolerance ends every group, so chains are grouped
    one by one; only inside an unbroken chain does order matter. With
    ``width`` also an unbroken chain is dealt out, in stretches of that much time.
    """
    kind = dict(rows.dtypes)[time]
    counted = rows.where(F.col(time).isNotNull()).groupBy(*keys, time).agg(F.count("*").alias("n"))
    if width:
        return dealt.head_times(counted, keys, time, tolerance, width)
    chained = chain_groups(counted, keys, time, tolerance).withColumn("_part", F.expr(f"group_no div {ISLANDS}"))

    def kernel(g: pd.DataFrame, starts: np.ndarray) -> tuple[np.ndarray, dict]:
        t, chain = g[time].to_numpy(), g["group_no"].to_numpy()
        new = np.concatenate(([True], chain[1:] != chain[:-1]))
        new[starts] = True
        edges = np.append(np.flatnonzero(new), len(t))
        head = np.repeat(edges[:-1], np.diff(edges))
        for k in np.flatnonzero(~(t[edges[1:] - 1] <= t[edges[:-1]] + tolerance)):  # the others are one group each
            a, b = edges[k], edges[k + 1]
            head[a:b] = a + _heads(t[a:b], tolerance)
        return np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(t)))), {"time": t, "n": g["n"].to_numpy(), "head": t[head]}

    return per_groups(chained, [*keys, "_part"], [time], kernel, f"time {kind}, n bigint, head {kind}").drop("_part")


def head_anchored(rows: DataFrame, keys: list[str], time: str, tolerance: float, width: float | None = None) -> DataFrame:
    """Adds ``head``, the time of the first row of the group: a group takes what lies within ``tolerance`` of its first row."""
    found = _head_times(rows, keys, time, tolerance, width).select(*keys, F.col("time").alias(time), "head")
    return rows.drop("head").join(found, [*keys, time])


def head_groups(rows: DataFrame, keys: list[str], time: str, tolerance: float, width: float | None = None) -> DataFrame:
    """One row per head-anchored group: start, stop and n."""
    found = _head_times(rows, keys, time, tolerance, width)
    return found.groupBy(*keys, F.col("head").alias("start")).agg(F.max("time").alias("stop"), F.sum("n").alias("n"))


def onset_groups(rows: DataFrame, keys: list[str], time: str, symbols: str, tolerance: float, labels: list[str] | None = None, width: float | None = None) -> DataFrame:
    """(keys, time, symbols, members, labels...): head-anchored groups with their sorted distinct symbols.

    ``symbols`` is an array column; rows without any are skipped. ``labels`` are gathered as sorted sets too.
    """
    heard = head_anchored(rows.where(F.size(symbols) > 0), keys, time, tolerance, width)
    gathered = [F.array_sort(F.array_distinct(F.flatten(F.collect_set(symbols)))).alias("symbols"), F.count("*").alias("members")]
    return heard.groupBy(*keys, F.col("head").alias("time")).agg(*gathered, *(F.array_sort(F.collect_set(x)).alias(x) for x in labels or []))


def between(points: DataFrame, edges: DataFrame, keys: list[str], time: str) -> DataFrame:
    """(keys, start, stop) of the intervals between neighbouring points, the key's edges (start, stop) included."""
    sides = edges.select(*keys, F.explode(F.array("start", "stop")).alias(time))
    by = Window.partitionBy(*keys).orderBy(time)
    whole = points.select(*keys, F.col(time).cast(dict(sides.dtypes)[time])).unionByName(sides)
    return whole.withColumn("stop", F.lead(time).over(by)).where(F.col("stop") > F.col(time)).select(*keys, F.col(time).alias("start"), "stop")


def merge_intervals(rows: DataFrame, keys: list[str], start: str, end: str, tolerance: float = 0) -> DataFrame:
    """Intervals of each key joined where one starts no later than ``tolerance`` after all before have ended.

    An interval with a null end lasts no time.
    """
    spans = rows.where(F.col(start).isNotNull()).withColumn(end, F.greatest(F.col(start), F.col(end)))
    by = Window.partitionBy(*keys).orderBy(start, end)
    reached = F.max(end).over(by.rowsBetween(Window.unboundedPreceding, -1))
    flagged = spans.withColumn("_starts", F.coalesce((F.col(start) > reached + tolerance).cast("int"), F.lit(1)))
    numbered = flagged.withColumn("region_no", F.sum("_starts").over(by))
    return numbered.groupBy(*keys, "region_no").agg(F.min(start).alias("start"), F.max(end).alias("stop"), F.count("*").alias("n"))


def coverage_gaps(rows: DataFrame, keys: list[str], bucket: str, long: int | None = None) -> DataFrame:
    """Runs of integer buckets that a key skips between those it has; with ``long`` also ``long_gap``: whether one has at least that many."""
    have = rows.select(*keys, bucket).where(F.col(bucket).isNotNull()).distinct()
    after = F.lead(bucket).over(Window.partitionBy(*keys).orderBy(bucket))
    gaps = have.withColumn("_next", after).where(F.col("_next") > F.col(bucket) + 1)
    made = gaps.select(*keys, (F.col(bucket) + 1).alias("first"), (F.col("_next") - 1).alias("last"), (F.col("_next") - F.col(bucket) - 1).alias("n"))
    return made if long is None else made.withColumn("long_gap", F.col("n") >= long)


def runs(rows: DataFrame, keys: list[str], order: list[str], value: Column) -> DataFrame:
    """Adds ``run_no``: counts the stretches of equal values, and ``occurrence``: how often the value has come."""
    by = Window.partitionBy(*keys).orderBy(*order)
    valued = rows.withColumn("_v", value)
    marked = valued.withColumn("_starts", F.coalesce((~F.col("_v").eqNullSafe(F.lag("_v").over(by))).cast("int"), F.lit(1)))
    first = F.row_number().over(by) == 1
    marked = marked.withColumn("_starts", F.when(first, 1).otherwise(F.col("_starts"))).withColumn("run_no", F.sum("_starts").over(by))
    return marked.withColumn("occurrence", F.row_number().over(Window.partitionBy(*keys, "_v").orderBy(*order))).drop("_v", "_starts")


def playback_segments(visits: DataFrame, keys: list[str], order: str, source: str, explicit: str | None = None) -> DataFrame:
    """Adds ``segment`` (a new one where the source bar is not the next; given ids win) and ``occurrence`` of the source bar."""
    by = Window.partitionBy(*keys).orderBy(order)
    jump = F.coalesce((F.col(source) != F.lag(source).over(by) + 1).cast("int"), F.lit(0))
    given = F.lit(None).cast("long") if explicit is None else F.col(explicit).cast("long")
    marked = visits.withColumn("_g", given).withColumn("_jump", F.when(F.col("_g").isNull(), jump).otherwise(0))
    up_to = by.rowsBetween(Window.unboundedPreceding, 0)
    marked = marked.withColumn("_base", F.last("_g", ignorenulls=True).over(up_to)).withColumn("_no", F.count("_g").over(up_to))
    since = F.sum("_jump").over(Window.partitionBy(*keys, "_no").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    seen = F.row_number().over(Window.partitionBy(*keys, source).orderBy(order))
    return marked.withColumn("segment", F.coalesce("_base", F.lit(0)) + since).withColumn("occurrence", seen).drop("_g", "_jump", "_base", "_no")


def entrances(regions: DataFrame, bars: DataFrame, keys: list[str], fraction: float = 1.0, fallback: float = 2.0) -> DataFrame:
    """First sounding region of each key, and those after a silence as long as ``fraction`` of the local measure.

    ``regions`` as of ``merge_intervals``; ``bars`` (keys, start, duration) in the same unit, ``fallback`` where there are none.
    """
    by = Window.partitionBy(*keys).orderBy("start")
    quiet = regions.withColumn("silence", F.col("start") - F.lag("stop").over(by)).withColumn("_first", F.row_number().over(by) == 1)
    placed = tempo.measure_at(quiet.withColumnRenamed("start", "_t"), bars, keys, "_t", ["duration"]).withColumnRenamed("_t", "start")
    needed = F.coalesce(F.col("duration") * fraction, F.lit(float(fallback)))
    kept = placed.withColumn("required", needed).where(F.col("_first") | (F.col("silence") + 1e-9 >= F.col("required")))
    return kept.withColumn("kind", F.when(F.col("_first"), "entrance").otherwise("restart_after_silence")).drop("_first", "duration")


def dense_landmarks(onsets: DataFrame, bars: DataFrame, keys: list[str], time: str, stride: int = 2, fewest: int = 2, spacing: float = 1.0, least: float = 0.38, most: int = 96) -> DataFrame:
    """Measures worth listening to: (keys, measure, time, n, confidence) of every ``stride``-th with enough distinct onsets.

    Confidence weighs density, nearness to the downbeat, the gap before and how rare the measure's rhythm is in the key. Landmarks keep
    ``spacing`` from the last kept; at most ``most`` a key, the earliest, as the reference operator has it. ``bars``: measure, index, start, end, duration.
    """
    times = onsets.select(*keys, F.col(time).alias("_t")).distinct()
    by = Window.partitionBy(*keys).orderBy("_t")
    times = times.withColumn("_gap", F.col("_t") - F.lag("_t").over(by))
    inside = joins.members_of(bars.select(*keys, "measure", "index", "start", "end", "duration"), times, keys, "start", "end", "_t", 16.0)
    part = F.rint((F.col("_t") - F.col("start")) / F.col("duration") * 8) / 8
    local = inside.groupBy(*keys, "measure", "index", "start", "duration").agg(F.count("*").alias("n"), F.min("_t").alias("time"), F.min_by("_gap", "_t").alias("_gap"), F.slice(F.transform(F.array_sort(F.collect_list(F.struct("_t", part.alias("p")))), lambda s: s["p"]), 1, 8).alias("_rhythm"))
    rare = F.count("*").over(Window.partitionBy(*keys, F.least("n", F.lit(8)), "_rhythm"))
    down = F.greatest(F.lit(0.0), 1.0 - (F.col("time") - F.col("start")) / (F.col("duration") * 0.35))
    gap = F.least(F.lit(1.0), F.coalesce(F.col("_gap"), F.lit(0.0)) / (F.col("duration") * 0.25))
    scored = local.withColumn("confidence", F.least(F.lit(1.0), F.col("n") / 6.0) * 0.35 + down * 0.25 + gap * 0.20 + 1.0 / rare * 0.20)
    eligible = scored.where((F.col("index") % max(1, stride) == 0) & (F.col("n") >= max(1, fewest)) & (F.col("confidence") >= least)).select(*keys, "measure", "time", "n", "confidence")
    kept = spaced(eligible, keys, "time", spacing, keep_last=False)
    return kept.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy("time"))).where(F.col("_r") <= most).drop("_r")


def spaced(rows: DataFrame, keys: list[str], time: str, spacing: float, keep_last: bool = True, order: list[str] | None = None) -> DataFrame:
    """The first row of each key and then each that is at least ``spacing`` after the last kept; also the last row if asked for.

    Of rows at one time the first by ``order`` counts. A key should hold a bounded number of rows.
    """
    kind = dict(rows.dtypes)[time]
    times = rows.where(F.col(time).isNotNull()).select(*keys, F.col(time)).distinct()

    def kernel(g: pd.DataFrame) -> dict:
        t = g[time].to_numpy()
        kept, at = [], 0
        while at < len(t):
            kept.append(at)
            at = max(at + 1, int(np.searchsorted(t, t[at] + spacing, side="left")))
        if keep_last and kept[-1] != len(t) - 1:
            kept.append(len(t) - 1)
        return {time: t[kept]}

    chosen = per_group(times, keys, [time], kernel, f"{time} {kind}")
    first = F.row_number().over(Window.partitionBy(*keys, time).orderBy(*(order or [time])))
    return rows.join(chosen, [*keys, time]).withColumn("_r", first).where("_r = 1").drop("_r")


def boundaries(points: DataFrame, ends: DataFrame, keys: list[str], time: str, apart: float = 2.0) -> DataFrame:
    """Distinct points in [0, end], those less than ``apart`` after the last kept left out; 0 and the end always stay."""
    inside = points.select(*keys, F.col(time).cast("double").alias(time)).unionByName(ends.select(*keys, F.lit(0.0).alias(time))).join(ends.select(*keys, F.col("end").cast("double").alias("_e")), keys)
    thinned = spaced(inside.where((F.col(time) >= 0) & (F.col(time) <= F.col("_e"))).dropDuplicates([*keys, time]), keys, time, apart, keep_last=False)
    return thinned.select(*keys, time).unionByName(ends.select(*keys, F.col("end").cast("double").alias(time))).distinct()


def merge_sections(rows: DataFrame, keys: list[str], start: str, end: str, same: list[str], confidence: str, longest: float = 40.0) -> DataFrame:
    """Neighbouring sections equal in ``same`` as one, up to ``longest``; its confidence is averaged pairwise in order. A key holds a song's sections."""
    kinds = dict(rows.dtypes)

    def kernel(g: pd.DataFrame) -> dict:
        labels = list(zip(*(g[c] for c in same), strict=True))
        out: list[list] = []
        for a, z, label, c in zip(g[start], g[end], labels, g[confidence], strict=True):
            if out and out[-1][2] == label and z - out[-1][0] <= longest:
                out[-1][1], out[-1][3], out[-1][4] = z, (out[-1][3] + c) / 2, out[-1][4] + 1
            else:
                out.append([a, z, label, c, 1])
        return {start: [o[0] for o in out], end: [o[1] for o in out], confidence: [o[3] for o in out], "n": [o[4] for o in out]} | {c: [o[2][i] for o in out] for i, c in enumerate(same)}

    return per_group(rows, keys, [start], kernel, ", ".join([f"{start} {kinds[start]}", f"{end} {kinds[end]}", f"{confidence} double", "n bigint", *(f"{c} {kinds[c]}" for c in same)]))


def catch_ups(edges: DataFrame, keys: list[str], index: str, stretch: str, least: float = 0.06) -> DataFrame:
    """Neighbouring edges that leave one in opposite directions by at least ``least`` each: first and second index and stretch."""
    by = Window.partitionBy(*keys).orderBy(index)
    both = edges.select(*keys, F.col(index).alias("first_edge"), F.lead(index).over(by).alias("second_edge"), F.col(stretch).alias("first_stretch"), F.lead(stretch).over(by).alias("second_stretch"))
    a, b = F.col("first_stretch") - 1, F.col("second_stretch") - 1
    return both.where((a * b < 0) & (F.abs(a) >= least) & (F.abs(b) >= least))


def episodes(events: DataFrame, keys: list[str]) -> DataFrame:
    """Catch-ups that share an edge, as one: first and last edge and the number of pairs."""
    return merge_intervals(events, keys, "first_edge", "second_edge").select(*keys, (F.col("region_no") - 1).alias("episode"), F.col("start").alias("first_edge"), F.col("stop").alias("last_edge"), F.col("n").alias("pairs"))


def fragments(controls: DataFrame, keys: list[str], order: str, accepted: str, fewest: int = 2) -> DataFrame:
    """Adds ``fragment``: a region is cut after each control whose edge to the next is not accepted; ``short`` marks those of fewer controls."""
    by = Window.partitionBy(*keys).orderBy(order)
    cut = F.sum(F.when(F.col(accepted), 0).otherwise(1)).over(by.rowsBetween(Window.unboundedPreceding, -1))
    placed = controls.withColumn("fragment", F.coalesce(cut, F.lit(0)))
    return placed.withColumn("short", F.count("*").over(Window.partitionBy(*keys, "fragment")) < fewest)


def knots(spans: DataFrame, keys: list[str], start: str, end: str, apart: float = 1e-6) -> DataFrame:
    """Start, middle and end of all spans, each once."""
    points = spans.select(*keys, F.explode(F.array(F.col(start), (F.col(start) + F.col(end)) / 2.0, F.col(end))).alias("time"))
    return head_groups(points, keys, "time", apart).select(*keys, F.col("start").alias("time"))


def landmarks(onsets: DataFrame, bars: DataFrame, keys: list[str], role: str, time: str, fraction: float = 0.4, near: float = 0.06) -> DataFrame:
    """Each bar's first onset within its opening part, the roles that sound with it, or the bar's start where none does.

    ``bars``: measure, start, end (keys too).
    """
    limited = bars.withColumn("_a", F.col("start") - 1e-6).withColumn("_z", F.col("start") + (F.col("end") - F.col("start")) * fraction)
    inside = joins.members_of(limited, onsets.select(*keys, F.col(role).alias("_role"), F.col(time).alias("_t")), keys, "_a", "_z", "_t", 8.0)
    first = inside.groupBy(*keys, "measure", "_role").agg(F.min("_t").alias("_t"))
    earliest = F.min("_t").over(Window.partitionBy(*keys, "measure"))
    joined = first.withColumn("_e", earliest).groupBy(*keys, "measure").agg(F.first("_e").alias("_e"), F.array_sort(F.collect_set(F.when(F.abs(F.col("_t") - F.col("_e")) <= near, F.col("_role")))).alias("_roles"))
    out = bars.join(joined, [*keys, "measure"], "left")
    return out.withColumn("landmark", F.coalesce("_e", F.col("start"))).withColumn("roles", F.coalesce("_roles", F.array().cast("array<string>"))).withColumn("kind", F.when(F.col("_e").isNull(), "bar_boundary").otherwise("first_event")).drop("_e", "_roles")


def control_grid(points: DataFrame, bars: DataFrame, keys: list[str], time: str, measure: str, tier: str, near: float = 0.05, most: int = 8) -> DataFrame:
    """Boundaries for piecewise work: points closer than ``near`` merged (tier A wins), stretches over ``most`` measures split at measures.

    Points: time, measure, tier; bars: measure, start. Split points have the tier ``computational``. A stretch is split only as far as its measures are known.
    """
    grouped = head_anchored(points, keys, time, near)
    best = grouped.groupBy(*keys, "head").agg(F.min_by(measure, time).alias(measure), F.coalesce(F.max(F.when(F.col(tier) == "A", "A")), F.min_by(tier, time)).alias(tier)).withColumnRenamed("head", time)
    by = Window.partitionBy(*keys).orderBy(time)
    led = best.withColumn("_next", F.lead(measure).over(by))
    steps = F.floor((F.col("_next") - F.col(measure) - 1) / most).cast("int")
    wanted = led.where(steps >= 1).select(*keys, F.col(measure).alias("_from"), F.posexplode(F.transform(F.sequence(F.lit(1), steps), lambda i: F.col(measure) + i * most)).alias("_i", measure))
    found = wanted.join(bars.select(*keys, F.col("measure").alias(measure), F.col("start").alias(time)), [*keys, measure], "left")
    run = Window.partitionBy(*keys, "_from").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    split = found.withColumn("_ok", F.min(F.col(time).isNotNull()).over(run)).where("_ok").select(*keys, time, measure, F.lit("computational").alias(tier))
    return best.select(*keys, time, measure, tier).unionByName(split)


def silence_checkpoints(gaps: DataFrame, keys: list[str], role: str, beat: float, drums: str = "drums", longest: float = 1.0, near: float = 0.5) -> DataFrame:
    """Shared silences: gaps of the drums over ``longest``, and what two other roles' gaps share over a beat; ends within ``near`` are one.

    ``gaps``: role, start, stop. Returns start, stop and the roles of each.
    """
    own = gaps.where((F.col(role) == drums) & (F.col("stop") - F.col("start") > longest)).select(*keys, "start", "stop", F.array(role).alias("roles"))
    rest = gaps.where(F.col(role) != drums).select(*keys, F.col(role).alias("_r"), "start", "stop")
    other = rest.select(*keys, F.col("_r").alias("_q"), F.col("start").alias("_a"), F.col("stop").alias("_z"))
    met = joins.overlapping(rest, other, keys, ("start", "stop"), ("_a", "_z"), max(4.0, 4 * beat)).where("_r < _q")
    shared = met.select(*keys, F.greatest("start", "_a").alias("start"), F.least("stop", "_z").alias("stop"), F.array("_r", "_q").alias("roles")).where(F.col("stop") - F.col("start") > beat)
    grouped = head_anchored(own.unionByName(shared), keys, "stop", near)
    return grouped.groupBy(*keys, F.col("head").alias("stop")).agg(F.min("start").alias("start"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("roles")))).alias("roles"))
