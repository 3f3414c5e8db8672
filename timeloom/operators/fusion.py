"""Agreement of several sources: clusters of predictions, hypotheses, support, authority.

Keys are a song, or a song and measure; a key holds a bounded number of rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from statistics import median

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.functions import robust, vectors
from timeloom.operators import islands, joins
from timeloom.operators.sequence import per_group, starts_of


def score_clusters(matches: DataFrame, keys: list[str], time: str, source: str, tolerance: float = 0.15) -> DataFrame:
    """Chains of matches in score time: number, median time, sorted sources and size."""
    chained = islands.chain_groups(matches, keys, time, tolerance, [source])
    return chained.groupBy(*keys, "group_no").agg(F.median(time).alias("time"), F.array_sort(F.collect_set(source)).alias("sources"), F.count("*").alias("n"))


def candidate_states(observations: DataFrame, keys: list[str], radius: float, tolerance: float = 0.18, most: int = 8, stem_bonus: float = 0.18, source_bonus: float = 0.08, source_bonus_most: float = 0.24, single_bonus: float = 0.12, residual_penalty: float = 0.15) -> DataFrame:
    """States of each cluster (keys): chains of observed times, the most confident observation per source, scored.

    Observations: time, source, evidence, confidence, residual, single (boolean). A state keeps median time and residual, mean
    confidence and the emission score: confidence, bonuses for evidence from the source's own stem, for more sources and for a single
    sufficient stem, less the residual's share of the radius. The best ``most`` states of a cluster stay, as the operator has it.
    """
    chained = islands.chain_groups(observations, keys, "time", tolerance, ["source"])
    top = Window.partitionBy(*keys, "group_no", "source").orderBy(F.desc("confidence"), "time")
    used = chained.withColumn("_r", F.row_number().over(top)).where("_r = 1")
    made = used.groupBy(*keys, "group_no").agg(
        F.median("time").alias("audio_time"), F.avg("confidence").alias("confidence"), F.median("residual").alias("residual"), F.count("*").alias("n_sources"),
        F.count_if(F.col("evidence") == F.col("source")).alias("_own"), F.max(F.coalesce("single", F.lit(False))).alias("single"), F.array_sort(F.collect_set("source")).alias("sources"),
    )
    more = F.least(F.lit(source_bonus_most), (F.col("n_sources") - 1) * source_bonus)
    emission = F.col("confidence") + F.col("_own") * stem_bonus + more + F.when(F.col("single"), single_bonus).otherwise(0.0) - F.abs("residual") / max(radius, 1e-9) * residual_penalty
    ranked = made.withColumn("emission", emission).withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("emission"), F.abs("residual"), "audio_time")))
    return ranked.where(F.col("rank") <= most).drop("_own", "group_no")


def fused_predictions(predictions: DataFrame, keys: list[str], time: str, role: str, weight: str, tolerance: float = 0.25, strong_spread: float = 0.10, bonus: float = 0.30, single_penalty: float = 0.10, spread_penalty: float = 1.2) -> DataFrame:
    """Chains of predicted times per chart time (keys): the heaviest of each role, their weighted mean, spread, confidence and class.

    ``strong`` (boolean) says that a prediction comes of a well-covered streak. Incompatible predictions stay in clusters of their own.
    """
    chained = islands.chain_groups(predictions, keys, time, tolerance, [role])
    top = Window.partitionBy(*keys, "group_no", role).orderBy(F.desc(weight), time)
    rows = chained.withColumn("_r", F.row_number().over(top)).where("_r = 1")
    made = rows.groupBy(*keys, "group_no").agg((F.sum(F.col(time) * F.col(weight)) / F.sum(weight)).alias("fused_time"), (F.max(time) - F.min(time)).alias("spread"), F.count("*").alias("role_count"), F.array_sort(F.collect_set(role)).alias("roles"), F.avg(weight).alias("_w"), F.max(F.coalesce("strong", F.lit(False))).alias("_strong"))
    several = F.col("role_count") >= 2
    kind = F.when(several & (F.col("spread") <= strong_spread), "multi_role_corroborated").when(several, "multi_role_compatible").when(F.col("_strong"), "single_role_strong").otherwise("single_role_provisional")
    confidence = F.col("_w") + (F.col("role_count") - 1) * bonus - F.when(several, 0.0).otherwise(single_penalty) - F.col("spread") * spread_penalty
    return made.withColumn("classification", kind).withColumn("confidence", confidence).drop("_w", "_strong")


def distinct_locations(rows: DataFrame, keys: list[str], time: str, score: str, apart: float = 0.75) -> DataFrame:
    """The best row of each chain of locations, with its ``rank`` by score; ties to the earlier."""
    chained = islands.chain_groups(rows, keys, time, apart, [score])
    best = F.row_number().over(Window.partitionBy(*keys, "group_no").orderBy(F.desc(score), time))
    kept = chained.withColumn("_r", best).where("_r = 1").drop("_r", "group_no")
    return kept.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(score), time)))


def open_clusters(batches: Iterator[pd.DataFrame], keys: list[str], ident: str, role: str, residual: str, weight: str, tolerance: float) -> Iterator[pd.DataFrame]:
    """The rows of ``residual_clusters`` of batches sorted by keys, residual, role and ident; a row comes once its place can't change."""
    names = [*keys, ident, "cluster"]
    at, middle = -1, math.nan  # the open cluster of the key that may go on
    held: dict = {}  # of each role its weight, residual and row
    last: pd.DataFrame | None = None

    def closed() -> list[tuple]:
        return [(*row, at) for _, _, row in held.values()]

    for batch in batches:
        if not len(batch):
            continue
        edges = np.zeros(len(batch), bool)
        edges[starts_of(batch[keys])] = True
        if last is not None:
            edges[0] = starts_of(pd.concat([last, batch[keys].head(1)], ignore_index=True))[-1] == 1
        last = batch[keys].tail(1)
        out: list[tuple] = []
        own = zip(*(batch[c].tolist() for c in (*keys, ident)), strict=True)
        for new, value, name, heavy, row in zip(edges.tolist(), batch[residual].astype(float).tolist(), batch[role].tolist(), batch[weight].astype(float).tolist(), own, strict=True):
            if new:
                out += closed()
                at, held = -1, {}
            if not held or not abs(value - middle) <= tolerance:
                out += closed()
                at, held = at + 1, {}
            old = held.get(name)
            if old is None or heavy > old[0]:
                if old is not None:
                    out.append((*old[2], None))
                held[name] = (heavy, value, row)
                middle = median(v for _, v, _ in held.values())
            else:
                out.append((*row, None))
        if out:
            yield pd.DataFrame(out, columns=names).astype({"cluster": "Int64"})
    if held:
        yield pd.DataFrame(closed(), columns=names).astype({"cluster": "Int64"})


def residual_clusters(rows: DataFrame, keys: list[str], ident: str, role: str, residual: str, weight: str, tolerance: float = 70.0) -> DataFrame:
    """(keys, ident, cluster): first-fit clusters by residual, least first; a row joins the first cluster whose median is near.

    A cluster holds one row a role: a heavier one takes the place of the lighter, which is then in no cluster (null).
    Residuals rise, so a cluster that one row lies beyond is out for all that follow: only the newest is ever joined, and a task holds its
    row of each role, never a whole key.
    """
    kinds = dict(rows.dtypes)
    known = rows.where(F.col(residual).isNotNull()).select(*dict.fromkeys((*keys, ident, role, residual, weight)))
    dealt = known.repartition(*keys).sortWithinPartitions(*(F.asc_nulls_last(c) for c in (*keys, residual, role, ident)))
    return dealt.mapInPandas(lambda batches: open_clusters(batches, keys, ident, role, residual, weight, tolerance), ", ".join([*(f"{c} {kinds[c]}" for c in (*keys, ident)), "cluster bigint"]))


def score_residual_clusters(rows: DataFrame, keys: list[str], role: str, residual: str, weight: str, confidence: str, selected: str, accepted: str) -> DataFrame:
    """Each cluster (keys, cluster): weighted medians of residual and confidence, dispersion, roles, and the fusion score of 0..1.

    The score adds 0.12 for each further role (0.30 at most) and 0.05 a selected row (0.15 at most), and takes off a two-hundredth of the dispersion (0.35 at most).
    """
    own = [*keys, "cluster"]
    placed = rows.where("cluster is not null")
    centre = robust.weighted_median(placed, own, residual, weight).withColumnRenamed("weighted_median", "residual_ms")
    sure = robust.weighted_median(placed, own, confidence, weight).withColumnRenamed("weighted_median", "confidence")
    spread = robust.median_and_mad(placed, own, residual).select(*own, F.col("mad").alias("dispersion_ms"))
    counts = placed.groupBy(*own).agg(F.count_distinct(role).alias("role_count"), F.array_sort(F.collect_set(role)).alias("roles"), F.count_if(F.col(selected)).alias("path_selected_count"), F.count_if(F.col(accepted)).alias("accepted_count"))
    made = counts.join(centre, own).join(sure, own).join(spread, own)
    score = F.col("confidence") + F.least(F.lit(0.30), (F.col("role_count") - 1) * 0.12) + F.least(F.lit(0.15), F.col("path_selected_count") * 0.05) - F.least(F.lit(0.35), F.col("dispersion_ms") / 200.0)
    return made.withColumn("fusion_score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))


def best_hypothesis(clusters: DataFrame, keys: list[str], multi: float = 0.52, single: float = 0.88, most_dispersion: float = 55.0) -> DataFrame:
    """The top cluster of each key and how it is accepted: by several roles, by an exceptional single one on the path, or not."""
    top = Window.partitionBy(*keys).orderBy(F.desc("fusion_score"), F.desc("role_count"), F.desc("path_selected_count"), "cluster")
    best = clusters.withColumn("alternatives", F.count("*").over(Window.partitionBy(*keys)) - 1).withColumn("_r", F.row_number().over(top)).where("_r = 1").drop("_r")
    many = (F.col("role_count") >= 2) & (F.col("fusion_score") >= multi)
    lone = (F.col("role_count") == 1) & (F.col("fusion_score") >= single) & (F.col("dispersion_ms") <= most_dispersion) & (F.col("path_selected_count") >= 1)
    return best.withColumn("route", F.when(many, "multi_role_consensus").when(lone, "exceptional_single_role").otherwise("unresolved")).withColumn("accepted", many | lone)


def neighbour_support(rows: DataFrame, keys: list[str], measure: str, residual: str, reach: int = 2, near: float = 100.0, fewest: int = 2) -> DataFrame:
    """Accepted hypotheses with the number of accepted others close by in measure and residual; lone weak ones are demoted.

    All counts are of what was accepted before any demotion.
    """
    others = rows.where("accepted").select(*keys, F.col(measure).alias("_m"), F.col(residual).alias("_v")).withColumn(measure, F.explode(F.sequence(F.col("_m") - reach, F.col("_m") + reach)))
    met = rows.where("accepted").select(*keys, measure, residual).join(others, [*keys, measure])
    near_ones = met.where((F.col("_m") != F.col(measure)) & (F.abs(F.col("_v") - F.col(residual)) <= near))
    counted = near_ones.groupBy(*keys, measure).agg(F.count("*").alias("support"))
    out = rows.drop("support").join(counted, [*keys, measure], "left").withColumn("support", F.when(F.col("accepted"), F.coalesce("support", F.lit(0))))
    weak = (F.col("route") == "exceptional_single_role") & (F.col("support") < fewest)
    kept = out.withColumn("accepted", F.col("accepted") & ~F.coalesce(weak, F.lit(False)))
    return kept.withColumn("route", F.when(weak, "unresolved_single_role_without_neighbours").otherwise(F.col("route")))


def adjacent_support(rows: DataFrame, keys: list[str], measure: str, residual: str, near: float = 90.0) -> DataFrame:
    """Adds ``supported``: the row before or after is the neighbouring measure with a residual close by."""
    by = Window.partitionBy(*keys).orderBy(measure)
    beside = lambda f, step: F.coalesce((f(measure).over(by) == F.col(measure) + step) & (F.abs(f(residual).over(by) - F.col(residual)) <= near), F.lit(False))
    return rows.withColumn("supported", beside(F.lag, -1) | beside(F.lead, 1))


def cross_role_support(rows: DataFrame, keys: list[str], role: str, measure: str, residual: str, near: float = 70.0) -> DataFrame:
    """Adds ``supporting_roles``: other roles with a residual close by in the same measure."""
    others = rows.select(*keys, measure, F.col(role).alias("_q"), F.col(residual).alias("_v"))
    met = rows.select(*keys, measure, role, residual).join(others, [*keys, measure]).where((F.col("_q") != F.col(role)) & (F.abs(F.col("_v") - F.col(residual)) <= near))
    found = met.groupBy(*keys, measure, role, residual).agg(F.array_sort(F.collect_set("_q")).alias("supporting_roles"))
    return rows.join(found, [*keys, measure, role, residual], "left").withColumn("supporting_roles", F.coalesce("supporting_roles", F.array().cast("array<string>")))


def shift_families(rows: DataFrame, keys: list[str], ident: str, start: str, end: str, shift: str, near: float = 1.0) -> DataFrame:
    """(keys, ident, family): first-fit families of shifted windows, by start and shift.

    A window joins the first family whose span it meets or borders and whose
    rounded median shift is within ``near``; the family's span and median grow.
    """
    kind = dict(rows.dtypes)[ident]

    def kernel(g: pd.DataFrame) -> dict:
        return {ident: g[ident], "family": first_fit(g[start].tolist(), g[end].tolist(), g[shift].tolist(), near)}

    return per_group(rows, keys, [start, shift, ident], kernel, f"{ident} {kind}, family bigint")


class _Median:
    """The median of what was added so far: the lower half as a heap of negatives, the upper half as a heap."""

    def __init__(self) -> None:
        self.low: list[float] = []
        self.high: list[float] = []

    def add(self, value: float) -> None:
        heapq.heappush(self.high, -heapq.heappushpop(self.low, -value))
        if len(self.high) > len(self.low):
            heapq.heappush(self.low, -heapq.heappop(self.high))

    def value(self) -> float:
        return -self.low[0] if len(self.low) > len(self.high) else (self.high[0] - self.low[0]) / 2


def first_fit(starts: list, ends: list, shifts: list, near: float) -> list[int]:
    """The family of each window, windows in order of start.

    Families are looked up by their median, in cells of ``near``; as starts
    never fall, a family that a window starts beyond is out for good. So a
    window is compared with the few live families around its shift, and
    medians cost a logarithm.
    """
    cell = near if near > 0 else 1.0
    live: dict[int, set[int]] = {}
    last: list = []
    middle: list[float] = []
    halves: list[_Median] = []
    where = []
    for a, z, s in zip(starts, ends, shifts, strict=True):
        at = -1
        for c in range(math.floor((s - near) / cell), math.floor((s + near) / cell) + 1):
            held = live.get(c, set())
            held -= {k for k in held if a > last[k] + 1}
            fits = [k for k in held if abs(s - middle[k]) <= near]
            if fits and (at < 0 or min(fits) < at):
                at = min(fits)
        if at < 0:
            at = len(last)
            last.append(z)
            middle.append(s)
            halves.append(_Median())
        else:
            live[math.floor(middle[at] / cell)].discard(at)
        halves[at].add(s)
        last[at], middle[at] = max(last[at], z), round(halves[at].value())
        live.setdefault(math.floor(middle[at] / cell), set()).add(at)
        where.append(at)
    return where


def describe_families(rows: DataFrame, keys: list[str], start: str, end: str, shift: str, score: str, margin: float = 0.04) -> DataFrame:
    """Each family's span, median shift, best and second score, and whether it is distinctive against families it overlaps."""
    own = [*keys, "family"]
    ordered = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*own).orderBy(F.desc(score))))
    made = ordered.groupBy(*own).agg(F.min(start).alias("first"), F.max(end).alias("last"), F.rint(F.median(shift)).cast("int").alias("shift"), F.count("*").alias("windows"), F.max(score).alias("best"), F.coalesce(F.max(F.when(F.col("_r") == 2, F.col(score))), F.lit(0.0)).alias("second"))
    other = made.select(*keys, F.col("family").alias("_f"), F.col("first").alias("_a"), F.col("last").alias("_z"), F.col("shift").alias("_s"), F.col("best").alias("_b"))
    share = joins.overlap_share(F.col("first"), F.col("last"), F.col("_a"), F.col("_z"))
    rivals = made.join(other, keys).where((F.col("family") != F.col("_f")) & (share >= 0.5) & (F.abs(F.col("shift") - F.col("_s")) > 1)).groupBy(*own).agg(F.max("_b").alias("rival"))
    out = made.join(rivals, own, "left").withColumn("margin", F.col("best") - F.col("rival"))
    return out.withColumn("uniqueness", F.when(F.col("rival").isNull(), "uniqueness_not_established").when(F.col("margin") >= margin, "locally_distinctive").otherwise("ambiguous_repeated_occurrence"))


def effective_groups(roles: Column, similarity) -> Column:
    """How many independent sources an ordered array of roles amounts to: each counts one less its greatest likeness to an earlier one.

    ``similarity`` is a column function of two roles.
    """
    each = F.transform(roles, lambda r, i: F.when(i == 0, 1.0).otherwise(F.greatest(F.lit(0.0), 1.0 - F.coalesce(F.array_max(F.transform(F.slice(roles, 1, F.greatest(i, F.lit(1))), lambda p: similarity(r, p))), F.lit(0.0)))))
    return F.when(F.size(roles) > 0, vectors.total(each)).otherwise(0.0)


def window_scores(rows: DataFrame, keys: list[str], confidence: str, eligible: str) -> DataFrame:
    """Per window (keys) the number of measures with an eligible candidate, the median and the least of their best confidences. Rows: measure."""
    best = rows.where(F.col(eligible)).groupBy(*keys, "measure").agg(F.max(confidence).alias("_c"))
    scored = best.groupBy(*keys).agg(F.count("*").alias("valid_measures"), F.median("_c").alias("window_score"), F.min("_c").alias("minimum_score"))
    return rows.select(*keys).distinct().join(scored, keys, "left").na.fill(0, ["valid_measures"]).na.fill(0.0, ["window_score", "minimum_score"])


def combine_sources(scores: DataFrame, keys: list[str], role: str, fewest: int = 2, least: float = 0.56, gain: float = 0.08, groups: float = 1.65, similarity=lambda a, b: F.lit(0.0)) -> DataFrame:
    """Median score and gain over the baseline of the sources with enough measures, their effective number, and the first reason to reject.

    Scores: window_score, baseline_score, valid_measures.
    """
    valid = scores.where(F.col("valid_measures") >= fewest)
    made = valid.groupBy(*keys).agg(F.median("window_score").alias("combined"), F.median(F.col("window_score") - F.col("baseline_score")).alias("improvement"), F.array_sort(F.collect_set(role)).alias("roles"), F.count("*").alias("n"))
    made = scores.select(*keys).distinct().join(made, keys, "left").withColumn("effective", F.coalesce(effective_groups(F.col("roles"), similarity), F.lit(0.0)))
    reason = F.when(F.col("n").isNull(), "insufficient_valid_source_count").when(F.col("combined") < least, "below_absolute_match_score").when(F.col("improvement") < gain, "below_baseline_improvement").when(F.col("effective") < groups, "insufficient_effective_independence")
    return made.withColumn("reason", reason).withColumn("accepted", F.col("reason").isNull())


def expected_roles(spans: DataFrame, sounding: DataFrame, keys: list[str], ident: str, span: tuple[str, str], role: str, sound: tuple[str, str], width: float = 8.0) -> DataFrame:
    """Adds ``expected_roles``: the roles that sound at any time within [start, end] of each span."""
    met = joins.overlapping(spans.select(*keys, ident, F.col(span[0]).alias("_a"), F.col(span[1]).alias("_z")), sounding.select(*keys, F.col(role).alias("_role"), F.col(sound[0]).alias("_s"), F.col(sound[1]).alias("_e")), keys, ("_a", "_z"), ("_s", "_e"), width, closed=True)
    found = met.groupBy(*keys, ident).agg(F.array_sort(F.collect_set("_role")).alias("expected_roles"))
    return spans.drop("expected_roles").join(found, [*keys, ident], "left").withColumn("expected_roles", F.coalesce("expected_roles", F.array().cast("array<string>")))


def solo_authority(controls: DataFrame, sounding: DataFrame, keys: list[str], region: str, time: str, role: str, sound: tuple[str, str], least: float = 0.60, edge: float = 1.5) -> DataFrame:
    """Controls with the roles expected around them (half way to their neighbours), those supported, and promotion of a lone expected role.

    Controls: roles, confidence, classification.
    """
    by = Window.partitionBy(*keys, region).orderBy(time)
    left = F.coalesce((F.lag(time).over(by) + F.col(time)) / 2, F.col(time) - edge)
    right = F.coalesce((F.lead(time).over(by) + F.col(time)) / 2, F.col(time) + edge)
    placed = controls.withColumn("_l", left).withColumn("_h", right).withColumn("_id", F.struct(region, time))
    got = expected_roles(placed, sounding, keys, "_id", ("_l", "_h"), role, sound)
    supported = F.array_intersect("expected_roles", "roles")
    promoted = (F.size("expected_roles") == 1) & (F.size("supporting_roles") == 1) & (F.col("confidence") >= least)
    got = got.withColumn("supporting_roles", F.array_sort(supported)).withColumn("support_ratio", F.when(F.size("expected_roles") > 0, F.size("supporting_roles") / F.size("expected_roles")).otherwise(0.0))
    return got.withColumn("promoted", promoted).withColumn("classification", F.when(F.col("promoted"), "solo_role_expected_strong").otherwise(F.col("classification"))).drop("_l", "_h", "_id")


def root_validation(regions: DataFrame, first_onset: Column, most_offset: float = 12.0, stretch: tuple[float, float] = (0.7, 1.3)) -> DataFrame:
    """Adds offset, stretch and ``root``: a region near the first onset, with two solo controls and plausible geometry, anchors the song.

    Regions: chart_start, chart_end, midi_start, midi_end, solo_count.
    """
    span = F.col("chart_end") - F.col("chart_start")
    out = regions.withColumn("offset", F.col("midi_start") - F.col("chart_start")).withColumn("stretch", F.when(span > 0, (F.col("midi_end") - F.col("midi_start")) / span))
    near = F.col("chart_start") <= first_onset + 3.0
    valid = near & (F.col("solo_count") >= 2) & (F.abs("offset") <= most_offset) & F.col("stretch").between(*stretch) & (F.col("midi_start") >= 0)
    return out.withColumn("root", F.coalesce(valid, F.lit(False)))


def reconcile_opening(regions: DataFrame, keys: list[str], fewest: int = 2, most_apart: float = 0.75, most_lag: float = 4.0) -> DataFrame:
    """Shifts the first region that three clocks agree on to the heard time; the others stay.

    Regions: chart_start, midi_start, midi_end, controls (count), candidates (independent), roles (array), role_chart_start, role_audio_start.
    """
    lag = F.col("midi_start") - F.col("role_audio_start")
    fits = (F.size("roles") == 1) & (F.col("chart_start") <= F.col("role_chart_start") + 3.0) & (F.col("controls") >= fewest) & (F.col("candidates") >= 2) & (F.abs(F.col("role_audio_start") - F.col("role_chart_start")) <= most_apart) & lag.between(0.0, most_lag)
    flagged = regions.withColumn("_fits", F.coalesce(fits, F.lit(False)))
    chosen = F.min(F.when(F.col("_fits"), F.col("chart_start"))).over(Window.partitionBy(*keys))
    moved = flagged.withColumn("reconciled", F.coalesce(F.col("_fits") & (F.col("chart_start") == chosen), F.lit(False))).withColumn("lag", F.when(F.col("reconciled"), lag))
    shift = F.coalesce("lag", F.lit(0.0))
    return moved.withColumn("midi_start", F.col("midi_start") - shift).withColumn("midi_end", F.col("midi_end") - shift).drop("_fits")


def rescore_rooted(candidates: DataFrame, occurrences: DataFrame, keys: list[str], ident: str, bonus: float = 0.22, penalty: float = 0.10, tolerance: float = 0.35, width: float = 16.0) -> DataFrame:
    """Candidates with their score adjusted by the largest ordinal error of the phrase occurrences they cover; ranks stay as they were.

    Candidates: chart_start, chart_end, midi_start, midi_end, score. Occurrences of eligible runs: chart, midi (starts paired by ordinal).
    """
    from timeloom.functions import scoring

    dealt = candidates.withColumn("_lo", F.col("chart_start") - 1e-9).withColumn("_hi", F.col("chart_end") + 1e-9)
    met = joins.members_of(dealt, occurrences.select(*keys, F.col("chart").alias("_c"), F.col("midi").alias("_m")), keys, "_lo", "_hi", "_c", width, closed=True)
    said = scoring.through_two_points(F.col("_c"), F.col("chart_start"), F.col("chart_end"), F.col("midi_start"), F.col("midi_end"))
    worst = met.groupBy(*keys, ident).agg(F.max(F.abs(said - F.col("_m"))).alias("ordinal_error"))
    e = F.col("ordinal_error")
    change = F.when(e <= tolerance, (1 - e / max(tolerance, 1e-9)) * bonus).when(e > tolerance, -F.least(F.lit(penalty), (e / tolerance - 1) * penalty)).otherwise(0.0)
    status = F.when(e <= tolerance, "phrase_ordinal_compatible").when(e > tolerance, "phrase_ordinal_incompatible")
    return candidates.join(worst, [*keys, ident], "left").withColumn("support", status).withColumn("score_before", F.col("score")).withColumn("score", F.col("score") + change)
