"""Gates that keep what they reject: every failed reason is listed, and a row is accepted when none is."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.functions import robust


def with_reasons(rows: DataFrame, reasons: dict[str, Column]) -> DataFrame:
    """Adds ``reasons``, the names of all conditions that hold, in the given order, and ``accepted``, that none does.

    A condition that is null does not hold.
    """
    named = F.array(*(F.when(condition, F.lit(name)) for name, condition in reasons.items()))
    listed = F.filter(named, lambda r: r.isNotNull()) if reasons else F.array().cast("array<string>")
    return rows.withColumn("reasons", listed).withColumn("accepted", F.size("reasons") == 0)


def sanitize_intervals(rows: DataFrame, keys: list[str], nominal: str, warped: str, meter: Column, unit: float = 1.0, ratio: tuple[float, float] = (0.30, 2.00), shortest: float = 0.20, fastest: float = 400.0) -> DataFrame:
    """Repairs boundaries of each key beside intervals that run backwards, are too short, stretched too far or too fast.

    ``unit`` is what a second is in the time columns. Adds ``reasons`` of the
    interval that starts at the row, ``bad`` (the row bounds such an
    interval), ``clean``: the time, interpolated between the nearest good
    rows where both exist and both clocks advance between them, and
    ``unresolved``: the interval after repair is still too short. Times of
    one key should differ in ``nominal``.
    """
    by = Window.partitionBy(*keys).orderBy(nominal)
    before, after = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(1, Window.unboundedFollowing)
    length, planned = F.lead(warped).over(by) - F.col(warped), F.lead(nominal).over(by) - F.col(nominal)
    measured = rows.withColumn("_d", length.cast("double")).withColumn("_n", planned.cast("double"))
    d, r = F.col("_d"), F.col("_d") / F.when(F.col("_n") > 0, F.col("_n"))
    speed = meter * F.lit(60.0 * unit) / F.when(d > 0, d)
    judged = with_reasons(measured, {
        "non_monotonic": d <= 0,
        "too_short": d < shortest * unit,
        "stretch_ratio": (r < ratio[0]) | (r > ratio[1]),
        "extreme_bpm": (d <= 0) | (speed > fastest),
    }).drop("accepted")
    marked = judged.withColumn("_o", F.size("reasons") > 0).withColumn("bad", F.col("_o") | F.coalesce(F.lag("_o").over(by), F.lit(False)))
    good = F.when(~F.col("bad"), F.struct(F.col(nominal).cast("double").alias("n"), F.col(warped).cast("double").alias("w")))
    placed = marked.withColumn("_l", F.last(good, ignorenulls=True).over(before)).withColumn("_r", F.first(good, ignorenulls=True).over(after))
    line = F.col("_l.w") + (F.col(nominal).cast("double") - F.col("_l.n")) / (F.col("_r.n") - F.col("_l.n")) * (F.col("_r.w") - F.col("_l.w"))
    mends = F.col("bad") & (F.col("_r.w") > F.col("_l.w")) & (F.col("_r.n") > F.col("_l.n"))
    mended = placed.withColumn("clean", F.when(mends, line).otherwise(F.col(warped).cast("double")))
    left = F.lead("clean").over(by) - F.col("clean")
    return mended.withColumn("unresolved", F.coalesce((left <= 0) | (left < shortest * unit), F.lit(False))).drop("_d", "_n", "_o", "_l", "_r")


def checkpoint_gate(residuals: DataFrame, keys: list[str], residual: str, radius: float, spread: float, least: int = 3) -> DataFrame:
    """Per checkpoint n, median and mad of its residuals; accepted with ``least`` of them, |median| <= radius and mad <= spread.

    With fewer residuals median and mad are null.
    """
    counted = residuals.where(F.col(residual).isNotNull()).groupBy(*keys).agg(F.count("*").alias("n"))
    got = counted.join(robust.median_and_mad(residuals.where(F.col(residual).isNotNull()), keys, residual), keys)
    enough = F.col("n") >= least
    got = got.withColumn("median", F.when(enough, F.col("median"))).withColumn("mad", F.when(enough, F.col("mad")))
    return got.withColumn("accepted", F.coalesce(enough & (F.abs("median") <= radius) & (F.col("mad") <= spread), F.lit(False)))


# Alignment methods, and those that section fits may follow.
METHODS = ("nominal", "offset", "linear", "dtw", "dtw-checkpoint", "checkpoint-linear", "checkpoint-dtw-diagnostic", "checkpoint-dtw-selective", "continuous-anchor-linear", "continuous-anchor-dtw", "continuous-anchor-structural", "bar-landmark-regularized")
SECTION_METHODS = METHODS[4:]
# What each materialisation mode lets through.
MODES = {
    "conservative": {"tiers": ("A",), "stretch": (0.90, 1.10), "short_delta": 0.12, "short_seconds": 6.0, "interval": 24, "growth": 0.0025, "delta_most": 0.25, "episode": (0.80, 1.20)},
    "permissive": {"tiers": ("A", "B"), "stretch": (0.85, 1.15), "short_delta": 0.25, "short_seconds": 10.0, "interval": 16, "growth": 0.005, "delta_most": 0.50, "episode": (0.70, 1.30)},
    "diagnostic-unsafe": {"tiers": ("A", "B", "C"), "stretch": (0.70, 1.30), "short_delta": 0.50, "short_seconds": 16.0, "interval": 8, "growth": 0.01, "delta_most": 0.75, "episode": (0.50, 1.50)},
}


def require_method(method: str, allowed: tuple[str, ...] = SECTION_METHODS) -> str:
    """The method, or an error that lists what is allowed."""
    if method not in allowed:
        raise ValueError(f"{method!r} is none of {', '.join(allowed)}")
    return method


def config_errors(assigned: DataFrame, inventory: DataFrame, keys: list[str], roles: tuple[str, ...], cutoff: float = 0.55) -> DataFrame:
    """(keys, code, track, detail): what is wrong with a song's track assignments.

    ``assigned``: track, role; ``inventory``: track, a row a track. Codes:
    configured_track_not_found (detail: the closest name, if close enough),
    configured_track_name_ambiguous, unknown_override_role,
    incompatible_duplicate_assignment, active_track_also_ignored. Inventories are a song's tracks, so pairs of one are few.
    """
    counted = inventory.groupBy(*keys, "track").agg(F.count("*").alias("_n"))
    found = assigned.join(counted, [*keys, "track"], "left")
    missing = found.where(F.col("_n").isNull()).select(*keys, "track").distinct()
    close = missing.join(counted.select(*keys, F.col("track").alias("_other")), keys, "left")
    likeness = 1.0 - F.levenshtein("track", "_other") / F.greatest(F.length("track"), F.length("_other"))
    best = close.withColumn("_l", likeness).groupBy(*keys, "track").agg(F.max_by("_other", F.struct("_l", "_other")).alias("_o"), F.max("_l").alias("_l"))
    row = lambda df, code, detail: df.select(*keys, F.lit(code).alias("code"), "track", detail.cast("string").alias("detail"))
    active = assigned.where("role <> 'ignore'")
    several = active.groupBy(*keys, "track").agg(F.array_join(F.array_sort(F.collect_set("role")), " ").alias("_roles"), F.count_distinct("role").alias("_k")).where("_k > 1")
    also = active.select(*keys, "track").distinct().join(assigned.where("role = 'ignore'").select(*keys, "track").distinct(), [*keys, "track"])
    parts = [
        row(best, "configured_track_not_found", F.when(F.col("_l") >= cutoff, F.col("_o"))), row(found.where("_n > 1").select(*keys, "track").distinct(), "configured_track_name_ambiguous", F.lit(None)),
        row(assigned.where(~F.col("role").isin(*roles)), "unknown_override_role", F.col("role")), row(several, "incompatible_duplicate_assignment", F.col("_roles")), row(also, "active_track_also_ignored", F.lit(None)),
    ]
    return reduce(DataFrame.unionByName, parts)


def unused_tracks(inventory: DataFrame, assigned: DataFrame, keys: list[str]) -> DataFrame:
    """Tracks of the inventory that no assignment names."""
    return inventory.join(assigned.select(*keys, "track").distinct(), [*keys, "track"], "left_anti")


def opening_gates(sources: DataFrame, keys: list[str], latest: float = 15.0, shift: float = 4.0, fewest: int = 4, together: float = 0.05) -> DataFrame:
    """Sources with reasons why one may not define the opening: only the earliest scored entrance may.

    Sources: first (null: none), n, score_start, content_start, heard (null: not found), has_audio.
    """
    earliest = F.min("first").over(Window.partitionBy(*keys))
    is_first = F.coalesce(F.abs(F.col("first") - F.col("_earliest")) <= together, F.lit(False))
    delay = F.col("first") - F.col("score_start")
    placed = sources.withColumn("_earliest", earliest).withColumn("earliest_entrance", is_first)
    few = F.col("n") < F.when(F.col("earliest_entrance"), 1).otherwise(fewest)
    before = F.col("first").isNull() | (delay < -0.025) | (delay > latest) | ~F.col("earliest_entrance") | few | ~F.col("has_audio")
    return with_reasons(placed, {
        "insufficient_events": F.col("first").isNull() | few, "not_an_early_score_entrance": (delay < -0.025) | (delay > latest), "later_than_earliest_configured_score_entrance": ~F.col("earliest_entrance"),
        "missing_audio": F.col("earliest_entrance") & ~F.col("has_audio"), "missing_audio_first_onset": ~before & F.col("heard").isNull(), "opening_anchor_shift_too_large": ~before & (F.abs(F.col("heard") - F.col("content_start")) > shift),
    }).drop("_earliest")


def choose_opening(gated: DataFrame, keys: list[str], together: float = 0.05, agree: float = 0.25) -> DataFrame:
    """Per key score and audio anchor and status: the earliest cohort's medians if they agree, else the one nearest to where content starts.

    Of equally near ones of the same priority the earliest entrance counts, then the least source, so reruns agree.
    Rows as of ``opening_gates``, with ``source`` and ``priority``.
    """
    own = Window.partitionBy(*keys)
    ok = F.col("accepted")
    cohort = gated.withColumn("_in", ok & (F.abs(F.col("first") - F.min(F.when(ok, F.col("first"))).over(own)) <= together))
    heard, first = F.when(F.col("_in"), F.col("heard")), F.when(F.col("_in"), F.col("first"))
    got = cohort.groupBy(*keys).agg(
        F.count(F.when(F.col("_in"), 1)).alias("_n"), (F.max(heard) - F.min(heard)).alias("spread"), F.median(heard).alias("_ma"), F.median(first).alias("_ms"), F.min("first").alias("_fs"), F.first("score_start").alias("_ss"), F.first("content_start").alias("_cs"),
        F.min_by(F.struct("heard", "first", "source"), F.when(F.col("_in"), F.struct(F.abs(F.col("heard") - F.col("content_start")), "priority", "first", "source"))).alias("_b"),
    )
    fused = (F.col("_n") > 1) & (F.col("spread") <= agree)
    none = F.col("_n") == 0
    pick = lambda none_value, both, one: F.when(none, none_value).when(fused, both).otherwise(one)
    return got.select(*keys, pick(F.coalesce("_fs", "_ss"), F.col("_ms"), F.col("_b.first")).alias("score_anchor"), pick(F.col("_cs"), F.col("_ma"), F.col("_b.heard")).alias("audio_anchor"), pick(F.lit("fallback_content_start"), F.lit("fused_early_anchors"), F.lit("selected_early_anchor")).alias("status"))


def transition_reasons(p: str, c: str, reject: float = 0.35) -> Column:
    """Names of what is wrong with following candidate struct ``p`` by ``c``; none if it may follow.

    Candidates: chart_start, chart_end, midi_start, midi_end, stretch, translation. Overlapping windows are
    compared at five points of what they share.
    """
    a, b = F.col(p), F.col(c)
    lo, hi = F.greatest(a["chart_start"], b["chart_start"]), F.least(a["chart_end"], b["chart_end"])
    at = lambda x, t: x["translation"] + x["stretch"] * t
    apart = F.greatest(*(F.abs(at(a, lo + (hi - lo) * f) - at(b, lo + (hi - lo) * f)) for f in (0.0, 0.25, 0.5, 0.75, 1.0)))
    middle, near = (lo + hi) / 2, F.least(F.lit(0.01), F.greatest(F.lit(1e-6), (hi - lo) / 1000.0))
    shares = hi > lo
    reasons = {
        "chart_window_did_not_advance": b["chart_start"] <= a["chart_start"], "chart_window_end_did_not_advance": b["chart_end"] <= a["chart_end"], "non_positive_chart_stretch": (a["stretch"] <= 0) | (b["stretch"] <= 0),
        "midi_window_start_did_not_advance": b["midi_start"] <= a["midi_start"], "midi_window_end_did_not_advance": b["midi_end"] <= a["midi_end"], "overlap_mapping_disagreement": shares & (apart > reject),
        "crossing_or_reversing_overlap_maps": shares & (at(b, F.least(hi, middle + near)) <= at(a, F.greatest(lo, middle - near))), "non_overlapping_sections_reverse_or_overlap_midi_time": ~shares & (b["midi_start"] <= a["midi_end"]),
    }
    return F.filter(F.array(*(F.when(x, F.lit(n)) for n, x in reasons.items())), lambda r: r.isNotNull())


def transition_adjustment(p: str, c: str, stretch: float = 0.80, translation: float = 0.08, overlap: float = 1.50) -> Column:
    """What a transition takes off a path's score: change of stretch and translation, and mean disagreement where windows overlap."""
    a, b = F.col(p), F.col(c)
    lo, hi = F.greatest(a["chart_start"], b["chart_start"]), F.least(a["chart_end"], b["chart_end"])
    at = lambda x, t: x["translation"] + x["stretch"] * t
    apart = reduce(lambda x, y: x + y, (F.abs(at(a, lo + (hi - lo) * f) - at(b, lo + (hi - lo) * f)) for f in (0.0, 0.25, 0.5, 0.75, 1.0))) / 5
    return -(F.abs(b["stretch"] - a["stretch"]) * stretch + F.abs(b["translation"] - a["translation"]) * translation + F.when(hi > lo, apart * overlap).otherwise(0.0))


def geometry(chart: Column, audio: Column, policy: dict) -> Column:
    """(accepted, basis, stretch, correction) of an edge: a normal stretch, or a short edge with a small correction."""
    stretch, correction = F.try_divide(audio, chart), F.abs(audio - chart)
    forward = (chart > 0) & (audio > 0)
    normal = stretch.between(*policy["stretch"])
    short = (chart <= policy["short_seconds"]) & (correction <= policy["short_delta"])
    basis = F.when(~forward, "catastrophic_non_positive_geometry").when(normal, "normal_stretch_range").when(short, "short_region_delta_exception").otherwise("geometry_out_of_policy")
    return F.struct((forward & (normal | short)).alias("accepted"), basis.alias("basis"), F.when(forward, stretch).alias("stretch"), F.when(forward, correction).alias("correction"))


def fused_edge(chart: Column, midi: Column, stretch: tuple[float, float] = (0.90, 1.10), longest: float = 16.0, most: float = 0.5) -> Column:
    """The reason why a fused edge is unsafe, or null."""
    ratio = F.try_divide(midi, chart)
    fits = ratio.between(*stretch) | ((chart <= longest) & (F.abs(midi - chart) <= most))
    return F.when(chart <= 0, "chart_control_did_not_advance").when(midi <= 0, "midi_control_did_not_advance").when(~fits, "unsafe_fused_edge_geometry")


def evidence_tier(controls: Column, strong: Column, episodes: Column, measures: Column, policy: dict) -> Column:
    """Tier A, B or C of a region from its controls, how many are strong, and how dense its correction episodes are."""
    share = strong / F.greatest(F.lit(1), controls)
    base = F.when((controls >= 3) & (strong >= 3) & (share >= 0.75), "A").when((controls >= 3) & (strong >= 2) & (share >= 0.40), "B").otherwise("C")
    allowed = F.greatest(F.lit(1), F.floor(F.greatest(F.lit(1), F.coalesce(measures, F.lit(1))) / policy["interval"]))
    return F.when((base == "C") | (episodes > allowed), "C").when((base == "A") & (episodes > 0), "B").otherwise(base)


def assess_edges(edges: DataFrame, policy: dict) -> DataFrame:
    """Edges (chart, audio lengths, in_episode, measures) under a mode: geometry, or the allowance of an episode, which grows with the region's measures."""
    grown = F.least(F.lit(policy["delta_most"]), F.lit(policy["short_delta"]) + F.greatest(F.lit(0), F.col("measures") - policy["interval"]) * policy["growth"])
    judged = edges.withColumn("_g", geometry(F.col("chart"), F.col("audio"), policy)).withColumn("allowance", grown)
    saved = ~F.col("_g.accepted") & F.col("in_episode") & (F.col("chart") <= policy["short_seconds"]) & F.coalesce(F.col("_g.correction") <= F.col("allowance"), F.lit(False)) & F.coalesce(F.col("_g.stretch").between(*policy["episode"]), F.lit(False))
    return judged.withColumn("accepted", F.col("_g.accepted") | saved).withColumn("basis", F.when(saved, "length_adjusted_episode_delta_exception").otherwise(F.col("_g.basis"))).withColumn("stretch", F.col("_g.stretch")).drop("_g")


def validate_proposals(mapped: DataFrame, keys: list[str], order: str, base: str, proposed: str, correction: str, safe: tuple[float, float] = (0.9, 1.1), warn: float = 60.0, error: float = 180.0) -> DataFrame:
    """Per proposal (keys): errors (intervals that do not advance, an abrupt jump), warnings (unsafe stretch, a large jump), stretch range, largest jump, status."""
    by = Window.partitionBy(*keys).orderBy(order)
    step = mapped.withColumn("_b", F.col(base) - F.lag(base).over(by)).withColumn("_p", F.col(proposed) - F.lag(proposed).over(by)).withColumn("_j", F.abs(F.col(correction) - F.lag(correction).over(by)))
    stretch = F.when((F.col("_p") > 0) & (F.col("_b") > 0), F.col("_p") / F.col("_b"))
    got = step.groupBy(*keys).agg(F.count_if(F.col("_p") <= 0).alias("_e"), F.count_if(~stretch.between(*safe)).alias("_w"), F.min(stretch).alias("least_stretch"), F.max(stretch).alias("most_stretch"), F.coalesce(F.max("_j"), F.lit(0.0)).alias("jump"))
    errors = F.col("_e") + F.when(F.col("jump") >= error, 1).otherwise(0)
    warnings = F.col("_w") + F.when((F.col("jump") >= warn) & (F.col("jump") < error), 1).otherwise(0)
    return got.withColumn("errors", errors).withColumn("warnings", warnings).withColumn("status", F.when(F.col("errors") > 0, "error").when(F.col("warnings") > 0, "warning").otherwise("ok")).drop("_e", "_w")


def alignment_severity(intervals: DataFrame, keys: list[str], nominal: str, warped: str, most: float = 0.15) -> DataFrame:
    """Per key stretch range, number of stretched measures and severity. Intervals: lengths on both clocks, bad and unresolved (booleans)."""
    ratio = F.when((F.col(nominal) > 0) & (F.col(warped) > 0), F.col(warped) / F.col(nominal))
    got = intervals.groupBy(*keys).agg(F.min(ratio).alias("least_stretch"), F.max(ratio).alias("most_stretch"), F.count_if(F.abs(ratio - 1) > most).alias("stretched"), F.max(F.coalesce("bad", F.lit(False))).alias("_b"), F.max(F.coalesce("unresolved", F.lit(False))).alias("_u"))
    return got.withColumn("severity", F.when(F.col("_u"), "severe").when(F.col("_b") | (F.col("stretched") > 0), "warning").otherwise("ok")).drop("_b", "_u")


def baseline_sanity(samples: DataFrame, keys: list[str], time: str, mapped: str, roots: DataFrame | None = None, slopes: tuple[float, float] = (0.5, 1.5)) -> DataFrame:
    """Per key whether a baseline is usable (no negative time, no reversal, plausible slope), else the fallback: a root's offset, or blocked.

    ``roots`` (keys, chart_start, offset): validated roots; the first counts.
    """
    by = Window.partitionBy(*keys).orderBy(time)
    step = samples.withColumn("_m", F.col(mapped) - F.lag(mapped).over(by)).withColumn("_t", F.col(time) - F.lag(time).over(by))
    got = step.groupBy(*keys).agg(F.max(F.col(mapped) < 0).alias("negative"), F.coalesce(F.max(F.col("_m") <= 0), F.lit(False)).alias("nonmonotonic"), F.coalesce(F.max(~(F.col("_m") / F.when(F.col("_t") > 0, F.col("_t"))).between(*slopes)), F.lit(False)).alias("implausible"))
    got = got.withColumn("valid", ~(F.col("negative") | F.col("nonmonotonic") | F.col("implausible")))
    if roots is None:
        return got.withColumn("root_offset", F.lit(None).cast("double")).withColumn("fallback", F.when(F.col("valid"), "none").otherwise("blocked"))
    first = roots.groupBy(*keys).agg(F.min_by("offset", "chart_start").alias("root_offset"))
    return got.join(first, keys, "left").withColumn("fallback", F.when(F.col("valid"), "none").when(F.col("root_offset").isNotNull(), "root_identity_clock").otherwise("blocked"))


def trend_eligible(n: Column, span: Column) -> Column:
    return F.coalesce((n >= 4) & (span >= 30), F.lit(False))


def significant_drift(n: Column, span: Column, slope: Column) -> Column:
    """An eligible trend of at least a millisecond a second that adds up to 75."""
    return F.coalesce(trend_eligible(n, span) & (F.abs(slope) >= 1.0) & (F.abs(slope * span) >= 75.0), F.lit(False))


def run_reason(run: Column, root_offset: Column, most: float = 0.75) -> Column:
    """The first reason why a phrase run may not anchor candidates, or null.

    ``run`` has found, representative, classification, boundary_score, joint_confidence, chart_count, midi_count, chart_start, midi_start.
    """
    off = F.abs(run["midi_start"] - run["chart_start"] - root_offset)
    return (
        F.when(root_offset.isNull(), "no_validated_root").when(~F.coalesce(run["found"], F.lit(False)), "missing_run_detail").when(~F.coalesce(run["representative"], F.lit(True)), "not_selected_cluster_representative").when(F.coalesce(run["classification"], F.lit("")) != "matching_phrase_run", "occurrence_count_not_exact")
        .when(F.coalesce(run["boundary_score"], F.lit(0.0)) < 0.45, "boundary_context_too_weak").when(F.coalesce(run["joint_confidence"], F.lit(0.0)) < 0.76, "joint_confidence_too_weak").when(run["chart_count"] != run["midi_count"], "ordinal_count_mismatch").when(off > most, "phrase_origin_disagrees_with_validated_root")
    )


def midi_authority(path: DataFrame, controls: DataFrame, keys: list[str], time: str, source: str, tracked: bool = False, fewest: int = 4, coverage: float = 0.35, gap: float = 30.0, roles: int = 1) -> DataFrame:
    """Per key whether transcribed timing may lead: enough controls, coverage, no long gap, enough roles; looser if a tracker confirmed it."""
    by = Window.partitionBy(*keys).orderBy(time)
    seen = path.withColumn("_g", F.col(time) - F.lag(time).over(by)).groupBy(*keys).agg(F.min(time).alias("_a"), F.max(time).alias("_z"), F.coalesce(F.max("_g"), F.lit(0.0)).alias("largest_gap"), F.count_distinct(source).alias("role_count"))
    got = seen.join(controls.groupBy(*keys).agg(F.count("*").alias("n_controls")), keys, "left").na.fill(0, ["n_controls"])
    span = F.col("_z") - F.col("_a")
    covered = F.least(F.lit(1.0), span / 4.0) if tracked else span / F.greatest(F.col("_z"), F.lit(1e-6))
    got = got.withColumn("coverage", covered)
    reasons = {"too_few_controls": F.col("n_controls") < (2 if tracked else fewest), "low_coverage": F.col("coverage") < (0.5 if tracked else coverage), "long_gap": F.col("largest_gap") > gap, "too_few_roles": F.col("role_count") < roles}
    return with_reasons(got, reasons).drop("_a", "_z")


def vocal_capability(notes: Column, timed: Column, lines: Column, starts: Column) -> Column:
    """(kind, direct): what a score's vocals can give, from counts of notes, timed texts, lyric lines and distinct starting measures."""
    kind = F.when((notes == 0) & (timed == 0) & (lines == 0), "no_vocal_material").when(timed > 0, "timed_beat_text").when((lines >= 2) & (starts >= 2), "measure_allocated_lyrics").when(lines > 0, "flat_untimed_lyrics").otherwise("notes_only")
    return F.struct(kind.alias("kind"), kind.isin("timed_beat_text", "measure_allocated_lyrics").alias("direct"))


def vocal_coverage(songs: DataFrame, words: DataFrame, pitches: DataFrame, keys: list[str], tail: float = 45.0) -> DataFrame:
    """Songs (keys, duration) with warnings: no words, no pitches, a long tail without vocals, ends that diverge. Rows have t and d."""
    end = lambda rows, n, e: rows.groupBy(*keys).agg(F.count("*").alias(n), F.max(F.col("t") + F.coalesce("d", F.lit(0.0))).alias(e))
    both = songs.join(end(words, "n_words", "word_end"), keys, "left").join(end(pitches, "n_pitches", "pitch_end"), keys, "left").na.fill(0, ["n_words", "n_pitches"])
    left = F.greatest(F.lit(0.0), F.col("duration") - F.greatest("word_end", "pitch_end"))
    threshold = F.greatest(F.lit(float(tail)), F.coalesce(F.col("duration"), F.lit(0.0)) * 0.25)
    return with_reasons(both.withColumn("tail", left), {"no_timed_words": F.col("n_words") == 0, "no_pitch_notes": F.col("n_pitches") == 0, "large_unexplained_song_tail_without_vocals": F.col("tail") > threshold, "lyrics_and_pitch_end_times_diverge": F.abs(F.col("word_end") - F.col("pitch_end")) > 30})
