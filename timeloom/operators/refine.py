"""Refinement of maps inside segments, their validation, and reports on how the offset moves along a song.

Keys are a song, or a song and segment; kernels take one key's rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.operators import islands, joins, maps, tempo
from timeloom.operators.sequence import banded_dtw, dealt_by, per_group, starts_of


def beat_grid(bars: DataFrame, spans: DataFrame, keys: list[str], ident: str, time: str, meter: str) -> DataFrame:
    """(keys, ident, start, stop, fraction): the beats of measures clipped to each span [start, end], with the share of the beat inside."""
    ended = tempo.measures(bars, keys, time).withColumn("_n", F.greatest(F.lit(1), F.col(meter)).cast("int"))
    width = (F.col("end") - F.col("start")) / F.col("_n")
    beats = ended.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).select(*keys, (F.col("start") + width * F.col("_i")).alias("_b0"), (F.col("start") + width * (F.col("_i") + 1)).alias("_b1"))
    met = joins.overlapping(spans.select(*keys, ident, F.col("start").alias("_s"), F.col("end").alias("_e")), beats, keys, ("_s", "_e"), ("_b0", "_b1"), 16.0)
    a, z = F.greatest("_s", "_b0"), F.least("_e", "_b1")
    return met.select(*keys, ident, a.alias("start"), z.alias("stop"), ((z - a) / (F.col("_b1") - F.col("_b0"))).alias("fraction"))


def validate_map(samples: DataFrame, keys: list[str], time: str, base: str, mapped: str, stretch: tuple[float, float] = (0.98, 1.02)) -> DataFrame:
    """Per key whether a map rises and its stretch against the baseline stays within bounds, and the largest change."""
    by = Window.partitionBy(*keys).orderBy(time)
    step = samples.withColumn("_m", F.col(mapped) - F.lag(mapped).over(by)).withColumn("_b", F.col(base) - F.lag(base).over(by))
    ratio = F.when(F.col("_b") > 0, F.col("_m") / F.col("_b"))
    got = step.groupBy(*keys).agg(F.coalesce(F.min(F.col("_m") > 0), F.lit(True)).alias("monotonic"), F.coalesce(F.min(ratio), F.lit(1.0)).alias("least_stretch"), F.coalesce(F.max(ratio), F.lit(1.0)).alias("most_stretch"), F.max(F.abs(F.col(mapped) - F.col(base))).alias("largest_change"))
    return got.withColumn("valid", F.col("monotonic") & F.col("least_stretch").between(*stretch) & F.col("most_stretch").between(*stretch))


def guarded(rows: DataFrame, checked: DataFrame, keys: list[str], base: str, mapped: str) -> DataFrame:
    """Rows with their mapped time where their key's map is valid, else the baseline; ``applied`` says which."""
    both = rows.join(checked.select(*keys, F.col("valid").alias("applied")), keys, "left").withColumn("applied", F.coalesce("applied", F.lit(False)))
    return both.withColumn(mapped, F.when(F.col("applied"), F.col(mapped)).otherwise(F.col(base)))


def continuous_map(anchors: DataFrame, bars: DataFrame, keys: list[str], manual: DataFrame | None = None, near: float = 0.05, fewest: int = 3, scale: tuple[float, float] = (0.70, 1.35)) -> DataFrame:
    """(measure times with ``mapped`` and ``applied``): a baseline corrected by the residuals of selected anchors, or the baseline itself.

    Anchors and manual ones: x, y, base. Manual ones win within ``near``. The
    correction starts at the first anchor and holds its last residual. Songs
    with fewer than ``fewest`` anchors, or whose map runs backwards or stretches beyond ``scale``, keep the baseline exactly.
    """
    rows = anchors.select(*keys, "x", "y", "base", F.lit(1).alias("_p"))
    if manual is not None:
        rows = rows.unionByName(manual.select(*keys, "x", "y", "base", F.lit(0).alias("_p")))
    grouped = islands.head_anchored(rows, keys, "x", near).groupBy(*keys, "head").agg(F.min_by(F.struct("x", "y", "base"), F.struct("_p", "x")).alias("_c")).select(*keys, "_c.*")
    enough = grouped.withColumn("_n", F.count("*").over(Window.partitionBy(*keys))).where(F.col("_n") >= fewest)
    mapped = maps.add_residuals(bars, enough.select(*keys, "x", (F.col("y") - F.col("base")).alias("r")), keys, "t", "base", "mapped", "base", "hold")
    checked = validate_map(mapped, keys, "t", "base", "mapped", scale).join(enough.select(*keys).distinct(), keys)
    return guarded(mapped, checked, keys, "base", "mapped")


def warp_segments(series: DataFrame, keys: list[str], source: str, band: float, turn: float = 0.35, repeat: float = 0.25, points: int = 9) -> DataFrame:
    """(keys, source, x, r, cost, edge_share, turns): per segment (keys) and source the residual of a banded warping of the predicted novelty onto the heard one.

    ``series``: t (on the baseline clock), predicted, heard. Residuals are
    taken at evenly spaced controls; they are 0 at both ends.
    """

    def kernel(g: pd.DataFrame) -> dict:
        t, a, b = g["t"].to_numpy(float), g["predicted"].to_numpy(float), g["heard"].to_numpy(float)
        cost, steps = banded_dtw(a, b, band, turn, repeat)
        if not steps or len(t) < 3:
            return {"x": [], "r": [], "cost": [], "edge_share": [], "turns": []}
        i, j = np.array(steps).T
        lag = np.array([np.median(j[i == k]) - k for k in range(len(t))])
        at = np.unique(np.rint(np.linspace(0, len(t) - 1, points)).astype(int))
        r = lag[at] * float(np.median(np.diff(t)))
        r[[0, -1]] = 0.0
        kind = np.diff(i) * 2 + np.diff(j)
        return {"x": t[at], "r": r, "cost": cost, "edge_share": float((np.abs(j - i) >= band - 1e-9).mean()), "turns": int((kind[1:] != kind[:-1]).sum())}

    return per_group(series, [*keys, source], ["t"], kernel, "x double, r double, cost double, edge_share double, turns bigint")


def select_sources(metrics: DataFrame, keys: list[str], source: str, gain: float = 8.0, relative: float = 0.20, held: float = -10.0) -> DataFrame:
    """The best source of each segment, or none, with the state of every candidate: enough improvement, no held-out source much worse.

    Metrics: base_median, median, base_p95, p95, held_gain (null: none held out), corroborating. Best by relative gain, corroboration, then the lower p95.
    """
    better = F.col("base_median") - F.col("median")
    share = better / F.when(F.col("base_median") > 0, F.col("base_median"))
    state = F.when((better < gain) | F.coalesce(share < relative, F.lit(True)) | (F.col("base_p95") < F.col("p95")), "rejected_no_meaningful_improvement").when(F.col("held_gain") < held, "rejected_held_out_degradation").otherwise("would_apply")
    judged = metrics.withColumn("relative_gain", share).withColumn("state", state)
    ok = F.col("state") == "would_apply"
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(ok), F.desc("relative_gain"), F.desc("corroborating"), "p95", source))
    return judged.withColumn("chosen", ok & (rank == 1))


def selective_map(segments: DataFrame, controls: DataFrame, bars: DataFrame, keys: list[str], stretch: tuple[float, float] = (0.98, 1.02)) -> DataFrame:
    """Measure times with the residuals of accepted, disjoint segments added; if the whole map fails its checks the baseline stays.

    Segments: segment, start, stop, accepted; controls: segment, x, r (0 at both ends); bars: t, base.
    """
    kept = segments.where("accepted")
    by = Window.partitionBy(*keys).orderBy("start")
    clash = kept.withColumn("_p", F.lag("stop").over(by)).groupBy(*keys).agg(F.coalesce(F.max(F.col("start") < F.col("_p") - 1e-7), F.lit(False)).alias("_clash"))
    ends = kept.select(*keys, F.explode(F.array(F.col("start"), F.col("stop"))).alias("x"), F.lit(0.0).alias("r"))
    inner = controls.join(kept.select(*keys, "segment"), [*keys, "segment"]).select(*keys, "x", "r")
    mapped = maps.add_residuals(bars, ends.unionByName(inner).groupBy(*keys, "x").agg(F.max_by("r", F.abs("r")).alias("r")), keys, "t", "base", "mapped", "base", "base")
    checked = validate_map(mapped, keys, "t", "base", "mapped", stretch).join(clash, keys)
    return guarded(mapped, checked.withColumn("valid", F.col("valid") & ~F.col("_clash")), keys, "base", "mapped")


def hand_positions(notes: DataFrame, keys: list[str], time: str, fret: str, width: int = 4) -> DataFrame:
    """(keys, time, fret, width) wherever the hand must move: below its position, or beyond its reach. A key is one track of a song."""
    frets = F.filter(F.collect_list(fret), lambda f: f > 0)
    at = notes.where(F.col(fret) >= 0).groupBy(*keys, F.col(time).cast("double").alias("time")).agg(F.greatest(F.lit(1), F.coalesce(F.array_min(frets), F.lit(1))).alias("_lo"), F.coalesce(F.array_max(frets), F.lit(1)).alias("_hi"))

    def kernel(g: pd.DataFrame) -> dict:
        here, out = None, []
        for t, lo, hi in zip(g["time"], g["_lo"], g["_hi"], strict=True):
            if here is None or lo < here or max(hi, lo) > here + width - 1:
                here = int(lo)
                out.append((t, here))
        return {"time": [t for t, _ in out], "fret": [f for _, f in out], "width": width}

    return per_group(at, keys, ["time"], kernel, "time double, fret bigint, width bigint")


def gap_spans(parts: dict[str, DataFrame], applied: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, start, stop, kind): unsupported spans of every kind, and the ways between applied regions. Rows: start, stop."""
    by = Window.partitionBy(*keys).orderBy("start")
    between = applied.select(*keys, F.col("stop").alias("start"), F.lead("start").over(by).alias("stop"), F.lit("between_applied_regions").alias("kind")).where(F.col("stop") > F.col("start") + 1e-6)
    out = between.select(*keys, F.col("start").cast("double"), F.col("stop").cast("double"), "kind")
    for kind, rows in parts.items():
        out = out.unionByName(rows.where(F.col("start").isNotNull() & F.col("stop").isNotNull()).select(*keys, F.col("start").cast("double"), F.col("stop").cast("double"), F.lit(kind).alias("kind")))
    return out


# Classes of phrase runs that leave open which performed run a written one is.
RISKY = ("multiple_possible_run_instances", "additional_midi_occurrences", "phrase_count_mismatch", "possible_extra_chart_or_missing_midi_phrase", "probable_complete_run")


def phrase_context(episodes: DataFrame, runs: DataFrame, keys: list[str], width: float = 60.0) -> DataFrame:
    """Episodes (episode, start, stop) with the phrase runs that overlap them.

    Adds ``exact_phrase`` (a matching run with firm boundaries is among them), ``ambiguous_phrase`` (one of the ``RISKY``), ``phrase_runs``
    (sorted) and ``dominant_run``: the run that shares most time, of equal ones the earliest, then the least. ``runs``: run, start, stop,
    classification, boundary_score; an episode comes once in its keys.

    Episodes that begin within a quarter of their key's mean length (``width`` at least) are a block. Runs are dealt out in stretches of
    ``width`` to the blocks that they overlap, about five each, and every episode lists its runs there: the pairs, which grow faster than
    either side, are never shuffled.
    """
    exact = F.coalesce((F.col("classification") == "matching_phrase_run") & (F.col("boundary_score") >= 0.45), F.lit(False))
    other = runs.select(*keys, "run", F.col("start").cast("double").alias("_a"), F.col("stop").cast("double").alias("_z"), exact.alias("_x"), F.coalesce(F.col("classification").isin(*RISKY), F.lit(False)).alias("_y"))
    whole = F.struct(*episodes.columns)
    timed = episodes.select(*keys, F.col("start").cast("double").alias("_s"), F.col("stop").cast("double").alias("_t"), whole.alias("_e"))
    long = F.greatest(F.lit(float(width)), F.avg(F.col("_t") - F.col("_s")).over(Window.partitionBy(*keys)) / 4)
    blocks = timed.withColumn("_block", F.floor(F.col("_s") / long).cast("long"))
    hulls = blocks.groupBy(*keys, "_block").agg(F.min("_s").alias("_from"), F.max("_t").alias("_to"))
    dealt = joins.overlapping(hulls, other, keys, ("_from", "_to"), ("_a", "_z"), width, 1e-9).drop("_from", "_to")
    both = dealt.unionByName(blocks, allowMissingColumns=True)
    own = [*keys, "_block"]
    placed = dealt_by(both, own).sortWithinPartitions(*own, F.col("_e").isNotNull(), "run")
    kinds = {f.name: f.dataType.simpleString() for f in both.schema.fields}
    found = placed.mapInArrow(lambda batches: _contexts(batches, own), f"_e {kinds['_e']}, exact_phrase boolean, ambiguous_phrase boolean, phrase_runs array<{kinds['run']}>, dominant_run {kinds['run']}")
    return found.select(*(f"_e.{c}" for c in dict.fromkeys((*keys, "episode", *episodes.columns))), "dominant_run", "exact_phrase", "ambiguous_phrase", "phrase_runs")


LISTED = 500_000  # runs listed in one batch; an episode with more is a batch of its own


def _contexts(batches: Iterator[pa.RecordBatch], own: list[str]) -> Iterator[pa.RecordBatch]:
    """The episodes of each block with their runs, which come first, sorted; a task holds a block's runs and a batch."""
    held: list[pa.Table] = []
    near: pa.Table | None = None  # the block's runs in one piece, once an episode asks
    last: pd.DataFrame | None = None
    done: list[tuple] = []
    listed = 0

    def made() -> pa.RecordBatch:
        kind = done[0][3].type
        lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum([len(d[3]) for d in done]))).astype(np.int32), pa.concat_arrays([d[3] for d in done]))
        rows = pa.concat_arrays([d[0] for d in done])
        return pa.RecordBatch.from_arrays([rows, pa.array([d[1] for d in done], pa.bool_()), pa.array([d[2] for d in done], pa.bool_()), lists, pa.concat_arrays([d[4] for d in done]).cast(kind)], ["_e", "exact_phrase", "ambiguous_phrase", "phrase_runs", "dominant_run"])

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        names = table.select(own).to_pandas()
        new = np.zeros(len(names), bool)
        new[starts_of(names)] = True
        if last is not None:
            new[0] = starts_of(pd.concat([last, names.head(1)], ignore_index=True))[-1] == 1
        last = names.tail(1)
        asks = table["_e"].is_valid().to_numpy()
        edges = np.flatnonzero(new | np.concatenate(([True], asks[1:] != asks[:-1])))
        for lo, hi in zip(edges.tolist(), [*edges.tolist()[1:], len(names)], strict=True):
            part = table.slice(lo, hi - lo)
            if new[lo]:
                held, near = [], None
            if not asks[lo]:
                held.append(part.select(["run", "_a", "_z", "_x", "_y"]))
                continue
            if near is None:
                near = pa.concat_tables(held or [part.select(["run", "_a", "_z", "_x", "_y"]).slice(0, 0)]).combine_chunks()
                run = pa.concat_arrays(near["run"].chunks) if near["run"].num_chunks else pa.array([], near["run"].type)
                a, z, x, y = (near[c].to_numpy() for c in ("_a", "_z", "_x", "_y"))
                fresh = np.ones(len(run), bool)
                fresh[1:] = pc.fill_null(pc.not_equal(run[1:], run[:-1]), True).to_numpy(zero_copy_only=False)
                rank, known = np.cumsum(fresh), run.is_valid().to_numpy(zero_copy_only=False)
            rows, begin, end = part["_e"].combine_chunks(), part["_s"].to_numpy(), part["_t"].to_numpy()
            rows = rows.chunk(0) if isinstance(rows, pa.ChunkedArray) else rows
            for i in range(len(begin)):
                latest, soonest = np.maximum(a, begin[i]), np.minimum(z, end[i])
                at = np.flatnonzero(latest < soonest + 1e-9)
                shared = soonest[at] - latest[at]
                best = at[shared == shared.max()] if len(at) else at
                best = best[a[best] == a[best].min()] if len(best) else best
                listing = at[known[at]]
                if len(listing):  # a run of several pieces is listed once
                    listing = listing[np.concatenate(([True], np.diff(rank[listing]) > 0))]
                done.append((rows.slice(i, 1), bool(x[at].any()), bool(y[at].any()), run.take(pa.array(listing)), run.take(pa.array(best[:1])) if len(best) else pa.nulls(1, run.type)))
                listed += len(listing)
                if listed >= LISTED or len(done) >= 1000:
                    yield made()
                    done, listed = [], 0
    if done:
        yield made()


def phase_episodes(controls: DataFrame, keys: list[str], gaps: DataFrame, dead: float = 0.045, beat: float = 0.5, roots: DataFrame | None = None, runs: DataFrame | None = None) -> DataFrame:
    """Runs of one direction in which a song's offset moves, with what they amount to, what speaks for an error, and a class. Controls: chart_time, offset, roles (count).

    A step within ``dead`` goes along with the run. ``roots`` (keys, root_valid, root_offset; without it roots count as valid and unknown)
    gives the departure from the root and whether it stays near a whole number of beats; ``runs`` as of ``phrase_context``. Classes:
    stable, correction_and_catch_up (the next steps go back), temporary_correction, probable_occurrence_switch and structurally_unrooted
    (large, without a valid root), persistent_migration (it stays, and something speaks for an error), supported_tempo_evolution (smooth, several
    roles or an exact phrase), provisional_phase_change.
    """

    def kernel(g: pd.DataFrame) -> dict:
        t, o, roles = g["chart_time"].to_numpy(float), g["offset"].to_numpy(float), g["roles"].to_numpy(int)
        delta = np.diff(o)
        sign = np.where(delta > dead, 1, np.where(delta < -dead, -1, 0))
        runs: list[list[int]] = []
        way = 0
        for i, s in enumerate(sign.tolist()):
            if runs and (s == 0 or way in (0, s)):
                runs[-1].append(i)
                way = way or s
            else:
                runs.append([i])
                way = s
        out = []
        for number, r in enumerate(runs):
            moved, step = float(delta[r].sum()), np.abs(delta[r])
            after = o[r[-1] + 2 : r[-1] + 6]
            back = bool(len(after) and np.abs(after - o[r[0]]).min() < abs(o[r[-1] + 1] - o[r[0]]) * 0.45)
            stays = bool(np.median(np.abs(after - o[r[-1] + 1])) <= max(0.12, abs(moved) * 0.35)) if len(after) else len(r) >= 3 and abs(moved) >= 0.30
            out.append((number, t[r[0]], t[r[-1] + 1], moved, abs(moved) / beat, float(step.max()), float(np.median(step)), len(r), int(roles[r[0] + 1 : r[-1] + 2].max()), back, stays, o[r[0]], o[r[-1] + 1]))
        names = ("episode", "start", "stop", "moved", "beats", "largest_step", "median_step", "steps", "role_count", "returns", "persists", "entry_offset", "exit_offset")
        return dict(zip(names, zip(*out, strict=True) if out else ([] for _ in names), strict=True))

    made = per_group(controls, keys, ["chart_time"], kernel, "episode bigint, start double, stop double, moved double, beats double, largest_step double, median_step double, steps bigint, role_count bigint, returns boolean, persists boolean, entry_offset double, exit_offset double")
    near = joins.nearest_span(made, gaps, keys, "episode", ("start", "stop"), ("start", "stop"), "kind", 15.0).withColumn("near_gap", F.col("near_distance").isNotNull())
    if roots is None:
        near = near.withColumn("root_valid", F.lit(True)).withColumn("root_offset", F.lit(None).cast("double"))
    else:
        near = near.join(roots.select(*keys, "root_valid", F.col("root_offset").cast("double").alias("root_offset")), keys, "left").withColumn("root_valid", F.coalesce("root_valid", F.lit(False)))
    if runs is None:
        near = near.withColumn("exact_phrase", F.lit(False)).withColumn("ambiguous_phrase", F.lit(False)).withColumn("phrase_runs", F.array().cast("array<bigint>")).withColumn("dominant_run", F.lit(None).cast("bigint"))
    else:
        near = phrase_context(near, runs, keys)
    length = F.col("stop") - F.col("start")
    departure = (F.col("exit_offset") - F.col("root_offset")) / beat
    near = near.withColumn("root_departure", F.col("exit_offset") - F.col("root_offset")).withColumn("root_beats", departure).withColumn("plateau_error", F.abs(departure - F.rint(departure)))
    near = near.withColumn("plateau", F.coalesce((F.abs(F.rint("root_beats")) >= 1) & (F.col("plateau_error") <= 0.16), F.lit(False)) & F.col("persists"))
    near = near.withColumn("rate", F.col("moved") / F.greatest(length, F.lit(1e-9)))
    near = near.withColumn("smooth", (F.col("steps") >= 3) & (F.col("largest_step") <= 0.22) & (F.col("median_step") <= 0.12) & (F.abs("rate") <= 0.055)).withColumn("abrupt", (F.col("largest_step") >= 0.32) | (F.col("largest_step") / beat >= 0.70))
    smooth, abrupt, plateau, several = F.col("smooth"), F.col("abrupt"), F.col("plateau"), F.col("role_count") >= 2
    exact, ambiguous, large = F.col("exact_phrase"), F.col("ambiguous_phrase"), F.col("beats") >= 0.70
    lone = ~several & large
    wrong = abrupt | plateau | ambiguous | F.col("near_gap") | lone
    kind = (
        F.when(F.abs("moved") < 0.12, "stable").when(F.col("returns"), "correction_and_catch_up").when((length <= 8) & ~F.col("persists"), "temporary_correction")
        .when(~F.col("root_valid") & F.col("near_gap") & large & F.col("persists"), "probable_occurrence_switch").when(~F.col("root_valid") & large, "structurally_unrooted")
        .when(smooth & several & ~ambiguous & ~plateau & ~abrupt, "supported_tempo_evolution").when(exact & smooth & ~plateau & ~abrupt, "supported_tempo_evolution")
        .when(F.col("persists") & wrong, "persistent_migration").when((length >= 20) & smooth, "supported_tempo_evolution").otherwise("provisional_phase_change")
    )
    part = lambda condition, worth: F.when(condition, worth).otherwise(0.0)
    error = 0.08 + part(abrupt, 0.30) + part(plateau, 0.28) + part(ambiguous, 0.22) + part(F.col("near_gap"), 0.24) + part(lone, 0.18) + part(F.col("persists"), 0.12) - part(exact & ~ambiguous, 0.12)
    reasons = {"smooth_directional_evolution": smooth, "multi_role_support": several, "abrupt_phase_step": abrupt, "persistent_metrical_plateau": plateau, "repeated_structure_ambiguity": ambiguous, "exact_phrase_ordinal_support": exact, "near_unsupported_or_recovery_gap": F.col("near_gap")}
    out = near.withColumn("classification", kind).withColumn("reasons", F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in reasons.items()))))
    out = out.withColumn("movement_confidence", F.least(F.lit(1.0), 0.30 + 0.09 * F.least("steps", F.lit(5)) + part(several, 0.20) + part(smooth, 0.10))).withColumn("phase_error_confidence", F.greatest(F.lit(0.0), F.least(F.lit(1.0), error)))
    migrates = F.col("classification") == "persistent_migration"
    severe = F.when(migrates & ((F.col("beats") >= 1.5) | plateau), 5).when(migrates | F.col("classification").isin("structurally_unrooted", "probable_occurrence_switch"), 4).when(F.col("classification").isin("correction_and_catch_up", "provisional_phase_change"), 3).otherwise(1)
    return out.withColumn("severity", severe)


def region_samples(segments: DataFrame, samples: DataFrame, keys: list[str], width: float = 32.0) -> DataFrame:
    """Samples (t, residual_ms, family) inside each region (region, start, stop): count, span, median and MAD, and the number of families."""
    met = joins.members_of(segments.select(*keys, "region", "start", "stop"), samples, keys, "start", "stop", "t", width)
    own = [*keys, "region"]
    centre = met.groupBy(*own).agg(F.count("*").alias("n"), (F.max("t") - F.min("t")).alias("span"), F.median("residual_ms").alias("median"), F.count_distinct("family").alias("families"))
    spread = met.join(centre.select(*own, F.col("median").alias("_m")), own).groupBy(*own).agg(F.median(F.abs(F.col("residual_ms") - F.col("_m"))).alias("mad"))
    return segments.join(centre.join(spread, own), own, "left").na.fill(0, ["n", "families"])


def audit(matches: DataFrame, keys: list[str], source: str, least: float = 0.72) -> DataFrame:
    """Per source how many events were asked, heard, heard well and heard more than once. Matches: candidates (count), confidence (null: none)."""
    return matches.groupBy(*keys, source).agg(F.count("*").alias("events"), F.count_if(F.col("candidates") > 0).alias("matched"), F.count_if(F.col("confidence") >= least).alias("strong"), F.count_if(F.col("candidates") > 1).alias("ambiguous"))


def shift_candidates(gaps: DataFrame, keys: list[str], sizes: tuple[int, ...] = (4, 8), shifts: int = 8, starts: int = 4) -> DataFrame:
    """(keys, gap, size, start, shift): where windows of each size in a gap (first, last measure) could have been moved to, by up to ``shifts`` measures.

    Of many starts four evenly spaced ones are taken, as the operator has it.
    """
    from timeloom.functions import vectors

    sized = gaps.select(*keys, "gap", "first", "last", F.explode(F.array(*(F.lit(s) for s in sizes))).alias("size")).where(F.col("last") - F.col("first") + 1 >= F.col("size"))
    begun = sized.withColumn("start", F.explode(vectors.spread_subset(F.sequence("first", F.col("last") - F.col("size") + 1), F.lit(starts))))
    moves = [s for s in range(-shifts, shifts + 1) if s]
    return begun.select(*keys, "gap", "size", "start", F.explode(F.array(*(F.lit(s) for s in moves))).alias("shift"))


def persistent(scores: DataFrame, keys: list[str], order: str, score: str, rival: str, fewest: int = 2, share: float = 0.5) -> DataFrame:
    """Per cluster how many of its sliding windows beat every competing shift, the longest such run, and whether that persists."""
    runs = islands.runs(scores.withColumn("_won", F.coalesce(F.col(score) > F.col(rival), F.lit(False))), keys, [order], F.col("_won"))
    length = runs.groupBy(*keys, "run_no").agg(F.first("_won").alias("_won"), F.count("*").alias("_n"))
    got = length.groupBy(*keys).agg(F.sum("_n").alias("windows"), F.coalesce(F.sum(F.when(F.col("_won"), F.col("_n"))), F.lit(0)).alias("won"), F.coalesce(F.max(F.when(F.col("_won"), F.col("_n"))), F.lit(0)).alias("longest"))
    return got.withColumn("persistent", (F.col("longest") >= fewest) & (F.col("won") >= F.col("windows") * share))


def chroma_search(scored: DataFrame, keys: list[str], residual: str, score: str, apart: float = 0.10) -> DataFrame:
    """Best residual of each source (keys), the best distinct one, the score without a shift, and the reasons why it is not accepted. Rows: one a residual tried."""
    from timeloom.operators import gates

    by = Window.partitionBy(*keys)
    top = scored.withColumn("_b", F.max_by(residual, F.struct(score, (-F.abs(F.col(residual))))).over(by))
    got = top.groupBy(*keys).agg(F.first("_b").alias("residual"), F.max(score).alias("best"), F.max(F.when(F.abs(F.col(residual) - F.col("_b")) >= apart, F.col(score))).alias("second"), F.min_by(score, F.abs(F.col(residual))).alias("unshifted"))
    got = got.withColumn("margin", F.col("best") - F.coalesce("second", F.lit(0.0))).withColumn("gain", F.col("best") - F.col("unshifted"))
    return gates.with_reasons(got, {"low_chroma_similarity": F.col("best") < 0.55, "insufficient_margin": F.col("margin") < 0.10, "insufficient_gain": F.col("gain") < 0.025, "excessive_residual": F.abs("residual") > 0.250})


def checkpoint_sources(found: DataFrame, keys: list[str], source: str, most: float = 0.050) -> DataFrame:
    """Per checkpoint (keys) the median residual of accepted sources, their spread, and whether they agree; one source alone is weak."""
    got = found.where("accepted").groupBy(*keys).agg(F.median("residual").alias("residual"), (F.max("residual") - F.min("residual")).alias("spread"), F.array_sort(F.collect_set(source)).alias("sources"))
    return got.withColumn("strength", F.when(F.size("sources") < 2, "single").when(F.col("spread") <= most, "strong").otherwise("disagreeing"))


def widen(search: Callable[[float], DataFrame], trusted: Callable[[DataFrame], int], first: float, wanted: int, most: float = 4.0) -> tuple[DataFrame, list[tuple[float, int]]]:
    """Searches with a radius that doubles until enough is trusted or it passes ``most``; the last result, and the radii tried. A few rounds, each one job."""
    tried: list[tuple[float, int]] = []
    radius, found = first, None
    while found is None or (radius <= most + 1e-9 and tried[-1][1] < wanted):
        found = search(radius)
        tried.append((radius, trusted(found)))
        radius *= 2
    return found, tried
