import numpy as np
import pytest
from pyspark.sql import functions as F

from timeloom.functions import notation, robust, vectors
from timeloom.operators import islands, refine


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_beat_grid_and_hand(spark):
    bars = spark.createDataFrame([(1, 0.0, 4), (1, 2.0, 2), (1, 4.0, 4)], "g int, t double, n int")
    spans = spark.createDataFrame([(1, 9, 1.25, 3.0)], "g int, id int, start double, end double")
    assert rows(refine.beat_grid(bars, spans, ["g"], "id", "t", "n")) == [(1, 9, 1.25, 1.5, 0.5), (1, 9, 1.5, 2.0, 1.0), (1, 9, 2.0, 3.0, 1.0)]
    notes = spark.createDataFrame([(1, 0.0, 3), (1, 0.0, 5), (1, 1.0, 6), (1, 2.0, 7), (1, 3.0, 0), (1, 4.0, 2), (1, 5.0, None)], "g int, t double, f int")
    assert rows(refine.hand_positions(notes, ["g"], "t", "f")) == [(1, 0.0, 3, 4), (1, 2.0, 7, 4), (1, 3.0, 1, 4)]


def test_maps_fall_back(spark):
    bars = spark.createDataFrame([(g, 10.0 * i, 10.0 * i + 1) for g in (1, 2) for i in range(6)], "g int, t double, base double")
    anchors = spark.createDataFrame([(1, 10.0, 11.5, 11.0), (1, 30.0, 32.0, 31.0), (1, 40.0, 41.0, 41.0), (2, 10.0, 11.0, 11.0)], "g int, x double, y double, base double")
    manual = spark.createDataFrame([(1, 30.02, 31.0, 31.02)], "g int, x double, y double, base double")
    got = {(r.g, r.t): (round(r.mapped, 2), r.applied) for r in refine.continuous_map(anchors, bars, ["g"], manual).collect()}
    assert got[1, 10.0] == (11.5, True) and got[1, 0.0] == (1.0, True) and abs(got[1, 30.0][0] - 30.98) < 0.02 and got[2, 10.0] == (11.0, False)
    segments = spark.createDataFrame([(1, 0, 10.0, 30.0, True), (2, 0, 10.0, 30.0, True), (2, 1, 20.0, 40.0, True)], "g int, segment int, start double, stop double, accepted boolean")
    controls = spark.createDataFrame([(1, 0, 20.0, 0.1), (2, 0, 20.0, 0.1)], "g int, segment int, x double, r double")
    done = {(r.g, r.t): (round(r.mapped, 2), r.applied) for r in refine.selective_map(segments, controls, bars, ["g"]).collect()}
    assert done[1, 20.0] == (21.1, True) and done[1, 40.0] == (41.0, True) and done[2, 20.0] == (21.0, False)


def test_segment_warping(spark):
    t = np.arange(60) * 0.1
    bump = lambda c: np.exp(-0.5 * ((t - c) / 0.2) ** 2)
    series = spark.createDataFrame([(1, "drums", float(a), float(p), float(h)) for a, p, h in zip(t, bump(3.0), bump(3.4), strict=True)], "seg int, src string, t double, predicted double, heard double")
    got = refine.warp_segments(series, ["seg"], "src", 8.0, 0.0, 0.0).orderBy("x").collect()
    assert got[0].r == 0 and got[-1].r == 0 and max(r.r for r in got) == pytest.approx(0.4, abs=0.11)
    metrics = [(1, "a", 30.0, 10.0, 60.0, 20.0, None, 1), (1, "b", 30.0, 12.0, 60.0, 20.0, 5.0, 3), (1, "c", 30.0, 28.0, 60.0, 20.0, None, 1), (1, "d", 30.0, 1.0, 60.0, 20.0, -50.0, 1)]
    df = spark.createDataFrame(metrics, "seg int, src string, base_median double, median double, base_p95 double, p95 double, held_gain double, corroborating int")
    assert {r.src: (r.state, r.chosen) for r in refine.select_sources(df, ["seg"], "src").collect()} == {"a": ("would_apply", True), "b": ("would_apply", False), "c": ("rejected_no_meaningful_improvement", False), "d": ("rejected_held_out_degradation", False)}


def test_phase_reports(spark):
    offsets = [0.0, 0.01, 0.5, 0.5, 0.5, 0.5, 0.0, 0.0]
    controls = spark.createDataFrame([(1, 10.0 * i, o, 1) for i, o in enumerate(offsets)], "g int, chart_time double, offset double, roles int")
    regions = spark.createDataFrame([(1, 0.0, 12.0), (1, 18.0, 30.0)], "g int, start double, stop double")
    gaps = refine.gap_spans({"phase_gap": regions.limit(0)}, regions, ["g"])
    assert rows(gaps) == [(1, 12.0, 18.0, "between_applied_regions")]
    made = [(r.start, r.stop, r.moved, r.near_gap, r.classification) for r in refine.phase_episodes(controls, ["g"], gaps).orderBy("episode").collect()]
    assert made == [(0.0, 50.0, 0.5, True, "correction_and_catch_up"), (50.0, 70.0, -0.5, False, "provisional_phase_change")]
    roots = spark.createDataFrame([(1, False, 0.0)], "g int, root_valid boolean, root_offset double")
    said = spark.createDataFrame([(1, 7, 40.0, 60.0, "matching_phrase_run", 0.5), (1, 8, 45.0, 50.0, "phrase_count_mismatch", 0.9), (1, 9, 70.0, 80.0, "matching_phrase_run", 0.9)], "g int, run long, start double, stop double, classification string, boundary_score double")
    whole = refine.phase_episodes(controls, ["g"], gaps.limit(0), roots=roots, runs=said).orderBy("episode").collect()
    assert [(r.phrase_runs, r.dominant_run, r.exact_phrase, r.ambiguous_phrase) for r in whole] == [([7, 8], 7, True, True), ([7, 8, 9], 7, True, True)]  # spans that touch count
    assert [(r.root_departure, r.plateau, r.classification, r.severity) for r in whole] == [(0.5, False, "correction_and_catch_up", 3), (0.0, False, "structurally_unrooted", 4)]
    assert whole[0].reasons == ["abrupt_phase_step", "repeated_structure_ambiguity", "exact_phrase_ordinal_support"] and round(whole[0].phase_error_confidence, 3) == 0.78
    runs = spark.createDataFrame([(1, i, s, 0.5) for i, s in enumerate([0.6, 0.7, 0.4, 0.6])], "g int, i int, s double, r double")
    assert rows(refine.persistent(runs, ["g"], "i", "s", "r")) == [(1, 4, 3, 2, True)]
    gap = spark.createDataFrame([(1, 0, 10, 29)], "g int, gap int, first int, last int")
    tried = refine.shift_candidates(gap, ["g"])
    assert tried.count() == 2 * 4 * 16 and {r.start for r in tried.where("size = 4").collect()} == {10, 15, 21, 26}
    samples = spark.createDataFrame([(1, 1.0, 5.0, "a"), (1, 2.0, 7.0, "b"), (1, 9.0, 1.0, "a")], "g int, t double, residual_ms double, family string")
    span = spark.createDataFrame([(1, 0, 0.0, 5.0), (1, 1, 20.0, 25.0)], "g int, region int, start double, stop double")
    assert [(r.region, r.n, r.median, r.mad, r.families) for r in refine.region_samples(span, samples, ["g"]).orderBy("region").collect()] == [(0, 2, 6.0, 1.0, 2), (1, 0, None, None, 0)]


def test_searches(spark):
    scored = spark.createDataFrame([(1, "piano", r / 100, 0.9 - abs(r - 5) / 20) for r in range(-30, 31)], "cp int, src string, res double, s double")
    got = refine.chroma_search(scored, ["cp", "src"], "res", "s").first()
    assert (got.residual, got.best, got.accepted) == (0.05, 0.9, True)
    both = refine.checkpoint_sources(spark.createDataFrame([(1, "a", 0.05, True), (1, "b", 0.08, True), (2, "a", 0.1, True), (3, "a", 0.1, False)], "cp int, src string, residual double, accepted boolean"), ["cp"], "src")
    assert {r.cp: r.strength for r in both.collect()} == {1: "strong", 2: "single"}
    found, tried = refine.widen(lambda r: spark.range(int(r)), lambda d: d.count(), 1.0, 3)
    assert found.count() == 4 and tried == [(1.0, 1), (2.0, 2), (4.0, 4)]
    audited = refine.audit(spark.createDataFrame([(1, "a", 0, None), (1, "a", 2, 0.8)], "g int, src string, candidates int, confidence double"), ["g"], "src")
    assert rows(audited) == [(1, "a", 2, 1, 1, 1)]


def test_grids_and_sections(spark):
    points = spark.createDataFrame([(1, 0.0, 0, "fixed"), (1, 40.0, 20, "B"), (1, 40.03, 20, "A"), (1, 50.0, 25, "fixed")], "g int, t double, m int, tier string")
    bars = spark.createDataFrame([(1, m, 2.0 * m) for m in range(26)], "g int, measure int, start double")
    assert rows(islands.control_grid(points, bars, ["g"], "t", "m", "tier")) == [(1, 0.0, 0, "fixed"), (1, 16.0, 8, "computational"), (1, 32.0, 16, "computational"), (1, 40.0, 20, "A"), (1, 50.0, 25, "fixed")]
    ends = spark.createDataFrame([(1, 10.0)], "g int, end double")
    marks = spark.createDataFrame([(1, 1.0), (1, 3.0), (1, 4.0), (1, 9.5), (1, 12.0)], "g int, t double")
    assert [r.t for r in islands.boundaries(marks, ends, ["g"], "t").orderBy("t").collect()] == [0.0, 3.0, 9.5, 10.0]
    sections = spark.createDataFrame([(1, 0.0, 10.0, "good", 0.8), (1, 10.0, 20.0, "good", 0.6), (1, 20.0, 30.0, "good", 0.5), (1, 30.0, 45.0, "good", 0.5), (1, 45.0, 50.0, "weak", 0.1)], "g int, a double, z double, q string, c double")
    assert [(r.a, r.z, round(r.c, 3), r.n) for r in islands.merge_sections(sections, ["g"], "a", "z", ["q"], "c").orderBy("a").collect()] == [(0.0, 30.0, 0.6, 3), (30.0, 45.0, 0.5, 1), (45.0, 50.0, 0.1, 1)]
    gaps = spark.createDataFrame([(1, "drums", 0.0, 4.0), (1, "bass", 1.0, 9.0), (1, "piano", 5.0, 8.9), (1, "piano", 20.0, 20.2)], "g int, role string, start double, stop double")
    assert rows(islands.silence_checkpoints(gaps, ["g"], "role", 0.5)) == [(1, 4.0, 0.0, ["drums"]), (1, 8.9, 5.0, ["bass", "piano"])]
    onsets = spark.createDataFrame([(1, 2.0 * m + 0.25 * k) for m in range(8) for k in range(m % 4 + 1)], "g int, t double")
    measures = spark.createDataFrame([(1, m, m, 2.0 * m, 2.0 * m + 2, 2.0) for m in range(8)], "g int, measure int, index int, start double, end double, duration double")
    assert [(r.measure, r.n) for r in islands.dense_landmarks(onsets, measures, ["g"], "t").orderBy("measure").collect()] == [(2, 3), (6, 3)]


def test_columns(spark):
    one = spark.range(1)
    value = lambda c: one.select(c.alias("x")).first().x
    points = F.array(*(F.struct(F.lit(p).cast("double").alias("position"), F.lit(v).cast("double").alias("value")) for p, v in ((0.0, 0.0), (30.0, 4.0), (30.0, 4.0), (90.0, 2.0))))
    assert [(p.t, p.v) for p in value(notation.bend_curve(points, F.lit(2.0), 60.0))] == [(0.0, 0.0), (1.0, 2.0), (2.0, 1.0)]
    note = {"legato": F.lit(True), "fret": F.lit(7), "harmonic": F.lit("Pinch_Harmonic"), "slide": F.lit("OutDown"), "bend_points": points, "bend": F.lit("Prebend-Release"), "pick": F.lit("Up"), "finger": F.lit("ring")}
    got = value(notation.techniques(note, F.lit(2.0), F.lit(5)))
    assert (got.po, got.ho, got.hp, got.slu, got.sl, got.bn, got.bt, got.pkd, got.fg, got.pm) == (True, None, True, 5, None, 2.0, 3, 1, 3, None)
    assert value(vectors.lagged_cosine(F.array(*(F.lit(float(v)) for v in (0, 0, 1, 0, 0, 0, 2, 0, 0, 0, 0, 0))), F.array(*(F.lit(float(v)) for v in (0, 0, 0, 1, 0, 0, 0, 2, 0, 0, 0, 0))), 2)) == pytest.approx(1.0)
    assert value(vectors.spread_subset(F.sequence(F.lit(0), F.lit(9)), F.lit(4))) == [0, 3, 6, 9]
    assert value(vectors.kit_agreement(F.array(F.lit("kick"), F.lit("ride")), F.array(F.lit("kick")))) == pytest.approx(1.25 / 2.25)
    line = spark.createDataFrame([(1, float(i), 2.0 * i + (50 if i == 3 else 0)) for i in range(12)], "g int, x double, y double")
    fit = robust.trimmed_line(line, ["g"], "x", "y").first()
    assert (fit.slope, fit.n, round(fit.median_residual, 6)) == (2.0, 11, 0.0)
    assert rows(robust.median_path(spark.createDataFrame([(1, 0, 1.0), (1, 0, 3.0), (1, 1, 5.0)], "g int, x int, y double"), ["g"], "x", "y")) == [(1, 0, 2.0), (1, 1, 5.0)]


@pytest.mark.parametrize("seed", range(3))
def test_phrase_context_lists_runs_without_shuffled_pairs(spark, seed):
    rng = np.random.default_rng(seed)
    kinds = ["matching_phrase_run", "phrase_count_mismatch", "other"]
    episodes = [(int(rng.integers(0, 3)), k, float(s), float(s + rng.choice([0, 3, 40, 300]))) for k, s in enumerate(rng.integers(0, 600, 60))] + [(9, 100, 0.0, 50.0), (0, 101, None, None)]
    runs = [(int(rng.integers(0, 3)), int(rng.integers(0, 150)), float(s), float(s + rng.integers(0, 60)), kinds[int(rng.integers(0, 3))], float(rng.choice([0.2, 0.45]))) for s in rng.integers(0, 700, 200)] + [(1, 999, None, 5.0, "other", None)]
    got = refine.phrase_context(spark.createDataFrame(episodes, "g int, episode int, start double, stop double"), spark.createDataFrame(runs, "g int, run int, start double, stop double, classification string, boundary_score double"), ["g"], [7.0, 60.0, 5000.0][seed])
    assert "collect_set" not in got._jdf.queryExecution().executedPlan().toString()
    want = []
    for g, e, s, t in episodes:
        met = [r for r in runs if r[0] == g and None not in (s, r[2]) and max(s, r[2]) < min(t, r[3]) + 1e-9]
        dominant = min(met, key=lambda r: (-(min(t, r[3]) - max(s, r[2])), r[2], r[1]))[1] if met else None
        want.append((g, e, s, t, dominant, any(r[4] == kinds[0] and r[5] >= 0.45 for r in met), any(r[4] in refine.RISKY for r in met), sorted({r[1] for r in met})))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == sorted(want, key=lambda r: r[1])
