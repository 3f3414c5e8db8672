import itertools

import numpy as np
import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from timeloom import plans
from timeloom.operators import islands, section_fit, sequence


def brute_dtw(a, b, band, turn, repeat):
    n, m = len(a), len(b)
    inside = lambda i, j: abs(j - i * (m - 1) / max(1, n - 1)) <= band
    best = {}

    def walk(i, j):
        if (i, j) not in best:
            cost = abs(a[i] - b[j])
            out = [cost if (i, j) == (0, 0) and inside(0, 0) else np.inf, np.inf, np.inf]
            for kind, (di, dj) in enumerate(((1, 1), (1, 0), (0, 1))):
                if inside(i, j) and i >= di and j >= dj and (i or j):
                    before = walk(i - di, j - dj)
                    out[kind] = min(out[kind], min(w + turn * (k != kind) for k, w in enumerate(before)) + cost + repeat * (kind > 0))
            best[i, j] = out
        return best[i, j]

    return min(walk(n - 1, m - 1))


@pytest.mark.parametrize("seed", range(25))
def test_banded_dtw_against_recursion(seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 6, rng.integers(1, 9)).astype(float), rng.integers(0, 6, rng.integers(1, 9)).astype(float)
    band, turn, repeat = rng.choice([0.5, 1.0, 2.5, 20.0]), rng.choice([0.0, 0.5]), rng.choice([0.0, 0.25])
    cost, steps = sequence.banded_dtw(a, b, band, turn, repeat)
    want = brute_dtw(a, b, band, turn, repeat)
    assert cost == pytest.approx(want) or (np.isinf(cost) and np.isinf(want))
    if np.isfinite(cost):
        assert steps[0] == (0, 0) and steps[-1] == (len(a) - 1, len(b) - 1)
        kinds = [{(1, 1): 0, (1, 0): 1, (0, 1): 2}[q[0] - p[0], q[1] - p[1]] for p, q in itertools.pairwise(steps)]
        whole = sum(abs(a[i] - b[j]) for i, j in steps) + repeat * sum(k > 0 for k in kinds) + turn * sum(x != y for x, y in itertools.pairwise([0, *kinds]))
        assert whole == pytest.approx(cost)


def test_band_is_narrow_in_memory():
    a = np.sin(np.arange(4000) / 30)
    assert sequence.banded_dtw(a, a, 8.0)[0] == 0.0


def song(spark):
    rng = np.random.default_rng(3)
    bars = [(1, i, i * 2.5, (i + 1) * 2.5) for i in range(16)]
    times = np.sort(rng.choice(np.arange(0, 40, 0.25), 90, replace=False))
    notes = [(1, "bass", float(t), [int(rng.integers(30, 60))]) for t in times]
    played = [(s, r, 0.4 + 1.02 * t, p) for s, r, t, p in notes]
    schema = "song int, role string, time double, symbols array<int>"
    return spark.createDataFrame(bars, "song int, index int, start double, end double"), spark.createDataFrame(notes, schema), spark.createDataFrame(played, schema)


def full_grid(start, end, expected, times, sets, context, heard, heard_sets, fit):
    """Every transform of the grid aligned on its own."""
    rows, number = [], 0
    for stretch in fit.stretch[0] + fit.stretch[2] * np.arange(round((fit.stretch[1] - fit.stretch[0]) / fit.stretch[2]) + 1):
        for target in expected - fit.radius + fit.step * np.arange(round(2 * fit.radius / fit.step) + 1):
            number += 1
            shift, margin = target - stretch * start, max(0.5, fit.maximum * 2)
            lo, hi = np.searchsorted(heard, shift + stretch * start - margin, side="left"), np.searchsorted(heard, shift + stretch * end + margin, side="right")
            if hi - lo < fit.fewest:
                continue
            whole, pairs = sequence.align(sequence.agreements(sets, heard_sets[lo:hi]), *fit.skips)
            if len(pairs) < fit.fewest:
                continue
            off = np.array([abs(heard[lo + j] - (shift + stretch * times[i])) for i, j in pairs])
            coverage, around = len({i for i, _ in pairs}) / len(times), section_fit._step_likeness(section_fit._lowest(context), section_fit._lowest(heard_sets[lo:hi]))
            if coverage >= fit.coverage and np.median(off) <= fit.median and off.max() <= fit.maximum:
                score = 0.58 * whole / len(times) + 0.20 * coverage + 0.10 * np.exp(-np.median(off) / 0.12) + fit.context_weight * around
                rows.append((shift + stretch * start, stretch, len(pairs), coverage, float(np.median(off)), float(off.max()), score, number))
    rows.sort(key=lambda r: (-round(r[6], 12), -r[3], round(r[4], 12), r[7]))
    kept = []
    for r in rows:
        if all(abs(r[0] - o[0]) >= fit.apart for o in kept):
            kept.append(r)
    return kept[: fit.most]


@pytest.mark.parametrize("seed", range(10))
def test_pruned_placements_equal_the_full_grid(seed):
    rng = np.random.default_rng(seed)
    fit = section_fit.Fit(radius=1.5, stretch=(0.94, 1.06, 0.02), step=0.1, apart=[0.75, 0.2][seed % 2], median=[0.12, 0.3][seed % 2], maximum=[0.35, 0.6][seed % 2], coverage=[0.5, 0.3][seed // 5])
    n = int(rng.integers(5, 14))
    times = np.sort(rng.random(n) * 9) + 20
    pitches = rng.integers(40, 40 + int(rng.choice([3, 12])), n)
    played = [(0.3 + 1.02 * t + rng.normal() * 0.03, p) for t, p in zip(times, pitches, strict=True) if rng.random() < 0.9] + [(float(t), int(p)) for t, p in zip(rng.random(12) * 16 + 17, rng.integers(40, 52, 12), strict=True)]
    played.sort()
    heard, heard_sets = np.array([t for t, _ in played]), [np.array([p]) for _, p in played]
    sets = [np.array([p]) for p in pitches]
    args = (20.0, 29.0, 20.2, times, sets, sets, heard, heard_sets, fit)
    got, want = section_fit.evaluate(*args), full_grid(*args)
    assert [g[4] for g in got] == [w[2] for w in want]
    assert np.allclose([(g[0], g[2], g[5], g[6], g[7], g[10]) for g in got] or [()], [(w[0], w[1], w[3], w[4], w[5], w[6]) for w in want] or [()])


def test_section_fit_finds_a_known_map(spark):
    bars, written, performed = song(spark)
    made = [r.asDict() for r in section_fit.windows(bars, ["song"]).orderBy("window").collect()]
    assert made[0]["first"] == 0 and made[-1]["last"] == 15 and all(b["first"] == a["last"] for a, b in itertools.pairwise(made))
    got = sorted((r.chart_time, r.midi_time) for r in section_fit.fit_sections(bars, written, performed, ["song"], "role").collect())
    assert len(got) >= 8 and all(b[0] > a[0] and b[1] > a[1] for a, b in itertools.pairwise(got))
    assert max(abs(m - (0.4 + 1.02 * t)) for t, m in got) < 0.25  # the grid steps by 0.1 s and 1 %


def test_materialise_cuts_bad_edges(spark):
    rows = [(1, 0, float(t), float(t) + 0.5 + (3.0 if t >= 40 else 0.0), float(t), "multi_role_corroborated", 20) for t in range(0, 80, 8)]
    controls = spark.createDataFrame(rows, "song int, region int, chart_time double, midi_time double, base double, classification string, measures int")
    got = section_fit.materialise(controls, ["song"]).orderBy("x").collect()
    assert [r.x for r in got][:5] == [0, 8, 16, 24, 32] and {r.fragment for r in got} >= {0}
    assert all(q.y > p.y for p, q in itertools.pairwise(got))


def test_empty_inputs(spark):
    bars, written, performed = song(spark)
    assert section_fit.fit_sections(bars.limit(0), written.limit(0), performed, ["song"], "role").count() == 0


def test_windows_gathered_at_once_are_placed_alike(spark):
    bars, written, performed = song(spark)
    made = section_fit.windows(bars, ["song"])
    groups = written.withColumn("side", F.lit("written")).unionByName(performed.withColumn("side", F.lit("performed")))
    got = section_fit.placements(section_fit.gathered(made, groups, ["song"], "role"), ["song"], "role")
    want = section_fit.candidates(section_fit.with_groups(made, written, ["song"], "role").withColumn("expected", F.col("start")), performed, ["song"], "role")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(got) == rows(want) != []


def test_section_candidates_makes_each_step_once(spark):
    """Windows, onset groups and placements are a kernel each; repeated steps were most of the query's time."""
    plan = plans.QUERIES["section_candidates"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInPandas") == 3


def raw_song(spark):
    """The song's onsets a few at once and one twice, with rows that belong nowhere."""
    bars, written, performed = song(spark)
    notes = written.withColumn("side", F.lit("written")).unionByName(performed.withColumn("side", F.lit("performed")))
    more = notes.where("time < 20").withColumn("time", F.col("time") + 0.02).withColumn("symbols", F.transform("symbols", lambda x: x + 3))
    odd = spark.createDataFrame([(1, "bass", None, [40], "written"), (1, "bass", 3.0, None, "written"), (1, "bass", 3.0, [], "performed"), (None, "bass", 3.0, [40], "written"), (1, None, 3.0, [40], "written"), (2, "bass", 3.0, [40], "performed")], notes.schema)
    notes = notes.unionByName(more).unionByName(notes.limit(9)).unionByName(odd)
    roles = bars.join(notes.select("song", "role").distinct(), "song")
    return bars, notes, section_fit.role_rows(roles, notes, ["song"], "role")


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def placed_in_steps(bars, notes):
    groups = islands.onset_groups(notes, ["song", "role", "side"], "time", "symbols", 0.03)
    return section_fit.placements(section_fit.gathered(section_fit.windows(bars, ["song"]), groups, ["song"], "role"), ["song"], "role")


def test_roles_are_placed_as_in_steps(spark):
    bars, notes, rows = raw_song(spark)
    got, want = section_fit.placed_roles(rows, ["song"], "role", 0.03), placed_in_steps(bars, notes)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert rows_of(got) == rows_of(want) != []


def test_a_role_is_dealt_out_once(spark):
    """Joins and exchanges between the kernels of section_candidates were most of what was left of its time."""
    plan = plans.QUERIES["section_candidates"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 0 and plan.count("RepartitionByExpression") == 1


def test_slices_that_begin_together_share_a_table(monkeypatch):
    rng = np.random.default_rng(5)
    table, aligned = rng.random((9, 40)), []
    accumulate = sequence.alignment_tables
    monkeypatch.setattr(sequence, "alignment_tables", lambda similarity, first, *more: aligned.extend(first.tolist()) or accumulate(similarity, first, *more))
    slices = [(lo, hi) for lo in (0, 3, 11) for hi in range(lo + 5, 40, 4)]
    assert sequence.align_slices(table, slices, 0.22, 0.025) == [sequence.align(table[:, lo:hi], 0.22, 0.025) for lo, hi in slices]
    assert aligned == [0, 3, 11]


def test_a_way_back_ends_outside_its_runs():
    """A slice whose matches no transform reaches was followed to its first row."""
    rng = np.random.default_rng(6)
    similarity = rng.random((12, 30))
    score, pairs = sequence.align(similarity, 0.22, 0.025)
    table = sequence.alignment_tables(similarity, np.array([0]), np.array([30]), 0.22, 0.025)[0]
    around = dict(pairs)
    least, most = [around.get(i, 0) for i in range(12)], [around.get(i, 29) + 1 for i in range(12)]
    assert sequence.aligned_run(table, 12, 30) == sequence.aligned_run(table, 12, 30, (least, most)) == (score, pairs)
    least[pairs[-1][0]] += 1
    assert sequence.aligned_run(table, 12, 30, (least, most)) is None


def test_prefixes_grow_by_a_layer():
    """A prefix was searched anew for each layer more."""
    asked = []
    follows = lambda p, c: asked.append(1) or (0.1 if c["at"] > p["at"] and c["at"] != 30 else None)
    layers = [[{"at": k, "worth": 1.0}, {"at": k, "worth": 0.5}] for k in range(60)]
    got = section_fit.longest_prefixes(layers, follows, "worth", 3, True)
    assert [(a, z) for a, z, _, _ in got] == [(0, 30), (31, 60)] and all(len(path) == z - a for a, z, _, path in got)
    assert got[0][2] == pytest.approx(30 - 2.9) and section_fit.best_path(layers[:31], follows, "worth", 3) is None
    assert len(asked) < 60 * 6 * 3


def test_paths_of_roles_are_those_of_their_placements(spark):
    bars, notes, rows = raw_song(spark)
    want = section_fit.role_paths(placed_in_steps(bars, notes), ["song"], "role")
    got = section_fit.placed_paths(rows, ["song"], "role", 0.03)
    assert got.columns == want.columns and rows_of(got) == rows_of(want) != []


def three_roles(spark):
    """Paths of three roles of two songs that agree, disagree and end."""
    rng = np.random.default_rng(8)
    rows = []
    for s, role in itertools.product((1, 2), ("bass", "drums", "lead")):
        for w in range(12):
            if rng.random() < 0.8:
                stretch, move = 1.0 + 0.01 * int(rng.integers(-3, 4)), float(rng.choice([0.0, 0.02, 0.2, 0.9]))
                rows.append((s, role, w, 7.5 * w, 7.5 * w + 10, stretch, move - 7.5 * w * (stretch - 1), float(rng.random()), 0.5 + float(rng.random()) / 2, float(rng.random()) / 8, 0, int(rng.integers(1, 4))))
    return spark.createDataFrame(rows, "song int, role string, window bigint, chart_start double, chart_end double, stretch double, translation double, score double, coverage double, median_residual double, streak bigint, streak_size bigint")


def nearly(got, want):
    assert len(got) == len(want) > 0
    assert all(p == pytest.approx(q, abs=1e-9) if isinstance(p, float) else p == q for x, y in zip(got, want, strict=True) for p, q in zip(x, y, strict=True))


def test_controls_of_songs_are_those_of_the_steps(spark):
    paths = three_roles(spark)
    got, want = section_fit.controls_of(paths, ["song"], "role"), section_fit.fuse(section_fit.fused_controls(paths, ["song"], "role"), ["song"])
    assert got.schema.simpleString() == want.schema.simpleString()
    nearly(rows_of(got), rows_of(want))
    assert {r.classification for r in got.collect()} >= {"multi_role_corroborated", "multi_role_compatible"}


@pytest.mark.parametrize("mode", ["conservative", "permissive"])
def test_maps_of_songs_are_those_of_the_steps(spark, mode):
    paths = three_roles(spark)
    region = Window.partitionBy("song", "region")
    found = section_fit.fuse(section_fit.fused_controls(paths, ["song"], "role"), ["song"])
    spanned = found.withColumn("base", F.col("chart_time")).withColumn("measures", F.floor(F.max("chart_time").over(region) / 2.5 - F.min("chart_time").over(region) / 2.5).cast("int"))
    got, want = section_fit.map_of(paths, ["song"], "role", 2.5, mode), section_fit.materialise(spanned, ["song"], mode)
    assert got.schema.simpleString() == want.schema.simpleString()
    if mode == "permissive":
        nearly(rows_of(got), rows_of(want))
    else:
        assert len(rows_of(got)) == len(rows_of(want))
    assert section_fit.map_of(paths.limit(0), ["song"], "role", 2.5, mode).count() == 0


@pytest.mark.parametrize("name", ["section_controls", "section_map"])
def test_songs_are_dealt_out_once_more(spark, name):
    plan = plans.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == plan.count("Window [") == 0 and plan.count("RepartitionByExpression") == 2
