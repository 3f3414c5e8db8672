import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from timeloom.operators import fusion, islands, maps, phrases, vocals


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_lyrics(spark):
    df = spark.createDataFrame([("hel-lo  wor-ld _ a_b",), ("",), (None,)], "t string").select(vocals.lyric_tokens(F.col("t")).alias("w"))
    assert [r.w for r in df.collect()] == [["hel-", "lo", "wor-", "ld", "+", "a b"], [], []]
    got = spark.range(1).select(vocals.syllable_spans(F.lit(1.0), F.lit(3.0), F.array(F.lit("hel-"), F.lit("l"))).alias("s")).first().s
    assert [(s.t, s.d, s.w) for s in got] == [(1.0, 1.5, "hel-"), (2.5, 0.5, "l")]
    words = spark.createDataFrame([(1, 0.0, 1.0, "la"), (1, 1.0, 1.0, "lo"), (1, 5.0, 1.0, "li")], "g int, t double, d double, w string")
    notes = spark.createDataFrame([(1, 0.1, 0.3, 60), (1, 0.5, 0.3, 62), (1, 1.2, 0.4, 64)], "g int, t double, d double, midi int")
    assert rows(vocals.with_continuations(words, notes, ["g"]).select("t", "w", "midi"))[:3] == [(0.1, "la", 60), (0.5, "+", 62), (1.2, "lo", 64)]
    lines = spark.createDataFrame([(1, 0, 2), (1, 1, 3)], "g int, line int, n int")
    assert rows(vocals.allocate_lines(lines, notes.unionByName(notes), ["g"], "line", "n", ["t"])) == [(1, 0, 1, 2), (1, 1, 3, 5)]


def test_pitch_of_syllables(spark):
    t = np.arange(0, 1.0, 0.01)
    hz = np.where(t < 0.5, 440.0, 466.16)
    hz[20:22] = 500.0  # too short to count
    frames = spark.createDataFrame([(1, float(a), float(b), 0.9) for a, b in zip(t, hz, strict=True)], "s int, t double, hz double, confidence double")
    regions = vocals.pitch_regions(frames, ["s"])
    assert [(round(r.start, 2), r.midi) for r in regions.orderBy("start").collect()] == [(0.0, 69), (0.5, 70)]
    syllables = spark.createDataFrame([(1, 0.0, 1.2, 69, 0.9), (2, 2.0, 1.0, 50, 0.4), (3, 4.0, 1.0, None, 0.4)], "s int, t double, d double, pitch int, confidence double")
    got = vocals.partition_syllables(syllables, regions, ["s"]).orderBy("s", "t").collect()
    assert [(r.s, round(r.t, 3), round(r.d, 3), r.midi) for r in got] == [(1, 0.0, 0.5, 69), (1, 0.5, 0.7, 70), (2, 2.0, 1.0, 50)]
    assert vocals.representative_pitch(syllables.withColumn("g", F.lit(1)), frames.withColumn("g", F.lit(1)), ["g"], "s").orderBy("s").first().pitch == 70


def test_monophonic(spark):
    notes = spark.createDataFrame([(1, 0.0, 1.0, 60, 0.5), (1, 0.5, 1.0, 60, 0.9), (1, 1.2, 1.0, 64, 0.95), (1, 2.0, 1.0, 67, 0.1), (1, 9.0, 0.0, 1, 1.0)], "g int, t double, d double, midi int, confidence double")
    assert [(r.t, round(r.d, 3), r.midi) for r in vocals.monophonic(notes, ["g"]).orderBy("t").collect()] == [(0.0, 1.2, 60), (1.2, 1.0, 64), (2.2, 0.8, 67)]


def brute_chain(points, fixed, least, most):
    best, n = (-np.inf, ()), len(points)
    for k in range(n + 1):
        for some in itertools.combinations(range(n), k):
            chosen = [points[i] for i in some]
            ok = all(b[0] > a[0] and b[1] > a[1] and least <= (b[1] - a[1]) / (b[0] - a[0]) <= most for a, b in itertools.pairwise(chosen))
            if ok and set(fixed) <= set(some):
                best = max(best, (sum(p[2] for p in chosen), some))
    return best[0]


@pytest.mark.parametrize("seed", range(8))
def test_constrained_path_is_the_heaviest(spark, seed):
    rng = np.random.default_rng(seed)
    n = 9
    x = np.sort(rng.choice(100, n, replace=False)).astype(float)
    y = x + rng.normal(0, 2, n)
    s = rng.uniform(0.1, 1, n)
    fixed = [int(rng.integers(n))] if seed % 2 else []
    df = spark.createDataFrame([(1, i, float(x[i]), float(y[i]), float(s[i]), i in fixed) for i in range(n)], "g int, id int, x double, y double, score double, fixed boolean")
    got = [r.id for r in phrases.constrained_path(df, ["g"], "id").orderBy("step").collect()]
    assert sum(s[i] for i in got) == pytest.approx(brute_chain(list(zip(x, y, s, strict=True)), fixed, 0.9, 1.1)) and set(fixed) <= set(got)


def test_anchor_path_against_all_choices(spark):
    rng = np.random.default_rng(5)
    states = [(1, c, 10.0 * c, 10.0 * c + float(rng.normal(0, 2)), float(rng.uniform(0, 1)), r) for c in range(5) for r in range(2)]
    df = spark.createDataFrame(states, "g int, cluster bigint, score_time double, audio_time double, emission double, rank bigint")
    got = {r.cluster: r.chosen for r in phrases.anchor_path(df, ["g"]).collect()}

    def worth(choice):
        total, last, held = 0.0, None, None
        for c, r in enumerate(choice):
            if r is None:
                total -= 0.55
                continue
            _, _, t, a, e, _ = next(s for s in states if s[1] == c and s[5] == r)
            total += e
            if last:
                scale = (a - last[1]) / (t - last[0])
                if a <= last[1] + 0.10 or not 0.70 <= scale <= 1.35:
                    return -np.inf
                total -= 1.4 * max(0, abs(scale - 1) - 0.08) + (max(0, abs(scale - held) - 0.05) if held is not None else 0)
                held = scale
            last = (t, a)
        return total

    best = max(itertools.product([None, 0, 1], repeat=5), key=worth)
    assert worth([got[c] for c in range(5)]) >= worth(best) - 0.3  # the last segment's scale is not part of a state
    manual = spark.createDataFrame([(1, 20.0, 20.5)], "g int, score_time double, audio_time double")
    assert {r.cluster for r in phrases.anchor_path(df, ["g"], manual).collect()} == {0, 1, 3, 4}


def test_tracker_states(spark):
    seen = [(1, 0, 1.0, 1.5, 8, True), (1, 1, 2.0, None, None, None), (1, 2, 3.0, 3.5, 8, True), (1, 3, 4.0, None, None, None), (1, 4, 5.0, None, None, None), (1, 5, 6.0, None, None, None), (1, 6, 7.0, 11.0, 9, True), (1, 7, 8.0, 12.0, 9, False), (1, 8, 9.0, 13.0, 9, False), (1, 9, 10.0, 14.0, 9, True)]
    df = spark.createDataFrame(seen, "g int, phrase bigint, score_time double, audio_time double, matched int, valid boolean")
    got = phrases.track(df, ["g"]).orderBy("phrase").collect()
    assert [r.state for r in got] == ["LOCKED", "COASTING", "LOCKED", "COASTING", "COASTING", "REACQUIRING", "LOCKED", "LOCKED", "LOST", "LOST"]
    assert [r.event for r in got][:7] == ["lock_acquired", "unobserved", "locked", "unobserved", "unobserved", "lock_lost", "lock_reacquired"] and [r.accepted for r in got][-3:] == [False, False, False]


def onsets(spark, shift=0.0, stretch=1.0):
    rng = np.random.default_rng(9)
    t = np.cumsum(rng.choice([0.25, 0.5, 0.75], 60))
    return spark.createDataFrame([(1, float(shift + stretch * a), [int(p)]) for a, p in zip(t, rng.integers(40, 70, 60), strict=True)], "g int, time double, symbols array<int>")


def test_phrases_are_placed(spark):
    asked = phrases.phrase_windows(onsets(spark), ["g"]).withColumn("expected", (F.col("start") + F.col("end")) / 2)
    got = phrases.multi_pass(asked, onsets(spark, 1.0, 1.01), ["g"]).collect()
    assert len(got) == asked.count() and all(abs(r.audio_time - (1.0 + 1.01 * r.score_time)) < 0.05 for r in got if r.tier == "A") and sum(r.tier == "A" for r in got) >= 15
    assert all(0 < r.d <= 1 for r in asked.select(phrases.distinctiveness(F.col("groups")).alias("d")).collect())
    path = spark.createDataFrame([(1, r.score_time, r.audio_time) for r in got if r.tier == "A"], "g int, t double, a double")
    segments = phrases.trusted_segments(path, ["g"], "t", "a", gap=6.0)
    assert segments.where("trusted").count() == 1 and phrases.segment_controls(path, segments, ["g"], "t").count() >= 3


def test_repeats(spark):
    bars = spark.createDataFrame([(1, i, 2.0 * i, 2.0 * (i + 1)) for i in range(8)], "g int, index int, start double, end double")
    beat = [(0.0, 40), (0.5, 43), (1.0, 45), (1.75, 47), (2.0, 50), (3.5, 52)]
    events = spark.createDataFrame([(1, "bass", 4.0 * k + t, [p]) for k in range(4) for t, p in beat], "g int, role string, time double, symbols array<int>")
    runs = phrases.repeat_runs(phrases.repeat_phrases(bars, events, ["g"], "role"), ["g"], "role")
    assert {(r.length, r.phase, r.n) for r in runs.collect()} >= {(2, 0, 4)}
    report = phrases.repeat_report(runs, phrases.repeat_matches(runs, events, ["g"], "role"), ["g"], "role")
    assert {r.classification for r in report.where("length = 2 and phase = 0").collect()} == {"matching_phrase_run"}


def test_lags_and_fingerprints(spark):
    t = np.arange(0, 10, 0.02)
    novelty = sum(np.exp(-0.5 * ((t - p) / 0.03) ** 2) for p in (3.1, 4.1, 5.6))
    frames = spark.createDataFrame([(1, float(a), float(v)) for a, v in zip(t, novelty, strict=True)], "g int, t double, novelty double")
    asked = spark.createDataFrame([(1, 7, [3.0, 4.0, 5.5], 3.0, 6.0)], "g int, measure int, predicted array<double>, start double, stop double")
    best = phrases.lag_search(asked, frames, ["g"], "measure", 0.5, 0.02).orderBy("rank").first()
    assert abs(best.lag - 0.1) < 0.011 and best.score > 0.9 and not best.edge
    events = spark.createDataFrame([(1, 0.0, 1.0, 60), (1, 1.0, 1.5, None), (1, 1.9, 2.5, 64)], "g int, time double, stop double, pitch int")
    got = phrases.fingerprint(events, spark.createDataFrame([(1, 0, 1.0)], "g int, id int, centre double"), ["g"], "id", 1.0, 4).first()
    assert got.rhythm == [1.0, 0.0, 1.0, 1.0] and len(got.chroma) == 48 and got.chroma[:4] == [1.0, 1.0, 0.0, 0.0]


def test_chains_with_a_root(spark):
    rows_ = [(1, 0, 0.0, 0.5, 0.2, True), (1, 1, 1.0, 1.5, 0.5, False), (1, 2, 1.0, 1.52, 0.9, False), (1, 3, 2.0, 2.5, 0.5, False), (1, 4, 3.0, 9.0, 5.0, False)]
    df = spark.createDataFrame(rows_, "g int, id int, x double, y double, score double, opens boolean")
    assert [r.id for r in phrases.safe_chain(df, ["g"], "id").orderBy("step").collect()] == [0, 2, 3]


@pytest.mark.parametrize("seed", range(12))
def test_first_fit_families_against_a_plain_search(seed):
    rng = np.random.default_rng(seed)
    n, near = int(rng.integers(1, 300)), [0.0, 1.0, 2.5][seed % 3]
    a = np.sort(rng.integers(0, 60, n))
    z, s = a + rng.integers(0, 9, n), rng.integers(-9, 9, n) / [1, 1, 2][seed % 3]
    families, want = [], []
    for i in range(n):
        at = next((k for k, f in enumerate(families) if z[i] >= f[0] - 1 and a[i] <= f[1] + 1 and abs(s[i] - f[2]) <= near), len(families))
        if at == len(families):
            families.append([a[i], z[i], s[i], []])
        f = families[at]
        f[3].append(s[i])
        f[0], f[1], f[2] = min(f[0], a[i]), max(f[1], z[i]), int(np.rint(np.median(f[3])))
        want.append(at)
    assert fusion.first_fit(a.tolist(), z.tolist(), s.tolist(), near) == want


def test_first_fit_clusters(spark):
    data = [(1, 1, "a", 0.0, 1.0), (1, 2, "b", 60.0, 1.0), (1, 3, "a", 65.0, 2.0), (1, 4, "c", 300.0, 1.0), (1, 5, "b", None, 1.0)]
    df = spark.createDataFrame(data, "m int, id int, role string, res double, w double")
    assert rows(fusion.residual_clusters(df, ["m"], "id", "role", "res", "w")) == [(1, 1, None), (1, 2, 0), (1, 3, 0), (1, 4, 1)]
    wins = spark.createDataFrame([(1, 1, 1, 4, 2), (1, 2, 5, 8, 2), (1, 3, 5, 8, 5), (1, 4, 20, 24, 2)], "g int, id int, s int, e int, k int")
    assert rows(fusion.shift_families(wins, ["g"], "id", "s", "e", "k")) == [(1, 1, 0), (1, 2, 0), (1, 3, 1), (1, 4, 2)]


def clusters_by_search(value, name, heavy, tolerance):
    held, where = [], [None] * len(value)
    for i in range(len(value)):
        at = next((k for k, c in enumerate(held) if abs(value[i] - np.median([value[j] for j in c.values()])) <= tolerance), len(held))
        if at == len(held):
            held.append({})
        old = held[at].get(name[i])
        if old is None or heavy[i] > heavy[old]:
            if old is not None:
                where[old] = None
            held[at][name[i]], where[i] = i, at
    return where


@pytest.mark.parametrize("seed", range(6))
def test_residual_clusters_stream(seed):
    rng = np.random.default_rng(seed)
    n = 600
    df = pd.DataFrame({"m": np.sort(rng.integers(0, 4, n)), "res": rng.integers(0, 400, n) / [1, 4][seed % 2], "role": rng.choice(list("abcdef"), n), "id": np.arange(n), "w": rng.integers(0, 30, n).astype(float)})
    df = df.sort_values(["m", "res", "role", "id"], ignore_index=True)
    want = {}
    for _, g in df.groupby("m"):
        want |= dict(zip(g["id"], clusters_by_search(g["res"].tolist(), g["role"].tolist(), g["w"].tolist(), 20.0), strict=True))
    seen = []
    batches = (seen.append(k) or df.iloc[k : k + 50] for k in range(0, n, 50))
    parts = fusion.open_clusters(batches, ["m"], "id", "role", "res", "w", 20.0)
    first = next(parts)
    assert seen == [0]  # rows come while their key still goes on
    got = pd.concat([first, *parts])
    assert {i: None if pd.isna(c) else c for i, c in zip(got["id"], got["cluster"], strict=True)} == want and len(got) == n


def test_maps_from_evidence(spark):
    ends = spark.createDataFrame([(1, 0.0, 100.0)], "g int, first double, last double")
    found = [(1, 20.0, 20.0, "onset", 1.0, True), (1, 20.2, 24.0, "silence", 1.0, None), (1, 50.0, 30.0, "silence", 1.0, None), (1, 80.0, 5.0, "silence", 1.0, None), (1, 70.0, 30.0, "onset", 1.0, False), (1, 90.0, -60.0, "onset", 1.0, True)]
    df = spark.createDataFrame(found, "g int, nominal double, residual_ms double, kind string, quality double, strong boolean")
    got = {round(r.x): (r.tier, r.kept, list(r.reasons), r.status) for r in maps.checkpoint_map(df, ends, ["g"]).collect()}
    assert got[20] == ("A", True, [], "applied") and got[80][2] == ["negligible"] and got[70][2] == ["diagnostic_tier"] and got[90][1]
    bars = spark.createDataFrame([(1, i, 2.0 * i, 2.0 * i, (0.1 if i != 4 else None), 0.9) for i in range(8)], "g int, i int, t double, base double, raw double, sure double")
    assert [(r.x, round(r.y, 3)) for r in maps.bar_map(bars, ["g"], "i", "t", "base", "raw", "sure").orderBy("x").collect()][3:5] == [(6.0, 6.1), (8.0, 8.1)]


def test_chains_dealt_in_stretches_are_the_same(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([("k", int(t)) for t in rng.integers(0, 3000, 200)] + [("k", None)], "k string, t long")
    one, two = islands.chain_groups(df, ["k"], "t", 20), islands.chain_groups(df, ["k"], "t", 20, width=100)
    assert rows(one.select("t", "group_no")) == rows(two.select("t", "group_no"))
    assert rows(islands.head_groups(df, ["k"], "t", 20)) == rows(islands.head_groups(df, ["k"], "t", 20, 100))
