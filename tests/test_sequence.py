from itertools import combinations, product

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from timeloom.operators import joins, sequence

SMALL = settings(max_examples=60, deadline=None)


@SMALL
@given(st.integers(0, 4), st.integers(0, 4), st.integers(0, 999))
def test_align_is_the_best_matching(n, m, seed):
    s = np.random.default_rng(seed).uniform(-0.3, 1, (n, m))
    best = max(
        sum(s[i, j] if s[i, j] > 0 else -np.inf for i, j in zip(a, b)) - 0.22 * (n - k) - 0.025 * (m - k)
        for k in range(min(n, m) + 1)
        for a in combinations(range(n), k)
        for b in combinations(range(m), k)
    )
    score, found = sequence.align(s, 0.22, 0.025)
    assert np.isclose(score, best)
    assert np.isclose(sum(s[i, j] for i, j in found) - 0.22 * (n - len(found)) - 0.025 * (m - len(found)), best)


@SMALL
@given(st.lists(st.integers(1, 3), min_size=1, max_size=2), st.integers(0, 999))
def test_viterbi_is_the_cheapest_path_of_two_layers(sizes, seed):
    rng, ends = np.random.default_rng(seed), np.cumsum([0, *sizes])
    layers = [np.arange(a, b) for a, b in zip(ends[:-1], ends[1:])]
    confidence, residual = rng.uniform(0, 1, ends[-1]), rng.uniform(0, 400, ends[-1])

    def cost(path):
        made = sum(0.42 if p < 0 else 1 - confidence[p] for p in path)
        return made + sum(min(2, abs(residual[q] - residual[p]) / 120) for p, q in zip(path, path[1:]) if p >= 0 and q >= 0)

    assert np.isclose(cost(sequence.viterbi(layers, confidence, residual)), min(map(cost, product(*([-1, *rows] for rows in layers)))))


@SMALL
@given(st.integers(0, 7), st.integers(0, 999))
def test_chain_is_the_longest(n, seed):
    rng = np.random.default_rng(seed)
    x = np.sort(rng.integers(0, 8, n))
    y = x + rng.normal(0, 0.3, n)

    def safe(c):
        return all(x[b] > x[a] and 0.88 <= (y[b] - y[a]) / (x[b] - x[a]) <= 1.12 for a, b in zip(c, c[1:]))

    path = sequence.chain(x, y, np.ones(n), 0.88, 1.12)
    assert safe(path) and len(path) == max(k for k in range(n + 1) if any(safe(c) for c in combinations(range(n), k)))


@SMALL
@given(st.lists(st.integers(0, 5), min_size=1, max_size=5), st.lists(st.integers(0, 5), min_size=1, max_size=5))
def test_dtw_matches_recursion(a, b):
    def least(i, j):
        ways = [least(p, q) for p, q in ((i - 1, j - 1), (i - 1, j), (i, j - 1)) if p >= 0 and q >= 0]
        return abs(a[i] - b[j]) + (min(ways) if ways else 0)

    cost, steps = sequence.banded_dtw(np.array(a, float), np.array(b, float), 99)
    assert cost == least(len(a) - 1, len(b) - 1) == sum(abs(a[i] - b[j]) for i, j in steps)
    assert sequence.banded_dtw(np.zeros(0), np.ones(2), 9)[1] == []


def test_beam_keeps_rising_positions():
    layers = [np.array([0, 1]), np.array([2, 3])]
    score, path = sequence.beam(layers, np.array([0.0, 5, 4, 10]), np.array([0.5, 0.9, 0.9, 0.1]), 5.0)
    assert path == [0, 2] and np.isclose(score, 0.5 + 0.9 - 0.75 * 0.2)
    assert sequence.beam([], np.zeros(0), np.zeros(0), 1.0) == (0.0, [])


def test_kernels_in_groups(spark):
    rows = spark.createDataFrame([("a", 1, 7, 0.9, 10.0), ("a", 1, 8, 0.2, 10.0), ("a", 2, 9, 0.1, 0.0), ("b", 5, 3, 1.0, 0.0)], "k string, h bigint, id bigint, confidence double, residual_ms double")
    got = sorted(map(tuple, sequence.viterbi_path(rows, ["k"], "h", "id").collect()))
    assert got == [("a", 1, 7), ("a", 2, None), ("b", 5, 3)]
    assert sequence.viterbi_path(rows.where("false"), ["k"], "h", "id").collect() == []


def test_asof_in_stretches_is_the_same(spark):
    left = spark.createDataFrame([(k, t) for k in "ab" for t in range(-7, 40, 3)], "k string, t long")
    right = spark.createDataFrame([("a", 2, 1), ("a", 11, 2), ("a", 30, 3), ("b", -5, 4)], "k string, s long, v long")
    plain, dealt = (sorted(map(str, joins.asof(left, right, ["k"], "t", "s", ["v", "s"], w).collect())) for w in (None, 4))
    assert plain == dealt


def test_viterbi_in_stretches(monkeypatch):
    rng = np.random.default_rng(9)
    layers = [np.arange(k * 9, k * 9 + 9) for k in range(6)]
    confidence, residual = rng.random(54), rng.normal(0, 150, 54)
    whole = sequence.viterbi(layers, confidence, residual)
    monkeypatch.setattr(sequence, "CELLS", 25)
    assert sequence.viterbi(layers, confidence, residual) == whole


def test_path_queries_take_every_event(spark, tmp_path):
    from datetime import datetime, timedelta

    from timeloom.plans import queries

    start = datetime(2024, 1, 1)
    rows = []
    for hour in range(4):  # five strong events that don't go on in the next hour, and a weak one that does
        rows += [(hour * 10 + k, "view", k, start + timedelta(hours=hour, minutes=1 if hour % 2 else 50, seconds=k), 90.0, None) for k in range(5)]
        rows.append((hour * 10 + 9, "view", 9, start + timedelta(hours=hour, minutes=25), 1.0, None))
    spark.createDataFrame(rows, "event_id long, event_type string, user_id long, ts timestamp_ntz, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    assert [r.chosen for r in queries.chain_path(spark, str(tmp_path)).orderBy("step").collect()] == [9, 19, 29, 39]
    assert queries.beam_path(spark, str(tmp_path)).count() == queries.viterbi_path(spark, str(tmp_path)).count() == 4
    assert queries._candidates(spark, str(tmp_path)).count() == 24
