import numpy as np
import pytest
from pyspark.sql import functions as F

from timeloom.functions import robust, slopes
from timeloom.operators import dealt, gates, islands


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def brute(x, y, least=0.0):
    made = slopes._direct(x, y, least)
    return (float(np.median(made)) if len(made) else None), len(made)


@pytest.mark.parametrize("seed", range(24))
def test_median_slope_without_pairs(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(65, 400))
    x, y = [
        (rng.random(n) * 100, rng.normal(size=n)), (rng.integers(0, 20, n) * 1.0, rng.integers(0, 5, n) * 1.0), (np.arange(n) * 1.0, np.zeros(n)), (1.7e9 + rng.random(n) * 1e6, rng.integers(0, 900, n) * 1.0),
        (rng.random(n) * 1e-3, rng.standard_cauchy(n)), (np.repeat(rng.random(n), 2)[:n], rng.integers(0, 3, n) * 1.0), (np.zeros(n), rng.random(n)), (rng.random(n), rng.random(n) * 1e9),
    ][seed % 8]
    least = [0.0, 0.25, 1.0][seed // 8]
    got, want = slopes.median_slope(x, y, least), brute(x, y, least)
    assert got[1] == want[1]
    assert got[0] == want[0] if want[0] is None else got[0] == pytest.approx(want[0], rel=1e-9, abs=1e-12)


def test_many_groups_together():
    rng = np.random.default_rng(1)
    sizes = [1, 2, 3, 70, 5, 64, 65, 1, 30]
    x = np.concatenate([np.sort(rng.integers(0, 30, n)) * 1.0 for n in sizes])
    y = rng.random(len(x))
    starts = np.cumsum([0, *sizes[:-1]])
    slope, pairs = slopes.median_slopes(x, y, starts)
    for at, n, s, p in zip(starts, sizes, slope, pairs, strict=True):
        want = brute(x[at : at + n], y[at : at + n])
        assert p == want[1] and (np.isnan(s) if want[0] is None else s == pytest.approx(want[0]))


def test_robust_line_by_key(spark):
    rng = np.random.default_rng(2)
    data = [(k, float(a), float(2 * a + b)) for k, n in (("a", 200), ("b", 5), ("c", 1)) for a, b in zip(rng.random(n), rng.normal(size=n), strict=True)] + [("d", None, 1.0), ("d", 1.0, None), (None, 0.0, 0.0), (None, 1.0, 3.0)]
    df = spark.createDataFrame(data, "k string, x double, y double")
    got = {r.k: r for r in robust.theil_sen_line(df, ["k"], "x", "y").collect()}
    assert set(got) == {"a", "b", "c", None} and got["c"].slope == 1.0 and got[None].slope == 3.0
    for k in "ab":
        x, y = (np.array([r[i] for r in data if r[0] == k]) for i in (1, 2))
        slope = brute(x, y)[0]
        off = np.abs(y - slope * x - np.median(y - slope * x))
        assert got[k].slope == pytest.approx(slope) and got[k].n == len(x) and got[k].median_residual == pytest.approx(np.median(off)) and got[k].maximum_residual == pytest.approx(off.max())
    assert rows(robust.theil_sen(df.limit(0), ["k"], "x", "y")) == []


def test_slopes_of_a_key_dealt_over_tasks(spark):
    rng = np.random.default_rng(3)
    data = [("a", float(x), float(x * 2 + e)) for x, e in zip(rng.random(300) * 9, rng.normal(size=300), strict=True)] + [("b", float(x), float(y)) for x, y in zip(rng.integers(0, 60, 250), rng.integers(0, 4, 250), strict=True)] + [("c", 1.0, 1.0), ("c", 1.0, 2.0)]
    df = spark.createDataFrame(data, "k string, x double, y double")
    got = {r.k: (r.slope, r.pairs) for r in dealt.median_slopes(df, ["k"], "x", "y", block=40).collect()}
    assert set(got) == {"a", "b"}
    for k in "ab":
        want = brute(*(np.array([r[i] for r in data if r[0] == k]) for i in (1, 2)))
        assert got[k][1] == want[1] and got[k][0] == pytest.approx(want[0], rel=1e-9, abs=1e-12)


def test_descents_counted_and_listed_in_blocks(spark):
    order = np.random.default_rng(4).permutation(90)
    df = spark.createDataFrame([(0, i, int(v)) for i, v in enumerate(order)], "k int, a long, b long")
    want = {(i, j) for i in range(90) for j in range(i + 1, 90) if order[j] < order[i]}
    assert rows(dealt.count_descents(df, ["k"], "a", "b", 16)) == [(0, len(want))]
    listed = [(r.a, r.a_2) for r in dealt.list_descents(df, ["k"], "a", "b", ["a"], 16).collect()]
    assert len(listed) == len(want) and set(listed) == want


@pytest.mark.parametrize("tolerance,width", [(7, 20), (50, 10), (3, 3), (1000, 100)])
def test_heads_of_an_unbroken_chain_dealt_over_tasks(spark, tolerance, width):
    rng = np.random.default_rng(tolerance)
    times = [("a", int(t)) for t in rng.integers(0, 1200, 500)] + [("b", int(t)) for t in np.cumsum(rng.integers(1, 30, 60))] + [("c", 5), ("c", 5), ("d", -40), ("d", -39), ("d", 3), ("e", None)]
    df = spark.createDataFrame(times, "k string, t long").repartition(5)
    whole = rows(islands.head_groups(df, ["k"], "t", tolerance))
    assert rows(islands.head_groups(df, ["k"], "t", tolerance, width)) == whole
    real = df.withColumn("t", F.col("t") / 8)
    assert rows(islands.head_groups(real, ["k"], "t", tolerance / 8, width / 8)) == rows(islands.head_groups(real, ["k"], "t", tolerance / 8))
    assert rows(islands.head_groups(df.limit(0), ["k"], "t", tolerance, width)) == []


def test_edges_of_no_length_are_rejected(spark):
    edges = spark.createDataFrame([(0.0, 1.0, True, 10), (1.0, 0.0, True, 10), (0.0, 0.0, False, None), (4.0, 4.1, False, 3), (None, 1.0, False, 3)], "chart double, audio double, in_episode boolean, measures int")
    got = [(r.accepted, r.basis) for r in gates.assess_edges(edges, gates.MODES["permissive"]).collect()]
    assert got[:4] == [(False, "catastrophic_non_positive_geometry")] * 3 + [(True, "normal_stretch_range")]
    fused = [r[0] for r in edges.select(gates.fused_edge(F.col("chart"), F.col("audio"))).collect()]
    assert fused[:4] == ["chart_control_did_not_advance", "midi_control_did_not_advance", "chart_control_did_not_advance", None]
