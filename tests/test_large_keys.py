import time

import numpy as np
from pyspark.sql import functions as F

from timeloom.operators import joins, phrases, select, sequence, vocals


def test_slices_align_as_alone():
    rng = np.random.default_rng(1)
    table = np.where(rng.random((7, 12)) < 0.5, rng.random((7, 12)), 0.0)
    slices = [(0, 12), (3, 9), (11, 12), (5, 5)]
    assert sequence.align_slices(table, slices, 0.22, 0.025) == [sequence.align(table[:, lo:hi], 0.22, 0.025) for lo, hi in slices]


def test_few_bytes_keep_all_tasks(spark):
    rows = spark.range(40).select((F.col("id") % 8).alias("k"), "id").groupBy("k").agg(F.count("*").alias("n"))
    assert sequence.dealt_by(rows, ["k"]).rdd.getNumPartitions() == 4  # as many as shuffle partitions, though a few bytes


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_nearest_forms_no_pairs(spark):
    rng = np.random.default_rng(2)
    a = [(i, int(t)) for i, t in enumerate(rng.integers(-300, 300, 60))] + [(99, None), (3, 5000)]
    b = [(int(i), int(t)) for i, t in enumerate(rng.integers(-300, 300, 25))] + [(50, 7), (51, 7), (52, None)]
    got = joins.nearest_within(spark.createDataFrame(a, "id long, t long"), spark.createDataFrame(b, "o long, u long"), "id", "t", "o", "u", 20)
    want = {(i, t): min((abs(u - t), u, o) for o, u in b if u is not None and abs(u - t) <= 20) for i, t in a if t is not None and any(u is not None and abs(u - t) <= 20 for _, u in b)}
    assert sorted(tuple(r) for r in got.collect()) == sorted((i, o, u - t) for (i, t), (_, u, o) in want.items())
    assert "Join" not in plan(got)


def test_suppression_compares_neighbours_only(spark):
    rng = np.random.default_rng(3)
    made = [("a", float(p), float(s)) for p, s in zip(rng.integers(0, 400, 200) / 2, rng.integers(0, 30, 200))] + [("b", None, 1.0), ("b", 3.0, 2.0)]
    kept = []
    for _, p, s in sorted((r for r in made if r[0] == "a"), key=lambda r: (-r[2], r[1])):
        if all(abs(p - q) >= 2.5 for q, _ in kept):
            kept.append((p, s))
    df = select.suppress(spark.createDataFrame(made, "k string, p double, s double"), ["k"], "p", "s", 2.5)
    got = sorted((r.k, r["rank"], r.position, r.score) for r in df.collect() if r.k == "a")
    assert got == [("a", i, p, s) for i, (p, s) in enumerate(kept)]
    assert sorted(r.score for r in df.collect() if r.k == "b") == [1.0, 2.0]
    assert "collect_list" not in plan(df)


def test_chain_by_layers_is_the_chain(monkeypatch):
    rng = np.random.default_rng(4)
    for n in (40, 160):
        x = np.sort(rng.integers(0, 5, n)).astype(float)
        y = x + np.round(rng.normal(0, 0.2, n), 2)
        order = np.lexsort((y, x))
        x, y, score = x[order], y[order], rng.integers(0, 4, n) / 3
        monkeypatch.setattr(sequence, "LAYER", 8)
        got = sequence.chain(x, y, score, 0.88, 1.12)
        monkeypatch.setattr(sequence, "LAYER", n + 1)
        assert got == sequence.chain(x, y, score, 0.88, 1.12)


def test_pitch_regions_of_a_long_syllable():
    n = 30_000  # every frame leaves the pitch before, and all short stretches join
    pitch = np.tile([60.0, 63.0, 66.0, 61.0], n // 4)
    began = time.perf_counter()
    found = vocals._regions(np.arange(n) * 1e-4, pitch, np.full(n, 0.9), 1.0, 1.0, 0.05)
    assert time.perf_counter() - began < 5 and found


def test_paths_hold_no_table_of_all_pairs(spark):
    n = 30_000  # a table of all pairs would take 7 GB
    rows = spark.range(n).select(F.lit(1).alias("k"), "id", (F.col("id") % 3 * 10.0).alias("x"), (F.col("id") % 3 * 10.0 + F.col("id") / 1e5).alias("y"), (F.col("id") % 7 / 7 + 0.1).alias("score"), F.lit(False).alias("fixed"))
    assert phrases.constrained_path(rows, ["k"], "id").count() == 3


def test_nearest_span_forms_no_pairs(spark):
    rng = np.random.default_rng(5)
    made = lambda n, first: [(int(rng.integers(2)), first + i, int(a), int(a + d), "abc"[i % 3]) for i, (a, d) in enumerate(zip(rng.integers(0, 400, n), rng.integers(0, 25, n) * rng.integers(0, 2, n)))]
    x, y = made(80, 0), made(60, 1000)
    df = lambda t: spark.createDataFrame(t, "k long, id long, a long, z long, kind string")
    want = {}
    for k, i, a, z, _ in x:
        found = [(0.0 if max(a, c) < min(z, e) + 1e-9 else float(min(abs(a - c), abs(a - e), abs(z - c), abs(z - e))), c, e, kind) for g, _, c, e, kind in y if g == k]
        d, _, _, kind = min((f for f in found if f[0] <= 4), default=(None, 0, 0, None))
        want[i] = (kind, d)
    got = joins.nearest_span(df(x).drop("kind"), df(y), ["k"], "id", ("a", "z"), ("a", "z"), "kind", 4.0)
    assert {r.id: (r.near_kind, r.near_distance) for r in got.collect()} == want
    assert plan(got).count("Join Inner") == 0
