import random

import pytest
from pyspark.sql import functions as F

from timeloom.functions import robust
from timeloom.operators import islands, joins, select, tempo


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_chain_and_head_groups_differ(spark):
    t = spark.createDataFrame([("a", x) for x in (0, 30, 60, 200, 210)], "k string, t long")
    assert islands.chain_groups(t, ["k"], "t", 40).agg(F.max("group_no")).first()[0] == 2
    assert rows(islands.head_groups(t, ["k"], "t", 40)) == [("a", 0, 30, 2), ("a", 60, 60, 1), ("a", 200, 210, 2)]


def test_merge_and_gaps(spark):
    t = spark.createDataFrame([("a", 0, 10), ("a", 2, 3), ("a", 9, 12), ("a", 20, 21)], "k string, s long, e long")
    assert rows(islands.merge_intervals(t, ["k"], "s", "e").select("start", "stop", "n")) == [(0, 12, 3), (20, 21, 1)]
    assert rows(islands.coverage_gaps(t, ["k"], "s")) == [("a", 1, 1, 1), ("a", 3, 8, 6), ("a", 10, 19, 10)]


def test_asof_nearest_and_map(spark):
    t = spark.createDataFrame([(1, 5), (2, 12), (3, -1)], "id long, t long")
    m = spark.createDataFrame([(0, 100), (10, 130)], "x long, y long")
    assert rows(joins.asof(t.withColumn("k", F.lit(0)), m.withColumn("k", F.lit(0)), ["k"], "t", "x", ["y"]).select("id", "y").na.fill(-1)) == [(1, 100), (2, 130), (3, -1)]
    assert rows(joins.apply_map(t, "t", m).select("id", "mapped")) == [(1, 115.0), (2, 132.0), (3, -1.0)]
    n = joins.nearest_within(t, spark.createDataFrame([(7, 4), (8, 6), (9, 40)], "o long, u long"), "id", "t", "o", "u", 6)
    assert rows(n) == [(1, 7, -1), (2, 8, -6), (3, 7, 5)]


def test_robust(spark):
    t = spark.createDataFrame([("a", 1.0, 1, 0), ("a", 2.0, 1, 1), ("a", 9.0, 5, 2)], "k string, v double, w long, x long")
    assert rows(robust.weighted_median(t, ["k"], "v", "w")) == [("a", 9.0)]
    assert rows(robust.median_and_mad(t, ["k"], "v")) == [("a", 2.0, 1.0)]
    assert rows(robust.theil_sen(t, ["k"], "x", "v")) == [("a", 4.0, 3)]
    assert rows(select.suppress(t, ["k"], "x", "v", 2)) == [("a", 0, 2.0, 9.0), ("a", 1, 0.0, 1.0)]


def test_empty_tables(spark):
    t = spark.createDataFrame([], "k string, s long, e long")
    assert rows(islands.merge_intervals(t, ["k"], "s", "e")) == rows(islands.head_groups(t, ["k"], "s", 1)) == []


def test_queries_match_sql(spark):
    import glob
    import os

    import duckdb

    from timeloom import plans

    folder, con = "/root/testdata/sf0.001", duckdb.connect()
    for f in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as from '{f}'")
    for name, sql in plans.ORACLE_SQL.items():
        df = plans.QUERIES[name](spark, folder)
        columns = ",".join(sorted(df.columns))
        ours = sorted(map(str, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))
        assert ours == sorted(map(str, con.execute(f"select {columns} from ({sql})").fetchall())), name


def plain_tempos(rows, initial, repeats):
    """Tempos of one key by a walk over its ticks."""
    best = {}
    for tick, bpm in rows:
        best[tick] = max(best.get(tick, 0.0), bpm)
    ordered = sorted([*((t, 1, b) for t, b in best.items()), *([(0, 0, initial)] if min(best) != 0 else [])])
    out = []
    before = None
    for tick, _, bpm in ordered:
        if repeats or before is None or bpm != before:
            out.append((tick, bpm))
        before = bpm
    return out


@pytest.mark.parametrize("seed", range(4))
def test_tempo_maps_are_sorted_once(spark, seed):
    rng = random.Random(seed)
    data = [(k, rng.randrange([0, -4][seed % 2], 9), float(rng.choice([90, 100, 120]))) for k in range(60) for _ in range(rng.randrange(1, 8))]
    data = [r for r in data if not (r[1] == 0 and min(t for k, t, _ in data if k == r[0]) < 0)]  # a second row at tick 0 has no place in order
    df = spark.createDataFrame(data, "k int, t int, b double")
    for drop in (True, False):
        made = tempo.tempo_events(df, ["k"], "t", "b", initial=100.0, drop_repeats=drop)
        want = {k: plain_tempos([(t, b) for q, t, b in data if q == k], 100.0, not drop) for k in {r[0] for r in data}}
        assert sorted(map(tuple, made.collect())) == sorted((k, t, b) for k, rows in want.items() for t, b in rows)
    based = tempo.rebase(tempo.tempo_events(df, ["k"], "t", "b", initial=100.0), ["k"], F.lit(3))
    plan = based._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "HashAggregate" not in plan
    expected = []
    for k, rows in want.items():
        rows = plain_tempos([(t, b) for q, t, b in data if q == k], 100.0, False)
        opening = next((b for t, b in reversed(rows) if t <= 3), rows[0][1])
        expected += [(k, 0, opening), *((k, t - 3, b) for t, b in rows if t > 3)]
    assert sorted(map(tuple, based.collect())) == sorted(expected)
