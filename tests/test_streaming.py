import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from timeloom.operators import islands, vocals
from timeloom.streaming import onsets

START = dt.datetime(2024, 1, 1)
SCHEMA = "k string, at timestamp"


def feed(spark, folder, rows):
    spark.createDataFrame([(k, START + dt.timedelta(seconds=s)) for k, s in rows], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def grouped(spark, folder, out):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    return sorted(tuple(r) for r in onsets.replay_heads(spark, onsets.head_groups(stream, ["k"], "at", 10_000_000, "30 seconds"), ["k"], out).collect())


def whole(spark, rows):
    zero = int(START.timestamp())
    df = spark.createDataFrame([(k, START + dt.timedelta(seconds=s)) for k, s in rows], SCHEMA).select("k", F.unix_micros("at").alias("t"))
    assert zero
    return sorted(tuple(r) for r in islands.head_groups(df, ["k"], "t", 10_000_000).collect())


def test_head_groups_of_a_stream(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(k, float(s)) for k in "ab" for s in rng.integers(0, 300, 120) / 2] + [("c", 3.0)]
    rows.sort(key=lambda r: r[1] + rng.integers(0, 20))  # out of order, but by less than rows may be late
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    feed(spark, folder, rows[:90])
    first = grouped(spark, folder, out)
    assert first == whole(spark, rows[:90])
    feed(spark, folder, rows[90:])  # a stop and a new start on the same state
    assert grouped(spark, folder, out) == whole(spark, rows)
    feed(spark, folder, [("a", 1.25), ("b", 2.25)])  # far behind the watermark: dropped
    assert grouped(spark, folder, out) == whole(spark, rows)
    feed(spark, folder, [("d", 10_000.0)])  # closes all that was open
    assert grouped(spark, folder, out) == whole(spark, [*rows, ("d", 10_000.0)])


def test_heads_by_hand():
    groups = onsets.Heads(10)
    groups.waiting = [30, 0, 5, 11]
    assert groups.settle(5) == [] and groups.waiting == [11, 30] and groups.head == 0
    assert groups.settle(12) == [(0, 5, 2)] and groups.head == 11
    assert groups.open() == [(11, 11, 1), (30, 30, 1)]
    assert groups.settle(21) == [(11, 11, 1)] and groups.head is None and groups.waiting == [30]


def test_one_voice_dealt_over_tasks(spark):
    rng = np.random.default_rng(2)
    notes = [(g, float(t), float(d), int(m), float(c)) for g in "xy" for t, d, m, c in zip(rng.random(80) * 60, rng.random(80), rng.integers(50, 54, 80), rng.integers(1, 9, 80) / 9, strict=True)] + [("z", 0.0, 100.0, 60, 0.5), ("z", 5.0, 1.0, 61, 0.9), ("z", 50.0, 1.0, 61, None)]
    df = spark.createDataFrame(notes, "g string, t double, d double, midi long, confidence double").repartition(4)
    line = lambda **kw: sorted(tuple(r) for r in vocals.monophonic(df, ["g"], **kw).collect())
    assert line(width=3.0) == line() == line(width=500.0)
