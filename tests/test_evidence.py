from datetime import datetime, timedelta

from pyspark.sql import functions as F

from timeloom.operators import evidence, gates
from timeloom.streaming import onsets


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_reasons_keep_rejected_rows(spark):
    t = spark.createDataFrame([(1, 5), (2, None), (3, 50)], "id int, n int")
    got = gates.with_reasons(t, {"few": F.col("n") < 10, "odd": F.col("id") % 2 == 1})
    assert rows(got.select("id", "reasons", "accepted")) == [(1, ["few", "odd"], False), (2, [], True), (3, ["odd"], False)]
    assert rows(gates.with_reasons(t, {}).select("accepted").distinct()) == [(True,)]


def test_sanitize_mends_between_good_rows(spark):
    times = [0.0, 2.0, 4.0, 3.9, 8.0, 10.0, 12.0]
    t = spark.createDataFrame([("a", 2.0 * i, w) for i, w in enumerate(times)], "k string, n double, w double")
    got = gates.sanitize_intervals(t, ["k"], "n", "w", F.lit(4)).orderBy("n").collect()
    assert [r.bad for r in got] == [False, False, True, True, True, False, False]
    assert [round(r.clean, 9) for r in got] == [0.0, 2.0, 4.0, 6.0, 8.0, 10.0, 12.0]
    assert got[2].reasons == ["non_monotonic", "too_short", "stretch_ratio", "extreme_bpm"] and not any(r.unresolved for r in got)
    edge = spark.createDataFrame([("a", 0.0, 1.0), ("a", 2.0, 0.5), ("a", 4.0, 3.0)], "k string, n double, w double")
    assert [r.unresolved for r in gates.sanitize_intervals(edge, ["k"], "n", "w", F.lit(4)).orderBy("n").collect()] == [True, False, False]
    assert gates.sanitize_intervals(t.limit(0), ["k"], "n", "w", F.lit(4)).count() == 0


def test_checkpoint_gate(spark):
    t = spark.createDataFrame([(1, 0.1), (1, 0.12), (1, 0.3), (2, 0.1), (2, None), (3, 2.0), (3, 2.0), (3, 2.0)], "m int, r double")
    got = {r.m: r for r in gates.checkpoint_gate(t, ["m"], "r", 1.0, 0.12).collect()}
    assert got[1].accepted and got[1].median == 0.12 and round(got[1].mad, 9) == 0.02
    assert not got[2].accepted and got[2].median is None and got[2].n == 1
    assert not got[3].accepted


def test_reliability_and_scale(spark):
    t = spark.createDataFrame([("a", True, 10.0, 0.5), ("a", True, 40.0, 0.7), ("a", False, 0.0, 0.1), ("b", False, 1.0, 0.9)], "role string, ok boolean, r double, c double")
    got = {r.role: round(r.reliability, 9) for r in evidence.role_reliability(t, ["role"], "ok", "r", "c").collect()}
    assert got == {"a": round(2 / 3 * 0.35 + 0.6 * 0.4 + 0.25 / (1 + 15 / 75), 9), "b": round(0.25 / (1 + 250 / 75), 9)}
    s = spark.createDataFrame([(1, "d", 1.0, 0.9, 100, 0, True), (1, "b", 1.004, 0.5, 50, 1, True), (1, "p", 1.2, 1.0, 9, 2, False), (2, "d", 0.97, 0.6, 20, 0, True), (3, "d", 3.0, 0.1, 1, 0, False)], "k int, source string, s double, c double, e int, p int, ok boolean")
    got = {r.k: (r.best, r.agreeing, round(r.scale, 9)) for r in evidence.choose_scale(s, ["k"], "source", "s", "c", "e", "p", "ok").collect()}
    assert got == {1: ("d", 2, round((90 + 25 * 1.004) / 115, 9)), 2: ("d", 1, 0.97), 3: (None, 0, 1.0)}


def test_proposals_and_quality(spark):
    p = spark.createDataFrame([("x", 0.0, 0, 0, 0, 0, 0, 0.0), ("y", 50.0, 10, 14, 2, 1, 0, 80.0), ("z", 900.0, 0, 0, 0, 0, 1, 0.0)], "name string, improvement double, base_mad int, mad int, controls int, warnings int, errors int, jump double").withColumn("k", F.lit(1))
    assert rows(evidence.rank_proposals(p, ["k"], "name").select("rank", "name", "total")) == [(1, "y", 16.0), (2, "x", 0.0), (3, "z", -100.0)]
    q = spark.createDataFrame([(1, "strong", 30), (1, "weak", 10), (2, "unsupported", 5)], "k int, q string, n int")
    got = evidence.quality_rollup(q, ["k"], "q", "n", evidence.QUALITY_SCORE)
    assert [(a, round(b, 9), c) for a, b, c in rows(got)] == [(1, round((30 * 0.91 + 10 * 0.42) / 40, 9), "good"), (2, 0.08, "weak")]


def test_stream_groups_close_behind_the_watermark(spark, tmp_path):
    start = datetime(2024, 1, 1)
    steps = [0, 30, 70, 111, 112, 4000]
    one = spark.createDataFrame([("a", start + timedelta(seconds=s)) for s in steps], "k string, at timestamp")
    one.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = lambda: onsets.chain_groups(spark.readStream.schema(one.schema).parquet(str(tmp_path / "in")), ["k"], "at", 40_000_000, "1 minute")
    sizes = lambda df: sorted((r.n, (r.last_us - r.first_us) // 1_000_000) for r in df.collect())
    assert sizes(onsets.replay(spark, stream())) == [(1, 0), (2, 1), (3, 70)]
    ended = stream().writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    ended.awaitTermination()
    assert sizes(spark.read.parquet(str(tmp_path / "out"))) == [(2, 1), (3, 70)]


def test_empty_stream(spark, tmp_path):
    (tmp_path / "none").mkdir()
    stream = spark.readStream.schema("k string, at timestamp").parquet(str(tmp_path / "none"))
    assert onsets.replay(spark, onsets.chain_groups(stream, ["k"], "at", 1, "1 minute")).count() == 0


def test_opening_of_tied_sources_is_the_earliest_entrance(spark):
    """Of sources as near and of the same priority, in whatever order they come."""
    tied = [(1, "b", 10.2, 21.0, 1), (1, "a", 10.1, 19.0, 1), (1, "c", 10.3, 19.0, 1)]
    for rows in (tied, tied[::-1]):
        df = spark.createDataFrame(rows, "g int, source string, first double, heard double, priority int").coalesce(1).withColumns({"score_start": F.lit(10.0), "content_start": F.lit(20.0), "accepted": F.lit(True)})
        got = gates.choose_opening(df, ["g"], together=0.5).first()
        assert (got.score_anchor, got.audio_anchor) == (10.1, 19.0)
