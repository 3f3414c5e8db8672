"""Tempo maps, measures, meters and beats.

All functions work per ``keys`` (the song, the role), which share nothing.
Rows with a null tick or time are left out of maps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.operators import joins

FALLBACK = 120.0  # beats a minute where nothing says otherwise
EARLIEST = -(1 << 62)


def tempo_events(rows: DataFrame, keys: list[str], tick: str, bpm: str, order: str | None = None, initial: float | Column = FALLBACK, drop_repeats: bool = True) -> DataFrame:
    """(keys, tick, bpm): one tempo a tick, the last by ``order`` (default: the fastest), from tick 0 on.

    Keys without an event at tick 0 start with ``initial``. Tempos equal to the one before are left out unless ``drop_repeats`` is false.
    Keys are dealt out once, over a count of tasks that is not merged into fewer, and sorted; no key and no tick is a group in memory.
    """
    seen = rows.where(F.col(tick).isNotNull() & (F.col(bpm) > 0))
    start = initial if isinstance(initial, Column) else F.lit(float(initial))
    ranked = [F.col(order).alias("_order")] if order else []
    told = seen.select(*keys, F.col(tick).cast("long").alias("tick"), F.col(bpm).cast("double").alias("bpm"), *ranked, *([start.cast("double").alias("_start")] if isinstance(initial, Column) else []))
    last = Window.partitionBy(*keys).orderBy("tick", *(["_order"] if order else []), "bpm")
    session = rows.sparkSession
    many = max(int(session.conf.get("spark.sql.shuffle.partitions")), 4 * session.sparkContext.defaultParallelism)
    ahead = told.repartition(many, *keys).withColumn("_ahead", F.lead("tick").over(last))
    per_tick = ahead.where(F.col("_ahead").isNull() | (F.col("_ahead") != F.col("tick")))
    by = Window.partitionBy(*keys).orderBy("tick")
    beside = per_tick.withColumn("_before", F.lag("tick").over(by)).withColumn("_after", F.lead("tick").over(by)).withColumn("_p", F.lag("bpm").over(by))
    at, own = F.col("tick"), F.col("bpm") if not order else F.when(F.col("_order").isNotNull(), F.col("bpm"))
    opening = F.col("_start") if isinstance(initial, Column) else start
    # The opening comes first, or, where ticks are negative, between them and the others.
    opens = F.coalesce(((at >= 0) & (F.col("_before") < 0)) | (F.col("_before").isNull() & (at > 0)), F.lit(False))
    ends = (at < 0) & F.col("_after").isNull()
    new = lambda value, before: (before.isNull() | (before != value)) if drop_repeats else F.lit(True)
    row = lambda tick_, value: F.struct(tick_.cast("long").alias("tick"), value.alias("bpm"))
    made = F.array(F.when(opens & new(opening, F.col("_p")), row(F.lit(0), opening)), F.when(new(own, F.when(opens, opening).otherwise(F.col("_p"))), row(at, own)), F.when(ends & new(opening, own), row(F.lit(0), opening)))
    return beside.select(*keys, F.inline(F.filter(made, lambda r: r.isNotNull())))


def segments(events: DataFrame, keys: list[str], ppq: float = 960.0, head: bool = False) -> DataFrame:
    """Tempo events with ``seconds`` at their tick, and ``open``, the tick from which they hold; the first holds always.

    Time starts at the first event, or, with ``head``, at tick 0.
    """
    by = Window.partitionBy(*keys).orderBy("tick")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    length = (F.lead("tick").over(by) - F.col("tick")) / ppq * (60.0 / F.col("bpm"))
    measured = events.withColumn("_length", length).withColumn("_first", F.row_number().over(by) == 1)
    lead_in = F.first(F.greatest(F.lit(0.0), F.col("tick") / ppq * (60.0 / F.col("bpm")))).over(by.rowsBetween(Window.unboundedPreceding, 0)) if head else F.lit(0.0)
    timed = measured.withColumn("seconds", lead_in + F.coalesce(F.sum("_length").over(before), F.lit(0.0)))
    return timed.withColumn("open", F.when(F.col("_first"), F.lit(EARLIEST)).otherwise(F.col("tick"))).drop("_length", "_first")


def seconds_at(rows: DataFrame, events: DataFrame, keys: list[str], tick: str, out: str = "seconds", ppq: float = 960.0, head: bool = False, width: int | None = None) -> DataFrame:
    """Adds the seconds of each row's tick; keys without tempo run at the fallback.

    Ticks before the first event run backwards at its tempo, or, with ``head``, stay at its time.
    """
    pieces = segments(events, keys, ppq, head).select(*keys, F.col("open").alias("_open"), F.col("tick").alias("_tick"), F.col("bpm").alias("_bpm"), F.col("seconds").alias("_seconds"))
    placed = joins.asof(rows, pieces, keys, tick, "_open", ["_tick", "_bpm", "_seconds"], width)
    run = F.col(tick) - F.col("_tick")
    run = F.greatest(F.lit(0), run) if head else run
    known = F.col("_seconds") + run / ppq * (60.0 / F.col("_bpm"))
    return placed.withColumn(out, F.coalesce(known, F.col(tick) / ppq * (60.0 / FALLBACK))).drop("_tick", "_bpm", "_seconds")


def active_tempo(rows: DataFrame, events: DataFrame, keys: list[str], tick: str, out: str = "bpm", default: float = FALLBACK, width: int | None = None) -> DataFrame:
    """Adds the last tempo at or before each row's tick."""
    found = joins.asof(rows, events.select(*keys, F.col("tick").alias("_tick"), F.col("bpm").alias("_bpm")), keys, tick, "_tick", ["_bpm"], width)
    return found.withColumn(out, F.coalesce("_bpm", F.lit(default))).drop("_bpm")


def rebase(events: DataFrame, keys: list[str], first: Column) -> DataFrame:
    """Events with ticks counted from ``first``; the tempo active there opens the map, before any event that of the first one."""
    by = Window.partitionBy(*keys).orderBy("tick")
    at = events.where(F.col("tick").isNotNull()).withColumn("_first", first).withColumn("_before", F.lag("tick").over(by)).withColumn("_after", F.lead("tick").over(by))
    reached = F.coalesce(F.col("tick") <= F.col("_first"), F.lit(False))
    active = (reached & (F.col("_after").isNull() | (F.col("_after") > F.col("_first")))) | (F.col("_before").isNull() & ~reached)
    row = lambda tick: F.struct(tick.cast("long").alias("tick"), F.col("bpm"))
    made = F.array(F.when(active, row(F.lit(0))), F.when(F.col("tick") > F.col("_first"), row(F.col("tick") - F.col("_first"))))
    return at.select(*keys, F.inline(F.filter(made, lambda r: r.isNotNull())))


def expected_events(visits: DataFrame, automations: DataFrame, keys: list[str], bar: str, start: str, length: str, order: str, ratio: str, bpm: str, initial: float = FALLBACK) -> DataFrame:
    """Tempo changes written into bars, laid on each visit of their bar; a ratio over 1 is in percent.

    Where none falls on tick 0, the map opens with the last one played, or ``initial``.
    """
    part = F.coalesce(F.col(ratio).cast("double"), F.lit(0.0))
    part = F.when(part > 1, part / 100.0).otherwise(part)
    laid = visits.join(automations.where(F.col(bpm).isNotNull()), [*keys, bar]).withColumn("_tick", F.rint(F.col(start) + part * F.coalesce(F.col(length), F.lit(0))).cast("long"))
    opening = F.max_by(bpm, F.struct(order, part, bpm)).over(Window.partitionBy(*keys))
    return tempo_events(laid.withColumn("_opening", opening).withColumn("_order", F.struct(order, part, bpm)), keys, "_tick", bpm, "_order", F.coalesce(F.col("_opening"), F.lit(initial)))


def measures(downbeats: DataFrame, keys: list[str], time: str, infer_end: bool = False) -> DataFrame:
    """Downbeats with ``start``, ``end`` and ``duration`` of their measure.

    The last one is left out, or, with ``infer_end``, as long as the one
    before; a measure that does not advance is left out only without it.
    """
    by = Window.partitionBy(*keys).orderBy(time)
    t = F.col(time)
    end = F.lead(time).over(by)
    end = F.coalesce(end, t * 2 - F.lag(time).over(by)) if infer_end else end
    made = downbeats.withColumn("start", t).withColumn("end", end).where(F.col("end").isNotNull())
    return (made if infer_end else made.where("end > start")).withColumn("duration", F.col("end") - F.col("start"))


def final_end(downbeats: DataFrame, keys: list[str], time: str) -> DataFrame:
    """Per key the last downbeat plus the last positive length of a measure."""
    by = Window.partitionBy(*keys).orderBy(time)
    length = F.lead(time).over(by) - F.col(time)
    longest = downbeats.select(*keys, F.col(time).alias("_t"), F.when(length > 0, length).alias("_d"))
    return longest.groupBy(*keys).agg((F.max("_t") + F.coalesce(F.max_by("_d", F.when(F.col("_d").isNotNull(), F.col("_t"))), F.lit(0))).alias("end"))


def measure_at(rows: DataFrame, bars: DataFrame, keys: list[str], time: str, values: list[str], width: int | None = None) -> DataFrame:
    """Adds the ``values`` of the measure that holds each row's time; before the first measure those of the first."""
    first = bars.groupBy(*keys).agg(F.min(F.struct("start", *(v for v in values if v != "start"))).alias("_f")).select(*keys, *(F.col(f"_f.{v}").alias(f"_first_{v}") for v in values))
    placed = joins.asof(rows, bars.select(*keys, "start", *(v for v in values if v != "start")), keys, time, "start", ["start", *(v for v in values if v != "start")], width).withColumnRenamed("start", "_start")
    both = placed.join(first, keys, "left")
    kept = [c for c in placed.columns if c not in (*values, "_start")]
    early = F.col("_start").isNull()
    return both.select(*kept, *(F.when(early, F.col(f"_first_{v}")).otherwise(F.col("_start") if v == "start" else F.col(v)).alias(v) for v in values))


def position(rows: DataFrame, bars: DataFrame, keys: list[str], time: str, meter: str, width: int | None = None) -> DataFrame:
    """Adds the measure's start, duration and meter and ``beat``: 1 on the downbeat, one more a beat."""
    placed = measure_at(rows, bars, keys, time, ["start", "duration", meter], width)
    return placed.withColumn("beat", (F.col(time) - F.col("start")) / F.col("duration") * F.greatest(F.lit(1), F.col(meter)) + 1.0)


def meter_at(rows: DataFrame, signatures: DataFrame, keys: list[str], time: str, start: str, meter: str, fallback: Column | None = None, width: int | None = None) -> DataFrame:
    """Adds the last signature that starts at or before the time (a nanosecond late at most), else ``fallback`` or 4."""
    late = rows.withColumn("_t", F.col(time) + 1e-9)
    found = joins.asof(late, signatures.select(*keys, F.col(start).cast("double").alias("_s"), F.col(meter).alias("_m")), keys, "_t", "_s", ["_m"], width)
    return found.withColumn(meter, F.greatest(F.lit(1), F.coalesce("_m", F.lit(4) if fallback is None else fallback))).drop("_m", "_t")


def duration_or_last(time: str, by) -> Column:
    """Time to the next row, for the last row time from the one before; null unless positive."""
    ahead, behind = F.lead(time).over(by) - F.col(time), F.col(time) - F.lag(time).over(by)
    length = F.coalesce(ahead, behind)
    return F.when(length > 0, length)


def dense_tempo(downbeats: DataFrame, keys: list[str], time: str, meter: str | Column, unit: float = 1.0, fallback: float = FALLBACK) -> DataFrame:
    """Adds ``bpm`` of each measure from its length (``unit`` is a second); one that does not advance repeats the one before."""
    by = Window.partitionBy(*keys).orderBy(time)
    length = F.lead(time).over(by) - F.col(time)
    beats = F.col(meter) if isinstance(meter, str) else meter
    own = downbeats.withColumn("_bpm", F.when(length > 0, beats * (60.0 * unit) / length))
    return own.withColumn("bpm", F.coalesce(F.last("_bpm", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0)), F.lit(fallback))).drop("_bpm")


def explicit_beats(downbeats: DataFrame, keys: list[str], time: str, meter: str, measure: str) -> DataFrame:
    """(keys, time, measure) of every beat: the measure on downbeats, -1 within; the last measure is as long as the last known.

    Beats that would not come after the one before are left out.
    """
    by = Window.partitionBy(*keys).orderBy(time, measure)
    length = F.lead(time).over(by) - F.col(time)
    known = downbeats.withColumn("_own", length).withColumn("_good", F.when(F.col("_own") > 0, F.col("_own")))
    before = F.last("_good", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0))
    known = known.withColumn("_d", F.when(F.col("_own").isNull(), before).otherwise(F.col("_good"))).withColumn("_again", F.col(time) == F.lag(time).over(by))
    split = known.where(~F.coalesce(F.col("_again"), F.lit(False))).withColumn("_i", F.explode(F.when(F.col("_d").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.greatest(F.lit(1), F.col(meter)).cast("int") - 1))))
    return split.select(*keys, (F.col(time) + F.when(F.col("_i") > 0, F.col("_i") * F.col("_d") / F.col(meter)).otherwise(0)).alias("time"), F.when(F.col("_i") == 0, F.col(measure).cast("long")).otherwise(F.lit(-1).cast("long")).alias("measure"))


def changes(rows: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Rows whose value is not null and differs from the last one that was not null."""
    by = Window.partitionBy(*keys).orderBy(*order)
    return rows.where(F.col(value).isNotNull()).withColumn("_p", F.lag(value).over(by)).where(F.col("_p").isNull() | (F.col("_p") != F.col(value))).drop("_p")


def song_timeline(headers: DataFrame, keys: list[str], order: str, time: str, meter: str) -> tuple[DataFrame, DataFrame]:
    """Measures with their meter (the last one written, 4 before any), and the rows where the meter changes."""
    by = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = headers.withColumn("ts_num", F.coalesce(F.last(meter, ignorenulls=True).over(by), F.lit(4)))
    return filled, changes(headers, keys, [order], meter).select(*keys, time, meter)


def beatmap(nominal: DataFrame, warped: DataFrame, keys: list[str], order: str, time: str, warped_time: str, meter: str, segment: str, measure: str, occurrence: str, repaired: DataFrame | None = None, safe: tuple[float, float] = (0.9, 1.1)) -> DataFrame:
    """One row a beat: identity, times on both clocks, both tempos, local stretch and flags.

    ``nominal`` and ``warped`` pair by keys and ``order``; a beat divides its
    measure evenly. ``repaired`` lists (keys, measure) whose interval was mended.
    """
    by = Window.partitionBy(*keys).orderBy(order)
    both = nominal.join(warped.select(*keys, order, F.col(warped_time).alias("_w")), [*keys, order])
    both = both.withColumn("_nd", duration_or_last(time, by)).withColumn("_wd", duration_or_last("_w", by)).withColumn("_next", F.lead(measure).over(by))
    if repaired is not None:
        both = both.join(repaired.select(*keys, F.col(measure), F.lit(True).alias("_r")).distinct(), [*keys, measure], "left")
    else:
        both = both.withColumn("_r", F.lit(None).cast("boolean"))
    count = F.greatest(F.lit(1), F.col(meter))
    stretch = F.col("_wd") / F.col("_nd")
    beats = both.withColumn("stretch", stretch).withColumn("beat_index", F.explode(F.sequence(F.lit(0), count.cast("int") - 1))).withColumn("_f", F.col("beat_index") / count)
    flags = F.filter(F.array(F.when(~F.col("stretch").between(*safe), F.lit("stretch_outside_safe_range")), F.when(F.col("_r"), F.lit("repaired_timeline_interval"))), lambda f: f.isNotNull())
    return beats.select(
        *keys, F.format_string("seg%03d.m%04d.o%02d.b%02d", F.col(segment).cast("int"), F.col(measure).cast("int"), F.col(occurrence).cast("int"), "beat_index").alias("beat_id"), F.col(segment).alias("segment"), F.col(measure).alias("measure"), "beat_index",
        (F.col(time) + F.coalesce("_nd", F.lit(0)) * F.col("_f")).alias("score_time"), (F.col("_w") + F.coalesce("_wd", F.lit(0)) * F.col("_f")).alias("audio_time"),
        (count * 60.0 / F.col("_nd")).alias("nominal_bpm"), (count * 60.0 / F.col("_wd")).alias("mapped_bpm"), "stretch", F.when(F.col("beat_index") == 0, "downbeat").otherwise("beat").alias("structural_role"), F.col("_next").alias("right_measure"), flags.alias("flags"),
    )


def validate_beatmap(beats: DataFrame, keys: list[str], order: list[str], safe: tuple[float, float] = (0.9, 1.1)) -> DataFrame:
    """Per key counts of repeated ids, times that are not finite or do not rise within a segment, unsafe stretches, and a status."""
    t = F.col("audio_time")
    by = Window.partitionBy(*keys, "segment").orderBy(*order)
    twice = beats.groupBy(*keys, "beat_id").agg((F.count("*") - 1).alias("_n")).groupBy(*keys).agg(F.sum("_n").alias("duplicate_ids"))
    finite = lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))
    rest = beats.withColumn("_p", F.lag("audio_time").over(by)).groupBy(*keys).agg(
        F.count_if(~(finite(t) & finite(F.col("score_time")))).alias("non_finite"), F.count_if(t <= F.col("_p")).alias("non_monotonic"), F.count_if(~F.col("stretch").between(*safe)).alias("unsafe_stretch")
    )
    errors = F.col("duplicate_ids") + F.col("non_finite") + F.col("non_monotonic")
    return rest.join(twice, keys).withColumn("status", F.when(errors > 0, "error").when(F.col("unsafe_stretch") > 0, "warning").otherwise("ok"))


def compare_series(a: DataFrame, b: DataFrame, keys: list[str], order: list[str], time: str, values: list[str], tolerance: float = 0.00011) -> DataFrame:
    """Per key both counts, mismatches of two series row by row (time beyond the tolerance, or other values), largest difference, status."""
    by = Window.partitionBy(*keys).orderBy(*order)
    x = a.select(*keys, F.row_number().over(by).alias("_i"), F.struct(time, *values).alias("_a"))
    y = b.select(*keys, F.row_number().over(by).alias("_i"), F.struct(time, *values).alias("_b"))
    both = x.join(y, [*keys, "_i"], "full")
    off = F.abs(F.col(f"_a.{time}") - F.col(f"_b.{time}"))
    differs = off > tolerance
    for v in values:
        differs = differs | ~F.col(f"_a.{v}").eqNullSafe(F.col(f"_b.{v}"))
    lone = F.col("_a").isNull() | F.col("_b").isNull()
    got = both.groupBy(*keys).agg(F.count("_a").alias("n_a"), F.count("_b").alias("n_b"), F.max(off).alias("largest"), F.count_if(lone | differs).alias("mismatches"))
    return got.withColumn("status", F.when(F.col("mismatches") == 0, "equivalent").otherwise("mismatch"))


def require_equal(compared: DataFrame) -> DataFrame:
    """The rows of ``compare_series``; an error as soon as one of them is a mismatch."""
    checked = F.assert_true(F.col("status") == "equivalent", F.concat(F.lit("series differ: "), F.to_json(F.struct(*compared.columns))))
    return compared.withColumn("_ok", checked).where("_ok is null").drop("_ok")
