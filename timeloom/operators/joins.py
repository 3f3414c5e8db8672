"""As-of, nearest, range, overlap and containment joins without cross joins.

Rows with a null time match nothing; left rows stay, with nulls. A column
that a join adds replaces one of that name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.operators import sequence


def _stretch(time: str, width: float) -> Column:
    return F.floor(F.col(time) / F.lit(width)).cast("long")


def asof(left: DataFrame, right: DataFrame, keys: list[str], time: str, start: str, values: list[str], width: int | None = None) -> DataFrame:
    """Adds to each left row the ``values`` of the last right row of its keys with start <= time (null: none).

    Of right rows with equal starts the one with the greatest values counts.
    With ``width`` each key is dealt out in stretches of that much time, so a
    few keys still use all tasks; a stretch gets the last right row before it
    from a join of stretches, which has one row a stretch.
    """
    left = left.drop(*(v for v in values if v in left.columns and v not in (*keys, time)))
    if width:
        cut, dealt = left.withColumn("_stretch", _stretch(time, width)), right.select(*keys, start, *(v for v in values if v != start)).where(F.col(start).isNotNull()).withColumn("_stretch", _stretch(start, width))
        kept = [c for c in dealt.columns if c not in (*keys, "_stretch")]
        last = dealt.groupBy(*keys, "_stretch").agg(F.max(F.struct(start, *(c for c in kept if c != start))).alias("_last")).select(*keys, (F.col("_stretch") + 1).alias("_from"), "_last")
        carried = asof(cut.select(*keys, "_stretch").distinct(), last, keys, "_stretch", "_from", ["_last"]).where("_last is not null")
        both = dealt.unionByName(carried.select(*keys, "_stretch", "_last.*"))
        return asof(cut, both, [*keys, "_stretch"], time, start, values).drop("_stretch")
    wide = F.struct(F.col(start).alias("_from"), *values)
    a = left.select(*keys, F.col(time).alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"), F.lit(None).cast(right.select(wide.alias("w")).schema["w"].dataType).alias("_at"))
    b = right.where(F.col(start).isNotNull()).select(*keys, F.col(start).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(left.select(F.struct(*left.columns).alias("w")).schema["w"].dataType).alias("_row"), wide.alias("_at"))
    by = Window.partitionBy(*keys).orderBy("_t", "_side", "_at").rowsBetween(Window.unboundedPreceding, 0)
    found = a.unionByName(b).withColumn("_at", F.last("_at", ignorenulls=True).over(by)).where("_side = 1")
    return found.select("_row.*", *(F.col(f"_at.{v}").alias(v) for v in values))


def nearest_within(left: DataFrame, right: DataFrame, left_id: str, left_time: str, right_id: str, right_time: str, radius: int) -> DataFrame:
    """For each left row the right row nearest in time, within ``radius``; the earlier one, then the lower id, on ties.

    Each right time is dealt to the bucket as wide as the radius it lies in
    and to both beside it, once with its lowest id; the last one before a left
    row and the first one after it are then found by order, so no pairs are formed.
    """
    a = left.select(F.col(left_id).alias("id"), F.col(left_time).alias("t")).where("t is not null").withColumn("_b", F.expr(f"t div {radius}"))
    times = right.select(F.col(right_id).alias("other_id"), F.col(right_time).alias("u")).where("u is not null").groupBy("u").agg(F.min("other_id").alias("other_id"))
    b = times.withColumn("_b", F.explode(F.array(*(F.expr(f"u div {radius} + {k}") for k in (-1, 0, 1)))))
    id_kind, other_kind = dict(a.dtypes)["id"], dict(b.dtypes)["other_id"]
    both = a.select("_b", "t", F.lit(True).alias("_asks"), "id", F.lit(None).cast(f"struct<u:{dict(b.dtypes)['u']},other_id:{other_kind}>").alias("_o"))
    both = both.unionByName(b.select("_b", F.col("u").alias("t"), F.lit(False).alias("_asks"), F.lit(None).cast(id_kind).alias("id"), F.struct("u", "other_id").alias("_o")))
    ahead = Window.partitionBy("_b").orderBy("t", "_asks").rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy("_b").orderBy(F.desc("t"), "_asks").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_p", F.last("_o", ignorenulls=True).over(ahead)).withColumn("_n", F.last("_o", ignorenulls=True).over(back)).where("_asks")
    before, after = F.col("t") - F.col("_p.u"), F.col("_n.u") - F.col("t")
    pick = F.when(before <= F.coalesce(after, before), F.col("_p")).otherwise(F.col("_n"))
    best = found.withColumn("_m", pick).where(F.abs(F.col("_m.u") - F.col("t")) <= radius).groupBy("_b", "id", "t").agg(F.first("_m").alias("m"))
    return best.select("id", F.col("m.other_id").alias("other_id"), (F.col("m.u") - F.col("t")).alias("residual"))


def apply_map(rows: DataFrame, time: str, controls: DataFrame, out: str = "mapped", width: int | None = None) -> DataFrame:
    """Maps times through piecewise linear controls (x, y): slope one before the first and after the last."""
    by = Window.partitionBy().orderBy("x") if "part" not in controls.columns else Window.partitionBy("part").orderBy("x")
    names = {c: f"_{c}" for c in ("x", "y", "x2", "y2")}
    pieces = controls.select(F.lit(0).alias("_k"), F.col("x").alias("_x"), F.col("y").alias("_y"), F.lead("x").over(by).alias("_x2"), F.lead("y").over(by).alias("_y2"))
    placed = asof(rows.withColumn("_k", F.lit(0)), pieces, ["_k"], time, "_x", list(names.values()), width)
    line = F.col("_y") + (F.col(time) - F.col("_x")) * (F.col("_y2") - F.col("_y")) / (F.col("_x2") - F.col("_x"))
    return placed.withColumn(out, F.coalesce(line, F.col("_y") + F.col(time) - F.col("_x"), F.col(time))).drop("_k", *names.values())


def self_pairs(rows: DataFrame, on: list[str], label: str, value: str) -> DataFrame:
    """Ordered pairs of labels (a < b) that share ``on``, with both values."""
    a = rows.select(*on, F.col(label).alias("a"), F.col(value).alias("va"))
    b = rows.select(*on, F.col(label).alias("b"), F.col(value).alias("vb"))
    return a.join(b, on).where("a < b")


def members_of(spans: DataFrame, rows: DataFrame, keys: list[str], start: str, end: str, time: str, width: float, closed: bool = False) -> DataFrame:
    """Rows inside spans of their keys: [start, end), or [start, end] if ``closed``, with the columns of both.

    A span meets the rows of the stretches of ``width`` it touches, so the
    join is on equality; a span costs as many copies as stretches it touches.
    """
    dealt = spans.where(F.col(start) <= F.col(end)).withColumn("_stretch", F.explode(F.sequence(_stretch(start, width), _stretch(end, width))))
    met = dealt.join(rows.withColumn("_stretch", _stretch(time, width)), [*keys, "_stretch"]).drop("_stretch")
    return met.where((F.col(time) >= F.col(start)) & ((F.col(time) <= F.col(end)) if closed else (F.col(time) < F.col(end))))


def overlapping(left: DataFrame, right: DataFrame, keys: list[str], a: tuple[str, str], b: tuple[str, str], width: float, tolerance: float = 0.0, closed: bool = False) -> DataFrame:
    """Pairs of spans of the same keys that overlap, or, ``closed``, touch; open overlap may be short of ``tolerance``.

    Both sides are dealt to the stretches they touch; a pair is kept in the
    first stretch they share, so it comes once.
    """
    x = left.withColumn("_first", _stretch(a[0], width)).withColumn("_stretch", F.explode(F.sequence("_first", F.greatest("_first", _stretch(a[1], width)))))
    y = right.withColumn("_begin", F.floor((F.col(b[0]) - tolerance) / width).cast("long")).withColumn("_stretch", F.explode(F.sequence("_begin", F.greatest("_begin", F.floor((F.col(b[1]) + tolerance) / width).cast("long")))))
    met = x.join(y, [*keys, "_stretch"]).where(F.col("_stretch") == F.greatest("_first", "_begin")).drop("_stretch", "_first", "_begin")
    latest, soonest = F.greatest(F.col(a[0]), F.col(b[0])), F.least(F.col(a[1]), F.col(b[1]))
    return met.where(latest <= soonest if closed else latest < soonest + tolerance)


def overlap_share(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Length that two inclusive integer spans share over the shorter one's; 0 if they share none."""
    shared = F.least(a_end, b_end) - F.greatest(a_start, b_start) + 1
    shorter = F.least(a_end - a_start, b_end - b_start) + 1
    return F.when(shared > 0, shared / F.greatest(shorter, F.lit(1))).otherwise(0.0)


def nearest_span(rows: DataFrame, spans: DataFrame, keys: list[str], ident: str, span: tuple[str, str], other: tuple[str, str], kind: str, limit: float) -> DataFrame:
    """Per row the nearest span of its keys within ``limit``: its kind and distance (0: they overlap), ties to the earlier one.

    Rows without one keep nulls. Both sides are dealt to the stretches of
    ``limit`` they touch, the row widened by it. In a stretch the spans are
    put in order once: the first whose running latest end passes the row's
    start overlaps it or none does, and else the nearest ends on either side
    decide. So no pairs are formed.
    """
    width = max(limit, 1e-9)
    s, e = F.col(span[0]).cast("double"), F.col(span[1]).cast("double")
    asked = rows.select(*keys, ident, s.alias("_s"), e.alias("_e")).where(F.col(ident).isNotNull() & F.col("_s").isNotNull() & F.col("_e").isNotNull())
    deal = lambda df, a, z: df.withColumn("_stretch", F.explode(F.sequence(F.floor(a / width).cast("long"), F.greatest(F.floor(a / width), F.floor(z / width)).cast("long"))))
    asked = deal(asked, F.col("_s") - limit, F.col("_e") + limit).distinct()
    given = spans.select(*keys, F.col(other[0]).cast("double").alias("_s"), F.col(other[1]).cast("double").alias("_e"), F.col(kind).alias("_kind")).where("_s is not null and _e is not null").distinct()
    given = deal(given, F.col("_s"), F.col("_e")).withColumn(ident, F.lit(0).cast(dict(rows.dtypes)[ident]))  # not null, which would turn whole numbers into doubles in pandas
    both = asked.withColumn("_kind", F.lit(None).cast(dict(spans.dtypes)[kind])).withColumn("_asks", F.lit(True)).unionByName(given.withColumn("_asks", F.lit(False)))
    for key in keys:
        both = both.where(F.col(key).isNotNull())  # as in a join, null keys meet nothing

    def kernel(g: pd.DataFrame) -> dict:
        asks = g["_asks"].to_numpy(bool)
        x, y = g[asks], g[~asks].reset_index(drop=True)  # y is in order of start, end and kind
        xs, xe, ys, ye = (d[c].to_numpy(float) for d in (x, y) for c in ("_s", "_e"))
        n, best, apart = len(y), np.full(len(x), -1), np.full(len(x), np.inf)
        if n and len(x):
            def offer(at: np.ndarray, d: np.ndarray, fits: np.ndarray) -> None:
                better = fits & (d <= limit) & ((d < apart) | ((d == apart) & (at < best)))
                best[better], apart[better] = at[better], d[better]

            proper = np.flatnonzero(ys < ye + 1e-9)
            if len(proper):
                first = np.searchsorted(np.maximum.accumulate(ye[proper] + 1e-9), xs, side="right")
                at = proper[np.minimum(first, len(proper) - 1)]
                offer(at, np.zeros(len(x)), (first < len(proper)) & (ys[at] < xe + 1e-9) & (xs < xe + 1e-9))
            for values in (ys, ye):
                order = np.argsort(values, kind="stable")
                ends = values[order]
                for own in (xs, xe):
                    right = np.searchsorted(ends, own, side="left")
                    left = np.searchsorted(ends, ends[np.maximum(right - 1, 0)], side="left")
                    for place, fits in ((np.minimum(right, n - 1), right < n), (left, right > 0)):
                        offer(order[place], np.abs(own - ends[place]), fits)
        got = np.flatnonzero(best >= 0)
        return {"_id": x[ident].to_numpy()[got], "_d": apart[got], "_os": ys[best[got]], "_oe": ye[best[got]], "_near": y["_kind"].to_numpy()[best[got]]}

    schema = f"_id {dict(rows.dtypes)[ident]}, _d double, _os double, _oe double, _near {dict(spans.dtypes)[kind]}"
    near = sequence.per_group(both, [*keys, "_stretch"], ["_s", "_e", "_kind"], kernel, schema).withColumnRenamed("_id", ident)
    best = near.groupBy(*keys, ident).agg(F.min(F.struct("_d", "_os", "_oe", "_near")).alias("_m"))
    return rows.join(best, [*keys, ident], "left").select(*rows.columns, F.col("_m._near").alias("near_kind"), F.col("_m._d").alias("near_distance"))


def without_near(rows: DataFrame, others: DataFrame, keys: list[str], time: str, other_time: str, radius: float) -> DataFrame:
    """Rows that have no other within ``radius`` (inclusive) of their time."""
    near = others.select(*keys, F.col(other_time).alias("_o")).withColumn("_stretch", F.explode(F.array(*(_stretch("_o", radius) + k for k in (-1, 0, 1)))))
    dealt = rows.withColumn("_stretch", _stretch(time, radius))
    on = [dealt[k].eqNullSafe(near[k]) for k in keys]
    met = (dealt["_stretch"] == near["_stretch"]) & (F.abs(dealt[time] - near["_o"]) <= radius)
    for c in on:
        met = met & c
    return dealt.join(near, met, "left_anti").drop("_stretch")


def lookup_layers(rows: DataFrame, key: str, layers: list[DataFrame], value: str, default: str | None = None) -> DataFrame:
    """Adds ``value`` from the first layer (key, value) that names the key, even if it says null; else ``default``.

    Layers hold each key once.
    """
    out = rows.drop(value)
    found, present = [], []
    for i, layer in enumerate(layers):
        out = out.join(layer.select(key, F.struct(F.col(value).alias("v")).alias(f"_l{i}")), key, "left")
        found.append(F.col(f"_l{i}.v"))
        present.append(F.col(f"_l{i}").isNotNull())
    pick: Column = F.lit(default)
    for f, p in zip(reversed(found), reversed(present), strict=True):
        pick = F.when(p, f).otherwise(pick)
    return out.withColumn(value, pick).drop(*(f"_l{i}" for i in range(len(layers))))


def full_merge(left: DataFrame, right: DataFrame, keys: list[str], items: str, position: str, label: str, apart: float) -> DataFrame:
    """Full outer join on keys of two tables of arrays of structs, both arrays in one.

    Of items with the same ``label`` that lie within ``apart`` of an earlier kept one (by position) only the first stays; left
    items come before right ones at equal positions.
    """
    both = left.select(*keys, F.col(items).alias("_a")).join(right.select(*keys, F.col(items).alias("_b")), keys, "full")
    empty = F.array().cast(left.schema[items].dataType)
    whole = F.concat(F.coalesce("_a", empty), F.coalesce("_b", empty))
    placed = F.array_sort(F.transform(whole, lambda x, i: F.struct(x[position].alias("p"), i.alias("i"), x.alias("x"))))
    kind = left.schema[items].dataType.simpleString()
    kept = F.aggregate(placed, F.array().cast(kind), lambda acc, s: F.when(F.exists(acc, lambda k: (k[label] == s["x"][label]) & (F.abs(k[position] - s["x"][position]) <= apart)), acc).otherwise(F.concat(acc, F.array(s["x"]))))
    return both.select(*keys, kept.alias(items), F.col("_a").isNotNull().alias("in_left"), F.col("_b").isNotNull().alias("in_right"))


def grid_candidates(rows: DataFrame, first: float, step: float, count: int, name: str) -> DataFrame:
    """Every row with each of ``count`` evenly spaced values; the grid is a constant array, not a join."""
    values = F.array(*(F.lit(first + step * i) for i in range(count)))
    return rows.select("*", F.posexplode(values).alias(f"{name}_index", name))


def similar_sources(rows: DataFrame, keys: list[str], source: str, values: str, likeness, least: float) -> DataFrame:
    """Pairs of sources of the same keys with their likeness (a column function of two arrays), those of ``least`` or more flagged."""
    pairs = self_pairs(rows, keys, source, values)
    return pairs.withColumn("similarity", likeness(F.col("va"), F.col("vb"))).withColumn("similar", F.col("similarity") >= least).drop("va", "vb")
