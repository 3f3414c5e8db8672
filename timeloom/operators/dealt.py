"""Order-dependent results of keys that one task can't hold: places, slopes and heads, in blocks that tasks share out.

Places come from range partitions. What has to be counted over a whole key is
counted inside blocks and between them, where a table of one row a pair of
blocks says all there is to say.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timeloom.functions import slopes
from timeloom.operators.sequence import per_group, per_groups
from timeloom.sources.shared import cut


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right, strict=True)))


def placed(rows: DataFrame, keys: list[str], order: list[Column], name: str = "place") -> DataFrame:
    """Adds each row's place in its key, from 0; equal rows stand in free order.

    The rows are sorted by range partitions and written to the shared folder, so the places stay as they are.
    """
    by = [*(F.col(k).asc_nulls_last() for k in keys), *order]
    dealt = cut(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33).alias("_part")
    sizes = dealt.groupBy(part).agg(F.count("*").alias("_n"))
    along = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_before"))
    whole = dealt.withColumn("_part", F.shiftright("_id", 33)).join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
    if not keys:
        return whole.select(*rows.columns, name)
    first = whole.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.min(name).alias("_first"))
    return whole.join(first, _same(keys, [f"_{k}" for k in keys])).select(*rows.columns, (F.col(name) - F.col("_first")).alias(name))


def _blocks(ranked: DataFrame, own: list[str], a: str, b: str, block: int) -> DataFrame:
    return ranked.withColumn("_ab", F.floor(F.col(a) / block).cast("long")).withColumn("_bb", F.floor(F.col(b) / block).cast("long"))


def _table(cells: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rows a pair of blocks, and how many rows stand behind it in a and below it in b."""
    held = np.zeros((int(cells["_ab"].max()) + 1, int(cells["_bb"].max()) + 1), np.int64)
    held[cells["_ab"], cells["_bb"]] = cells["n"]
    behind = np.zeros_like(held)
    behind[:-1] = np.cumsum(held[::-1], axis=0)[::-1][1:]
    below = np.zeros_like(held)
    below[:, 1:] = np.cumsum(behind, axis=1)[:, :-1]
    return held, below


def count_descents(ranked: DataFrame, own: list[str], a: str, b: str, block: int) -> DataFrame:
    """``own`` and ``falls``: how many pairs of rows rise in place ``a`` and fall in place ``b``; places are numbers from 0 within ``own``.

    Pairs in one block of a, and those in one block of b but not of a, are
    counted by merging in that block's task; all others by the table of blocks.
    """
    rows = _blocks(ranked, own, a, b, block)

    def inside(g: pd.DataFrame) -> dict:
        return {"falls": [slopes.descents(g[b].to_numpy(float), np.ones(len(g), bool), np.ones(len(g), bool))]}

    def across(g: pd.DataFrame) -> dict:
        z, whole = g[b].to_numpy(float), np.ones(len(g), bool)
        edges = np.flatnonzero(np.diff(g["_ab"].to_numpy(), prepend=-1, append=-1))
        again = sum(slopes.descents(z[p:q], whole[p:q], whole[p:q]) for p, q in zip(edges[:-1], edges[1:], strict=True))
        return {"falls": [slopes.descents(z, whole, whole) - again]}

    def between(g: pd.DataFrame) -> dict:
        held, below = _table(g)
        return {"falls": [int((held * below).sum())]}

    cells = rows.groupBy(*own, "_ab", "_bb").agg(F.count("*").alias("n"))
    parts = [per_group(rows.select(*own, "_ab", a, b), [*own, "_ab"], [a], inside, "falls bigint"), per_group(rows.select(*own, "_bb", "_ab", a, b), [*own, "_bb"], [a], across, "falls bigint"), per_group(cells, own, ["_ab", "_bb"], between, "falls bigint")]
    return reduce(DataFrame.unionByName, (p.select(*own, "falls") for p in parts)).groupBy(*own).agg(F.sum("falls").alias("falls"))


def list_descents(ranked: DataFrame, own: list[str], a: str, b: str, carried: list[str], block: int) -> DataFrame:
    """The pairs that ``count_descents`` counts: ``own`` and ``carried`` of both rows, the second's with the ending ``_2``. To be asked where they are few."""
    rows = _blocks(ranked, own, a, b, block)
    kinds = dict(ranked.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in carried), *(f"{c}_2 {kinds[c]}" for c in carried)])

    def pairs(g: pd.DataFrame, apart: bool) -> dict:
        found: list[np.ndarray] = []
        whole = np.ones(len(g), bool)
        slopes.descents(g[b].to_numpy(float), whole, whole, found)
        i, j = np.concatenate(found, axis=1) if found else np.zeros((2, 0), int)
        if apart:
            keep = g["_ab"].to_numpy()[i] != g["_ab"].to_numpy()[j]
            i, j = i[keep], j[keep]
        return {c: g[c].to_numpy()[i] for c in carried} | {f"{c}_2": g[c].to_numpy()[j] for c in carried}

    def between(g: pd.DataFrame) -> dict:
        held, below = _table(g)
        x, y = np.nonzero((held > 0) & (below > 0))
        made = [(i, j, p, q) for i, j in zip(x.tolist(), y.tolist(), strict=True) for p, q in zip(*np.nonzero(held[i + 1 :, :j]), strict=True)]
        made = [(i, j, i + 1 + p, q) for i, j, p, q in made]
        return dict(zip(("_ab", "_bb", "_ab2", "_bb2"), zip(*made, strict=True) if made else ([], [], [], []), strict=True))

    cells = rows.groupBy(*own, "_ab", "_bb").agg(F.count("*").alias("n"))
    met = per_group(cells, own, ["_ab", "_bb"], between, "_ab bigint, _bb bigint, _ab2 bigint, _bb2 bigint")
    second = rows.select(*own, F.col("_ab").alias("_ab2"), F.col("_bb").alias("_bb2"), *(F.col(c).alias(f"{c}_2") for c in carried))
    far = rows.select(*own, "_ab", "_bb", *carried).join(met, [*own, "_ab", "_bb"]).join(second, [*own, "_ab2", "_bb2"])
    columns = [*own, *carried, *(f"{c}_2" for c in carried)]
    near = [per_group(rows, [*own, "_ab"], [a], lambda g: pairs(g, False), schema), per_group(rows, [*own, "_bb"], [a], lambda g: pairs(g, True), schema)]
    return reduce(DataFrame.unionByName, (p.select(*columns) for p in [*near, far]))


STATE = "low double, high double, under bigint, over bigint, room bigint, turn int, wide double, tall double"


def _probes(low: float, high: float, under: int, over: int, rank: int, room: int, turn: int, wide: float, tall: float, drawn: np.ndarray) -> list[float]:
    """Slopes to count next, for one wanted rank; none once the bracket is narrow. ``wide`` and ``tall``: extent of the points."""
    if np.isfinite(low) and np.isfinite(high) and (over - under <= room or high - low <= 4 * slopes.resolution(max(abs(low), abs(high)), wide, tall)):
        return []
    at = (rank + 0.5 - under) / (over - under)
    inside = drawn[(drawn > low) & (drawn < high)]
    if len(inside) >= 8:
        margin = min(0.25, max(0.01, 0.35 * room / (over - under), 1.0 / len(inside)))
        made = [float(np.quantile(inside, min(max(q, 0.0), 1.0), method="nearest")) for q in (at - margin, at + margin)]
        if made[0] == made[1]:
            by = slopes.resolution(made[0], wide, tall)
            made = [made[0] - by, made[0] + by]
        return made
    if np.isfinite(low) and np.isfinite(high):
        margin = min(0.25, max(0.02, 0.35 * room / (over - under)))
        return [low + (high - low) * min(max(q, 0.001), 0.999) for q in (at - margin, at + margin)] if turn % 3 else [low + (high - low) / 2]
    reach = max(1.0, *(abs(v) for v in (low, high) if np.isfinite(v)), 1.0) * 2.0**turn
    return [low + reach] if np.isfinite(low) else [high - reach] if np.isfinite(high) else [-reach, reach]


def median_slopes(rows: DataFrame, keys: list[str], x: str, y: str, block: int = 1_000_000, rounds: int = 60) -> DataFrame:
    """As ``robust.theil_sen``, for keys of more points than a task holds: (keys, slope, pairs).

    Each round counts, for a few slopes a key, the pairs below them; the
    slopes of a narrow bracket (four a point at most) are then listed. Keys
    should not be null. Where more slopes than that lie within rounding of
    each other, the middle of the bracket is given.
    """
    points = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    extent = points.groupBy(*keys).agg(F.min("_x").alias("_left"), F.min("_y").alias("_low"), (F.max("_x") - F.min("_x")).alias("wide"), (F.max("_y") - F.min("_y")).alias("tall"))
    points = cut(placed(points, keys, [F.col("_x"), F.col("_y")], "_a").join(extent, keys))
    ties = points.groupBy(*keys, "_x").agg(F.count("*").alias("_t"), F.first("wide").alias("wide"), F.first("tall").alias("tall"))
    sizes = ties.groupBy(*keys).agg(F.sum("_t").alias("n"), F.sum(F.expr("_t * (_t - 1) div 2")).alias("_same"), F.first("wide").alias("wide"), F.first("tall").alias("tall")).withColumn("pairs", F.expr("n * (n - 1) div 2 - _same")).where("pairs > 0")
    sizes = cut(sizes.select(*keys, "n", "pairs", "wide", "tall"))
    some = points.join(sizes.select(*keys, "n"), keys).where(F.col("_a") % F.ceil(F.col("n") / 256) == 0)  # steers the search, decides nothing

    def draw(g: pd.DataFrame) -> dict:
        return {"drawn": [np.sort(slopes._direct(g["_x"].to_numpy(), g["_y"].to_numpy(), 0.0)).tolist()]}

    drawn = per_group(some.select(*keys, "_x", "_y"), keys, ["_x"], draw, "drawn array<double>")
    own = [*keys, "rank"]
    ranks = sizes.withColumn("rank", F.explode(F.array_distinct(F.array(F.expr("(pairs - 1) div 2"), F.expr("pairs div 2")))))
    state = ranks.join(drawn, keys).select(*own, F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"), F.lit(0).cast("long").alias("under"), F.col("pairs").alias("over"), (F.col("n") * 4).alias("room"), F.lit(0).alias("turn"), "wide", "tall", "drawn", F.array().cast("array<struct<s:double,falls:bigint>>").alias("counted"))
    columns = [*own, *(c.split()[0] for c in STATE.split(", ")), "drawn"]
    schema = ", ".join([*(f"{k} {dict(state.dtypes)[k]}" for k in own), STATE, "drawn array<double>, probes array<double>"])

    def advance(batches):
        for batch in batches:
            out = []
            for r in batch.to_dict("records"):
                for c in r["counted"]:
                    if r["low"] < c["s"] < r["high"]:
                        if c["falls"] <= r["rank"]:
                            r["low"], r["under"] = c["s"], c["falls"]
                        else:
                            r["high"], r["over"] = c["s"], c["falls"]
                r["probes"] = _probes(r["low"], r["high"], r["under"], r["over"], r["rank"], r["room"], r["turn"], r["wide"], r["tall"], np.asarray(r["drawn"]))
                r["turn"] += 1
                out.append([r[c] for c in (*columns, "probes")])
            yield pd.DataFrame(out, columns=[*columns, "probes"])

    state = cut(state.mapInPandas(advance, schema))
    for _ in range(rounds):
        open_ = state.where(F.size("probes") > 0).select(*own, F.explode("probes").alias("s"))
        if open_.isEmpty():
            break
        ranked = placed(points.join(open_, keys).withColumn("_z", F.col("_y") - F.col("_low") - F.col("s") * (F.col("_x") - F.col("_left"))).select(*own, "s", "_a", "_z"), [*own, "s"], [F.col("_z"), F.col("_a")], "_b")
        counted = count_descents(ranked, [*own, "s"], "_a", "_b", block).groupBy(*own).agg(F.collect_list(F.struct("s", "falls")).alias("counted"))
        ask = state.drop("probes").join(counted, own, "left").withColumn("counted", F.coalesce("counted", F.array().cast("array<struct<s:double,falls:bigint>>")))
        state = cut(ask.mapInPandas(advance, schema))
    few = state.where("over - under <= room").select(*own, "low", "high", "under")
    held = points.join(few, keys)
    first = placed(held.withColumn("_z", F.col("_y") - F.col("_low") - F.col("low") * (F.col("_x") - F.col("_left"))), own, [F.col("_z"), F.col("_a")], "_p")
    second = placed(first.withColumn("_z", F.col("_y") - F.col("_low") - F.col("high") * (F.col("_x") - F.col("_left"))), own, [F.col("_z"), F.col("_p")], "_q")
    listed = list_descents(second.select(*own, "_p", "_q", "_x", "_y"), own, "_p", "_q", ["_x", "_y"], block).where("_x_2 > _x")
    ordered = placed(listed.select(*own, F.expr("(_y_2 - _y) / (_x_2 - _x)").alias("s")), own, [F.col("s")], "at")
    exact = ordered.join(few, own).where("at = rank - under").select(*own, "s")
    close = state.where("over - under > room").select(*own, ((F.col("low") + F.col("high")) / 2).alias("s"))
    return exact.unionByName(close).groupBy(*keys).agg(F.avg("s").alias("slope")).join(sizes.select(*keys, "pairs"), keys).select(*keys, "slope", "pairs")


def _last_heads(t: np.ndarray, tolerance: float) -> np.ndarray:
    """For each of the sorted times, the last head of these times if it is one itself; by doubling of steps."""
    n = len(t)
    jump, last = np.searchsorted(t, t + tolerance, side="right"), np.arange(n)
    while (jump < n).any():
        on = np.flatnonzero(jump < n)
        to = jump[on]
        last[on], jump[on] = last[to], jump[to]
    return last


def head_times(counted: DataFrame, keys: list[str], time: str, tolerance: float, width: float) -> DataFrame:
    """(keys, time, n, head) of distinct times (``n`` of each): heads as of ``islands.head_anchored``, a key dealt out in stretches of ``width``, ``tolerance`` at least.

    A stretch whose first time comes more than ``tolerance`` after all before
    starts anew. Of the others each task says, for every time that may be the
    first head there, which head is then the last; so each is a pointer into
    the next stretch, and the pointers that are taken are found by doubling.
    Tasks hold a stretch each, however long a key goes on unbroken. Keys
    should not be null.
    """
    kind = dict(counted.dtypes)[time]
    width = max(width, tolerance)
    rows = counted.select(*keys, F.col(time).alias("t"), "n", F.floor(F.col(time) / width).cast("long").alias("_s"))
    along = Window.partitionBy(*keys).orderBy("_s")  # one row a stretch
    stretch = rows.groupBy(*keys, "_s").agg(F.min("t").alias("_a"), F.max("t").alias("_z"))
    stretch = stretch.withColumn("_anew", F.coalesce(F.col("_a") - F.lag("_z").over(along) > tolerance, F.lit(True)))
    stretch = cut(stretch.withColumn("_to", F.lead("_s").over(along)).withColumn("_after", F.lead("_a", 2).over(along)).withColumn("_to2", F.lead("_s", 2).over(along)).withColumn("_anew1", F.lead("_anew").over(along)).withColumn("_anew2", F.lead("_anew", 2).over(along)))

    def entries(g: pd.DataFrame, starts: np.ndarray) -> tuple[np.ndarray, dict]:
        t, anew, number = g["t"].to_numpy(), g["_anew"].to_numpy(bool), g["_s"].to_numpy()
        own, first, last = [], [], []
        for k, (a, z) in enumerate(zip(starts, np.append(starts[1:], len(t)), strict=True)):
            mine = t[a:z]
            if anew[a]:
                at = 0
                while (after := int(np.searchsorted(mine, mine[at] + tolerance, side="right"))) < len(mine):
                    at = max(after, at + 1)
                some, ends = mine[:1], mine[at : at + 1]
            else:
                some = mine[: int(np.searchsorted(mine, number[a] * width + tolerance, side="right")) + 1]
                ends = mine[_last_heads(mine, tolerance)[: len(some)]]
            own.append(np.full(len(some), k))
            first.append(some)
            last.append(ends)
        return np.concatenate(own), {"entry": np.concatenate(first), "last": np.concatenate(last)}

    own = [*keys, "_s"]
    nodes = cut(per_groups(rows.join(stretch.select(*own, "_anew"), own), [*own, "_anew"], ["t"], entries, f"entry {kind}, last {kind}"))

    # the next head after a last head: in the next stretch, or else the first of the one after
    leaving = nodes.select(*own, "last").distinct().join(stretch.select(*own, "_to", "_anew1"), own).where("not _anew1").select(*keys, F.col("_to").alias("_s"), F.lit(1).alias("asks"), F.col("last").alias("t"), F.col("_s").alias("from"))
    met = nodes.where("not _anew").select(*own, F.lit(0).alias("asks"), F.col("entry").alias("t"), F.lit(None).cast("long").alias("from")).unionByName(leaving)

    def enter(g: pd.DataFrame, starts: np.ndarray) -> tuple[np.ndarray, dict]:
        asks, t = g["asks"].to_numpy() == 1, g["t"].to_numpy()
        ends = np.append(starts[1:], len(t))
        at = np.zeros(len(t), np.int64)
        for a, z in zip(starts, ends, strict=True):
            m = a + int(np.count_nonzero(~asks[a:z]))
            at[m:z] = a + np.searchsorted(t[a:m], t[m:z] + tolerance, side="right")
            at[m:z] = np.where(at[m:z] < m, at[m:z], -1)
        some = np.flatnonzero(asks)
        group = np.searchsorted(starts, some, side="right") - 1
        found = pd.array(t[np.maximum(at[some], 0)], dtype="Int64" if kind == "bigint" else "Float64")
        found[at[some] < 0] = pd.NA
        return group, {"from": g["from"].to_numpy()[some].astype("int64"), "last": t[some], "next": found}

    met = per_groups(met, own, ["asks", "t"], enter, f"from bigint, last {kind}, next {kind}")
    ahead = stretch.select(*keys, F.col("_s").alias("from"), "_to", "_to2", "_after", "_anew2")
    beyond = F.col("next").isNull()
    steps = met.drop("_s").join(ahead, [*keys, "from"]).select(*keys, F.col("from").alias("_s"), "last", F.when(beyond, F.when(~F.col("_anew2"), F.col("_after"))).otherwise(F.col("next")).alias("next"), F.when(beyond, F.col("_to2")).otherwise(F.col("_to")).alias("next_s")).where("next is not null")
    jump = cut(nodes.join(steps, [*own, "last"]).select(*own, "entry", "next_s", "next"))
    taken = nodes.where("_anew").select(*own, "entry")
    on = [*own, "entry"]
    while True:
        new = cut(taken.join(jump, on).select(*keys, F.col("next_s").alias("_s"), F.col("next").alias("entry")))
        if new.isEmpty():
            break
        taken = cut(taken.unionByName(new))
        ahead = jump.select(*keys, F.col("_s").alias("next_s"), F.col("entry").alias("next"), F.col("next_s").alias("_s2"), F.col("next").alias("_n2"))
        jump = cut(jump.join(ahead, [*keys, "next_s", "next"]).select(*own, "entry", F.col("_s2").alias("next_s"), F.col("_n2").alias("next")))

    heads = taken.join(nodes.select(*own, "entry", "last"), on)
    carried = stretch.select(*own).join(heads, own, "left").withColumn("_carry", F.last("last", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1))).select(*own, "entry", "_carry")

    def final(g: pd.DataFrame, starts: np.ndarray) -> tuple[np.ndarray, dict]:
        t, entry, carry = g["t"].to_numpy(), g["entry"], g["_carry"]
        some, held = entry.notna().to_numpy(), carry.notna().to_numpy()
        entry, carry = entry.fillna(0).to_numpy(t.dtype), carry.fillna(0).to_numpy(t.dtype)
        head, ends = np.empty(len(t), t.dtype), np.append(starts[1:], len(t))
        for a, z in zip(starts, ends, strict=True):
            at = a + int(np.searchsorted(t[a:z], entry[a])) if some[a] else z
            head[a:at] = carry[a] if held[a] else 0
            while at < z:
                end = max(a + int(np.searchsorted(t[a:z], t[at] + tolerance, side="right")), at + 1)
                head[at:end] = t[at]
                at = end
        return np.repeat(np.arange(len(starts)), ends - starts), {"time": t, "n": g["n"].to_numpy(), "head": head}

    return per_groups(rows.join(carried, own), own, ["t"], final, f"time {kind}, n bigint, head {kind}").drop("_s")


def regions(rows: DataFrame, keys: list[str], start: str, end: str, width: float, name: str = "_region") -> DataFrame:
    """Adds the number of the unbroken region a span lies in: a new one begins where a span starts when all before it have ended.

    A key is dealt out in stretches of ``width``; a table of one row a stretch carries on how far spans reach.
    """
    own = [*keys, "_s"]
    by = Window.partitionBy(*own).orderBy(start, end)
    spans = cut(rows.where(F.col(start).isNotNull()).withColumn("_s", F.floor(F.col(start) / width).cast("long")))  # read several times
    along = Window.partitionBy(*keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    reach = spans.groupBy(*own).agg(F.max(end).alias("_z"))
    reach = reach.select(*own, F.max("_z").over(along).alias("_reached"))
    begun = spans.join(reach, own).withColumn("_reached", F.greatest("_reached", F.max(end).over(by.rowsBetween(Window.unboundedPreceding, -1))))
    begun = begun.withColumn("_new", F.coalesce((F.col(start) >= F.col("_reached")).cast("int"), F.lit(1)))
    counted = begun.groupBy(*own).agg(F.sum("_new").alias("_n"))
    before = counted.select(*own, F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_before"))
    inside = F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0))
    return begun.withColumn("_in", inside).join(before, own).withColumn(name, F.col("_before") + F.col("_in")).select(*rows.columns, name)
