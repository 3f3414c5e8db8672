"""Section fit: windows of written measures placed on performed events, paths through the placements, their fusion and the map made of it.

Windows, candidates and paths are rows. What is greedy or ordered inside one
role or song runs in a kernel; a group there is a song's role, never the
whole table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom.operators import fusion, islands, joins
from timeloom.operators.gates import MODES
from timeloom.operators.sequence import CELLS, agreements, agreements_of, aligned_run, alignment_tables, dealt_by, in_order, per_group, per_long_group


@dataclass(frozen=True)
class Fit:
    """Fixed values of the fit, in seconds and measures."""

    measures: tuple[int, int, int] = (3, 4, 6)  # fewest, wanted, most
    overlap: int = 1
    context: int = 8
    seconds: tuple[float, float] = (6.0, 16.0)
    radius: float = 8.0
    stretch: tuple[float, float, float] = (0.90, 1.10, 0.01)
    step: float = 0.10
    fewest: int = 5
    coverage: float = 0.50
    median: float = 0.12
    maximum: float = 0.35
    skips: tuple[float, float] = (0.22, 0.025)
    context_weight: float = 0.12
    apart: float = 0.75
    most: int = 5


TOGETHER = 64  # slices weighed at once, then twice as many each time


def windows(bars: DataFrame, keys: list[str], fit: Fit = Fit()) -> DataFrame:
    """(keys, window, first, last, start, end, context_start, context_end): runs of measures that overlap by one, about eleven seconds long.

    ``bars``: index (0, 1, ...), start, end. A key holds a song's measures.
    """
    return per_group(bars, keys, ["index"], lambda g: _windows(g["start"].to_numpy(float), g["end"].to_numpy(float), fit), "window bigint, first bigint, last bigint, start double, end double, context_start double, context_end double")


def _windows(a: np.ndarray, z: np.ndarray, fit: Fit) -> dict:
    """Columns of the windows of one song's measures."""
    fewest, wanted, most = fit.measures
    out, at, n = [], 0, len(a)
    while at < n:
        counts = np.arange(min(fewest, n - at), min(most, n - at) + 1)
        length = z[at + counts - 1] - a[at]
        outside = np.maximum(0, fit.seconds[0] - length) + np.maximum(0, length - fit.seconds[1])
        count = int(counts[np.lexsort((counts, np.abs(length - sum(fit.seconds) / 2), np.abs(counts - wanted), outside))[0]])
        stop = min(n, at + fit.context)
        out.append((len(out), at, at + count - 1, a[at], z[at + count - 1], a[max(0, stop - fit.context)], z[stop - 1]))
        at += max(1, count - fit.overlap)
    names = ("window", "first", "last", "start", "end", "context_start", "context_end")
    return dict(zip(names, zip(*out, strict=True) if out else ([] for _ in names), strict=True))


def with_groups(made: DataFrame, groups: DataFrame, keys: list[str], role: str, width: float = 16.0) -> DataFrame:
    """Each window for each role with its onset groups and those of its context, as arrays in time; ``observable`` says there are enough.

    ``groups``: role, time, symbols (sorted array of ints).
    """
    gathered = lambda df, name: df.groupBy(*keys, role, "window").agg(F.array_sort(F.collect_list(F.struct("time", "symbols"))).alias(name))
    own = gathered(joins.members_of(made.select(*keys, "window", "start", "end"), groups, keys, "start", "end", "time", width), "groups")
    near = gathered(joins.members_of(made.select(*keys, "window", F.col("context_start").alias("_a"), F.col("context_end").alias("_z")), groups, keys, "_a", "_z", "time", width), "context")
    roles = groups.select(*keys, role).distinct()
    whole = made.join(roles, keys).join(own, [*keys, role, "window"], "left").join(near, [*keys, role, "window"], "left")
    empty = F.array().cast("array<struct<time:double,symbols:array<int>>>")
    return whole.withColumn("groups", F.coalesce("groups", empty)).withColumn("context", F.coalesce("context", empty)).withColumn("observable", F.size("groups") >= Fit.fewest)


def gathered(made: DataFrame, groups: DataFrame, keys: list[str], role: str, baseline: str = "start", fit: Fit = Fit(), width: float = 16.0) -> DataFrame:
    """Each window for each role with enough written groups: these, those of its context and the performed ones that it can reach, as arrays in time.

    ``groups``: role, time, symbols and side, ``written`` or ``performed``;
    ``baseline`` is a column of the windows, the same for all roles. All
    groups meet the windows in one join and are gathered at once.
    """
    low, high = _reach(F.col(baseline), F.col("start"), F.col("end"), fit)
    asked = made.withColumn("_lo", low).withColumn("_hi", high)
    asked = asked.withColumn("_first", F.least("start", "context_start", "_lo")).withColumn("_last", F.greatest("end", "context_end", "_hi"))
    met = joins.members_of(asked, groups.select(*keys, role, "time", "symbols", (F.col("side") == "written").alias("_written")), keys, "_first", "_last", "time", width, closed=True)
    at, is_written = F.col("time"), F.col("_written")
    within = {"groups": is_written & (at >= F.col("start")) & (at < F.col("end")), "context": is_written & (at >= F.col("context_start")) & (at < F.col("context_end")), "heard": ~is_written & at.between(F.col("_lo"), F.col("_hi"))}
    got = met.groupBy(*keys, role, "window").agg(*(F.first(c).alias(c) for c in made.columns if c not in (*keys, "window")), *(F.array_sort(F.collect_list(F.when(w, F.struct("time", "symbols")))).alias(name) for name, w in within.items()))
    return got.where((F.size("groups") >= fit.fewest) & (F.size("heard") > 0))


def _reach(expected: Column | float, start: Column | float, end: Column | float, fit: Fit) -> tuple:
    """First and last time at which a performed group can matter to a window."""
    reach = fit.radius + max(0.5, fit.maximum * 2) + 1e-6
    return expected - reach, expected + (end - start) * fit.stretch[1] + reach


def _lowest(sets: list[np.ndarray]) -> np.ndarray:
    return np.array([int(s.min()) if len(s) else -1 for s in sets], np.int64)


def _step_likeness(a: np.ndarray, b: np.ndarray) -> float:
    """How alike the steps from group to group are, by the groups' lowest symbols (-1: none, passed over)."""
    x, y = np.diff(a[a >= 0]), np.diff(b[b >= 0])
    n = min(len(x), len(y))
    return float(np.where(x[:n] == y[:n], 1.0, np.where(x[:n] % 12 == y[:n] % 12, 0.5, 0.0)).mean()) if n else 0.0


CANDIDATE = "midi_start double, midi_end double, stretch double, translation double, matched bigint, coverage double, median_residual double, maximum_residual double, sequence_score double, context_score double, score double"


def _steps_alike(a: np.ndarray, b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """``_step_likeness`` of a and each run [lo, hi) of b."""
    x, heard = np.diff(a[a >= 0]), b >= 0
    y, place = np.diff(b[heard]), np.concatenate(([0], np.cumsum(heard)))
    n = np.clip(place[hi] - place[lo] - 1, 0, len(x))
    if not len(x) or not len(y):
        return np.zeros(len(lo))
    step = y[np.minimum(place[lo][:, None] + np.arange(len(x)), len(y) - 1)]
    worth = np.where(step == x, 1.0, np.where(step % 12 == x % 12, 0.5, 0.0))
    return np.where(np.arange(len(x)) < n[:, None], worth, 0.0).sum(axis=1) / np.maximum(n, 1)


def _supported(stretches: np.ndarray, first: float, step: float, targets: int, apart: np.ndarray, likeness: np.ndarray, heard: np.ndarray, within: tuple[float, ...]) -> list[np.ndarray]:
    """Of each transform, how many written groups (``apart`` from the window's start) have a performed one that agrees at all no further than each of ``within`` from where they are placed.

    An agreeing pair votes for a run of the evenly spaced targets. The runs
    of a written group come in order, so each gives way to the one before and
    a group is counted once.
    """
    i, j = np.nonzero(likeness > 0)
    same, width = i[1:] == i[:-1], targets + 1
    out = [np.empty((len(stretches), targets), np.int64) for _ in within]
    some = max(1, CELLS // max(1, len(i)))
    for at in range(0, len(stretches), some):
        part = stretches[at : at + some]
        middle = (heard[j] - part[:, None] * apart[i] - first) / step  # stretch, pair
        row = np.arange(len(part))[:, None] * width
        for found, near in zip(out, within, strict=True):
            lo = np.clip(np.ceil(middle - near / step - 1e-6), 0, targets).astype(np.int64)
            hi = np.clip(np.floor(middle + near / step + 1e-6) + 1, 0, targets).astype(np.int64)
            lo[:, 1:] = np.where(same, np.maximum(lo[:, 1:], hi[:, :-1]), lo[:, 1:])
            votes = np.bincount((row + lo).ravel(), minlength=len(part) * width) - np.bincount((row + hi).ravel(), minlength=len(part) * width)
            found[at : at + some] = np.cumsum(votes.reshape(len(part), width), axis=1)[:, :targets]
    return [found.ravel() for found in out]


def _best_gains(likeness: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The highest likeness of each row within each run [lo, hi) of columns, by tables of the highest of 1, 2, 4, ... columns."""
    out = np.empty((len(likeness), len(lo)))
    power, table = np.frexp(hi - lo)[1] - 1, likeness
    for k in range(int(power.max(initial=-1)) + 1):
        mine = np.flatnonzero(power == k)
        out[:, mine] = np.maximum(table[:, lo[mine]], table[:, hi[mine] - 2**k])
        table = np.maximum(table[:, : -(2**k)], table[:, 2**k :])
    return out


def _distinct(start: np.ndarray, score: np.ndarray, coverage: np.ndarray, residual: np.ndarray, number: np.ndarray, fit: Fit) -> list[int]:
    """The best rows that lie ``apart`` in time, at most ``most``."""
    left = np.lexsort((number, residual, -coverage, -score))
    kept: list[int] = []
    while len(left) and len(kept) < fit.most:
        kept.append(int(left[0]))
        left = left[np.abs(start[left] - start[left[0]]) >= fit.apart]
    return kept


def evaluate(start: float, end: float, expected: float, times: np.ndarray, sets: list[np.ndarray], context: list[np.ndarray], heard: np.ndarray, heard_sets: list[np.ndarray], fit: Fit) -> list[tuple]:
    """``best_placements`` of groups given as sets of symbols."""
    if not len(times) or not len(heard):
        return []
    return best_placements(start, end, expected, times, agreements(sets, heard_sets), _lowest(context), heard, _lowest(heard_sets), fit)


def best_placements(start: float, end: float, expected: float, times: np.ndarray, likeness: np.ndarray, own: np.ndarray, heard: np.ndarray, lows: np.ndarray, fit: Fit) -> list[tuple]:
    """The best placements of one window, distinct in time, best first.

    ``likeness`` of the window's groups (at ``times``) and the performed ones
    (at ``heard``); ``own`` and ``lows`` are the lowest symbols of the
    context's groups and of the performed ones.

    All stretches and translations of the grid count, but few are aligned.
    A placement is only accepted if every match lies within ``maximum`` of
    its place, half of them within ``median``, and the matches cover enough:
    so transforms without that many agreeing performed groups at these
    distances are left out, whatever their alignment. The slices of performed
    groups that the others see are aligned once each, in order of a bound on
    their score (each written group's best agreement, what must be skipped,
    the coverage its transforms can reach); once the best ones kept are above
    every bound left, the rest can't change them. Slices that begin together
    share one table of the alignment.
    """
    n = len(times)
    stretches = fit.stretch[0] + fit.stretch[2] * np.arange(round((fit.stretch[1] - fit.stretch[0]) / fit.stretch[2]) + 1)
    targets = expected - fit.radius + fit.step * np.arange(round(2 * fit.radius / fit.step) + 1)
    needed = max(fit.fewest, int(np.ceil(fit.coverage * n - 1e-9)))
    covered, close = _supported(stretches, targets[0], fit.step, len(targets), times - start, likeness, heard, (fit.maximum, fit.median))
    usable = np.flatnonzero((covered >= needed) & (2 * close >= needed))
    stretch = stretches[usable // len(targets)]
    shift = targets[usable % len(targets)] - stretch * start
    margin = max(0.5, fit.maximum * 2)
    left = np.searchsorted(heard, shift + stretch * start - margin, side="left")
    right = np.searchsorted(heard, shift + stretch * end + margin, side="right")
    enough = right - left >= fit.fewest
    usable, stretch, shift = usable[enough], stretch[enough], shift[enough]
    slices, of = np.unique(left[enough] * (len(heard) + 1) + right[enough], return_inverse=True)
    if not len(slices):
        return []
    lo, hi = np.divmod(slices, len(heard) + 1)
    around = _steps_alike(own, lows, lo, hi)
    most_covered = np.zeros(len(slices), np.int64)
    np.maximum.at(most_covered, of, covered[usable])
    gain = _best_gains(likeness, lo, hi)
    whole = np.where(gain > 0, gain, -fit.skips[0]).sum(axis=0) - np.maximum(0, hi - lo - n) * fit.skips[1]
    bound = 0.58 * whole / n + 0.20 * most_covered / n + 0.10 + fit.context_weight * around + 1e-9
    order = np.argsort(-bound, kind="stable")
    by_slice = np.argsort(of, kind="stable")
    edges = np.searchsorted(of[by_slice], np.arange(len(slices) + 1))
    begins, first_of = np.unique(lo, return_inverse=True)
    ends = np.zeros(len(begins), np.int64)
    np.maximum.at(ends, first_of, hi)
    tables: dict[int, tuple[np.ndarray, memoryview]] = {}
    rows, kept = np.empty((0, 8)), []  # start, score, coverage, median and largest residual, sequence, transform, matches
    at, some = 0, order[:0]
    while at < len(order):
        some = order[at : at + min(1024, max(TOGETHER, 2 * len(some)))]
        at += len(some)
        if len(kept) == fit.most and bound[some[0]] < rows[kept[-1], 1]:
            break
        new = [b for b in np.unique(first_of[some]).tolist() if b not in tables]
        tables |= zip(new, alignment_tables(likeness, begins[new], ends[new], *fit.skips), strict=True)
        mine, own_of = np.concatenate([by_slice[edges[k] : edges[k + 1]] for k in some.tolist()]), np.cumsum(edges[some + 1] - edges[some])
        place = shift[mine][:, None] + stretch[mine][:, None] * times
        starts = np.concatenate(([0], own_of[:-1]))
        least = np.searchsorted(heard, np.minimum.reduceat(place, starts) - fit.maximum - 1e-9, side="left") - lo[some][:, None]
        most = np.searchsorted(heard, np.maximum.reduceat(place, starts) + fit.maximum + 1e-9, side="right") - lo[some][:, None]
        aligned = []
        for k, a, z in zip(some.tolist(), least.tolist(), most.tolist(), strict=True):
            found = aligned_run(tables[first_of[k]], n, int(hi[k] - lo[k]), (a, z))  # None: no transform has all its matches near
            if found and len(found[1]) >= fit.fewest:
                aligned.append((k, *found))
        if not aligned:
            continue
        matches = np.array([len(pairs) for _, _, pairs in aligned])
        i, j = np.zeros((2, len(aligned), matches.max()), np.int64)
        for r, (k, _, pairs) in enumerate(aligned):
            i[r, : len(pairs)], j[r, : len(pairs)] = np.array(pairs).T
            j[r] += lo[k]
        number = np.array([k for k, _, _ in aligned])
        mine = np.concatenate([by_slice[edges[k] : edges[k + 1]] for k in number.tolist()])
        r = np.repeat(np.arange(len(aligned)), edges[number + 1] - edges[number])
        off = np.abs(heard[j[r]] - (shift[mine][:, None] + stretch[mine][:, None] * times[i[r]]))
        off[np.arange(off.shape[1]) >= matches[r][:, None]] = np.inf
        off.sort(axis=1)
        each, half = np.arange(len(r)), matches[r] // 2
        middle, most = np.where(matches[r] % 2, off[each, half], (off[each, half - 1] + off[each, half]) / 2), off[each, matches[r] - 1]
        coverage, sequence = matches[r] / n, np.array([worth for _, worth, _ in aligned])[r] / n
        score = 0.58 * sequence + 0.20 * coverage + 0.10 * np.exp(-middle / 0.12) + fit.context_weight * around[number[r]]
        good = (coverage >= fit.coverage) & (middle <= fit.median) & (most <= fit.maximum)
        if good.any():
            made = np.column_stack((shift[mine] + stretch[mine] * start, score, coverage, middle, most, sequence, mine, matches[r]))
            rows = np.concatenate((rows, made[good]))
            kept = _distinct(*rows[:, :4].T, usable[rows[:, 6].astype(np.int64)], fit)
    out = []
    for begin, score, coverage, middle, most, sequence, place, matched in rows[kept].tolist():
        q = int(place)
        out.append((begin, float(shift[q] + stretch[q] * end), float(stretch[q]), float(shift[q]), int(matched), coverage, middle, most, sequence, float(around[of[q]]), score))
    return out


def candidates(made: DataFrame, performed: DataFrame, keys: list[str], role: str, baseline: str = "expected", fit: Fit = Fit()) -> DataFrame:
    """Ranked placements of every observable window: (keys, role, window, rank, chart_start, chart_end) and the columns of a candidate.

    ``made`` as of ``with_groups`` with the column ``baseline`` (where the
    start is expected); ``performed``: role, time, symbols. Only performed
    groups that a window can reach travel to it.
    """
    low, high = _reach(F.col(baseline), F.col("start"), F.col("end"), fit)
    asked = made.where("observable").withColumn("_lo", low).withColumn("_hi", high)
    met = joins.members_of(asked.select(*keys, role, "window", "_lo", "_hi"), performed.select(*keys, role, F.col("time").alias("_t"), F.col("symbols").alias("_s")), [*keys, role], "_lo", "_hi", "_t", 16.0, closed=True)
    heard = met.groupBy(*keys, role, "window").agg(F.array_sort(F.collect_list(F.struct(F.col("_t").alias("time"), F.col("_s").alias("symbols")))).alias("heard"))
    return placements(asked.join(heard, [*keys, role, "window"]), keys, role, baseline, fit)


def placements(asked: DataFrame, keys: list[str], role: str, baseline: str = "start", fit: Fit = Fit()) -> DataFrame:
    """Ranked placements, as of ``candidates``, of windows as of ``gathered``."""
    kinds = dict(asked.dtypes)
    own = [*keys, role, "window"]
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in own), "rank bigint, chart_start double, chart_end double", CANDIDATE])

    def flat(name: str) -> list:
        """Times, symbols one after the other and how many each group has: plain arrays, which reach Python without an object a group."""
        parts = {"t": F.transform(name, lambda g: g["time"]), "s": F.flatten(F.transform(name, lambda g: g["symbols"])), "n": F.transform(name, lambda g: F.size(g["symbols"]))}
        return [c.alias(f"_{name}_{part}") for part, c in parts.items()]

    def sets(symbols: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        return np.split(symbols.astype(np.int64), np.cumsum(sizes)[:-1]) if len(sizes) else []

    def work(batches):
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                found = evaluate(row["start"], row["end"], row[baseline], row["_groups_t"].astype(float), sets(row["_groups_s"], row["_groups_n"]), sets(row["_context_s"], row["_context_n"]), row["_heard_t"].astype(float), sets(row["_heard_s"], row["_heard_n"]), fit)
                out += [(*(row[k] for k in own), rank, row["start"], row["end"], *f) for rank, f in enumerate(found, 1)]
            yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    return dealt_by(asked.select(*own, *dict.fromkeys(("start", "end", baseline)), *flat("groups"), *flat("context"), *flat("heard")), own).mapInPandas(work, schema)


BAR, WRITTEN, PERFORMED = 0, 1, 2  # kinds of rows of a song's role
ROW = "kind int, number bigint, start double, end double, context_start double, context_end double"  # number: a bar's, a window's or a symbol
FOUND = "window bigint, rank bigint, chart_start double, chart_end double, " + CANDIDATE


def role_rows(bars: DataFrame, notes: DataFrame, keys: list[str], role: str) -> DataFrame:
    """Measures and onsets of every song's role as rows of one kind, for ``placed_roles``.

    ``bars``: role, index, start, end; ``notes``: role, side (``written`` or
    ``performed``), time, symbols. Onsets without a key, time or symbol are left out.
    """
    none = F.lit(None).cast("double")
    measures = bars.select(*keys, role, F.lit(BAR).alias("kind"), F.col("index").cast("long").alias("number"), F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end"))
    kind = F.when(F.col("side") == "written", WRITTEN).when(F.col("side") == "performed", PERFORMED)
    onsets = notes.select(*keys, role, kind.alias("kind"), F.explode("symbols").alias("number"), F.col("time").cast("double").alias("start"), none.alias("end")).withColumn("number", F.col("number").cast("long"))
    rows = measures.unionByName(onsets)
    for c in (*keys, role, "kind", "number", "start"):
        rows = rows.where(F.col(c).isNotNull())
    return rows.withColumn("context_start", none).withColumn("context_end", none)


def _grouped(g: pd.DataFrame, tolerance: float) -> pd.DataFrame:
    """A role's rows with its onsets as head-anchored groups: each symbol once, at the time of the group's first onset."""
    kind, number, start, end = (g[c].to_numpy() for c in ("kind", "number", "start", "end"))
    took, at = [np.flatnonzero(kind == BAR)], start.copy()
    for side in (WRITTEN, PERFORMED):
        mine = np.flatnonzero(kind == side)
        mine = mine[np.argsort(start[mine], kind="stable")]
        at[mine] = start[mine][islands.heads(start[mine], tolerance)]
        mine = mine[np.lexsort((number[mine], at[mine]))]
        again = (np.diff(at[mine]) == 0) & (np.diff(number[mine]) == 0)
        took.append(mine[np.concatenate((np.ones(min(1, len(mine)), bool), ~again))])
    some = np.concatenate(took)
    return pd.DataFrame({"kind": kind[some], "number": number[some], "start": at[some], "end": end[some], "context_start": np.nan, "context_end": np.nan})


def _windowed(g: pd.DataFrame, fit: Fit) -> pd.DataFrame:
    """A role's rows with windows in place of its measures."""
    is_bar = g["kind"].to_numpy() == BAR
    bars = g[is_bar].sort_values("number", kind="stable")
    made = _windows(bars["start"].to_numpy(float), bars["end"].to_numpy(float), fit)
    names = [c.split()[0] for c in ROW.split(", ")]
    made |= {"kind": np.full(len(made["window"]), BAR), "number": np.array(made["window"], np.int64)}
    return pd.DataFrame({c: np.concatenate((made[c], g[c].to_numpy()[~is_bar])) for c in names})


class _Groups:
    """Onset groups of one side in time; those of a stretch of time are taken as rows of a membership table."""

    def __init__(self, rows: pd.DataFrame, symbols: np.ndarray) -> None:
        at, held = rows["start"].to_numpy(float), rows["number"].to_numpy()
        self.times, self.first, self.of = np.unique(at, return_index=True, return_inverse=True)
        self.lows, self.code, self.width = held[self.first], np.searchsorted(symbols, held), len(symbols)
        self.first = np.append(self.first, len(at))

    def run(self, start: float, end: float, closed: bool = False) -> slice:
        return slice(*(int(np.searchsorted(self.times, t, side=side)) for t, side in ((start, "left"), (end, "right" if closed else "left"))))

    def table(self, run: slice) -> np.ndarray:
        members = slice(self.first[run.start], self.first[max(run.start, run.stop)])
        out = np.zeros((max(0, run.stop - run.start), self.width))
        out[self.of[members] - run.start, self.code[members]] = 1.0
        return out


def _placed(g: pd.DataFrame, fit: Fit) -> dict:
    """Ranked placements of a role's windows, where the start is expected as written."""
    kind, out = g["kind"].to_numpy(), []
    symbols = np.unique(g["number"].to_numpy()[kind != BAR])
    written, performed = (_Groups(g[kind == side], symbols) for side in (WRITTEN, PERFORMED))
    for window, start, end, a, z in g.loc[kind == BAR, ["number", "start", "end", "context_start", "context_end"]].itertuples(index=False):
        low, high = _reach(start, start, end, fit)
        own, near, heard = written.run(start, end), written.run(a, z), performed.run(low, high, True)
        if own.stop - own.start < fit.fewest or heard.stop <= heard.start:
            continue
        likeness = agreements_of(written.table(own), performed.table(heard), symbols % 12)
        found = best_placements(start, end, start, written.times[own], likeness, written.lows[near], performed.times[heard], performed.lows[heard], fit)
        out += [(window, rank, start, end, *f) for rank, f in enumerate(found, 1)]
    names = [c.split()[0] for c in FOUND.split(", ")]
    return dict(zip(names, zip(*out, strict=True) if out else ([] for _ in names), strict=True))


def placed_roles(rows: DataFrame, keys: list[str], role: str, tolerance: float, fit: Fit = Fit()) -> DataFrame:
    """Ranked placements, as of ``placements``, of rows as of ``role_rows``: a song's role is dealt to a task once and its onset groups, windows and placements are made there, one kernel after the other."""
    own = [*keys, role]
    grouped = per_long_group(rows, own, ["kind", "start", "number"], lambda g: _grouped(g, tolerance), ROW)
    windowed = in_order(grouped, own, lambda g: _windowed(g, fit), ROW)
    return in_order(windowed, own, lambda g: _placed(g, fit), FOUND)


def _follows(p: dict, c: dict, reject: float = 0.35) -> float | None:
    """What following p by c takes off the score, or None if it may not follow."""
    if c["chart_start"] <= p["chart_start"] or c["chart_end"] <= p["chart_end"] or min(c["stretch"], p["stretch"]) <= 0 or c["midi_start"] <= p["midi_start"] or c["midi_end"] <= p["midi_end"]:
        return None
    lo, hi = max(p["chart_start"], c["chart_start"]), min(p["chart_end"], c["chart_end"])
    change = 0.80 * abs(c["stretch"] - p["stretch"]) + 0.08 * abs(c["translation"] - p["translation"])
    if hi <= lo:
        return None if c["midi_start"] <= p["midi_end"] else change
    at = lambda x, t: x["translation"] + x["stretch"] * t
    points = np.linspace(lo, hi, 5)
    apart = np.abs(at(p, points) - at(c, points))
    near = min(0.01, max(1e-6, (hi - lo) / 1000))
    if apart.max() > reject or at(c, min(hi, (lo + hi) / 2 + near)) <= at(p, max(lo, (lo + hi) / 2 - near)):
        return None
    return change + 1.50 * float(apart.mean())


def _kept_paths(layers: list[list[dict]], follows: Callable[[dict, dict], float | None], worth: str, width: int) -> Iterator[list[tuple[float, list[dict]]]]:
    """The best ``width`` paths through the first layer, the first two and so on, as long as there are any. Ties keep list order."""
    kept: list[tuple[float, list[dict]]] = []
    for number, layer in enumerate(layers):
        grown = [(score + x[worth] - loss, [*path, x]) for score, path in kept for x in layer if (loss := follows(path[-1], x)) is not None] if number else [(x[worth], [x]) for x in layer]
        if not grown:
            return
        kept = sorted(grown, key=lambda k: -k[0])[:width]
        yield kept


def best_path(layers: list[list[dict]], follows: Callable[[dict, dict], float | None], worth: str, width: int) -> tuple[float, list[dict]] | None:
    """Beam search for one entry of each layer; None if no kept path reaches the end. Ties keep list order."""
    reached = list(_kept_paths(layers, follows, worth, width))
    return reached[-1][0] if reached and len(reached) == len(layers) else None


def longest_prefixes(layers: list[list[dict]], follows: Callable[[dict, dict], float | None], worth: str, width: int, skip: bool) -> list[tuple[int, int, float, list[dict]]]:
    """(first, stop, score, path) of the stretches of layers that each have a path, the longest prefix first.

    With ``skip`` the layer at which a prefix fails is passed over. A prefix's kept paths are those of the one before grown by a layer.
    """
    out, at = [], 0
    while at < len(layers):
        best, stop = None, at
        for kept in _kept_paths(layers[at:], follows, worth, width):
            best, stop = kept[0], stop + 1
        if best is None:
            at += 1
            continue
        out.append((at, stop, *best))
        at = stop + (1 if skip and stop < len(layers) else 0)
    return out


def role_paths(found: DataFrame, keys: list[str], role: str, width: int = 12) -> DataFrame:
    """The chosen candidate of each window on its role's monotone path: found's columns, streak and streak_size.

    Windows without candidates split a role's evidence; so does a step that no path can take.
    """
    kinds = dict(found.dtypes)
    columns = [c for c in found.columns if c not in (*keys, role)]
    return per_group(found, [*keys, role], ["window", "rank"], lambda g: _chosen(g[columns], width), ", ".join([*(f"{c} {kinds[c]}" for c in columns), STREAK]))


STREAK = "streak bigint, streak_size bigint"


def _chosen(g: pd.DataFrame, width: int = 12) -> dict:
    """``role_paths`` of one role's candidates, which come by window and rank."""
    layers: dict[int, list[dict]] = {}
    for r in g.to_dict("records"):
        layers.setdefault(r["window"], []).append(r)
    numbers = sorted(layers)
    blocks = np.split(np.array(numbers), np.flatnonzero(np.diff(numbers) > 1) + 1)
    out, streak = [], 0
    for block in blocks:
        for _, _, _, path in longest_prefixes([layers[w] for w in block.tolist()], _follows, "score", width, False):
            out += [{**r, "streak": streak, "streak_size": len(path)} for r in path]
            streak += 1
    return {c: [r[c] for r in out] for c in [*g.columns, "streak", "streak_size"]}


def placed_paths(rows: DataFrame, keys: list[str], role: str, tolerance: float, fit: Fit = Fit()) -> DataFrame:
    """``role_paths`` of the placements of rows as of ``role_rows``, all of it in one kernel: a chain of kernels holds a worker each."""
    kernel = lambda g: _chosen(pd.DataFrame(_placed(_windowed(_grouped(g, tolerance), fit), fit)))
    return per_long_group(rows, [*keys, role], ["kind", "start", "number"], kernel, f"{FOUND}, {STREAK}")


def fused_controls(paths: DataFrame, keys: list[str], role: str) -> DataFrame:
    """Clusters of the roles' predictions at every knot of the chosen windows: chart_time, and the columns of ``fusion.fused_predictions``."""
    points = islands.knots(paths, keys, "chart_start", "chart_end").withColumnRenamed("time", "chart_time")
    spans = paths.withColumn("_a", F.col("chart_start") - 1e-9).withColumn("_z", F.col("chart_end") + 1e-9)
    met = joins.members_of(spans, points, keys, "_a", "_z", "chart_time", 16.0, closed=True)
    from timeloom.functions import scoring

    strong = (F.col("streak_size") >= 2) & (F.col("coverage") >= 0.60) & (F.col("median_residual") <= 0.10)
    said = met.select(*keys, "chart_time", role, (F.col("translation") + F.col("stretch") * F.col("chart_time")).alias("midi_time"), scoring.support_weight(F.col("score"), F.col("coverage"), F.col("median_residual")).alias("weight"), strong.alias("strong"))
    return fusion.fused_predictions(said, [*keys, "chart_time"], "midi_time", role, "weight")


def _fused_edge(p: dict, c: dict) -> float | None:
    chart, midi = c["chart_time"] - p["chart_time"], c["fused_time"] - p["fused_time"]
    if chart <= 0 or midi <= 0 or not (0.90 <= midi / chart <= 1.10 or (chart <= 16.0 and abs(midi - chart) <= 0.5)):
        return None
    return 0.75 * abs(midi / chart - 1)


CONTROL = "region bigint, chart_time double, midi_time double, role_count bigint, classification string, confidence double"


def fuse(controls: DataFrame, keys: list[str], gap: float = 18.0, spacing: float = 1.0, width: int = 16) -> DataFrame:
    """Regions of controls that rise on both clocks: (keys, region, chart_time, midi_time, role_count, classification, confidence).

    Layers further apart than ``gap`` are fused on their own; a prefix ends where no cluster can follow, and that layer is passed over.
    Controls closer than ``spacing`` are thinned, and regions that do not come after the one before are left out.
    """
    return per_group(controls, keys, ["chart_time", "fused_time"], lambda g: _regions(g.to_dict("records"), gap, spacing, width), CONTROL)


def _regions(clusters: list[dict], gap: float = 18.0, spacing: float = 1.0, width: int = 16) -> dict:
    """Columns of the controls of one song's clusters, which come by chart_time and fused_time."""
    layers: dict[float, list[dict]] = {}
    for r in clusters:
        layers.setdefault(r["chart_time"], []).append(r)
    times = np.array(sorted(layers))
    out, region, last = [], 0, None
    for block in np.split(times, np.flatnonzero(np.diff(times) > gap) + 1):
        for _, _, _, path in longest_prefixes([layers[t] for t in block.tolist()], _fused_edge, "confidence", width, True):
            kept = [path[0]]
            for x in path[1:-1]:
                if x["chart_time"] - kept[-1]["chart_time"] >= spacing:
                    kept.append(x)
            kept += [path[-1]] if path[-1] is not kept[-1] else []
            if last is not None and (kept[0]["chart_time"] <= last["chart_time"] or kept[0]["fused_time"] <= last["fused_time"]):
                continue
            out += [(region, x["chart_time"], x["fused_time"], x["role_count"], x["classification"], x["confidence"]) for x in kept]
            last, region = kept[-1], region + 1
    names = [c.split()[0] for c in CONTROL.split(", ")]
    return dict(zip(names, zip(*out, strict=True) if out else ([] for _ in names), strict=True))


def _clusters(paths: pd.DataFrame, role: str, tolerance: float = 0.25, strong_spread: float = 0.10, bonus: float = 0.30, single_penalty: float = 0.10, spread_penalty: float = 1.2) -> list[dict]:
    """``fused_controls`` of one song's paths, by chart_time and fused_time."""
    start, end = paths["chart_start"].to_numpy(float), paths["chart_end"].to_numpy(float)
    points = np.unique(np.concatenate((start, (start + end) / 2.0, end)))
    points = points[np.unique(islands.heads(points, 1e-6))]
    score, coverage, residual = (paths[c].to_numpy(float) for c in ("score", "coverage", "median_residual"))
    weight = np.maximum(0.05, score * 0.55 + coverage * 0.30 + np.exp(-residual / 0.12) * 0.15)
    strong = (paths["streak_size"].to_numpy() >= 2) & (coverage >= 0.60) & (residual <= 0.10)
    roles, shift, stretch = paths[role].to_numpy(), paths["translation"].to_numpy(float), paths["stretch"].to_numpy(float)
    out = []
    for at in points.tolist():
        mine = np.flatnonzero((start - 1e-9 <= at) & (at <= end + 1e-9))
        said = shift[mine] + stretch[mine] * at
        order = sorted(range(len(mine)), key=lambda k: (said[k], roles[mine[k]]))
        cuts = np.flatnonzero(np.diff(said[order]) > tolerance) + 1
        found = []
        for group in np.split(np.array(order), cuts):
            best: dict = {}  # the heaviest of each role, then the earliest
            for k in sorted(group.tolist(), key=lambda k: (roles[mine[k]], -weight[mine[k]], said[k])):
                best.setdefault(roles[mine[k]], k)
            heaviest = np.array(list(best.values()))
            times, weights = said[heaviest], weight[mine[heaviest]]
            spread, several = float(times.max() - times.min()), len(best) >= 2
            sure = strong[mine[heaviest]].any()
            kind = "multi_role_corroborated" if several and spread <= strong_spread else "multi_role_compatible" if several else "single_role_strong" if sure else "single_role_provisional"
            confidence = float(weights.sum()) / len(best) + (len(best) - 1) * bonus - (0.0 if several else single_penalty) - spread * spread_penalty
            fused = float((times * weights).sum() / weights.sum())
            found.append({"chart_time": at, "fused_time": fused, "role_count": len(best), "classification": kind, "confidence": confidence})
        out += sorted(found, key=lambda c: c["fused_time"])
    return out


def controls_of(paths: DataFrame, keys: list[str], role: str) -> DataFrame:
    """``fuse`` of ``fused_controls``, a song's paths at a time: its roles have a row a window, so a song is little."""
    return per_group(paths, keys, [role, "window"], lambda g: _regions(_clusters(g, role)), CONTROL)


MAPPED = "fragment bigint, x double, y double, base double, offset double"


def materialise(controls: DataFrame, keys: list[str], mode: str = "conservative", fewest: int = 2) -> DataFrame:
    """Controls that a mode lets into the map: (keys, fragment, x, y, base, offset). Rows: region, chart_time, midi_time, base (the baseline there), classification, measures.

    Regions are cut at edges the mode rejects; fragments of an enabled tier are taken in order, each trimmed from its front until the way
    from the fragment before is acceptable. Between fragments the map keeps the baseline's shape with the offset interpolated
    (``maps.add_residuals`` of offset over base, held outside).
    """
    return per_group(controls, keys, ["region", "chart_time"], _admitted(mode, fewest), MAPPED)


def map_of(paths: DataFrame, keys: list[str], role: str, measure: float, mode: str = "conservative", fewest: int = 2) -> DataFrame:
    """``materialise`` of ``controls_of`` on a baseline of identity, a song at a time; a region has as many measures of ``measure`` seconds as fit between its ends."""
    admitted = _admitted(mode, fewest)

    def kernel(g: pd.DataFrame) -> dict:
        made = pd.DataFrame(_regions(_clusters(g, role))).sort_values(["region", "chart_time"], ignore_index=True)
        chart = made.groupby("region")["chart_time"]
        return admitted(made.assign(base=made["chart_time"], measures=np.floor(chart.transform("max") / measure - chart.transform("min") / measure)))

    return per_group(paths, keys, [role, "window"], kernel, MAPPED)


def _admitted(mode: str, fewest: int) -> Callable[[pd.DataFrame], dict]:
    policy = MODES[mode]

    def edge_ok(chart: float, audio: float) -> bool:
        return chart > 0 and audio > 0 and (policy["stretch"][0] <= audio / chart <= policy["stretch"][1] or (chart <= policy["short_seconds"] and abs(audio - chart) <= policy["short_delta"]))

    def tier(part: pd.DataFrame, episodes: int) -> str:
        n, strong = len(part), int((part["classification"] != "single_role_provisional").sum())
        base = "A" if n >= 3 and strong >= 3 and strong / n >= 0.75 else "B" if n >= 3 and strong >= 2 and strong / n >= 0.40 else "C"
        measures = part["measures"].iat[0]
        allowed = max(1, int((measures if pd.notna(measures) else 1) // policy["interval"]))
        return "C" if base == "C" or episodes > allowed else "B" if base == "A" and episodes else base

    def spans(part: pd.DataFrame) -> list[tuple[int, int]]:
        s = (np.diff(part["midi_time"]) / np.diff(part["chart_time"])) - 1
        pairs = np.flatnonzero((s[:-1] * s[1:] < 0) & (np.abs(s[:-1]) >= 0.06) & (np.abs(s[1:]) >= 0.06)).tolist()
        out: list[tuple[int, int]] = []
        for a in pairs:
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], a + 1)
            else:
                out.append((a, a + 1))
        return out

    def kernel(g: pd.DataFrame) -> dict:
        kept: list[pd.DataFrame] = []
        for _, part in g.groupby("region", sort=True):
            part = part.reset_index(drop=True)
            chart, audio = np.diff(part["chart_time"]), np.diff(part["midi_time"])
            episodes = spans(part)
            measures = part["measures"].iat[0] if len(part) and pd.notna(part["measures"].iat[0]) else 1
            allowance = min(policy["delta_most"], policy["short_delta"] + max(0, measures - policy["interval"]) * policy["growth"])
            ok = [edge_ok(c, a) or (any(lo <= i <= hi for lo, hi in episodes) and c <= policy["short_seconds"] and a > 0 and abs(a - c) <= allowance and policy["episode"][0] <= a / c <= policy["episode"][1]) for i, (c, a) in enumerate(zip(chart, audio, strict=True))]
            for span in np.split(np.arange(len(part)), np.flatnonzero(~np.array(ok, bool)) + 1):
                for trim in range(max(1, len(span) - 1)):
                    some = part.iloc[span[trim:]]
                    if len(some) < fewest or tier(some, len(spans(some))) not in policy["tiers"]:
                        continue
                    if not kept:
                        kept.append(some)
                        break
                    end, begin = kept[-1].iloc[-1], some.iloc[0]
                    if edge_ok(begin["chart_time"] - end["chart_time"], begin["midi_time"] - end["midi_time"]):
                        kept.append(some)
                        break
        whole = pd.concat([k.assign(fragment=i) for i, k in enumerate(kept)]) if kept else g.iloc[:0].assign(fragment=0)
        rises = (np.diff(whole["chart_time"]) > 0).all() and (np.diff(whole["midi_time"]) > 0).all()
        whole = whole if rises else whole.iloc[:0]
        return {"fragment": whole["fragment"], "x": whole["chart_time"], "y": whole["midi_time"], "base": whole["base"], "offset": whole["midi_time"] - whole["base"]}

    return kernel


def fit_sections(bars: DataFrame, written: DataFrame, performed: DataFrame, keys: list[str], role: str, fit: Fit = Fit()) -> DataFrame:
    """All steps on a baseline of identity: the fused controls of each song, of ``written`` and ``performed`` onset groups (role, time, symbols)."""
    groups = written.withColumn("side", F.lit("written")).unionByName(performed.withColumn("side", F.lit("performed")), allowMissingColumns=True)
    found = placements(gathered(windows(bars, keys, fit), groups, keys, role, fit=fit), keys, role, fit=fit)
    return fuse(fused_controls(role_paths(found, keys, role), keys, role), keys)
