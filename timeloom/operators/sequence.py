"""Ordered-group kernels: alignment, path selection, chains and warping inside one key's bounded group.

These recurrences depend on order and have no algebraic form, so each group
is handed to one kernel in an Arrow batch. A group must be bounded by its key
(a day, a block of windows, a segment between controls), never by a cap: the
kernels take every row they are given.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKIP = 0.42  # cost of leaving a layer without a candidate
DRIFT_MS, DRIFT_MOST = 120.0, 2.0  # scale and ceiling of the cost of a change in residual
BEND_MS, BEND_MOST = 180.0, 1.5  # the same for a change of that change
LAYER = 8  # rows of equal x, on average, from which a chain is found a layer at a time
CELLS = 1_000_000  # transitions weighed at once; a fuller layer is taken in stretches


def starts_of(keys: pd.DataFrame) -> np.ndarray:
    """Places where a row's keys differ from the row's before; 0 is one."""
    new = np.zeros(len(keys), bool)
    new[:1] = True
    for name in keys:
        column = keys[name]
        last = column.shift()
        new[1:] |= ((column != last) & ~(column.isna() & last.isna())).to_numpy()[1:]
    return np.flatnonzero(new)


def dealt_by(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows dealt by their keys over enough tasks for all cores, however few their bytes: kernels take long over little.

    A count of tasks is not merged into fewer; the hash keeps Spark from taking an earlier dealing by the same keys for this one.
    """
    session = rows.sparkSession
    tasks = min(int(session.conf.get("spark.sql.shuffle.partitions")), max(32, 4 * session.sparkContext.defaultParallelism))
    return rows.repartition(tasks, F.xxhash64(*keys))


def per_group(rows: DataFrame, keys: list[str], order: list[str], kernel: Callable[[pd.DataFrame], dict], schema: str) -> DataFrame:
    """Applies a kernel to each group in order; its columns follow the keys, a group without results gives no row.

    Groups are dealt by their keys and streamed in sorted partitions, so a
    small group costs no call of its own and a task holds one group beside a
    batch. Nulls sort last; a null key is a group like any other.
    """
    dealt = rows.repartition(*keys).sortWithinPartitions(*(F.asc_nulls_last(c) for c in [*keys, *order]))
    return in_order(dealt, keys, kernel, schema)


def per_long_group(rows: DataFrame, keys: list[str], order: list[str], kernel: Callable[[pd.DataFrame], dict], schema: str) -> DataFrame:
    """``per_group`` for kernels that take long over little: groups are dealt to two tasks a core, however few their bytes; a worker's start for each task costs more than what a finer dealing evens out."""
    tasks = max(16, 2 * rows.sparkSession.sparkContext.defaultParallelism)
    dealt = rows.repartition(tasks, F.xxhash64(*keys)).sortWithinPartitions(*(F.asc_nulls_last(c) for c in [*keys, *order]))
    return in_order(dealt, keys, kernel, schema)


def in_order(dealt: DataFrame, keys: list[str], kernel: Callable[[pd.DataFrame], dict], schema: str) -> DataFrame:
    """``per_group`` of rows that are dealt by their keys and in order, as another kernel over the same keys leaves them: nothing is dealt again."""
    kinds = {f.name: f.dataType.simpleString() for f in dealt.schema.fields}
    names = [c.split()[0] for c in schema.split(", ")]

    def made(group: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame(kernel(group.reset_index(drop=True)), columns=names)
        for at, key in enumerate(keys):
            value = group[key].iat[0]
            out.insert(at, key, None if pd.api.types.is_scalar(value) and pd.isna(value) else value)
        return out

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # parts of the group that may go on
        for batch in batches:
            if not len(batch):
                continue
            starts = starts_of(batch[keys])
            if held and starts_of(pd.concat([held[-1][keys].tail(1), batch[keys].head(1)], ignore_index=True))[-1] == 0:
                starts = starts[1:]  # the first rows belong to the group held
            edges = [0, *starts.tolist(), len(batch)]
            parts = [batch.iloc[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
            done = []
            for number, part in enumerate(parts):
                if number and held:
                    done.append(pd.concat(held) if len(held) > 1 else held[0])
                    held = []
                if len(part):
                    held.append(part)
            results = [r for r in map(made, done) if len(r)]
            if results:
                yield pd.concat(results, ignore_index=True)
        if held:
            last = made(pd.concat(held) if len(held) > 1 else held[0])
            if len(last):
                yield last

    return dealt.mapInPandas(work, ", ".join([*(f"{k} {kinds[k]}" for k in keys), schema]))


def per_groups(rows: DataFrame, keys: list[str], order: list[str], kernel: Callable[[pd.DataFrame, np.ndarray], tuple[np.ndarray, dict]], schema: str) -> DataFrame:
    """As ``per_group``, for kernels that take many small groups at once: whole groups in order and the places where each begins.

    The kernel returns, for each row of its result, the number of the group in what it was given, and the columns.
    """
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    names = [c.split()[0] for c in schema.split(", ")]

    def made(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.reset_index(drop=True)
        starts = starts_of(frame[keys])
        group, columns = kernel(frame, starts)
        out = frame[keys].iloc[starts[group]].reset_index(drop=True)
        for name in names:
            out[name] = columns[name]
        return out

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # the group that may go on
        for batch in batches:
            if not len(batch):
                continue
            starts = starts_of(batch[keys])
            goes_on = bool(held) and starts_of(pd.concat([held[-1][keys].tail(1), batch[keys].head(1)], ignore_index=True))[-1] == 0
            if goes_on and len(starts) == 1:
                held.append(batch)
                continue
            last = int(starts[-1])
            done = [*held, batch.iloc[:last]]
            held = [batch.iloc[last:]]
            if sum(map(len, done)):
                yield made(pd.concat(done))
        if held:
            yield made(pd.concat(held))

    dealt = rows.repartition(*keys).sortWithinPartitions(*(F.asc_nulls_last(c) for c in [*keys, *order]))
    return dealt.mapInPandas(work, ", ".join([*(f"{k} {kinds[k]}" for k in keys), schema]))


def align(similarity: np.ndarray, skip_row: float, skip_column: float) -> tuple[float, list[tuple[int, int]]]:
    """Best order-preserving matching: its score and its (row, column) matches.

    Skips cost what is given; only a positive similarity matches. Where moves
    tie, a skipped row comes first, then a skipped column. Each row of the
    table is one running maximum.
    """
    n, m = similarity.shape
    ramp = np.arange(m + 1) * skip_column
    best = np.empty((n + 1, m + 1))
    best[0] = -ramp
    gain = np.where(similarity > 0, similarity, -np.inf)
    for i in range(n):
        fresh = best[i] - skip_row
        fresh[1:] = np.maximum(fresh[1:], best[i, :-1] + gain[i])
        best[i + 1] = np.maximum.accumulate(fresh + ramp) - ramp
    return float(best[n, m]), _matches(best, n, m, skip_row, skip_column)


def _matches(best: np.ndarray, i: int, j: int, skip_row: float, skip_column: float) -> list[tuple[int, int]]:
    """The matches on the best way to (i, j) of a table as of ``align``, in order."""
    matches = []
    while i and j:
        here = best[i, j] - 1e-9
        if best[i - 1, j] - skip_row >= here:
            i -= 1
        elif best[i, j - 1] - skip_column >= here:
            j -= 1
        else:
            i, j = i - 1, j - 1
            matches.append((i, j))
    return matches[::-1]


def alignment_tables(similarity: np.ndarray, first: np.ndarray, stop: np.ndarray, skip_row: float, skip_column: float) -> list[tuple[np.ndarray, memoryview]]:
    """Tables of ``align`` of the runs of columns [first, stop): the scores of all rows with 0, 1, ... columns, and the last move of each cell (0: a row was skipped, 1: a column, 2: a match), cells row by row.

    What lies right of a column does not touch it, so a table serves every run that begins where it does.
    """
    out: list[tuple[np.ndarray, memoryview]] = []
    n, columns = similarity.shape
    longest = int(np.max(stop - first, initial=1))
    gain = np.full((n, columns + longest), -np.inf)
    np.copyto(gain[:, :columns], similarity, where=similarity > 0)
    together = max(1, CELLS // max(1, n * longest))
    for part in range(0, len(first), together):
        lo = first[part : part + together]
        m = int((stop[part : part + together] - lo).max())
        seen = np.lib.stride_tricks.sliding_window_view(gain, m, axis=1)
        ramp = np.arange(m + 1) * skip_column
        best, fresh, skipped = np.repeat(-ramp[None, :], len(lo), axis=0), np.empty((len(lo), m + 1)), np.empty((len(lo), m + 1))
        moves = np.empty((len(lo), n, m), np.uint8)
        for i in range(n):
            np.subtract(best, skip_row, out=skipped)
            fresh[:, 0] = skipped[:, 0]
            np.add(best[:, :-1], seen[i][lo], out=fresh[:, 1:])
            np.maximum(fresh[:, 1:], skipped[:, 1:], out=fresh[:, 1:])
            fresh += ramp
            np.maximum.accumulate(fresh, axis=1, out=best)
            best -= ramp
            here = best[:, 1:] - 1e-9
            np.subtract(2, best[:, :-1] - skip_column >= here, out=moves[:, i], dtype=np.uint8)
            moves[:, i] *= skipped[:, 1:] < here
        out += [(best[k].copy(), moves[k].reshape(-1).data) for k in range(len(lo))]
    return out


def aligned_run(table: tuple[np.ndarray, memoryview], i: int, j: int, within: tuple[list[int], list[int]] | None = None) -> tuple[float, list[tuple[int, int]]] | None:
    """Score and matches, as of ``align``, of all ``i`` rows and the first ``j`` columns of a table as of ``alignment_tables``.

    ``within`` gives each row a run of columns; None is returned once a row turns out to be matched outside its own.
    """
    moves, matches, score = table[1], [], float(table[0][j])
    columns = len(moves) // i if i else 0
    least, most = within or ([0] * i, [columns] * i)
    while i and j:
        move = moves[(i - 1) * columns + j - 1]
        if move == 0:
            i -= 1
        elif move == 1:
            j -= 1
        else:
            i, j = i - 1, j - 1
            if not least[i] <= j < most[i]:
                return None
            matches.append((i, j))
    return score, matches[::-1]


def align_slices(similarity: np.ndarray, slices: list[tuple[int, int]], skip_row: float, skip_column: float) -> list[tuple[float, list[tuple[int, int]]]]:
    """``align`` of several runs of columns [lo, hi) of one table; runs that begin together share a table."""
    lo, hi = np.array(slices).T
    first, of = np.unique(lo, return_inverse=True)
    stop = np.zeros(len(first), np.int64)
    np.maximum.at(stop, of, hi)
    tables = alignment_tables(similarity, first, stop, skip_row, skip_column)
    return [aligned_run(tables[k], len(similarity), int(b - a)) for k, a, b in zip(of.tolist(), lo, hi, strict=True)]


def _layers(group: pd.DataFrame, layer: str) -> list[np.ndarray]:
    values = group[layer].to_numpy()
    edges = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1], [True])))
    return [np.arange(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def viterbi(layers: list[np.ndarray], confidence: np.ndarray, residual: np.ndarray) -> list[int]:
    """One row, or -1 (skipped), of each layer at least cost.

    A row costs one minus its confidence; after a chosen row also its change
    in residual and, after two, the change of that change. The row before the
    last is the one on the best path to the last. Ties go to the earlier state, the skip first.
    """
    if not layers:
        return []
    reached, came, states = [], [], [np.concatenate(([-1], rows)) for rows in layers]
    for at, now in enumerate(states):
        own = np.where(now < 0, SKIP, 1 - confidence[now])
        if not at:
            reached.append(own)
            came.append(np.zeros(len(now), int))
            continue
        before = states[at - 1]
        older = states[at - 2][came[-1]] if at > 1 else None
        ways, least = [], []
        for some in np.array_split(np.arange(len(now)), -(-len(now) * len(before) // CELLS)):
            to = now[some]
            step = residual[to][None, :] - residual[before][:, None]
            both = (before >= 0)[:, None] & (to >= 0)[None, :]
            cost = np.where(both, np.minimum(DRIFT_MOST, np.abs(step) / DRIFT_MS), 0.0)
            if older is not None:
                bend = np.abs(step - (residual[before] - residual[older])[:, None])
                cost += np.where(both & (older >= 0)[:, None], np.minimum(BEND_MOST, bend / BEND_MS), 0.0)
            whole = reached[-1][:, None] + cost + own[some][None, :]
            ways.append(whole.argmin(axis=0))
            least.append(whole.min(axis=0))
        came.append(np.concatenate(ways))
        reached.append(np.concatenate(least))
    state, path = int(reached[-1].argmin()), []
    for at in range(len(states) - 1, -1, -1):
        path.append(int(states[at][state]))
        state = came[at][state]
    return path[::-1]


def beam(layers: list[np.ndarray], position: np.ndarray, confidence: np.ndarray, span: float, width: int = 12, weight: float = 0.75) -> tuple[float, list[int]]:
    """Best of the ``width`` partial paths kept: one row a layer, positions rising.

    A path earns its rows' confidence and loses ``weight`` times how far each
    step is from ``span`` layers' time, as a ratio. A layer that no kept path
    can enter ends the search; what was reached until then is returned.
    """
    paths: list[tuple[float, list[int]]] = [(0.0, [])]
    for rows in layers:
        grown = []
        for score, path in paths:
            for row in rows.tolist():
                step = position[row] - position[path[-1]] if path else span
                if step > 0:
                    grown.append((score + confidence[row] - weight * abs(step / span - 1), [*path, row]))
        if not grown:
            break
        grown.sort(key=lambda x: -x[0])
        paths = grown[:width]
    return float(paths[0][0]), paths[0][1]


def _reach(y: np.ndarray, layer: np.ndarray, run: float, limit: float, above: bool) -> np.ndarray:
    """For each y how many of the sorted ``layer`` have a slope to it over ``limit`` (or equal, if not ``above``); slopes fall along the layer.

    Found by halving with the slope itself, so rounding decides as it does pair by pair.
    """
    lo, hi = np.zeros(len(y), np.int64), np.full(len(y), len(layer))
    while (lo < hi).any():
        middle = (lo + hi) // 2
        slope = (y - layer[np.minimum(middle, len(layer) - 1)]) / run
        over = (slope > limit if above else slope >= limit) & (lo < hi)
        lo, hi = np.where(over, middle + 1, lo), np.where(over | (lo >= hi), hi, middle)
    return lo


def layered_chain(x: np.ndarray, y: np.ndarray, score: np.ndarray, edges: np.ndarray, least: float, most: float, longest: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As the loop of ``chain`` for rows in order of x and y: a layer of equal x meets each layer before at once.

    The rows of a layer that may come before a row are a run of it; its best is looked up in tables of the best of 1, 2, 4, ... rows.
    Without ``longest`` only the score counts, and a row starts afresh where none before it adds to its own.
    """
    n = len(x)
    length, total, before = np.ones(n, int), score.astype(float).copy(), np.full(n, -1)
    tables: list[list[np.ndarray]] = []
    for a, z in zip(edges[:-1], edges[1:], strict=True):
        best = np.full(z - a, -1)
        for (c, d), table in zip(zip(edges, edges[1:], strict=False), tables, strict=False):
            run = x[a] - x[c]
            first, stop = _reach(y[a:z], y[c:d], run, most, True), _reach(y[a:z], y[c:d], run, least, False)
            some = np.flatnonzero(stop > first)
            power = np.frexp(stop[some] - first[some])[1] - 1  # of two, within the run
            for k in np.unique(power).tolist():
                at = some[power == k]
                for pick in (table[k][first[at]], table[k][stop[at] - 2**k]):
                    old = best[at]
                    better = (old < 0) | (length[pick] > length[old]) | ((length[pick] == length[old]) & ((total[pick] > total[old]) | ((total[pick] == total[old]) & (pick < old))))
                    best[at] = np.where(better, pick, old)
        got = np.flatnonzero(best >= 0)
        if not longest:
            got = got[total[best[got]] + score[a + got] > score[a + got]]
        length[a + got], total[a + got], before[a + got] = length[best[got]] + int(longest), total[best[got]] + score[a + got], best[got]
        rank = np.empty(z - a, np.int64)
        rank[np.lexsort((np.arange(z - a), -total[a:z], -length[a:z]))] = np.arange(z - a)
        level, table = np.arange(z - a), []
        while len(level):
            table.append(a + level)
            step = 2 ** (len(table) - 1)
            one, two = level[: max(0, len(level) - step)], level[step:]
            level = np.where(rank[one] <= rank[two], one, two)
        tables.append(table)
    return length, total, before


def layers_of(x: np.ndarray, y: np.ndarray, score: np.ndarray) -> np.ndarray | None:
    """Edges of the runs of equal x, if the rows are numbers in order of x and y and the runs are long; else None."""
    edges = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1], [True])))
    ordered = np.isfinite(x).all() and np.isfinite(y).all() and np.isfinite(score).all() and (np.diff(x) >= 0).all() and not ((np.diff(x) == 0) & (np.diff(y) < 0)).any()
    return edges if ordered and (len(edges) - 1) * LAYER <= len(x) else None


def chain(x: np.ndarray, y: np.ndarray, score: np.ndarray, least: float, most: float) -> list[int]:
    """Longest chain with x rising and each slope of y within [least, most]; then the best score, then the earliest.

    Rows in order of x and y with few different x are taken a layer at a time; others weigh all rows before them.
    """
    if not len(x):
        return []
    edges = layers_of(x, y, score)
    if edges is not None:
        length, total, before = layered_chain(x, y, score, edges, least, most)
    else:
        length, total, before = np.ones(len(x), int), score.astype(float).copy(), np.full(len(x), -1)
        for at in range(1, len(x)):
            run = x[at] - x[:at]
            slope = np.divide(y[at] - y[:at], run, out=np.full(at, np.inf), where=run > 0)
            fit = np.flatnonzero((slope >= least) & (slope <= most))
            if len(fit):
                pick = fit[np.lexsort((fit, -total[fit], -length[fit]))[0]]
                length[at], total[at], before[at] = length[pick] + 1, total[pick] + score[at], pick
    at, path = int(np.lexsort((np.arange(len(x)), -total, -length))[0]), []
    while at >= 0:
        path.append(at)
        at = int(before[at])
    return path[::-1]


def banded_dtw(a: np.ndarray, b: np.ndarray, band: float, turn: float = 0.0, repeat: float = 0.0) -> tuple[float, list[tuple[int, int]]]:
    """Least-cost warping of a onto b from corner to corner, and its (i, j) steps; infinite if the band has no path.

    A cell costs the absolute difference and must lie within ``band`` of the
    diagonal, in cells of b. ``turn`` is charged where the kind of step
    changes and ``repeat`` for each step that is not diagonal; ties go to the
    diagonal, then to a step in a, then to one in b.

    Only the band is held, a row of it at a time: steps from the row before
    are shifts of it, and steps within the row are one running minimum.
    """
    n, m = len(a), len(b)
    if not n or not m:
        return float("inf"), []
    centre = np.arange(n) * ((m - 1) / max(1, n - 1))
    first = np.maximum(0, np.ceil(centre - band)).astype(int)
    last = np.minimum(m - 1, np.floor(centre + band)).astype(int)
    if first[0] > 0 or last[-1] < m - 1 or (last < first).any():
        return float("inf"), []
    above, origins = np.zeros((3, 0)), []
    for i in range(n):
        width = last[i] - first[i] + 1
        cost = np.abs(a[i] - b[first[i] : last[i] + 1])
        row, origin = np.full((3, width), np.inf), np.zeros((3, width), np.int8)
        if not i:
            row[0, 0] = cost[0]
        for kind in (0, 1) if i else ():
            ways = np.full((3, width), np.inf)
            shift = first[i] - first[i - 1] - (1 - kind)  # where the step's origin lies in the row above
            lo, hi = max(0, -shift), min(width, above.shape[1] - shift)
            if hi > lo:
                ways[:, lo:hi] = above[:, lo + shift : hi + shift]
            ways[[k for k in range(3) if k != kind]] += turn
            origin[kind] = ways.argmin(axis=0)
            row[kind] = ways.min(axis=0) + (cost + repeat if kind else cost)
        if width > 1:
            run = np.cumsum(cost + repeat)
            enter = np.minimum(row[0], row[1]) + turn
            row[2, 1:] = run[1:] + np.minimum.accumulate(enter[:-1] - run[:-1])
            origin[2, 1:] = np.stack((row[0, :-1] + turn, row[1, :-1] + turn, row[2, :-1])).argmin(axis=0)
        origins.append(origin)
        above = row
    kind = int(above[:, -1].argmin())
    whole = float(above[kind, -1])
    if not np.isfinite(whole):
        return whole, []
    i, j, steps = n - 1, m - 1, [(n - 1, m - 1)]
    while i or j:
        before = int(origins[i][kind, j - first[i]])
        i, j = (i - 1, j - 1) if kind == 0 else (i - 1, j) if kind == 1 else (i, j - 1)
        kind = before
        steps.append((i, j))
    return whole, steps[::-1]


def viterbi_path(rows: DataFrame, keys: list[str], layer: str, ident: str, saturated: str = "corridor_saturated") -> DataFrame:
    """Chosen ``ident`` (null: skipped) of each layer, from the columns ``confidence`` and ``residual_ms``.

    Rows with a null in these, and rows that ``saturated`` (if there is such a column) marks, are never chosen; their layer stays.
    """

    def kernel(g: pd.DataFrame) -> dict:
        layers = _layers(g, layer)
        usable = g["confidence"].notna() & g["residual_ms"].notna()
        if saturated in g:
            usable &= ~g[saturated].fillna(False).astype(bool)
        path = viterbi([r[usable.to_numpy()[r]] for r in layers], g["confidence"].to_numpy(float), g["residual_ms"].to_numpy(float))
        return {"layer": [g[layer].iat[r[0]] for r in layers], "chosen": pd.array([g[ident].iat[p] if p >= 0 else None for p in path], "Int64")}

    return per_group(rows, keys, [layer, ident], kernel, "layer bigint, chosen bigint")


def beam_path(rows: DataFrame, keys: list[str], layer: str, ident: str, span: float, width: int = 12) -> DataFrame:
    """Chosen ``ident`` of each layer that the best kept path reached, from ``position`` and ``confidence``."""

    def kernel(g: pd.DataFrame) -> dict:
        _, path = beam(_layers(g, layer), g["position"].to_numpy(float), g["confidence"].to_numpy(float), span, width)
        return {"layer": g[layer].to_numpy()[path], "chosen": g[ident].to_numpy()[path]}

    return per_group(rows, keys, [layer, ident], kernel, "layer bigint, chosen bigint")


def chain_path(rows: DataFrame, keys: list[str], ident: str, least: float = 0.88, most: float = 1.12) -> DataFrame:
    """Members of each key's longest safe chain, from ``x``, ``y`` and ``score``."""

    def kernel(g: pd.DataFrame) -> dict:
        path = chain(g["x"].to_numpy(float), g["y"].to_numpy(float), g["score"].to_numpy(float), least, most)
        return {"step": np.arange(len(path)), "chosen": g[ident].to_numpy()[path]}

    return per_group(rows, keys, ["x", "y", ident], kernel, "step bigint, chosen bigint")


def warp_series(rows: DataFrame, keys: list[str], at: str, a: str, b: str, band: float, turn: float = 0.0, repeat: float = 0.0) -> DataFrame:
    """Steps (i, j) of the warping of series ``a`` onto series ``b``, both ordered by ``at``."""

    def kernel(g: pd.DataFrame) -> dict:
        _, steps = banded_dtw(g[a].to_numpy(float), g[b].to_numpy(float), band, turn, repeat)
        return {"step": np.arange(len(steps)), "i": [i for i, _ in steps], "j": [j for _, j in steps]}

    return per_group(rows, keys, [at], kernel, "step bigint, i bigint, j bigint")


def set_agreement(a: np.ndarray, b: np.ndarray, period: int = 12, octave: float = 0.72) -> float:
    """Mean over the members of a: 1 if b holds it, ``octave`` if b holds one equal modulo ``period``, else 0."""
    if not len(a) or not len(b):
        return 0.0
    same, near = np.isin(a, b), np.isin(a % period, b % period)
    return float(np.where(same, 1.0, np.where(near, octave, 0.0)).mean())


def agreements(a: list[np.ndarray], b: list[np.ndarray], period: int = 12, octave: float = 0.72) -> np.ndarray:
    """``set_agreement`` of every set of a with every set of b, as products of membership tables."""
    symbols = np.unique(np.concatenate([*a, *b, np.zeros(0, np.int64)]).astype(np.int64))

    def held(sets: list[np.ndarray]) -> np.ndarray:
        table = np.zeros((len(sets), len(symbols)))
        if len(symbols):
            table[np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.searchsorted(symbols, np.concatenate([*sets, np.zeros(0, np.int64)]))] = 1.0
        return table

    return agreements_of(held(a), held(b), symbols % period, octave)


def agreements_of(x: np.ndarray, y: np.ndarray, classes: np.ndarray, octave: float = 0.72) -> np.ndarray:
    """``agreements`` of sets given as rows of 0 and 1 over the same symbols, whose classes are given."""
    of = (classes[:, None] == np.unique(classes)).astype(float)
    same, near = x @ y.T, (x @ of) @ (y @ of > 0).T.astype(float)
    size = x.sum(axis=1)[:, None]
    return np.where((size > 0) & (y.sum(axis=1)[None, :] > 0), (same + octave * (near - same)) / np.maximum(size, 1), 0.0)


def align_counted(similarity: np.ndarray, skip_row: float, skip_column: float, backwards: bool = False) -> tuple[float, list[tuple[int, int]]]:
    """As ``align``, but of alignments that score alike the one with most matches, forwards or from the end; the score is per match."""
    given = similarity[::-1, ::-1] if backwards else similarity
    more = 1e-7  # worth of a match where scores tie
    score, found = align(np.where(given > 0, given + more, given), skip_row, skip_column)
    n, m = similarity.shape
    pairs = sorted((n - 1 - i, m - 1 - j) for i, j in found) if backwards else found
    return (score - more * len(pairs)) / max(1, len(pairs)), pairs


def align_sets(rows: DataFrame, keys: list[str], at: str, side: str, members: str, skip_a: float = 0.22, skip_b: float = 0.025) -> DataFrame:
    """Matches (a_at, b_at) of two ordered lists of integer sets, and the whole score over the first list's length.

    ``side`` is 0 for the first list, 1 for the second.
    """

    def kernel(g: pd.DataFrame) -> dict:
        left, right = g[g[side] == 0], g[g[side] == 1]
        likeness = agreements([np.asarray(p) for p in left[members]], [np.asarray(q) for q in right[members]])
        score, found = align(likeness, skip_a, skip_b)
        return {"a_at": left[at].to_numpy()[[i for i, _ in found]], "b_at": right[at].to_numpy()[[j for _, j in found]], "score": score / max(1, len(left))}

    return per_group(rows, keys, [side, at], kernel, "a_at bigint, b_at bigint, score double")
