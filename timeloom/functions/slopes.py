"""Order statistics of the slopes of all pairs of points, found without forming the pairs.

A pair's slope is below s exactly where y - s x falls from its first point to
its second. So counting the slopes below s is counting the descents of one
sequence, which merging does in n log n; the median is closed in on by such
counts, and only the slopes of a narrow bracket around it are formed.
"""

from __future__ import annotations

import numpy as np

DIRECT = 64  # points of which all pairs are formed
SAMPLE = 768  # points whose pairs steer the search
ROUNDS = 200


def resolution(slope: float, wide: float, tall: float) -> float:
    """What slopes must differ by to be told apart by counts, over points of that extent."""
    return 2.0**-46 * (tall / wide + abs(slope)) if wide > 0 else 0.0


def sequence_of(x: np.ndarray, y: np.ndarray, least: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(x, y, first, second) of two entries a point: it can be a pair's second from x on, and a first for what lies more than ``least`` behind.

    Entries are in order of where they take effect; seconds come before firsts at one place.
    """
    n = len(x)
    place = np.concatenate((x, x + least))
    first = np.repeat([False, True], n)
    order = np.lexsort((first, place))
    both = np.concatenate((np.arange(n), np.arange(n)))[order]
    return x[both], y[both], first[order], both


def descents(z: np.ndarray, heads: np.ndarray, tails: np.ndarray, found: list | None = None) -> int:
    """How many pairs of a head and a tail behind it have a smaller z at the tail; ``found`` gets (head, tail) places of them, an array a level."""
    n = len(z)
    if n < 2:
        return 0
    size = 1 << (n - 1).bit_length()
    value = np.concatenate((z, np.full(size - n, np.inf)))[:, None]
    place = np.arange(size)[:, None]
    heads = np.concatenate((heads, np.zeros(size - n, bool)))
    tails = np.concatenate((tails, np.zeros(size - n, bool)))
    total = 0
    while value.shape[0] > 1:
        half = value.shape[1]
        value, place = value.reshape(-1, 2 * half), place.reshape(-1, 2 * half)
        order = np.argsort(value, axis=1, kind="stable")
        value, place = np.take_along_axis(value, order, axis=1), np.take_along_axis(place, order, axis=1)
        second = (order >= half) & tails[place]
        before = np.cumsum(second, axis=1)
        ask = (order < half) & heads[place]
        total += int(before[ask].sum())
        if found is not None and total:
            many = before[ask]
            row = np.nonzero(ask)[0]
            listed = place[second]  # row by row, in order of z
            start = np.concatenate(([0], np.cumsum(before[:, -1])))[row]
            steps = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            found.append(np.stack((np.repeat(place[ask], many), listed[np.repeat(start, many) + steps])))
    return total


def count_below(x: np.ndarray, y: np.ndarray, first: np.ndarray, slope: float) -> int:
    """How many slopes of first with second entries are below ``slope``; entries as of ``sequence_of``."""
    return descents(y - slope * x, first, ~first)


def _between(x: np.ndarray, y: np.ndarray, first: np.ndarray, low: float, high: float) -> np.ndarray:
    """The slopes that are below ``high`` and not below ``low``."""
    # by the first clock at ``low``, such a pair stands in order; at ``high`` it has changed places
    place = np.arange(len(x))
    start = y - low * x if np.isfinite(low) else x
    order = np.lexsort((place, start))
    pairs: list[np.ndarray] = []
    end = y - high * x if np.isfinite(high) else -x
    descents(end[order], first[order], ~first[order], pairs)
    if not pairs:
        return np.zeros(0)
    i, j = (order[p] for p in np.concatenate(pairs, axis=1))
    keep = i < j  # entries in order: the second has come into reach
    i, j = i[keep], j[keep]
    return (y[j] - y[i]) / (x[j] - x[i])


def _direct(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    run, rise = x[None, :] - x[:, None], y[None, :] - y[:, None]
    some = run > least
    return rise[some] / run[some]


def median_slope(x: np.ndarray, y: np.ndarray, least: float = 0.0) -> tuple[float | None, int]:
    """The median of the slopes of all pairs whose x are more than ``least`` apart (None: there is none), and their number.

    Values must be finite. Where more slopes than a few a point lie within
    rounding of each other at the median, one of them is returned.
    """
    n = len(x)
    if n <= DIRECT:
        every = _direct(x, y, least)
        return (float(np.median(every)) if len(every) else None), len(every)
    order = np.argsort(x, kind="stable")
    ordered = x[order]
    pairs = int((n - np.searchsorted(ordered, ordered + least, side="right")).sum())
    if not pairs:
        return None, 0
    centre_x, centre_y = ordered[n // 2], float(np.median(y))  # smaller numbers round less
    px, py, first, _ = sequence_of(ordered - centre_x, y[order] - centre_y, least)
    wide, tall = float(np.ptp(x)), float(np.ptp(y))
    ranks = (pairs - 1) // 2, pairs // 2  # of the two middle slopes, from 0
    some = np.random.default_rng(0).choice(n, min(n, SAMPLE), replace=False)
    drawn = np.sort(_direct(x[some], y[some], least))
    low, high, under, over = -np.inf, np.inf, 0, pairs
    room = 4 * n

    def narrow(s: float) -> bool:
        """Takes ``s`` as a bound of the bracket; true if the two middle slopes lie on either side of it."""
        nonlocal low, high, under, over
        if not low < s < high:
            return False
        k = count_below(px, py, first, s)
        if k <= ranks[0]:
            low, under = s, k
        elif k > ranks[1]:
            high, over = s, k
        else:
            low, under = s, k
            return True
        return False

    for turn in range(ROUNDS):
        if over - under <= room:
            break
        at = (ranks[0] + 0.5 - under) / (over - under)
        inside = drawn[np.searchsorted(drawn, low, side="right") : np.searchsorted(drawn, high, side="left")]
        if len(inside) >= 8:
            margin = min(0.25, max(0.01, 0.35 * room / (over - under), 1.0 / len(inside)))
            guesses = [float(np.quantile(inside, min(max(q, 0.0), 1.0), method="nearest")) for q in (at - margin, at + margin)]
            if guesses[0] == guesses[1]:  # many pairs have this slope
                near = [resolution(guesses[0], wide, tall) * k for k in (1, 1024)]
                for by in near:
                    if any([narrow(guesses[0] - by), narrow(guesses[0] + by)]):
                        break
                    if low == guesses[0] - by and high == guesses[0] + by:
                        if over - under <= room:
                            break
                        return guesses[0], pairs
                continue
        elif np.isfinite(low) and np.isfinite(high):
            width = high - low
            if width <= 4 * resolution(max(abs(low), abs(high)), wide, tall):
                return (low + high) / 2, pairs
            margin = min(0.25, max(0.02, 0.35 * room / (over - under)))
            guesses = [low + width * min(max(q, 0.001), 0.999) for q in (at - margin, at + margin)] if turn % 3 else [low + width / 2]
        else:
            width = max(1.0, abs(low) if np.isfinite(low) else 0.0, abs(high) if np.isfinite(high) else 0.0) * 2.0**turn
            guesses = [low + width] if np.isfinite(low) else [high - width] if np.isfinite(high) else [0.0]
        split = [s for s in guesses if narrow(s)]
        if split:
            below, above = _extreme(px, py, first, split[0], under)
            return (below + above) / 2, pairs
    values = np.sort(_between(px, py, first, low, high))
    middle = [values[min(max(r - under, 0), len(values) - 1)] for r in ranks]
    return float(middle[0] + middle[1]) / 2, pairs


def group_medians(values: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """The median of each group's values, not a number where it has none."""
    order = np.lexsort((values, group))
    n = np.bincount(group, minlength=groups)
    start = np.cumsum(n) - n
    ordered = np.append(values[order], np.nan)
    low, high = start + np.maximum(n - 1, 0) // 2, start + n // 2
    none = n == 0
    low[none], high[none] = len(values), len(values)
    return (ordered[low] + ordered[high]) / 2


def median_slopes(x: np.ndarray, y: np.ndarray, starts: np.ndarray, least: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """``median_slope`` of each of the groups that begin at ``starts``, each in order of x: slopes (not a number: none) and numbers of pairs.

    The pairs of small groups are formed together.
    """
    edges = np.append(starts, len(x))
    size = np.diff(edges)
    slope, pairs = np.full(len(starts), np.nan), np.zeros(len(starts), np.int64)
    for g in np.flatnonzero(size > DIRECT).tolist():
        found, pairs[g] = median_slope(x[edges[g] : edges[g + 1]], y[edges[g] : edges[g + 1]], least)
        slope[g] = np.nan if found is None else found
    group = np.repeat(np.arange(len(starts)), size)
    after = edges[1:][group] - np.arange(len(x)) - 1
    after[size[group] > DIRECT] = 0
    bounds = np.concatenate(([0], np.cumsum(after)))
    at = 0
    while at < len(x):  # whole groups, about a million pairs at a time
        stop = int(np.searchsorted(bounds, bounds[at] + 1_000_000, side="right"))
        stop = len(x) if stop > len(x) else int(edges[min(max(np.searchsorted(edges, stop), 1), len(edges) - 1)])
        many = after[at:stop]
        i = np.repeat(np.arange(at, stop), many)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many)
        run = x[j] - x[i]
        keep = run > least
        i, run, rise = i[keep], run[keep], (y[j] - y[i])[keep]
        if len(i):
            own = group[i]
            low, high = int(own[0]), int(own[-1]) + 1
            n = np.bincount(own - low, minlength=high - low)
            found = group_medians(rise / run, own - low, high - low)
            some = np.flatnonzero(n)
            slope[low + some], pairs[low + some] = found[some], n[some]
        at = stop
    return slope, pairs


def _extreme(x: np.ndarray, y: np.ndarray, first: np.ndarray, s: float, below: int) -> tuple[float, float]:
    """The greatest slope below ``s`` and the least not below it, where ``below`` slopes are below."""

    def closing(up: bool) -> float:
        reach = max(abs(s), 1e-9) * 1e-3
        while True:
            low, high = (s, s + reach) if up else (s - reach, s)
            k = count_below(x, y, first, high if up else low)
            got = k - below if up else below - k
            if got:
                break
            reach *= 4
        near, far = 0.0, reach
        while got > 4 * len(x) and far - near > 4 * np.spacing(max(abs(s), far)):
            mid = (near + far) / 2
            k = count_below(x, y, first, s + mid if up else s - mid)
            g = k - below if up else below - k
            near, far, got = (near, mid, g) if g else (mid, far, got)
        if got > 4 * len(x):
            return s + far if up else s - far
        values = _between(x, y, first, *((s, s + far) if up else (s - far, s)))
        return float(values.min() if up else values.max())

    return closing(False), closing(True)
