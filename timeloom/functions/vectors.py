"""Likeness of sets, sequences and vectors held in array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ZERO = 0.0


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(_ZERO), lambda s, v: s + v)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def cosine(a: Column, b: Column) -> Column:
    """Cosine clipped to 0..1; 0 for a zero vector, an empty one or unlike lengths."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    made = F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot(a, b) / norm))
    return F.when((F.size(a) == F.size(b)) & (F.size(a) > 0) & (norm > 1e-12), made).otherwise(0.0)


def pitch_agreement(expected: Column, observed: Column, octave: float = 0.72) -> Column:
    """Mean over the expected symbols: 1 if observed, ``octave`` if one an octave away is, else 0; 0 if either set is empty."""
    classes = F.transform(observed, lambda o: F.pmod(o, F.lit(12)))
    each = F.transform(expected, lambda p: F.when(F.array_contains(observed, p), 1.0).when(F.array_contains(classes, F.pmod(p, F.lit(12))), octave).otherwise(0.0))
    return F.when((F.size(expected) > 0) & (F.size(observed) > 0), total(each) / F.size(expected)).otherwise(0.0)


def kit_agreement(expected: Column, observed: Column, heavy: tuple[str, ...] = ("kick", "snare"), weight: float = 1.25) -> Column:
    """Weighted share of the expected pieces that were observed; ``heavy`` pieces count more."""
    worth = lambda pieces: total(F.transform(pieces, lambda p: F.when(p.isin(*heavy), weight).otherwise(1.0)))
    share = worth(F.array_intersect(expected, observed)) / F.greatest(worth(F.array_distinct(expected)), F.lit(1e-9))
    return F.when((F.size(expected) > 0) & (F.size(observed) > 0), F.least(F.lit(1.0), share)).otherwise(0.0)


def steps(values: Column) -> Column:
    """Differences of neighbours; one element fewer, none for fewer than two."""
    n = F.size(values)
    return F.when(n > 1, F.zip_with(F.slice(values, 2, n - 1), F.slice(values, 1, n - 1), lambda b, a: b - a)).otherwise(F.slice(values, 1, 0))


def step_agreement(roots_a: Column, roots_b: Column) -> Column:
    """Mean over the steps of both sequences, as far as both go: 1 for equal ones, half for equal modulo an octave."""
    a, b = steps(roots_a), steps(roots_b)
    n = F.least(F.size(a), F.size(b))
    each = F.zip_with(F.slice(a, 1, F.greatest(n, F.lit(0))), F.slice(b, 1, F.greatest(n, F.lit(0))), lambda x, y: F.when(x == y, 1.0).when(F.pmod(x, F.lit(12)) == F.pmod(y, F.lit(12)), 0.5).otherwise(0.0))
    return F.when(n > 0, total(each) / n).otherwise(0.0)


def phrase_agreement(onsets_a: Column, onsets_b: Column, symbols_a: Column, symbols_b: Column, least: int = 4) -> Column:
    """Rhythm (onsets relative to the phrase), count and shared symbols of two phrases; 0 if one has fewer than ``least`` onsets."""
    na, nb = F.size(onsets_a), F.size(onsets_b)
    most = F.greatest(na, nb, F.lit(1))
    n = F.least(na, nb)
    near = F.zip_with(F.slice(onsets_a, 1, F.greatest(n, F.lit(0))), F.slice(onsets_b, 1, F.greatest(n, F.lit(0))), lambda x, y: F.greatest(F.lit(0.0), 1.0 - F.abs(x - y) / 0.14))
    either = F.size(F.array_union(symbols_a, symbols_b))
    shared = F.when(either > 0, F.size(F.array_intersect(symbols_a, symbols_b)) / either).otherwise(0.5)
    whole = total(near) / most * 0.55 + F.greatest(F.lit(0.0), 1.0 - F.abs(na - nb) / most) * 0.25 + shared * 0.20
    return F.when((na >= least) & (nb >= least), whole).otherwise(0.0)


def middle(values: Column) -> Column:
    """Median of an array, the mean of the middle two of an even number."""
    s, n = F.array_sort(values), F.size(values)
    return F.when(n > 0, (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2.0)


def upper_middle(values: Column) -> Column:
    """The upper of the middle two of an even number."""
    return F.get(F.array_sort(values), F.floor(F.size(values) / 2).cast("int"))


def centred_cosine(a: Column, b: Column, least: int = 8) -> Column:
    """Cosine of two equally long series about their medians, clipped to 0..1; 0 if shorter than ``least``."""
    about = lambda v: F.transform(v, lambda x: x - middle(v))
    return F.when(F.size(a) >= least, cosine(about(a), about(b))).otherwise(0.0)


def lagged_cosine(a: Column, b: Column, lags: int, least: int = 8) -> Column:
    """The best ``centred_cosine`` over shifts of up to ``lags`` frames either way; the longer series is cut to the shorter."""
    n = F.least(F.size(a), F.size(b))
    tried = []
    for lag in range(-lags, lags + 1):
        m = F.greatest(n - abs(lag), F.lit(0))
        left, right = (F.slice(a, 1 - lag, m), F.slice(b, 1, m)) if lag < 0 else (F.slice(a, 1, m), F.slice(b, 1 + lag, m))
        tried.append(centred_cosine(left, right, least))
    return F.when(n >= least, F.greatest(*tried) if len(tried) > 1 else tried[0]).otherwise(0.0)


def spread_subset(values: Column, k: Column) -> Column:
    """``k`` elements evenly spaced over the array, both ends included; all if there are no more than k."""
    n = F.size(values)
    places = F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(k - 1, F.lit(0))), lambda i: F.rint(i * (n - 1) / F.greatest(k - 1, F.lit(1))).cast("int")))
    return F.when(n <= k, values).otherwise(F.transform(places, lambda i: F.get(values, i)))
