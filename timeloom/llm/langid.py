"""Language identification by interpolated Kneser-Ney character models.

Each language's model is a set of sorted hash arrays, one per n-gram order,
shared by all languages: a row holds one log-probability per language, already
interpolated over the lower orders. A text gets the language whose model has
the lowest cross-entropy per character; one whose best cross-entropy is far
above what that language's own texts have is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.llm.runtime import map_arrow, release, slices, text_of
from timeloom.llm.textarrays import LETTER, class_table, joined, mix

ORDER = 4
DISCOUNT = 0.75
UNDECIDED = "und"


def fold(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters with one blank between words and around the text, end to end; and the bounds."""
    points, offsets = joined([" " + t.lower() + " " for t in texts])
    letter = class_table()[points] == LETTER
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[offsets[:-1]] = True
    points = np.where(letter, points, np.uint32(0x20))[keep]
    edge = np.zeros(len(offsets), np.int64)
    np.cumsum(np.add.reduceat(keep, offsets[:-1], dtype=np.int64), out=edge[1:])
    return points, edge


@dataclass
class Table:
    """Sorted n-gram hashes; per language the interpolated log-probability of the n-gram's last
    character, and the log-weight that the n-gram as a context leaves to the next lower order."""

    keys: np.ndarray
    logp: np.ndarray
    logback: np.ndarray

    def __post_init__(self) -> None:
        self.bits = max(4, int(len(self.keys)).bit_length() + 1)
        self.starts = np.searchsorted(self.keys, np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits))
        self.padded = np.concatenate((self.keys, np.full(1, np.iinfo(np.uint64).max, np.uint64)))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row of each hash and whether it is there: a look-up by leading bits, then along the sorted hashes."""
        at = self.starts[(keys >> np.uint64(64 - self.bits)).view(np.int64)]
        there = self.padded[at]
        low = np.flatnonzero(there < keys)
        while len(low):
            at[low] += 1
            there[low] = self.padded[at[low]]
            low = low[there[low] < keys[low]]
        return np.minimum(at, max(0, len(self.keys) - 1)), (there == keys) & (at < len(self.keys))


@dataclass
class Model:
    languages: list[str]
    letters: np.ndarray  # sorted code points of the training texts; ids start at 1
    tables: list[Table]
    unseen: float
    sharpness: float
    limits: np.ndarray  # per language: highest accepted cross-entropy of an endless text
    slack: np.ndarray  # per language: what a text of n characters may have beyond it, times sqrt(n)
    number: np.ndarray | None = None

    def ids(self, points: np.ndarray) -> np.ndarray:
        if self.number is None:
            self.number = np.zeros(0x110000, np.uint16)
            self.number[self.letters] = np.arange(1, len(self.letters) + 1)
        return self.number[points].astype(np.uint64)

    def character_scores(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log-probability of each character per language. ``first``: places where fewer than ORDER - 1 characters
        of the same text come before, with their number."""
        places, before = first
        n = len(ids)
        top = self.tables[ORDER - 1]
        key = ids.copy()
        for k in range(1, ORDER):
            key[k:] |= ids[:-k] << np.uint64(16 * k)
        at, hit = top.find(mix(key))
        hit[places] = False
        out = top.logp[at]
        rest = np.ones(n, bool)
        rest[places] = False
        miss = np.flatnonzero(~hit & rest)
        out[miss] = 0
        out[places] = 0
        for order in range(ORDER - 1, 0, -1):
            at, hit = self.tables[order - 1].find(mix(gram(ids, miss - 1, order)))
            out[miss[hit]] += self.tables[order - 1].logback[at[hit]]
            miss = np.concatenate((miss, places[before == order - 1]))
            at, hit = self.tables[order - 1].find(mix(gram(ids, miss, order)))
            out[miss[hit]] += self.tables[order - 1].logp[at[hit]]
            miss = miss[~hit]
        out[miss] += self.unseen
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character and language, and the number of characters scored."""
        points, bounds = fold(texts)
        length = np.diff(bounds)
        places = [bounds[:-1][length > k] + k for k in range(ORDER - 1)]
        scores = self.character_scores(self.ids(points), (np.concatenate(places), np.repeat(np.arange(ORDER - 1), [len(p) for p in places])))
        scores[bounds[:-1]] = 0
        total = np.add.reduceat(scores, bounds[:-1], axis=0, dtype=np.float64)
        return -total / np.maximum(length - 1, 1)[:, None], np.where(length > 2, length - 1, 0)

    def decide(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and acceptance of each text; no letter or no model: undecided, 0, rejected."""
        if not self.languages:
            return [UNDECIDED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        h, length = self.entropies(texts)
        best = h.argmin(axis=1)
        z = np.exp(np.clip(-self.sharpness * np.sqrt(np.maximum(length, 1))[:, None] * (h - h.min(axis=1, keepdims=True)), -60, 0))
        score = np.where(length > 0, 1 / z.sum(axis=1), 0.0)
        lowest = h[np.arange(len(h)), best]
        accepted = (length > 0) & (lowest <= self.limits[best] + self.slack[best] / np.sqrt(np.maximum(length, 1)))
        return [self.languages[b] if n else UNDECIDED for b, n in zip(best.tolist(), length.tolist(), strict=True)], score, accepted


def gram(ids: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """The ``order`` ids that end at each place, 16 bits each, so that four fit; ``mix`` hashes them one to one."""
    key = np.zeros(len(at), np.uint64)
    for k in range(order - 1, -1, -1):
        key = key << np.uint64(16) | ids[at - k]
    return key


def _tally(parts: Iterator[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of all parts with their counts; one part is sorted at a time."""
    found = [np.unique(p, return_counts=True) for p in parts]
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    values, at = np.unique(np.concatenate([v for v, _ in found]), return_inverse=True)
    return values, np.bincount(at, weights=np.concatenate([n for _, n in found])).astype(np.int64)


def _counts(ids: list[np.ndarray], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the n-grams within each text, texts taken about 500,000 characters at a time."""
    long = [x for x in ids if len(x) >= order]
    edges = np.cumsum([len(x) for x in long]) // 500_000 if long else np.zeros(0, np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(edges)) + 1).tolist(), len(long)]
    return _tally(np.concatenate([gram(x, np.arange(order - 1, len(x)), order) for x in long[a:b]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a)


def kneser_ney(ids: list[np.ndarray], alphabet: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per order: n-grams, their interpolated log-probability; contexts of that order, their log back-off weight.

    The highest order counts occurrences, lower ones the distinct characters
    before; each is discounted and interpolated with the order below.
    """
    grams, counts = zip(*(_counts(ids, k) for k in range(1, ORDER + 1)), strict=True)
    counts = list(counts)
    for k in range(ORDER - 1):  # continuation counts
        tail = grams[k + 1] & np.uint64((1 << 16 * (k + 1)) - 1)
        keys, n = np.unique(tail, return_counts=True)
        at = np.searchsorted(grams[k], keys)
        fresh = np.zeros(len(grams[k]), np.int64)
        fresh[at] = n
        counts[k] = np.maximum(fresh, 1)
    out = []
    below: tuple[np.ndarray, np.ndarray] | None = None
    for k in range(ORDER):
        context = grams[k] >> np.uint64(16) if k else np.zeros(len(grams[k]), np.uint64)
        heads, start = np.unique(context, return_index=True)
        which = np.searchsorted(heads, context)
        total = np.bincount(which, weights=counts[k], minlength=len(heads))
        kinds = np.bincount(which, minlength=len(heads))
        back = DISCOUNT * kinds / np.maximum(total, 1)
        if k == 0:
            lower = np.full(len(grams[0]), 1.0 / (alphabet + 1))
        else:
            keys, p = below
            lower = p[np.searchsorted(keys, grams[k] & np.uint64((1 << 16 * k) - 1))]
        prob = (counts[k] - DISCOUNT) / total[which] + back[which] * lower
        below = (grams[k], prob)
        out.append((grams[k], np.log(prob), heads, np.log(np.minimum(back, 1.0))))
    return out


def pieces(text: str, words: int = 6) -> list[str]:
    """Stretches of so many words, spread over the text, 20 at most."""
    split = text.split()
    starts = range(0, max(1, len(split) - words + 1), words)
    return [" ".join(split[at : at + words]) for at in starts[:: -(-len(starts) // 20)]]


def rejection(model: Model, texts: list[str], h: np.ndarray, length: np.ndarray, truth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Limits and slack from held-out texts and their cross-entropies.

    The slack follows from how far short stretches lie above their own text.
    The limit lies twice as far above a language's median as the 0.98
    quantile, lengths taken into account, so a few junk or wrongly labelled
    texts do not move it. Languages with under 50 texts take at least the
    distance of all together; one without any is never rejected.
    """
    own = np.where(length > 0, h[np.arange(len(h)), truth], 0.0)
    rise: list[list[np.ndarray]] = [[] for _ in model.languages]
    for at in np.flatnonzero(length > 0).tolist():
        short, n = model.entropies(pieces(texts[at]))
        rise[truth[at]].append(((short[:, truth[at]] - own[at]) * np.sqrt(n))[n > 0])
    slack = np.array([max(0.0, float(np.quantile(np.concatenate(r), 0.99))) if r and sum(map(len, r)) else 0.0 for r in rise])
    adjusted = own - slack[truth] / np.sqrt(np.maximum(length, 1))
    parts = [adjusted[(truth == i) & (length > 0)] for i in range(len(model.languages))]
    every = np.concatenate([x - np.median(x) for x in parts if len(x)] or [np.zeros(1)])
    limits = np.full(len(parts), np.inf)
    for i, x in enumerate(parts):
        if len(x):
            centre = float(np.median(x))
            away = float(np.quantile(x, 0.98)) - centre
            limits[i] = centre + 2 * (away if len(x) >= 50 else max(away, float(np.quantile(every, 0.98))))
    return limits, slack


def train(texts: list[str], labels: list[str], held: np.ndarray | None = None) -> Model:
    """Fits one model per label; a tenth of each label's texts is kept to calibrate scores and rejection.

    Where texts are too few for that, rejection is calibrated by a model of half of them.
    """
    languages = sorted(set(labels))
    none = np.zeros(0)
    if not languages:
        return Model([], np.zeros(0, np.uint32), [], 0.0, 1.0, none, none)
    half = None
    if held is None:
        met: dict[str, int] = {}
        rank = np.array([met.update({y: met.get(y, -1) + 1}) or met[y] for y in labels])  # among the texts of its label
        held = rank % 10 == 9
        if len(texts) < 20 * len(languages):
            held[:] = False
            half = train(texts, labels, rank % 2 == 1) if rank.any() else None
    folded = [fold(texts[part]) for part in slices(texts)]
    seen, n = _tally(points for points, _ in folded)
    letters = np.sort(seen[np.argsort(-n, kind="stable")[:65_000]])
    model = Model(languages, letters, [], float(-np.log(len(letters) + 1.0) * 2), 1.0, none, none)
    each = []
    while folded:  # two bytes a character are kept
        points, bounds = folded.pop(0)
        ids = model.ids(points).astype(np.uint16)
        each += [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    fitted = [kneser_ney([x for x, y, h in zip(each, labels, held, strict=True) if y == language and not h], len(letters)) for language in languages]
    for k in range(ORDER):
        plain = np.unique(np.concatenate([f[k][0] for f in fitted] + ([f[k + 1][2] for f in fitted] if k + 1 < ORDER else [])))
        logp = np.full((len(plain), len(languages)), np.nan)
        back = np.zeros((len(plain), len(languages)))
        for i, f in enumerate(fitted):
            logp[np.searchsorted(plain, f[k][0]), i] = f[k][1]
            if k + 1 < ORDER:
                back[np.searchsorted(plain, f[k + 1][2]), i] = f[k + 1][3]
        rows, cols = np.nonzero(np.isnan(logp))
        if k == 0:
            logp[rows, cols] = model.unseen
        else:
            below = model.tables[k - 1]
            at, hit = below.find(mix(plain[rows] & np.uint64((1 << 16 * k) - 1)))
            lower = np.where(hit, below.logp[at, cols], model.unseen)
            at, hit = below.find(mix(plain[rows] >> np.uint64(16)))
            logp[rows, cols] = lower + np.where(hit, below.logback[at, cols], 0.0)
        order = np.argsort(mix(plain))
        model.tables.append(Table(mix(plain)[order], logp[order].astype(np.float32), back[order].astype(np.float32)))
    check = [i for i in range(len(texts)) if held[i]] or list(range(len(texts)))
    h, length = model.entropies([texts[i] for i in check])
    truth = np.array([languages.index(labels[i]) for i in check])
    if held.any():
        model.limits, model.slack = rejection(model, [texts[i] for i in check], h, length, truth)
    elif half:
        model.limits, model.slack = half.limits, half.slack
    else:
        model.limits, model.slack = np.full(len(languages), np.inf), np.zeros(len(languages))
    grid = np.array([0.1, 0.2, 0.5, 1.0, 2.0, 4.0, 8.0])
    gap = np.sqrt(np.maximum(length, 1))[:, None] * (h - h.min(axis=1, keepdims=True))
    loss = []
    for s in grid:
        z = np.exp(np.clip(-s * gap, -60, 0))
        loss.append(-np.log(np.maximum(z[np.arange(len(z)), truth] / z.sum(axis=1), 1e-9))[length > 0].mean() if (length > 0).any() else 0.0)
    model.sharpness = float(grid[int(np.argmin(loss))])
    return model


def fit(documents: DataFrame, train_rows, sample: int = 6_000) -> Model:
    """Trains on about ``sample`` documents at most, shared out equally among the languages and picked by a hash of doc_id.

    ``train_rows`` is a condition on doc_id; rows without lang are left out.
    """
    known = documents.where(F.col("lang").isNotNull() & train_rows & F.col("doc_id").isNotNull()).select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    if not sizes:
        return train([], [])
    share = sample / len(sizes)
    rate = F.lit(0.0)
    for language, n in sizes.items():
        rate = F.when(F.col("lang") == language, min(1.0, share / n)).otherwise(rate)
    rows = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < rate * 1_000_003).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["lang"], r["text"]))
    texts, labels = [r["text"] for r in rows], [r["lang"] for r in rows]
    del rows
    model = train(texts, labels)
    del texts, labels
    release()
    return model


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and accepted for every whole text.

    Null texts and texts without a letter are ``und`` with score 0, rejected.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys = batch.column("text").to_pylist(), batch.column("doc_id")
            for part in slices(texts, 500_000):
                language, score, accepted = model.decide(texts[part])
                yield pa.RecordBatch.from_arrays([keys[part.start : part.stop], pa.array(language, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())], names=["doc_id", "lang_pred", "score", "accepted"])

    return map_arrow(text_of(documents), work, "doc_id bigint, lang_pred string, score double, accepted boolean")


def with_language(documents: DataFrame, model: Model) -> DataFrame:
    """The documents as they are, with ``lang_pred`` and ``accepted`` (columns of those names are replaced)."""
    rows = documents.drop("lang_pred", "accepted")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            language, accepted = [], []
            for part in slices(texts, 500_000):
                a, _, b = model.decide(texts[part])
                language += a
                accepted += b.tolist()
            yield batch.append_column("lang_pred", pa.array(language, pa.string())).append_column("accepted", pa.array(accepted, pa.bool_()))

    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", lang_pred string, accepted boolean"
    return map_arrow(rows, work, schema)
