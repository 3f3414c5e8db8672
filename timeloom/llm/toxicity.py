"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic function of
its hashed words and word beginnings; the document's is the noisy-or of its
sentences. Only document labels are needed to train it, and the sentence
scores then say where the offence is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.llm.runtime import map_arrow, release, slices, text_of
from timeloom.llm.textarrays import LETTER, NUMBER, class_table, joined, span_hashes

BITS = 20
STOPS = np.array([ord(c) for c in ".!?\n。！？…"], np.uint32)
BEGINNINGS = (4, 6)


@dataclass
class Bags:
    """Features of a batch: hashed feature and sentence per entry, document per sentence, sentence spans."""

    feature: np.ndarray
    sentence: np.ndarray
    document: np.ndarray
    start: np.ndarray
    end: np.ndarray


def bags(texts: list[str]) -> Bags:
    """Splits whole texts into sentences and hashes their words; a text without letters has no features."""
    lowered = [t.lower() if len(t.lower()) == len(t) else "".join(c.lower() if len(c.lower()) == 1 else c for c in t) for t in texts]
    points, offsets = joined(lowered)
    n = len(points)
    opens = np.zeros(n + 1, bool)
    opens[offsets] = True
    if not n:
        none = np.zeros(0, np.int64)
        return Bags(none, none, none, none, none)
    stop = np.isin(points, STOPS)
    begin = opens[:-1].copy()
    begin[1:] |= stop[:-1] & ~stop[1:]
    number = np.cumsum(begin) - 1
    starts = np.flatnonzero(begin)
    ends = np.concatenate((starts[1:], [n]))
    document = np.searchsorted(offsets, starts, side="right") - 1
    kind = class_table()[points]
    word = (kind == LETTER) | (kind == NUMBER)
    first = np.flatnonzero(word & np.concatenate(([True], ~word[:-1] | opens[1:-1])))
    last = np.flatnonzero(word & np.concatenate((~word[1:] | opens[1:-1], [True]))) + 1
    hashes, where = [span_hashes(points, first, last)], [number[first]]
    for k in BEGINNINGS:
        long = last - first > k
        hashes.append(span_hashes(points, first[long], first[long] + k) + np.uint64(k))
        where.append(number[first[long]])
    feature = (np.concatenate(hashes) >> np.uint64(64 - BITS)).astype(np.int64)
    return Bags(feature, np.concatenate(where), document, starts - offsets[document], ends - offsets[document])


def distinct(sentence: np.ndarray, feature: np.ndarray) -> np.ndarray:
    """Packed (sentence, feature) pairs, each once: a word counts once in a sentence, however often it is repeated."""
    return np.unique(sentence << BITS | feature)


@dataclass
class Model:
    """Weights by hashed feature, the sentence bias and the calibration of document scores."""

    weights: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0
    known: np.ndarray | None = None

    @property
    def telling(self) -> np.ndarray:
        if self.known is None:
            self.known = self.weights != 0
        return self.known

    def sentences(self, b: Bags) -> np.ndarray:
        telling = np.flatnonzero(self.telling[b.feature])
        pairs = distinct(b.sentence[telling], b.feature[telling])
        z = self.bias + np.bincount(pairs >> BITS, weights=self.weights[pairs & ((1 << BITS) - 1)], minlength=len(b.document))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def documents(self, b: Bags, n: int) -> np.ndarray:
        none = np.bincount(b.document, weights=np.log1p(-np.minimum(self.sentences(b), 1 - 1e-12)), minlength=n)
        return self.calibrate(-np.expm1(none))

    def calibrate(self, p: np.ndarray) -> np.ndarray:
        p = np.clip(p, 1e-9, 1 - 1e-9)
        z = self.scale * np.log(p / (1 - p)) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(texts: list[bytes], labels: np.ndarray, features: int = 8192, epochs: int = 300) -> Model:
    """Fits noisy-or weights by Adam on documents given as (sentence, feature) pairs packed in int64.

    The ``features`` most telling ones by chi-square are used. With a single
    label every score is that label's share.
    """
    y = np.asarray(labels, float)
    weights = np.zeros(1 << BITS, np.float32)
    if not len(y) or y.min() == y.max():
        return Model(weights, -9.0, 0.0, 6.0 if len(y) and y[0] else -6.0)
    pairs = [np.frombuffer(t, np.int64) for t in texts]
    feature = np.concatenate([(p & ((1 << BITS) - 1)).astype(np.int32) for p in pairs])
    document = np.repeat(np.arange(len(pairs), dtype=np.int32), [len(p) for p in pairs])
    once = np.unique(document.astype(np.int64) << BITS | feature)
    seen, of = once & ((1 << BITS) - 1), once >> BITS
    a = np.bincount(seen, weights=y[of], minlength=1 << BITS)
    n = np.bincount(seen, minlength=1 << BITS).astype(float)
    rate = y.mean()
    expected = n * rate
    chi = np.where(n >= 3, (a - expected) ** 2 / np.maximum(expected * (1 - rate), 1e-9), 0)
    chosen = np.sort(np.argsort(-chi, kind="stable")[:features])
    chosen = chosen[chi[chosen] > 2.0]
    del once, seen, of
    number = np.full(1 << BITS, -1, np.int32)
    number[chosen] = np.arange(len(chosen))
    column = number[feature]
    kept = column >= 0
    column, place = column[kept], document[kept]
    # sentences are numbered in order within a document, so the pairs' sentence numbers start anew with each
    sentence_of = np.concatenate([(p >> BITS).astype(np.int32) for p in pairs])
    sentences = np.array([int(p[-1] >> BITS) + 1 if len(p) else 0 for p in pairs])
    sentence = (np.cumsum(sentences) - sentences)[place] + sentence_of[kept]
    doc_of_sentence = np.repeat(np.arange(len(pairs)), sentences)
    del feature, document, sentence_of, kept
    fold = np.arange(len(y)) % 5 == 4
    used = np.where(fold, 0.0, np.where(y > 0, 0.5 / max(y[~fold].mean(), 1e-6), 0.5 / max(1 - y[~fold].mean(), 1e-6)))
    used /= max(used.sum(), 1e-9)
    w, bias = np.zeros(len(chosen)), -5.0
    moments = [np.zeros(len(chosen)), np.zeros(len(chosen)), 0.0, 0.0]
    for step in range(1, epochs + 1):
        p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(sentence, weights=w[column], minlength=len(doc_of_sentence)), -30, 30)))
        none = np.bincount(doc_of_sentence, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(y))
        whole = np.clip(-np.expm1(none), 1e-9, 1 - 1e-9)
        d_none = np.where(y > 0, -(1 - whole) / whole, 1.0) * used  # of the loss by minus log(1 - whole)
        grad = d_none[doc_of_sentence] * p
        g = np.bincount(column, weights=grad[sentence], minlength=len(w)) + 2e-6 * w
        gb = float(grad.sum())
        moments[0] += 0.1 * (g - moments[0])
        moments[1] += 0.001 * (g * g - moments[1])
        moments[2] += 0.1 * (gb - moments[2])
        moments[3] += 0.001 * (gb * gb - moments[3])
        w -= 0.1 * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-7)
        bias -= 0.1 * (moments[2] / (1 - 0.9**step)) / (np.sqrt(moments[3] / (1 - 0.999**step)) + 1e-7)
    weights[chosen] = w
    model = Model(weights, float(bias))
    if fold.any():
        z = np.log(whole / (1 - whole))[fold]
        scale, shift = 1.0, 0.0
        for _ in range(500):  # Platt scaling on the fifth that was not fitted
            q = 1 / (1 + np.exp(-np.clip(scale * z + shift, -30, 30)))
            scale -= 0.02 * (float(((q - y[fold]) * z).mean()) + 0.01 * (scale - 1))
            shift -= 0.2 * float((q - y[fold]).mean())
        model.scale, model.shift = max(scale, 0.05), shift
    return model


def fit(documents: DataFrame, labels: DataFrame, train_rows, sample: int = 5_000, longest: int = 200_000) -> Model:
    """Trains on a bounded sample of labelled documents.

    ``train_rows`` is a condition on doc_id. ``sample`` doc_ids at most, half
    of each label where there are as many, are picked by a hash of doc_id; a
    null label is none, and of repeated labels the highest counts. Texts of
    more than ``longest`` code points are not learned from (they are scored
    like all others). The picked ids are broadcast, so no text is shuffled.
    """
    marks = labels.where(F.col("toxic").isNotNull() & train_rows).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rate = F.when(F.col("toxic") == 1, min(1.0, sample / 2 / max(1, sizes.get(1, 0)))).otherwise(min(1.0, sample / 2 / max(1, sizes.get(0, 0))))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003))
    picked = marks.where(drawn < rate * 1_000_003).orderBy(drawn, "doc_id").limit(sample)
    rows = text_of(documents).where(F.length("text") <= longest).join(F.broadcast(picked), "doc_id").select("doc_id", "text", "toxic")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            packed = []
            for t in texts:
                b = bags([t])
                packed.append(distinct(b.sentence, b.feature).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(packed, pa.binary()), batch.column("toxic")], names=["doc_id", "pairs", "toxic"])

    got = sorted(map_arrow(rows, work, "doc_id bigint, pairs binary, toxic int").collect(), key=lambda r: (r["doc_id"], bytes(r["pairs"])))
    pairs, marked = [bytes(r["pairs"]) for r in got], np.array([r["toxic"] for r in got], float)
    del got
    model = train(pairs, marked)
    del pairs
    release()
    return model


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and the offending sentences (start, end, score above one half) of every whole text.

    Null and empty texts have no sentence and get the lowest score.
    """
    schema = "doc_id bigint, score double, offending array<struct<start:int,end:int,score:double>>"
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys = batch.column("text").to_pylist(), batch.column("doc_id")
            for part in slices(texts, 500_000):
                own = texts[part]
                b = bags(own)
                each = model.sentences(b)
                spans: list[list[dict]] = [[] for _ in own]
                for i in np.flatnonzero(each > 0.5).tolist():
                    spans[b.document[i]].append({"start": int(b.start[i]), "end": int(b.end[i]), "score": float(each[i])})
                yield pa.RecordBatch.from_arrays([keys[part.start : part.stop], pa.array(model.documents(b, len(own)), pa.float64()), pa.array(spans, kind)], names=["doc_id", "score", "offending"])

    return map_arrow(text_of(documents), work, schema)


def with_score(documents: DataFrame, model: Model) -> DataFrame:
    """The documents as they are, with their ``score`` (a column of that name is replaced)."""
    rows = documents.drop("score")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            got = [model.documents(bags(texts[part]), part.stop - part.start) for part in slices(texts, 500_000)]
            yield batch.append_column("score", pa.array(np.concatenate(got), pa.float64()))

    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", score double"
    return map_arrow(rows, work, schema)
