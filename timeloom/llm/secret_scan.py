"""Secret scan: fixed rules, and a character convolutional network over every other candidate.

Rules find assignments, access keys and long hexadecimal runs. Every other
long token of a text is a candidate, which the network scores from its
characters and those around it. The network is trained on the rules' findings
(in their context, with the context replaced, so that it knows a secret
without its key word, and at the end of a path) against tokens that no rule
reports. A long token is scored over overlapping frames; the highest counts.
Tokens against which it is trained may hold secrets themselves, so those that
a first network takes for findings are left out of the training of the second.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.llm.runtime import map_arrow, release, text_of

# The rules.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
NAME = re.compile(r"[A-Za-z]{3,12}")
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
PART = re.compile(r"[=/._-]+")  # between the parts of a path
KINDS = ("assign", "access", "hex", "model")

LEFT, INSIDE, RIGHT = 20, 32, 8
WINDOW = LEFT + INSIDE + RIGHT
KEYWORD = re.compile(r"pass|secret|token|key|auth|cred|akia", re.IGNORECASE)

Span = tuple[int, int, int]  # start, kind, end


def rule_spans(text: str) -> list[Span]:
    """Findings of the rules, leftmost and non-overlapping per kind; short ones are dropped after matching."""
    found: list[Span] = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, taken: list[Span]) -> list[tuple[int, int]]:
    """Long tokens that no rule's finding touches; ``taken`` is in order of start."""
    out, at, reach = [], 0, 0
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        while at < len(taken) and taken[at][0] < e:
            reach = max(reach, taken[at][2])
            at += 1
        if reach <= s:
            out.append((s, e))
    return out


def window(text: str, start: int, end: int) -> str:
    """A fixed frame: the text before, the token's head, the text after."""
    inside = text[start : min(end, start + INSIDE)]
    return text[max(0, start - LEFT) : start].rjust(LEFT) + inside.ljust(INSIDE) + text[end : end + RIGHT].ljust(RIGHT)


def windows_of(text: str, start: int, end: int) -> list[str]:
    """Frames that cover the whole token, each half over the one before, and one from each part of a path on.

    Frames after the first end where the token does or after INSIDE
    characters; what is before a frame is shown as it stands.
    """
    starts = [start, *range(start + INSIDE // 2, end - INSIDE // 2, INSIDE // 2)]
    if end - start > INSIDE:
        starts.append(end - INSIDE)
    starts += [m.end() for m in PART.finditer(text, start, end) if m.end() <= end - 12]
    return [window(text, at, min(end, at + INSIDE)) if at > start else window(text, start, end) for at in sorted(set(starts))]


def encode(windows: list[str]) -> np.ndarray:
    raw = np.frombuffer("".join(windows).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, WINDOW)
    return np.minimum(raw, 128).astype(np.int64)


@dataclass
class Network:
    """One-hot characters, a convolution, max-pooling per zone, a linear layer."""

    kernel: np.ndarray  # width, character, filter
    bias: np.ndarray
    weights: np.ndarray  # zones * filters
    offset: float
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5

    ZONES = ((0, LEFT), (LEFT, LEFT + INSIDE), (LEFT + INSIDE, WINDOW))

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        width = len(self.kernel)
        padded = np.pad(x, ((0, 0), (width // 2, width // 2)), constant_values=32)
        z = np.repeat(self.bias[None, None, :], WINDOW, 1).repeat(len(x), 0)
        for k in range(width):
            z += self.kernel[k][padded[:, k : k + WINDOW]]
        pooled, where = [], []
        for a, b in self.ZONES:
            at = z[:, a:b].argmax(axis=1)
            where.append(at + a)
            pooled.append(np.take_along_axis(z[:, a:b], at[:, None, :], 1)[:, 0])
        mean = np.maximum(z[:, LEFT : LEFT + INSIDE], 0).mean(axis=1)
        h = np.concatenate([*(np.maximum(p, 0) for p in pooled), mean], axis=1)
        return h @ self.weights + self.offset, h, np.stack(where, 1)

    def probability(self, windows: list[str], block: int = 512) -> np.ndarray:
        out = [self.forward(encode(windows[i : i + block]))[0] for i in range(0, len(windows), block)]
        return 1 / (1 + np.exp(-(self.scale * np.concatenate(out) + self.shift))) if out else np.zeros(0)


def train(windows: list[str], labels: list[int], filters: int = 16, width: int = 5, epochs: int = 6, recall: float = 0.98, seed: int = 11) -> Network:
    """Fits the network by Adam, calibrates it and sets the threshold on a held-out fifth.

    The threshold is the highest one that keeps ``recall`` of the held-out
    findings. Without both labels nothing is reported.
    """
    rng = np.random.default_rng(seed)
    y = np.array(labels, float)
    net = Network(rng.normal(0, 0.1, (width, 129, filters)), np.zeros(filters), rng.normal(0, 0.1, 4 * filters), 0.0)
    if not len(y) or y.min() == y.max():
        net.threshold = 2.0
        return net
    order = rng.permutation(len(y))
    held, used = order[: len(y) // 5], order[len(y) // 5 :]
    x = encode(windows)
    params = [net.kernel, net.bias, net.weights, np.zeros(1)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    balance = np.where(y > 0, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    for _ in range(epochs):
        for batch in np.array_split(rng.permutation(used), max(1, len(used) // 128)):
            xb = x[batch]
            net.offset = float(params[3][0])
            logit, h, where = net.forward(xb)
            d = (1 / (1 + np.exp(-logit)) - y[batch]) * balance[batch] / len(batch)
            dh = d[:, None] * net.weights[None, :] * (h > 0)
            g_kernel, g_bias = np.zeros_like(net.kernel), np.zeros_like(net.bias)
            padded = np.pad(xb, ((0, 0), (width // 2, width // 2)), constant_values=32)
            rows, cols = np.arange(len(batch))[:, None], np.arange(filters)[None, :]
            for zone in range(3):
                g = dh[:, zone * filters : (zone + 1) * filters]
                g_bias += g.sum(0)
                for k in range(width):
                    np.add.at(g_kernel[k], (padded[rows, where[:, zone] + k], np.broadcast_to(cols, g.shape)), g)
            grads = [g_kernel, g_bias, h.T @ d + 1e-4 * net.weights, np.array([d.sum()])]
            step += 1
            for p, g, (m, v) in zip(params, grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.offset = float(params[3][0])
    logit = np.concatenate([net.forward(x[held[i : i + 512]])[0] for i in range(0, len(held), 512)]) if len(held) else np.zeros(0)
    for _ in range(200):  # Platt scaling
        p = 1 / (1 + np.exp(-(net.scale * logit + net.shift)))
        net.scale -= 0.05 * float(((p - y[held]) * logit).mean()) if len(held) else 0.0
        net.shift -= 0.05 * float((p - y[held]).mean()) if len(held) else 0.0
    if y[held].sum():
        p = 1 / (1 + np.exp(-(net.scale * logit + net.shift)))
        net.threshold = float(np.quantile(p[y[held] > 0], 1 - recall, method="lower"))
    return net


def examples(text: str, seed: int) -> list[tuple[str, int]]:
    """Labelled windows of one text: findings, variants of them without their context, and plain tokens.

    Variants are the finding bare, cut short, written in letters and digits
    at random, and at the end of a path; plain tokens are the text's own and
    paths made of its words.
    """
    rng = np.random.default_rng(seed & 0xFFFFFFFF)
    spans = rule_spans(text)
    out = []
    words = KEYWORD.sub("", text)
    names = NAME.findall(words)
    path = lambda: "".join(names[i] + "./_-="[rng.integers(0, 5)] for i in rng.integers(0, len(names), rng.integers(1, 5))) if names else ""
    for start, kind, end in spans[:8]:
        if kind == 0:
            m = ASSIGN.match(text, start)
            start, end = m.span(2)
        out.append((window(text, start, end), 1))
        own = text[start:end]
        short = own[: int(rng.integers(16, max(17, min(len(own), 64) + 1)))]
        other = "".join(LETTERS[i] for i in rng.integers(0, len(LETTERS), len(short)))
        for before, value in (("", own), ("", short), ("", other), (path(), short), (path(), other)):
            at = int(rng.integers(0, max(1, len(words) - LEFT)))
            head = words[at : at + LEFT] + " " + before
            out.append((window(head + value + " " + words[:RIGHT], len(head), len(head) + len(value)), 1))
    plain = candidates(text, spans)
    for i in rng.permutation(len(plain))[:2].tolist():
        frames = windows_of(text, *plain[i])
        out += [(frames[k], 0) for k in sorted({0, int(rng.integers(0, len(frames)))})]
    if names and rng.random() < 0.25:
        made = "x " + path() + path() + names[0]
        if not rule_spans(made):
            frames = windows_of(made + " " + words[:RIGHT], 2, len(made))
            out.append((frames[int(rng.integers(0, len(frames)))], 0))
    return out


def train_clean(windows: list[str], labels: list[int]) -> Network:
    """Trains without the plain tokens that a network of the other half of the examples takes for findings."""
    y = np.array(labels)
    keep = np.ones(len(y), bool)
    side = np.random.default_rng(5).permutation(len(y)) % 2
    for half in (0, 1):
        judge = train([w for w, h in zip(windows, side, strict=True) if h != half], y[side != half].tolist())
        rows = np.flatnonzero((side == half) & (y == 0))
        keep[rows] = judge.probability([windows[i] for i in rows]) < max(0.5, judge.threshold)
    model = train([windows[i] for i in np.flatnonzero(keep)], y[keep].tolist())
    release()
    return model


def fit(documents: DataFrame, sample: int = 20_000, examples_max: int = 12_000) -> Network:
    """Trains on about ``sample`` documents picked by a hash of doc_id, at most ``examples_max`` windows of each label."""
    texts = text_of(documents)
    total = texts.count()
    picked = texts.where(F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1))), F.lit(1_000_003)) < int(1_000_003 * min(1.0, sample / max(1, total))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [x for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for x in examples(t, hash(k))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32())], names=["view", "label"])

    rows = map_arrow(picked, work, "view string, label int")
    got: list[tuple[str, int]] = []
    for label in (0, 1):
        got += [(r["view"], label) for r in rows.where(F.col("label") == label).orderBy(F.xxhash64("view"), "view").limit(examples_max).collect()]
    return train_clean([w for w, _ in got], [y for _, y in got])


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def all_spans(texts: list[str], net: Network, most: int = 8_192) -> tuple[list[list[Span]], list[list[Span]]]:
    """The rules' findings and all findings of each text; about ``most`` frames are judged at a time, or one token's."""
    base = [rule_spans(t) for t in texts]
    every = [list(b) for b in base]
    held: list[tuple[int, int, int, list[str]]] = []
    n = 0

    def judge() -> None:
        p = net.probability([w for *_, frames in held for w in frames])
        top = np.maximum.reduceat(p, np.cumsum([0, *(len(h[3]) for h in held)])[:-1])
        for (i, s, e, _), hit in zip(held, top >= net.threshold, strict=True):
            if hit:
                every[i].append((s, 3, e))

    for i, t in enumerate(texts):
        for s, e in candidates(t, base[i]):
            held.append((i, s, e, windows_of(t, s, e)))
            n += len(held[-1][3])
            if n >= most:
                judge()
                held, n = [], 0
    if held:
        judge()
    return base, [sorted(x) for x in every]


def masked(text: str, spans: list[Span], mark: str = "[secret]") -> str:
    """The text with each stretch of findings, overlapping ones together, replaced."""
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:]


def mask(documents: DataFrame, net: Network) -> DataFrame:
    """The documents with findings replaced; where there is one, n_chars is counted anew. A null text stays null."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            spans = all_spans([t or "" for t in texts], net)[1]
            new = [masked(t, x) if x else t for t, x in zip(texts, spans, strict=True)]
            length = [len(t) if x else n for t, x, n in zip(new, spans, batch.column("n_chars").to_pylist(), strict=True)]
            made = batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(new, pa.string()))
            yield made.set_column(batch.schema.get_field_index("n_chars"), "n_chars", pa.array(length, pa.int64()))

    rows = documents.withColumn("n_chars", F.col("n_chars").cast("long"))
    return map_arrow(rows, work, ", ".join(f"`{n}` {t}" for n, t in rows.dtypes))


def scan(documents: DataFrame, net: Network) -> DataFrame:
    """All findings of every whole text: doc_id, rule counts, digests of the spans and the spans.

    A null or empty text has none; repeated rows are scanned each on its own.
    Offsets are code points, ends exclusive.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            base, every = all_spans(texts, net)
            count = [[sum(k == kind for _, k, _ in b) for b in base] for kind in range(3)]
            sha = [hashlib.sha256(spans_text(b).encode()).hexdigest() for b in base]
            spans = [spans_text(x) for x in every]
            arrays = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in count), pa.array(sha, pa.string()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return map_arrow(text_of(documents), work, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
