"""Token counts by a lazily compiled finite-state transducer.

A word-level BPE is turned into a deterministic transducer over symbols (the
bytes of a word, its last byte marked). A state is what can still matter of a
prefix: its live suffixes (proper prefixes of some token) with the token
before each and the token count there. Two tokens may stand side by side
exactly if encoding their joined text gives them back, so each symbol has one
possible last token, and each transition carries how the count changes.
Transitions are compiled when first needed.

A batch is one symbol stream, cut into equal chunks that step through the
transition table together. A chunk's map from entry state to (exit state,
count) is the part before its first word end, which depends on the entry,
and a constant rest. Inside long words the maps are evaluated for all chunks
at once, each on the exit of the chunk before, until no entry changes: a state
forgets what lies further back than tokens reach, so few rounds do.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.llm.bytebpe import byte_letters, contraction_lengths
from timeloom.llm.runtime import map_arrow, slices, text_of
from timeloom.llm.textarrays import NUMBER, SPACE, class_table, code_points

UNKNOWN, START = 0, 1
FINAL = 256  # added to a byte that ends its word


class Transducer:
    """Transitions in an open-addressing table: key ``state << 9 | symbol``, value ``state << 6 | delta + 32``."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str, states: int = 400_000) -> None:
        letters = byte_letters()
        self.states = states
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.ids = {}
        self.prefixes = set()
        self.letter = {b: c for c, b in letters.items()}
        for token in {*(a + b for a, b in merges), *self.letter.values(), *(c + suffix for c in self.letter.values())} & vocab.keys():
            symbols = self._symbols(token, suffix, letters)
            self.ids[symbols] = token
            self.prefixes.update(symbols[:k] for k in range(1, len(symbols)))
        self.suffix = suffix
        self.most_fits = 2_000_000
        self.fits: dict[tuple[str, str], bool] = {}
        self.clear()

    def _symbols(self, token: str, suffix: str, letters: dict[str, int]) -> tuple[int, ...]:
        last = token.endswith(suffix) and token != suffix
        body = [letters[c] for c in (token[: -len(suffix)] if last else token)]
        return (*body[:-1], body[-1] + FINAL) if last else tuple(body)

    def clear(self) -> None:
        self.key = [(), ((), ((None, 0),))]
        self.number = {self.key[START]: START}
        self.used = 0
        self._room(18)

    def _room(self, bits: int) -> None:
        self.bits = bits
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.zeros(1 << bits, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot that holds each key, or the free one where it belongs."""
        mask = (1 << self.bits) - 1
        with np.errstate(over="ignore"):
            at = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)
        there = self.keys[at]
        wrong = np.flatnonzero((there != keys) & (there >= 0))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & mask
            there = self.keys[at[wrong]]
            wrong = wrong[(there != keys[wrong]) & (there >= 0)]
        return at

    def _enter(self, key: int, value: int) -> None:
        if 2 * self.used >= len(self.keys):
            old = self.keys >= 0
            keys, values = self.keys[old].tolist(), self.values[old].tolist()
            self._room(self.bits + 1)
            self.used = 0
            for k, v in zip(keys, values, strict=True):
                self._enter(k, v)
        mask = (1 << self.bits) - 1
        at = (key * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> (64 - self.bits)
        while self.keys[at] >= 0:
            at = at + 1 & mask
        self.keys[at], self.values[at] = key, value
        self.used += 1

    def bpe(self, parts: list[str]) -> list[str]:
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 30))
            pair = (parts[best], parts[best + 1])
            if pair not in self.rank:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    out.append(pair[0] + pair[1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def _pieces(self, token: str) -> list[str]:
        if token.endswith(self.suffix) and token != self.suffix:
            body = list(token[: -len(self.suffix)])
            return [*body[:-1], body[-1] + self.suffix]
        return list(token)

    def _fit(self, a: str, b: str) -> bool:
        got = self.fits.get((a, b))
        if got is None:
            if len(self.fits) >= self.most_fits:  # a memo: results stay the same
                self.fits.clear()
            got = self.fits[a, b] = self.bpe(self._pieces(a) + self._pieces(b)) == [a, b]
        return got

    def compile(self, state: int, symbol: int) -> int:
        """The value of a new transition, entered into the table."""
        if state == UNKNOWN:
            packed = (START if symbol >= FINAL else UNKNOWN) << 6 | 32
        else:
            longest, live = self.key[state]
            token = delta = None
            for k, (before, count) in enumerate(live):
                if (t := self.ids.get((*longest[k:], symbol) if k < len(longest) else (symbol,))) is not None and (before is None or self._fit(before, t)):
                    token, delta = t, count + 1
                    break
            if token is None:
                raise ValueError(f"no token covers symbol {symbol}")
            if symbol >= FINAL:
                packed = START << 6 | delta + 32
            else:
                grown = (*longest, symbol)
                kept = [(k, (before, count - delta)) for k, (before, count) in enumerate(live) if before is not False and grown[k:] in self.prefixes]
                at = kept[0][0] if kept else len(grown)
                slots = dict(kept)
                key = (grown[at:], (*(slots.get(k, (False, 0)) for k in range(at, len(grown))), (token, 0)))
                if key not in self.number:
                    self.number[key] = len(self.key)
                    self.key.append(key)
                packed = self.number[key] << 6 | delta + 32
        self._enter(state << 9 | symbol, packed)
        return packed

    def step(self, state: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = state.astype(np.int64) << 9 | symbols
        at = self._slots(keys)
        packed = self.values[at]
        absent = np.flatnonzero(self.keys[at] < 0)
        if len(absent):
            new = {k: self.compile(k >> 9, k & 511) for k in np.unique(keys[absent]).tolist()}
            packed[absent] = [new[k] for k in keys[absent].tolist()]
        return packed >> 6, (packed & 63) - 32

    def deltas(self, symbols: np.ndarray, chunk: int = 256) -> np.ndarray:
        """How each symbol of a stream of whole words changes the token count."""
        if len(self.key) > self.states:
            self.clear()
        n = len(symbols)
        lanes = -(-n // chunk)
        pad = lanes * chunk - n
        stream = np.concatenate((symbols, np.full(pad, 2 * FINAL - 1, symbols.dtype))).reshape(lanes, chunk)
        ends = stream >= FINAL
        head = np.where(ends.any(axis=1), ends.argmax(axis=1) + 1, chunk)  # symbols that the entry state decides
        out = np.zeros((chunk, lanes), np.int8)
        by_step = np.ascontiguousarray(stream.T)
        state = np.full(lanes, UNKNOWN, np.int32)
        state[0] = START
        head[0] = 0
        for i in range(chunk):
            state, out[i] = self.step(state, by_step[i])
        inner = (head == chunk) & ~ends[:, -1]  # within one word: the exit depends on the entry
        entry = np.concatenate(([START], np.where(inner, START, state)[:-1])).astype(np.int32)
        todo = np.flatnonzero(head > 0)
        while len(todo):
            s = entry[todo]
            for i in range(int(head[todo].max())):
                on = np.flatnonzero(head[todo] > i)
                s[on], out[i, todo[on]] = self.step(s[on], by_step[i, todo[on]])
            within = inner[todo] & (todo + 1 < lanes)
            after, new = todo[within] + 1, s[within]
            other = entry[after] != new
            todo = after[other]
            entry[todo] = new[other]
        return out.T.ravel()[:n]


class TokenCounter:
    """Counts as the tokenizers library gives them for a word-level BPE file, without added special tokens."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.special = [x["content"] for x in spec["added_tokens"]]
        self.split = re.compile("|".join(map(re.escape, self.special)))
        self.machine = Transducer(model["vocab"], merges, model["end_of_word_suffix"])

    def normal(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbol stream of normalised texts, and the text bounds in it."""
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        whole = "".join(texts)
        points = code_points(whole)
        n = len(points)
        kind = class_table()[points]
        begin = np.ones(n + 1, bool)
        if n:
            begin[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
            begin[offsets] = True
            marks = np.flatnonzero((points == 0x27) & begin[:-1])
            if len(marks):
                length = contraction_lengths(points, marks, offsets[np.searchsorted(offsets, marks, side="right")])
                marks, length = marks[length > 0], length[length > 0]
                begin[marks + 1] = False
                begin[marks + length] = True
        width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        first = np.concatenate(([0], np.cumsum(width)))
        stream = np.frombuffer(whole.encode("utf-8", "replace"), np.uint8).astype(np.int32)
        stream[first[1:][begin[1:]] - 1] += FINAL
        word = np.repeat(kind != SPACE, width)
        bounds = np.concatenate(([0], np.cumsum(word)))[first[offsets]]
        return stream[word], bounds

    def count(self, texts: list[str]) -> list[int]:
        plain, extra, parts = [], [], []
        for t in texts:
            found = self.split.split(t) if any(s in t for s in self.special) else [t]
            extra.append(len(found) - 1)
            parts.append(len(found))
            plain += [self.normal(x) for x in found]
        stream, bounds = self.symbols(plain)
        total = np.zeros(len(stream) + 1, np.int64)
        if len(stream):
            np.cumsum(self.machine.deltas(stream), out=total[1:])
        at = bounds[np.concatenate(([0], np.cumsum(parts)))]
        return (total[at[1:]] - total[at[:-1]] + np.array(extra, np.int64)).tolist()


@functools.lru_cache(2)
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def count_tokens(documents: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """Per document: bytes, tokens and whether it has more than ``limit`` tokens. A null text counts as empty."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = counter(tokenizer)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n = [c for part in slices(texts) for c in machine.count(texts[part])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    rows = text_of(documents).withColumn("n_bytes", F.octet_length("text").cast("long"))
    return map_arrow(rows, work, "doc_id bigint, n_bytes bigint, n_tokens bigint").withColumn("over_limit", F.col("n_tokens") > limit)
