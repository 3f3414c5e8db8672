"""Token ids of a byte-level BPE vocabulary over batches of texts."""

from __future__ import annotations

import functools
import json
import re

import numpy as np

from timeloom.llm.textarrays import SPACE, class_table, joined
from timeloom.llm.wordcache import WordCache

_APOSTROPHE = 0x27
_ONE = np.array([ord(c) for c in "stmd"], np.uint32)
_TWO = ("re", "ve", "ll")


def contraction_lengths(points: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Length of the English contraction at each apostrophe ``at`` (0: none) that ends by ``ends``."""
    padded = np.concatenate((points, np.zeros(2, points.dtype)))
    one, two = padded[at + 1], padded[at + 2]
    out = np.where(np.isin(one, _ONE) & (at + 2 <= ends), 2, 0)
    for a, b in _TWO:
        out[(one == ord(a)) & (two == ord(b)) & (at + 3 <= ends)] = 3
    return out


def word_starts(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the words of the usual byte-level pattern.

    A word is a contraction, a run of letters, numbers or other marks with one
    blank before it, or a run of white space without the blank that a
    following word takes.
    """
    if not len(points):
        return np.zeros(0, np.int64)
    kind = class_table()[points]
    fresh = np.ones(len(points), bool)
    fresh[1:] = kind[1:] != kind[:-1]
    opens = np.zeros(len(points) + 1, bool)
    opens[offsets] = True
    fresh |= opens[:-1]
    begin = fresh.copy()
    after = np.flatnonzero(fresh & (kind != SPACE) & ~opens[:-1])
    after = after[kind[after - 1] == SPACE]
    begin[after - 1] = True
    begin[after] = points[after - 1] != 0x20
    marks = np.flatnonzero((points == _APOSTROPHE) & begin & fresh)
    if len(marks):
        ends = offsets[np.searchsorted(offsets, marks, side="right")]
        n = contraction_lengths(points, marks, ends)
        marks, n = marks[n > 0], n[n > 0]
        begin[marks + 1] = False
        inside = marks + n < len(points)
        begin[(marks + n)[inside]] = True
    return np.flatnonzero(begin)


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies, by its rule."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Ids as the tokenizers library gives them without adding special tokens.

    Special strings inside a text become their own ids, the library's default.
    """

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.core = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.cache = WordCache(self._words)

    def _words(self, words: list[str]) -> list[list[int]]:
        one = self.core.encode_single_piece
        return [one(w.encode("utf-8", "replace")) for w in words]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.split is not None and any(s in t for s in self.special for t in texts):
            return [self._with_special(t) for t in texts]
        return self._plain(texts)

    def _with_special(self, text: str) -> np.ndarray:
        parts = [(p, p in self.special) for p in self.split.split(text) if p]
        plain = iter(self._plain([p for p, special in parts if not special]))
        found = [np.array([self.special[p]], np.uint32) if special else next(plain) for p, special in parts]
        return np.concatenate(found) if found else np.zeros(0, np.uint32)

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        points, offsets = joined(texts)
        starts = word_starts(points, offsets)
        if not len(starts):
            return [np.zeros(0, np.uint32) for _ in texts]
        ids, n = self.cache.ids(points, starts, np.concatenate((starts[1:], [len(points)])))
        total = np.concatenate(([0], np.cumsum(n)))
        bounds = total[np.searchsorted(starts, offsets)]
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


@functools.lru_cache(2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


__all__ = ["ByteBpe", "byte_bpe", "byte_letters", "contraction_lengths", "word_starts"]
