"""Memo of token ids per distinct word, kept in sorted hash arrays and applied to whole batches."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from timeloom.llm.textarrays import span_hashes, spread


class WordCache:
    """Encodes words seen before by array look-ups only.

    ``encode`` gets the distinct new words of a batch and returns their ids.
    ``limit`` bounds the remembered words; beyond it the memo starts anew, so
    memory does not grow with the input and results stay the same.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], limit: int = 3_000_000) -> None:
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.n = np.zeros(0, np.int32)
        self.new_keys, self.new_at, self.new_n = self.keys, self.at, self.n
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, n, hit = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int32), np.zeros(len(hashes), bool)
        for keys, where, count in ((self.keys, self.at, self.n), (self.new_keys, self.new_at, self.new_n)):
            if len(keys):
                i = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                same = keys[i] == hashes
                at[same], n[same] = where[i[same]], count[i[same]]
                hit |= same
        return at, n, hit

    def _merge(self, a: tuple, b: tuple) -> tuple:
        keys = np.concatenate((a[0], b[0]))
        order = np.argsort(keys, kind="stable")
        return keys[order], np.concatenate((a[1], b[1]))[order], np.concatenate((a[2], b[2]))[order]

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        ids = self.encode(words)
        n = np.fromiter(map(len, ids), np.int32, len(ids))
        flat = np.fromiter((x for w in ids for x in w), np.uint32, int(n.sum()))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros(len(self.pool), np.uint32)))
        self.pool[self.used : self.used + len(flat)] = flat
        at = self.used + np.cumsum(n) - n
        self.used += len(flat)
        self.new_keys, self.new_at, self.new_n = self._merge((self.new_keys, self.new_at, self.new_n), (hashes, at, n))
        if len(self.new_keys) > 65_536:
            self.keys, self.at, self.n = self._merge((self.keys, self.at, self.n), (self.new_keys, self.new_at, self.new_n))
            self.new_keys, self.new_at, self.new_n = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def ids(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each word."""
        if len(self.keys) + len(self.new_keys) > self.limit:
            self.clear()
        hashes, first, inverse = np.unique(span_hashes(points, starts, ends), return_index=True, return_inverse=True)
        at, n, hit = self._find(hashes)
        if not hit.all():
            missing = np.flatnonzero(~hit)
            s, e = starts[first[missing]], ends[first[missing]]
            text = points[spread(s, e - s)].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
            bounds = np.concatenate(([0], np.cumsum(e - s))).tolist()
            self._learn(hashes[missing], [text[a:b] for a, b in zip(bounds, bounds[1:], strict=False)])
            at, n, hit = self._find(hashes)
        counts = n[inverse].astype(np.int64)
        return self.pool[spread(at[inverse], counts)], counts
