"""Texts as NumPy code-point arrays: classes, word bounds and word hashes of a whole batch at once."""

from __future__ import annotations

import functools
import sys
import unicodedata

import numpy as np

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
_MULT = np.uint64(0x9E3779B97F4A7C15)


@functools.lru_cache(1)
def class_table() -> np.ndarray:
    """Class of every code point: white space, letter, number or other."""
    out = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for cp in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            out[cp] = LETTER
        elif kind == "N":
            out[cp] = NUMBER
    for lo, hi in ((9, 13), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)):
        out[lo : hi + 1] = SPACE
    return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts end to end, and the n + 1 offsets of the texts in them."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return code_points("".join(texts)), offsets


class _Powers:
    """Powers of the hash multiplier and of its inverse, grown as longer inputs come."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = pow(int(_MULT), -1, 1 << 64)
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, _MULT, np.uint64))), dtype=np.uint64)
                self.down = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, np.uint64(inverse), np.uint64))), dtype=np.uint64)
        return self.up, self.down


_POWERS = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of ``values[starts[i]:ends[i]]`` for each i; length is part of it."""
    up, down = _POWERS.get(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    with np.errstate(over="ignore"):
        seeded = values.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0xA0761D6478BD642F)
        seeded ^= seeded >> np.uint64(29)
        seeded *= up[: len(values)]
        np.cumsum(seeded, out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indexes start, start + 1, ... of each run, run after run."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(counts) - counts
    return np.repeat(starts - first, counts) + np.arange(total)
