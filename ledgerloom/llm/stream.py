"""Texts as arrays of code points, in groups of bounded size."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np

GROUP_CHARS = 1 << 20


def groups(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with GROUP_CHARS together; a longer text is a group of its own."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > start and size + n > GROUP_CHARS:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def code_points(texts: list[str | None], end: str = "\n") -> tuple[np.ndarray, np.ndarray]:
    """All texts' code points, each text followed by end; and where each begins, then the whole length."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t or "") + 1 for t in texts], out=starts[1:])
    joined = end.join([t or "" for t in texts]) + end if texts else ""
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), starts


@cache
def letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@cache
def capitals() -> np.ndarray:
    return np.fromiter((chr(i).isupper() for i in range(0x110000)), bool, 0x110000)


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each number."""
    with np.errstate(over="ignore"):
        x = (x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word (runs of other bytes than space and U+0009 to U+000D) and how many words each text has."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    starts = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=starts[1:])
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    begin = np.flatnonzero(solid & ~np.r_[False, solid[:-1]])
    counts = np.bincount(np.searchsorted(starts, begin, side="right") - 1, minlength=len(raw))
    if not len(begin):
        return np.zeros(0, np.uint64), counts
    at = np.flatnonzero(solid)
    length = np.add.reduceat(solid.astype(np.int64), begin)
    place = at - np.repeat(begin, length)
    with np.errstate(over="ignore"):
        h = mixed(data[at].astype(np.uint64) | (place.astype(np.uint64) << np.uint64(8)))
        edge = np.r_[0, np.cumsum(length)[:-1]].astype(np.int64)
        return mixed(np.add.reduceat(h, edge), 3), counts
