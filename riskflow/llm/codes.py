"""Texts as arrays of code points: words, their places and their hashes in a few array passes.

Hashes of spans come from one running sum of ``code * BASE**place`` modulo 2**64, divided by the power
of the span's start, and are then mixed. They are 64 bits wide and depend on the text alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15 | 1
BLOCK = 1 << 20


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, BLOCK + 1)
            steps = np.full(size, BASE, np.uint64)
            steps[0] = 1
            cls.up = np.cumprod(steps, dtype=np.uint64)
            steps[1:] = pow(BASE, -1, 1 << 64)
            cls.down = np.cumprod(steps, dtype=np.uint64)
        return cls.up, cls.down


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of entries whose sizes together are at most ``limit``; a larger entry is a range of its own."""
    first = end = total = 0
    for end, size in enumerate(sizes):
        if end > first and total + size > limit:
            yield first, end
            first, total = end, 0
        total += size
        end += 1
    if end > first:
        yield first, end


def blocks(texts: Sequence[str], limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``limit`` code points together."""
    return runs(map(len, texts), limit)


def text_blocks(column: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, int, list[str]]]:
    """Ranges of an Arrow column of texts with about ``limit`` bytes together, and their texts; only these are copied."""
    for a, b in runs(pc.binary_length(column).to_pylist(), limit):
        yield a, b, column.slice(a, b - a).to_pylist()


def code_points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, and where each text starts, with the end as last entry."""
    edges = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)), out=edges[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4"), edges


def word_spans(codes: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without ASCII white space; no word crosses the edge of a text."""
    word = ~((codes == 32) | ((codes >= 9) & (codes <= 13)))
    before = np.zeros(len(codes) + 1, bool)
    before[1:] = word
    after = np.zeros(len(codes) + 1, bool)
    after[:-1] = word
    cut = np.zeros(len(codes) + 1, bool)
    cut[edges] = True
    return np.flatnonzero(after & (~before | cut)), np.flatnonzero(before & (~after | cut))


def prefix(codes: np.ndarray) -> np.ndarray:
    up, _ = _Powers.get(len(codes) + 1)
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[:len(codes)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = _Powers.get(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each ``n`` neighbouring word hashes; entry i covers i to i + n - 1."""
    size = max(0, len(words) - n + 1)
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out = out * np.uint64(BASE) + words[k:k + size]
    return mix(out)


def window_hashes(sums: np.ndarray, n: int) -> np.ndarray:
    """Hash of each ``n`` neighbouring values, from their running sum."""
    size = max(0, len(sums) - n)
    _, down = _Powers.get(len(sums))
    return mix((sums[n:n + size] - sums[:size]) * down[:size])


def run_edges(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive whole numbers."""
    cut = np.flatnonzero(np.diff(places) != 1)
    return (places[np.concatenate([[0], cut + 1])], places[np.concatenate([cut, [-1]])]) if len(places) else (places, places)
