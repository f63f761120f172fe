"""Splitting text into the pieces that byte-level BPE merges within, over whole blocks of texts at once.

The rule is the published one of byte-level BPE: contractions, then letters, numbers or other signs with
one space before them, then white space, of which the last character goes with what follows.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np

from riskflow.llm.codes import prefix, span_hashes

LETTER, NUMBER, SPACE, OTHER = range(4)
# The code points with Unicode's White_Space property, and the endings of contractions.
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SHORT_ENDINGS, LONG_ENDINGS = "stmd", ("re", "ve", "ll")


@cache
def kinds() -> np.ndarray:
    first = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((first.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[WHITE_SPACE] = SPACE
    return table


def piece_starts(codes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where pieces start; each ends where the next starts. No piece crosses the edge of a text."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    kind = kinds()[codes]
    edge = np.zeros(n + 1, bool)
    edge[edges] = True
    start = edge[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]

    after = np.flatnonzero(start & (kind != SPACE) & ~edge[:n])
    after = after[kind[after - 1] == SPACE]              # runs with white space right before them
    start[after - 1] = True
    joined = after[codes[after - 1] == 32]
    start[joined] = False

    for i in np.flatnonzero(start & (codes == 39)):      # an apostrophe that starts a piece
        if i + 1 >= n or edge[i + 1] or kind[i + 1] != LETTER:
            continue
        size = 1 if chr(codes[i + 1]) in SHORT_ENDINGS else 0
        if not size and i + 2 < n and not edge[i + 2] and chr(codes[i + 1]) + chr(codes[i + 2]) in LONG_ENDINGS:
            size = 2
        if size:
            start[i + 1] = False
            if i + 1 + size < n:
                start[i + 1 + size] = True
    return np.flatnonzero(start)


def distinct_pieces(whole: str, codes: np.ndarray, starts: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The different pieces of a block, and for each place in it the number of its piece.

    Places are brought together by hashes and compared with the first of their kind by code points.
    """
    if not len(starts):
        return [], np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(codes))
    size = ends - starts
    _, first, kind = np.unique(span_hashes(prefix(codes), starts, ends), return_index=True, return_inverse=True)
    if (size == size[first][kind]).all():
        twin = np.repeat(starts[first][kind] - starts, size)
        twin += np.arange(len(codes))
        if (codes == codes[twin]).all():
            return [whole[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)], kind
    return [whole[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.arange(len(starts))
