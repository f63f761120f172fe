"""Periodic runs of words, found through minimizers at several scales.

A run is a stretch of words whose smallest period is q, of at least ``least`` words and ``times`` periods, that no
neighbouring word extends. Periods up to ``direct`` are found by comparing each word with the one q further on. Longer ones are
taken in scales of periods from Q to Q * 3/2. At a scale, word sequences of ``k >= q`` words are hashed and the smallest hash of every ``w``
neighbouring places is selected. Since ``w + k - 1 <= (times - 1) * Q``, a run holds a window and its copy one period on; both select
the same place of the period, and as ``k >= q`` the same sequence can't recur in between. So neighbours among equal
minimizers, at a distance of the scale, meet every run. Each such pair is extended both ways by halving steps over running hashes, and what is found
is compared word by word. A stretch found under several periods (multiples of one) keeps the smallest.

Null and empty texts and texts without words have no run and an empty collapsed text. Rows without an id keep their words as they are
(``with_planted`` changes texts by their id only). Repeated rows give repeated results, an empty table an empty one. A text of any length
is one row, held by one task with a few numbers per word. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riskflow.llm.codes import mix, prefix, run_edges, span_hashes, text_blocks, window_hashes
from riskflow.llm.tables import text_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
OUT = ("n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")


@dataclass(frozen=True)
class RunRule:
    least: int = 24
    times: int = 3
    direct: int = 15

    def shortest(self, period: int | np.ndarray) -> int | np.ndarray:
        return np.maximum(self.least, self.times * period)

    def scales(self, longest: int) -> Iterator[tuple[int, int, int, int]]:
        """``low, high, k, w`` of the scales for texts of up to ``longest`` words."""
        low = self.direct + 1
        while self.times * low <= longest:
            high = low * 3 // 2
            yield low, high, high, (self.times - 1) * low - high + 1
            low = high + 1


def lag_stretches(ids: np.ndarray, left: np.ndarray, lag: int, rule: RunRule) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the stretches in which words ``lag`` apart are equal, long enough for a run."""
    equal = np.flatnonzero((ids[:-lag] == ids[lag:]) & (left[:-lag] > lag))
    first, last = run_edges(equal)
    length = last - first + 1 + lag
    long = length >= rule.shortest(lag)
    return first[long], length[long]


def minimizers(hashes: np.ndarray, w: int) -> np.ndarray:
    """Places of the smallest hash, the leftmost of equal ones, of every ``w`` neighbouring places."""
    mask = np.uint64((1 << len(hashes).bit_length()) - 1)
    low = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while 2 * size <= w:
        low, size = np.minimum(low[:-size], low[size:]), 2 * size
    if size < w:
        low = np.minimum(low[:size - w], low[w - size:])
    at = (low & mask).astype(np.int64)
    return at[np.flatnonzero(np.diff(at, prepend=-1))]


def common_length(sums: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray, ahead: bool) -> np.ndarray:
    """For how many words, up to ``most``, the texts from ``a`` and ``b`` agree onwards, or backwards before them."""
    low, high = np.zeros(len(a), np.int64), most.copy()
    while (low < high).any():
        m = (low + high + 1) >> 1
        if ahead:
            same = span_hashes(sums, a, a + m) == span_hashes(sums, b, b + m)
        else:
            same = span_hashes(sums, a - m, a) == span_hashes(sums, b - m, b)
        low, high = np.where(same, m, low), np.where(same, high, m - 1)
    return low


def find_runs(ids: np.ndarray, sizes: np.ndarray, rule: RunRule = RunRule()) -> np.ndarray:
    """``text, start, length, period`` of all runs, in this order; ``ids`` are the words of texts of ``sizes``, longest first."""
    edges = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    left = edges[1:][owner] - np.arange(len(ids))              # words from here to the end of the text
    found: list[np.ndarray] = []

    def keep(first: np.ndarray, length: np.ndarray, period: int | np.ndarray) -> None:
        found.append(np.stack([owner[first], first - edges[:-1][owner[first]], length, np.broadcast_to(period, len(first))], 1))

    for lag in range(1, min(rule.direct, len(ids) - 1) + 1):
        keep(*lag_stretches(ids, left, lag, rule), lag)
    values = mix(ids.astype(np.uint64) + np.uint64(1))
    sums = prefix(values)
    for low, high, k, w in rule.scales(int(sizes[0]) if len(sizes) else 0):
        end = int(edges[np.count_nonzero(sizes >= rule.times * low)])
        grams = window_hashes(sums[:end + 1], k)
        at = minimizers(grams, w)
        at = at[left[at] >= k]
        at = at[np.argsort(grams[at], kind="stable")]
        lag = at[1:] - at[:-1]
        pair = np.flatnonzero((grams[at[1:]] == grams[at[:-1]]) & (lag >= low) & (lag <= high) & (left[at[:-1]] >= lag + k))
        a, lag = at[:-1][pair], lag[pair]
        before = common_length(sums, a, a + lag, a - edges[:-1][owner[a]], ahead=False)
        after = common_length(sums, a, a + lag, left[a] - lag, ahead=True)
        long = before + after + lag >= rule.shortest(lag)
        for first, length, q in np.unique(np.stack([a - before, before + after + lag, lag], 1)[long], axis=0):
            if (ids[first:first + length - q] == ids[first + q:first + length]).all():
                keep(np.array([first]), np.array([length]), q)
            else:                                              # hashes of different words have met
                i, j = edges[owner[first]], edges[owner[first] + 1]
                start, size = lag_stretches(ids[i:j], left[i:j], q, rule)
                keep(start + i, size, q)
    rows = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    again = np.zeros(len(rows), bool)
    again[1:] = (rows[1:, :3] == rows[:-1, :3]).all(axis=1)     # the same stretch by a multiple of its period
    rows = rows[~again]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def with_planted(doc_id: int | None, words: list[str]) -> list[str]:
    """The words, with a tail made periodic in every tenth document by the checksum of its id."""
    n = len(words)
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a:a + p]
    return words[:a] + (tail * (-(-(n - a) // p)))[:n - a]


def runs_of(texts: list[list[str]], rule: RunRule = RunRule()) -> list[np.ndarray]:
    """``start, length, period`` of the runs of each text, by start and period."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    number: defaultdict[str, int] = defaultdict(count().__next__)
    ids = np.fromiter((number[w] for i in order for w in texts[i]), np.int64)
    found = find_runs(ids, np.array([len(texts[i]) for i in order], np.int64), rule)
    cuts = np.searchsorted(found[:, 0], np.arange(len(order) + 1))
    out: list[np.ndarray] = [found[:0, 1:]] * len(texts)
    for place, i in enumerate(order):
        out[i] = found[cuts[place]:cuts[place + 1], 1:]
    return out


def collapse(words: list[str], runs: np.ndarray) -> list[str]:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def strongest(runs: np.ndarray) -> tuple[int, int, int, int] | tuple[None, None, None, None]:
    """Start, length, period and thousandths of the exponent of the run with most periods; ties by start, then period."""
    if not len(runs):
        return None, None, None, None
    # Equal fractions are equal as floats, different ones differ below 2**26 words.
    start, length, period = (int(x) for x in runs[np.argmax(runs[:, 1] / runs[:, 2])])
    return start, length, period, 1000 * length // period


def periodic_runs(docs: DataFrame, rule: RunRule = RunRule(), planted: bool = False) -> DataFrame:
    """Per row the number of runs, the strongest, and digests of all runs and of the text without its repeats."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = [part.split()[0] for part in OUT.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_blocks(batch.column("text")):
                at = batch.column("doc_id").slice(a, b - a)
                split = [WORD.findall(t) for t in texts]
                if planted:
                    split = [with_planted(i, words) for i, words in zip(at.to_pylist(), split, strict=True)]
                rows = []
                for words, runs in zip(split, runs_of(split, rule), strict=True):
                    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist())
                    left = " ".join(collapse(words, runs)).encode("utf-8", "surrogatepass")
                    rows.append((len(runs), *strongest(runs), sha256(listed.encode()).hexdigest(), sha256(left).hexdigest()))
                kinds = [pa.int64()] * 5 + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays([at, *map(pa.array, zip(*rows, strict=True), kinds)], ["doc_id", *names])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, f"doc_id {kind}, {OUT}")
