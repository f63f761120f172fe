"""Best-fit packing of documents into fixed-length sequences, improved by swap-based local search.

Documents become ids and an end mark; what is longer than a sequence is cut into full pieces, of which
the first may be shorter. Spark deals the pieces evenly to tasks, which pack them in groups of a bounded size. In a group each piece
goes to the fullest sequence that holds it, large ones first. Then the emptiest sequences give pieces to
fuller ones, by moves and by exchanges of one for one, one for two and two for one, each of which raises
the sum of squared fills; sequences that run empty are gone. The search ends when no exchange is left, or
none of ``PATIENCE`` sources in a row could be emptied.

Null and empty texts are the end mark alone. Repeated rows are packed as often as they occur; null ids
stay null. An empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from riskflow.llm.bpe import worker_encoder
from riskflow.llm.codes import text_blocks
from riskflow.llm.tables import store, text_of

CAPACITY, END_MARK = 2048, 0
#: Pieces of one group, which a task holds at a time, and sources drained in a row without one running empty before the search ends.
GROUP, PATIENCE = 6_000, 200


def pieces(docs: DataFrame, vocab_path: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(vocab_path, None)
        for batch in batches:
            for a, b, texts in text_blocks(batch.column("text"), 1 << 19):
                ids, bounds = encoder.encode(texts)
                rows = []
                for i in range(b - a):
                    own = np.append(ids[bounds[i]:bounds[i + 1]], END_MARK).astype("<u4")
                    cuts = [0, *range(len(own) % capacity or capacity, len(own) + 1, capacity)]
                    rows += [(i, n, s, e - s, zlib.crc32(own[s:e].tobytes())) for n, (s, e) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
                at, number, *rest = (pa.array(c, pa.int64()) for c in zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a).take(at), number.cast(pa.int32()), *rest], names)

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Piece numbers by bin: large pieces first, each into the fullest bin with room for it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0                                             # bit r is set if some bin has r left
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, at = capacity, len(bins)
            bins.append([])
        bins[at].append(i)
        left = room - size
        if left:
            by_room[left].append(at)
            rooms |= 1 << left
    return bins


class Search:
    """Exchanges between the bins that are not full."""

    def __init__(self, sizes: np.ndarray, bins: list[list[int]], capacity: int) -> None:
        self.sizes, self.capacity = sizes.astype(np.int64), capacity
        self.bins = [set(b) for b in bins]
        self.fill = np.array([sum(int(sizes[i]) for i in b) for b in bins], np.int64)
        open_bins = np.flatnonzero(self.fill < capacity)
        self.items = np.array(sorted(i for b in open_bins for i in self.bins[b]), np.int64)
        self.home = np.zeros(len(sizes), np.int64)
        for b in open_bins:
            self.home[list(self.bins[b])] = b
        self.open = open_bins

    def shift(self, given: tuple[int, ...], taken: tuple[int, ...], source: int, target: int) -> None:
        for moved, a, b in ((given, source, target), (taken, target, source)):
            for i in moved:
                self.bins[a].remove(i)
                self.bins[b].add(i)
                self.home[i] = b
        gain = int(self.sizes[list(given)].sum() - self.sizes[list(taken)].sum())
        self.fill[source] -= gain
        self.fill[target] += gain

    def best(self, amount: int, source: int) -> tuple[int, int] | None:
        """The item of a fuller bin to exchange for ``amount``, and its bin, with the largest gain; a move counts as item -1."""
        fill = self.fill[self.open]
        found, top = None, 0
        fits = (fill + amount <= self.capacity) & (fill >= self.fill[source] - amount + 1) & (self.open != source) & (fill > 0)
        if fits.any():
            at = int(np.argmax(np.where(fits, fill, -1)))
            top = amount * (int(fill[at]) - int(self.fill[source]) + amount)
            found = (-1, int(self.open[at])) if top > 0 else None
        home = self.home[self.items]
        rise = amount - self.sizes[self.items]
        after = self.fill[home] + rise
        gain = rise * (self.fill[home] - self.fill[source] + rise)
        gain[(rise <= 0) | (after > self.capacity) | (home == source)] = 0
        if len(gain) and gain.max() > max(top, 0):
            at = int(gain.argmax())
            found = (int(self.items[at]), int(home[at]))
        return found

    def pair_for(self, amount: int, source: int) -> tuple[tuple[int, int], int] | None:
        """Two items of one fuller bin, together smaller than ``amount``, that it can be exchanged for."""
        order = np.argsort(-self.fill[self.open], kind="stable")
        for b in self.open[order].tolist():
            room = self.capacity - int(self.fill[b])
            if b == source or room == 0 or self.fill[b] < self.fill[source] or len(self.bins[b]) < 2:
                continue
            own = sorted(self.bins[b], key=lambda i: (int(self.sizes[i]), i))
            low, high = 0, len(own) - 1
            while low < high:                             # largest sum below amount, by two ends
                both = int(self.sizes[own[low]] + self.sizes[own[high]])
                if both >= amount:
                    high -= 1
                elif both < amount - room:
                    low += 1
                else:
                    return (own[low], own[high]), b
        return None

    def drain(self, source: int) -> bool:
        """Make the bin emptier while an exchange raises the squared fills; whether one did."""
        changed = False
        while self.bins[source]:
            own = sorted(self.bins[source], key=lambda i: (-int(self.sizes[i]), i))
            for given in [(i,) for i in own] + [(own[i], own[i + 1]) for i in range(len(own) - 1)]:
                amount = int(self.sizes[list(given)].sum())
                found = self.best(amount, source)
                if found:
                    self.shift(given, () if found[0] < 0 else (found[0],), source, found[1])
                    break
                two = self.pair_for(amount, source) if len(given) == 1 else None
                if two:
                    self.shift(given, two[0], source, two[1])
                    break
            else:
                return changed
            changed = True
        return changed

    def run(self, patience: int = PATIENCE) -> list[list[int]]:
        idle, changed = 0, True
        while changed and idle < patience and not self.lower_bound_met():
            changed = False
            for source in self.open[np.argsort(self.fill[self.open], kind="stable")].tolist():
                if idle >= patience:
                    break
                if not self.bins[source] or self.fill[source] == self.capacity:
                    continue
                changed |= self.drain(source)
                idle = idle + 1 if self.bins[source] else 0
            keep = (self.fill[self.open] < self.capacity) & (self.fill[self.open] > 0)
            self.open = self.open[keep]                    # full and empty bins take no further part
            self.items = self.items[np.isin(self.home[self.items], self.open)]
        return [sorted(b) for b in self.bins if b]

    def lower_bound_met(self) -> bool:
        return int((self.fill > 0).sum()) == math.ceil(int(self.fill.sum()) / self.capacity)


def pack(sizes: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    return Search(sizes, best_fit(sizes, capacity), capacity).run() if len(sizes) else []


def pack_documents(docs: DataFrame, vocab_path: str, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``."""
    cut = store(pieces(docs, vocab_path, capacity), "pieces")
    spark = docs.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    tasks = min(tasks, max(1, math.ceil(cut.count() / group)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        for frame in _groups(frames, group):
            lengths = frame["length"].to_numpy()
            sequence, offset = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
            for members in pack(lengths, capacity):
                sequence[members] = number
                offset[members] = np.cumsum(lengths[members]) - lengths[members]
                number += 1
            yield frame.assign(sequence_id=sequence, offset=offset)

    kind = cut.schema["doc_id"].dataType.simpleString()
    return cut.repartition(tasks).mapInPandas(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def _groups(frames: Iterable[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """The rows of a task in groups of at most ``size``."""
    kept: list[pd.DataFrame] = []
    for frame in frames:
        while len(frame):
            room = size - sum(map(len, kept))
            kept.append(frame.iloc[:room])
            frame = frame.iloc[room:]
            if sum(map(len, kept)) == size:
                yield pd.concat(kept, ignore_index=True)
                kept = []
    if kept:
        yield pd.concat(kept, ignore_index=True)
