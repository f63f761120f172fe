"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of shingles of five words (lower case). Documents with one set are a class, and classes
are compared. Bands of a MinHash signature put classes into buckets; buckets tie classes to components,
outside of which there are no candidates. A component is dealt out in blocks, pairs of blocks to tasks, so that
no task holds more than two blocks. In a task the signatures of a pair are compared a few values at a time,
and the pair is dropped once the posterior probability that its similarity reaches the threshold (uniform
prior) is below the tolerance. What remains is verified exactly on the shingle sets. A task returns per
class its number of links and one edge that holds its group together, never its pairs.

A document with fewer than five words is one shingle of all its words. Null and empty texts and texts without
words have no shingle, and rows without an id cannot be named: both get no link and their own id as class.
Rows repeated with id and text count as copies. An id that occurs with different texts ties their classes.
An empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import blake2b
from math import ceil, comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.codes import blocks, code_points, mix, prefix, run_hashes, span_hashes, word_spans
from riskflow.llm.components import connected_components
from riskflow.llm.tables import store, text_of


@dataclass(frozen=True)
class Join:
    """``bands`` of ``rows`` MinHash values; a pair of similarity 0.8 shares no band with probability 3e-5."""

    threshold: float = 0.8
    words: int = 5
    bands: int = 20
    rows: int = 4
    step: int = 16
    tolerance: float = 1e-6
    block: int = 400

    @property
    def values(self) -> int:
        return self.bands * self.rows


@cache
def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return rng.integers(1, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, np.uint64)


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """Sorted different shingle hashes of each text."""
    out: list[np.ndarray] = []
    for a, b in blocks(texts, 1 << 19):
        codes, edges = code_points([t.lower() for t in texts[a:b]])
        starts, ends = word_spans(codes, edges)
        hashes = span_hashes(prefix(codes), starts, ends)
        runs = run_hashes(hashes, words)
        cuts = np.searchsorted(starts, edges)
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            if j - i >= words:
                out.append(np.unique(runs[i:j - words + 1]))
            else:
                out.append(run_hashes(hashes[i:j], j - i) if j > i else np.zeros(0, np.uint64))
    return out


def min_hashes(sets: list[np.ndarray], n: int) -> np.ndarray:
    """Signatures of non-empty sets, one row each."""
    out = np.zeros((len(sets), n), np.uint32)
    if not sets:
        return out
    up, plus = _permutations(n)
    at = 0
    while at < len(sets):
        end, total = at, 0
        while end < len(sets) and (end == at or total + len(sets[end]) <= 200_000):
            total += len(sets[end])
            end += 1
        whole = np.concatenate(sets[at:end])
        starts = np.cumsum([0, *map(len, sets[at:end - 1])])
        for k in range(n):
            out[at:end, k] = np.minimum.reduceat(((whole * up[k] + plus[k]) >> np.uint64(32)).astype(np.uint32), starts)
        at = end
    return out


def set_key(shingles: np.ndarray) -> bytes | None:
    return blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def signatures(docs: DataFrame, join: Join) -> DataFrame:
    """``doc_id, key, signature, buckets`` per row; all but the id are null without shingles."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    salt = mix(np.arange(join.bands).astype(np.uint64) + np.uint64(77))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist(), join.words)
            keys = [set_key(s) for s in sets]
            full = [i for i, k in enumerate(keys) if k is not None]
            values = min_hashes([sets[i] for i in full], join.values)
            bands = values.reshape(len(full), join.bands, join.rows).astype(np.uint64)
            buckets = np.zeros((len(full), join.bands), np.uint64)
            for r in range(join.rows):
                buckets = mix(buckets + bands[:, :, r] + salt)
            signature, places = [None] * len(keys), [None] * len(keys)
            for n, i in enumerate(full):
                signature[i], places[i] = values[n].tobytes(), buckets[n].view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(signature, pa.binary()),
                                              pa.array(places, pa.list_(pa.int64()))], ["doc_id", "key", "signature", "buckets"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, f"doc_id {kind}, key binary, signature binary, buckets array<long>")


@cache
def least_matches(join: Join) -> dict[int, int]:
    """After n compared values the fewest matches with which a pair goes on.

    With a uniform prior, m matches of n give P(similarity >= t) = P(Binomial(n + 1, t) <= m).
    """
    found = {}
    for n in range(join.step, join.values + 1, join.step):
        below, m = 0.0, 0
        while below + (p := comb(n + 1, m) * join.threshold**m * (1 - join.threshold)**(n + 1 - m)) < join.tolerance:
            below, m = below + p, m + 1
        found[n] = m
    return found


def surviving_pairs(left: np.ndarray, right: np.ndarray, same: bool, join: Join) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of left, row of right) that pass all rounds of comparison."""
    if same:
        a, b = np.triu_indices(len(left), 1)
    else:
        a, b = (x.ravel() for x in np.indices((len(left), len(right))))
    matches = np.zeros(len(a), np.int32)
    for n, least in least_matches(join).items():
        done = n - join.step
        for k in range(done, n):
            matches += left[a, k] == right[b, k]
        go = matches >= least
        a, b, matches = a[go], b[go], matches[go]
    return a, b


def shared_counts(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact sizes of the intersections of the pairs, through products of incidence matrices when there are many pairs."""
    if len(a) < 4 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a, b, strict=True)], np.int64)
    whole, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(whole, return_inverse=True, return_counts=True)
    shared = times[column] > 1                             # a shingle of one set alone is in no intersection
    _, column = np.unique(column[shared], return_inverse=True)
    owner = owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    wide = 4096
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, wide):
        i, j = np.searchsorted(column, [start, start + wide])
        part = np.zeros((len(sets), wide), np.float32)
        part[owner[i:j], column[i:j] - start] = 1
        total += part @ part.T
    return total[a, b].astype(np.int64)


def join_blocks(rows: pd.DataFrame, join: Join) -> pd.DataFrame:
    """``rep, hub, links`` of one pair of blocks: weighted links of each linked class, and a class it hangs together with."""
    sets = shingle_sets(rows["text"].tolist(), join.words)
    mine = [set_key(s) == k for s, k in zip(sets, rows["key"], strict=True)]     # an id may have other texts, too
    rows = rows.assign(place=np.arange(len(rows)))[mine].drop_duplicates(["rep", "key"], ignore_index=True)
    sets = [sets[i] for i in rows["place"]]
    lo, hi = rows["lo"].iat[0], rows["hi"].iat[0]
    mine = np.flatnonzero(rows["own"] == lo)
    other = mine if lo == hi else np.flatnonzero(rows["own"] == hi)
    values = np.frombuffer(b"".join(rows["signature"]), np.uint32).reshape(len(rows), -1)
    a, b = surviving_pairs(values[mine], values[other], lo == hi, join)
    a, b = mine[a], other[b]
    size = np.array([len(s) for s in sets])
    shared = shared_counts(sets, a, b) if len(a) else np.zeros(0, np.int64)
    linked = shared >= join.threshold * (size[a] + size[b] - shared) - 1e-9
    a, b = a[linked], b[linked]

    copies = rows["copies"].to_numpy()
    links = np.bincount(a, copies[b], len(rows)) + np.bincount(b, copies[a], len(rows))
    reps, root = rows["rep"].to_numpy(), np.arange(len(rows))
    _, first, same = np.unique(reps, return_index=True, return_inverse=True)
    a, b = np.append(a, root), np.append(b, first[same])   # texts of one id are tied
    while True:                                            # smallest row number that a chain of links reaches
        before = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        root = root[root]
        if (root == before).all():
            break
    hit = np.flatnonzero(links > 0)
    return pd.DataFrame({"rep": reps[hit], "hub": reps[root[hit]], "links": links[hit].astype(np.int64)})


def near_duplicates(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """``doc_id, class_id, n_links`` per row: the smallest id of those that chains of links reach, and the number of rows linked to."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = store(signatures(docs, join), "signatures")
    named = signed.where("key IS NOT NULL AND doc_id IS NOT NULL")
    classes = store(named.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.any_value("signature").alias("signature"),
                                             F.any_value("buckets").alias("buckets")), "classes")

    # Each bucket ties its classes to the smallest of them.
    placed = classes.select("rep", F.explode("buckets").alias("bucket"))
    hubs = placed.groupBy("bucket").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    ties = placed.join(hubs, "bucket").where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()
    parts = store(connected_components(ties), "candidates")

    # Blocks of a component, and the rows of each pair of blocks.
    sizes = parts.groupBy("component").agg(F.ceil(F.count("*") / join.block).cast("int").alias("n_blocks"))
    members = (parts.join(sizes, "component").join(classes.drop("buckets"), F.col("node") == F.col("rep"))
               .join(docs.select(F.col("doc_id").alias("text_id"), text_of().alias("text")), F.col("text_id") == F.col("rep")))
    own = F.pmod(F.xxhash64("rep"), "n_blocks").cast("int")
    met = members.select("component", "n_blocks", "rep", "key", "copies", "signature", "text", own.alias("own"),
                         F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("with"))
    met = met.select("component", "n_blocks", F.least("own", "with").alias("lo"), F.greatest("own", "with").alias("hi"), "own",
                     "rep", "key", "copies", "signature", "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _groups(frames, ["component", "lo", "hi"]):
            if len(group) > 1:
                found = join_blocks(group, join)
                yield found.assign(component=group["component"].iat[0], whole=group["n_blocks"].iat[0] == 1)

    dealt = met.repartition("component", "lo", "hi").sortWithinPartitions("component", "lo", "hi")
    linked = store(dealt.mapInPandas(run, f"rep {kind}, hub {kind}, links long, component {kind}, whole boolean"), "links")

    # A component in one block is resolved there; those of several are put together from the blocks' edges.
    joined = connected_components(linked.where("NOT whole AND rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")))
    label = (linked.where("whole").groupBy("rep").agg(F.min("hub").alias("hub"))
             .unionByName(joined.select(F.col("node").alias("rep"), F.col("component").alias("hub"))))
    smallest = label.groupBy("hub").agg(F.min("rep").alias("class_id"))
    label = label.join(smallest, "hub").select("rep", "class_id")
    counts = linked.groupBy("rep").agg(F.sum("links").alias("links"))
    named_classes = classes.select("key", "rep", "copies").join(counts, "rep", "left").join(label, "rep", "left")
    # A class with very many copies is a skewed partition of this join, which adaptive execution splits.
    found = signed.select("doc_id", "key").join(named_classes, "key", "left")
    has_id = F.col("doc_id").isNotNull() & F.col("copies").isNotNull()
    return found.select("doc_id", F.when(has_id, F.coalesce("class_id", "rep")).otherwise(F.col("doc_id")).alias("class_id"),
                        F.when(has_id, F.col("copies") - 1 + F.coalesce("links", F.lit(0))).otherwise(F.lit(0)).alias("n_links"))


def _groups(frames: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Runs of rows with equal keys, also across batches."""
    kept: list[pd.DataFrame] = []
    for frame in frames:
        if frame.empty:
            continue
        cut = np.flatnonzero((frame[keys].to_numpy()[1:] != frame[keys].to_numpy()[:-1]).any(axis=1)) + 1
        pieces = [frame.iloc[a:b] for a, b in zip([0, *cut], [*cut, len(frame)], strict=True)]
        if kept and (kept[-1][keys].iloc[-1] != pieces[0][keys].iloc[0]).any():
            yield pd.concat(kept, ignore_index=True)
            kept = []
        kept.append(pieces[0])
        for piece in pieces[1:]:
            yield pd.concat(kept, ignore_index=True)
            kept = [piece]
    if kept:
        yield pd.concat(kept, ignore_index=True)


def one_of_each_group(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """``docs`` with the row of the smallest id of each group of linked documents; rows without an id stay."""
    gone = near_duplicates(docs, join).where("doc_id <> class_id").select(F.col("doc_id").alias("_gone")).distinct()
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    return row.join(gone, F.col("_row.doc_id") == F.col("_gone"), "left_anti").select("_row.*")
