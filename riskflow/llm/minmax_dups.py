"""Near duplicates by min-max hashing.

A document is the set of its different shingles of ``words`` words (A-Z in lower case). Documents with one set are a class.
Each permutation gives two values of a set, its minimum and its maximum, so a signature takes half the evaluations of as many minima,
and as the two places of a set are drawn without putting back, the share of equal values varies less around the similarity.
A band is both values of ``rows`` permutations. Equal bands tie classes to the smallest class of the bucket, ties to candidate
components. A component is dealt out in blocks of bounded number and weight, pairs of blocks to tasks, and all pairs of two blocks
are confirmed on their full sets: ``100 * |A and B| >= percent * |A or B|``. A task returns one edge per linked class, never its pairs.

A text with fewer words than a shingle is one shingle of all its words. Null and empty texts and texts without words have no
shingle, link with nothing and are their own component. Rows without an id can't be named by others: they link with nothing and have a null
component. Repeated rows, and rows that share an id, are documents of their own. An empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.codes import code_points, mix, prefix, run_hashes, runs, span_hashes, text_blocks, word_spans
from riskflow.llm.components import connected_components
from riskflow.llm.near_dups import shared_counts
from riskflow.llm.shares import join_groups
from riskflow.llm.tables import store, text_of


@dataclass(frozen=True)
class MinMax:
    """Two sets of similarity 0.8 share no band with probability 5e-7, ones of five shingles with 1e-5."""

    percent: int = 80
    words: int = 4
    bands: int = 48
    rows: int = 3
    block: int = 400
    weight: int = 400_000


@cache
def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(11)
    return rng.integers(1, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, np.uint64)


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """Sorted different shingle hashes of each text."""
    codes, edges = code_points(texts)
    codes = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
    starts, ends = word_spans(codes, edges)
    hashes = span_hashes(prefix(codes), starts, ends)
    shingles, cuts = run_hashes(hashes, words), np.searchsorted(starts, edges)
    out = []
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        out.append(np.unique(shingles[i:j - words + 1]) if j - i >= words else run_hashes(hashes[i:j], j - i) if j > i else np.zeros(0, np.uint64))
    return out


def min_max(sets: list[np.ndarray], n: int) -> np.ndarray:
    """Minimum and maximum of each non-empty set under ``n`` permutations, as (set, permutation, 2)."""
    out = np.zeros((len(sets), n, 2), np.uint32)
    up, plus = _permutations(n)
    for a, b in runs(map(len, sets), 200_000):
        whole, starts = np.concatenate(sets[a:b]), np.cumsum([0, *map(len, sets[a:b - 1])])
        for k in range(n):
            values = ((whole * up[k] + plus[k]) >> np.uint64(32)).astype(np.uint32)
            out[a:b, k, 0] = np.minimum.reduceat(values, starts)
            out[a:b, k, 1] = np.maximum.reduceat(values, starts)
    return out


def similarity(left: np.ndarray, right: np.ndarray) -> float:
    """Estimate from two signatures: the share of equal values, minima and maxima alike."""
    return float((left == right).mean())


def band_buckets(values: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit bucket per set and band."""
    parts = values.reshape(len(values), bands, -1).astype(np.uint64)
    out = np.broadcast_to(mix(np.arange(bands).astype(np.uint64) + np.uint64(1)), (len(values), bands)).copy()
    for k in range(parts.shape[2]):
        out = mix(out + parts[:, :, k])
    return out.view(np.int64)


def set_key(shingles: np.ndarray) -> bytes | None:
    return blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def signatures(docs: DataFrame, rule: MinMax) -> DataFrame:
    """``doc_id, text_key, key, n_shingles, buckets`` per row; key and buckets are null without shingles."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "text_key", "key", "n_shingles", "buckets"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_blocks(batch.column("text"), 1 << 19):
                sets = shingle_sets(texts, rule.words)
                full = [i for i, s in enumerate(sets) if len(s)]
                places: list[np.ndarray | None] = [None] * len(sets)
                for i, row in zip(full, band_buckets(min_max([sets[i] for i in full], rule.bands * rule.rows), rule.bands), strict=True):
                    places[i] = row
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, b - a), batch.column("text_key").slice(a, b - a), pa.array([set_key(s) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array(places, pa.list_(pa.int64()))], names)

    read = docs.select("doc_id", F.xxhash64(text_of()).alias("text_key"), text_of().alias("text"))
    return read.mapInArrow(run, f"doc_id {kind}, text_key long, key binary, n_shingles long, buckets array<long>")


def candidates(classes: DataFrame) -> DataFrame:
    """``node, component``: the classes that buckets tie together, directly or through others."""
    placed = classes.select("cls", F.explode("buckets").alias("bucket"))
    hubs = store(placed.groupBy("bucket").agg(F.min("cls").alias("hub"), F.count("*").alias("n")).where("n > 1"), "buckets")
    tied = join_groups(placed, hubs, "bucket", "n", "cls").where("cls <> hub")
    return store(connected_components(tied.select(F.col("cls").alias("a"), F.col("hub").alias("b"))), "candidates")


def link_block(rows: pd.DataFrame, sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked classes of one pair of blocks, and for each the smallest class that links within the pair reach."""
    own, size = rows["own"].to_numpy(), np.array([len(s) for s in sets])
    lo, hi = rows["lo"].iat[0], rows["hi"].iat[0]
    mine = np.flatnonzero(own == lo)
    if lo == hi:
        a, b = (mine[x] for x in np.triu_indices(len(mine), 1))
    else:
        a, b = (x.ravel() for x in np.meshgrid(mine, np.flatnonzero(own == hi)))
    near = 100 * np.minimum(size[a], size[b]) >= percent * np.maximum(size[a], size[b])
    a, b = a[near], b[near]
    shared = shared_counts(sets, a, b) if len(a) else np.zeros(0, np.int64)
    linked = 100 * shared >= percent * (size[a] + size[b] - shared)
    a, b = a[linked], b[linked]
    root = np.arange(len(rows))
    while True:
        before = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        root = root[root]
        if (root == before).all():
            break
    hit = np.unique(np.concatenate([a, b]))
    cls = rows["cls"].to_numpy()
    return cls[hit], cls[root[hit]]


def whole_groups(frames: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The sorted rows of a task in frames that cut no group."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if frame.empty:
            continue
        values = frame[keys].to_numpy()
        cut = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        if held and (held[-1][keys].to_numpy()[-1] != values[0]).any():
            yield pd.concat(held, ignore_index=True)
            held = []
        if len(cut):
            yield pd.concat([*held, frame.iloc[:cut[-1]]], ignore_index=True)
            held = [frame.iloc[cut[-1]:]]
        else:
            held.append(frame)
    if held:
        yield pd.concat(held, ignore_index=True)


def links(docs: DataFrame, classes: DataFrame, parts: DataFrame, rule: MinMax) -> DataFrame:
    """``cls, hub, component, whole``: one edge per linked class and pair of blocks; ``whole`` marks components of one block."""
    named = parts.join(classes.select("cls", "rep", "text_key", "n_shingles"), F.col("node") == F.col("cls"))
    amount = F.greatest(F.count("*") / rule.block, F.sum("n_shingles") / rule.weight)
    blocks = named.groupBy("component").agg(F.ceil(amount).cast("int").alias("n_blocks"))
    texts = docs.select(F.col("doc_id").alias("rep"), F.xxhash64(text_of()).alias("text_key"), text_of().alias("text"))
    own = F.pmod(F.xxhash64("cls"), "n_blocks").cast("int")
    met = named.join(blocks, "component").join(texts, ["rep", "text_key"]).select(
        "component", "n_blocks", "cls", "text", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("with"))
    met = met.select("component", "n_blocks", F.least("own", "with").alias("lo"), F.greatest("own", "with").alias("hi"), "own", "cls", "text")
    keys = ["component", "lo", "hi"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, keys):
            frame = frame.drop_duplicates([*keys, "cls"], ignore_index=True)          # rows repeated with id and text
            starts = np.flatnonzero(np.r_[True, (frame[keys].to_numpy()[1:] != frame[keys].to_numpy()[:-1]).any(axis=1)])
            edges = np.append(starts, len(frame))
            sizes = np.add.reduceat(frame["text"].str.len().to_numpy(), starts)
            for i, j in runs(sizes, 1 << 20):
                sets = shingle_sets(frame["text"].iloc[edges[i]:edges[j]].tolist(), rule.words)
                for k in range(i, j):
                    group = frame.iloc[edges[k]:edges[k + 1]]
                    if len(group) > 1:
                        cls, hub = link_block(group, sets[edges[k] - edges[i]:edges[k + 1] - edges[i]], rule.percent)
                        yield pd.DataFrame({"cls": cls, "hub": hub, "component": group["component"].iat[0], "whole": group["n_blocks"].iat[0] == 1})

    dealt = met.repartition(*keys).sortWithinPartitions(*keys)
    return store(dealt.mapInPandas(run, "cls long, hub long, component long, whole boolean"), "links")


def near_duplicates(docs: DataFrame, rule: MinMax = MinMax()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row: the size of its set, the smallest id that links reach, and whether it is its own."""
    signed = store(signatures(docs, rule), "signatures")
    named = signed.where("key IS NOT NULL AND doc_id IS NOT NULL")
    classes = named.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"),
                                       F.min_by(F.struct("text_key", "n_shingles", "buckets"), "doc_id").alias("of"))
    # The numbers are fixed by writing the table.
    classes = store(classes.select(F.monotonically_increasing_id().alias("cls"), "key", "rep", "copies", "of.*"), "classes")
    linked = links(docs, classes, candidates(classes), rule)

    # A component of one block is resolved there; those of several are put together from the edges of their blocks.
    several = connected_components(linked.where("NOT whole AND cls <> hub").select(F.col("cls").alias("a"), F.col("hub").alias("b")))
    label = linked.where("whole").select("cls", "hub").unionByName(several.select(F.col("node").alias("cls"), F.col("component").alias("hub")))
    label = store(label.join(classes.select("cls", "rep"), "cls"), "labels")
    least = label.groupBy("hub").agg(F.min("rep").alias("least"), F.count("*").alias("n"))
    reached = join_groups(label, store(least, "components"), "hub", "n", "cls").select("cls", "least")
    groups = store(classes.select("cls", "key", "rep", "copies").join(reached, "cls", "left")
                   .select("key", "copies", F.coalesce("least", "rep").alias("reached")), "groups")
    found = join_groups(signed.select("doc_id", "key", "n_shingles"), groups, "key", "copies", "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("reached", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
