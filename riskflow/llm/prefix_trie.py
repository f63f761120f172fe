"""The trie of conversation prefixes, as tables of nodes under a minimal perfect hash.

Conversations are rebuilt (``rebuild``), and each of their prefixes has a digest: the sums of four 32-bit parts of the
hashes of (place, turn), so that prefixes of a conversation of any length are summed in segments of ``segment`` turns. Equal digests are
one node; that depth, parent and last turn agree under a digest is verified, from the root on, or the job fails. A node belongs to its smallest member,
and what a conversation owns is the end of its path. So a shard with some conversations, a bounded number of segments, can add
up what they own along their whole paths: it enumerates its distinct digests, gives them slots by a minimal perfect hash (each lookup is
verified by the stored digest), scatters what is owned into flat arrays and adds them to the parents' slots, deepest first.
The sums of the shards add up to those of the trie. What later segments of a conversation own enters at the end of the segment before.

Turns are ordered by number (null first), then role and text; repeated rows are turns of their own. A null role or text is empty, rows
without a conversation id are left out. A conversation that is rebuilt without turns ends at the root. An empty table gives an empty result.
Only ``conv_id, turn, role, text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.codes import mix
from riskflow.llm.shares import join_groups
from riskflow.llm.tables import store, text_of

FAMILY, HEADS = 5, 9
SEGMENT, ROWS = 4096, 200_000
KEY, PARENT, LIMBS = ["k1", "k2"], ["p1", "p2"], ["s0", "s1", "s2", "s3"]


def parts_of(rows: DataFrame, size: int) -> int:
    return max(1, -(-rows.count() // size))


def numbered(chats: DataFrame, size: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """``conv_id, part, at, hash, n_bytes`` in the order of turns, and per conversation and part the first ``at`` and the rows before it.

    The table is sorted in ranges, which may begin and end inside a conversation.
    """
    rows = chats.where("conv_id IS NOT NULL").select("conv_id", F.col("turn").cast("long").alias("turn"), text_of("role").alias("role"), text_of().alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    ranged = rows.repartitionByRange(parts_of(chats, size), *order).sortWithinPartitions(*order)
    turn = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.lit("\n"), F.col("text"))
    placed = store(ranged.select("conv_id", F.monotonically_increasing_id().alias("id"), F.md5(turn).alias("hash"), F.octet_length("text").alias("n_bytes"))
                   .select("conv_id", F.shiftright("id", 33).alias("part"), F.col("id").alias("at"), "hash", F.col("n_bytes").cast("long").alias("n_bytes")), "turns")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = placed.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    return placed, store(spans.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "spans")


def rebuild(chats: DataFrame, size: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns ``conv_id, d, hash, n_bytes, last``, and conversations ``conv_id, n_turns``.

    The first h turns come from the conversation at the start of the family of five, the others are one's own after h.
    """
    placed, spans = numbered(chats, size)
    convs = spans.groupBy("conv_id").agg(F.sum("n").alias("n"))
    convs = convs.withColumns({"base": F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY)), "h": F.crc32(F.col("conv_id").cast("string")) % HEADS})
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(bases, "base", "left").withColumn("k", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = store(convs.withColumn("n_turns", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).select("conv_id", "base", "h", "k", "n_turns"), "convs")

    where = spans.drop("n").join(convs, "conv_id")
    turns = placed.join(where, ["conv_id", "part"]).withColumn("d", F.col("at") - F.col("first") + F.col("before") + 1)
    own = turns.where("d > h").select("conv_id", (F.col("k") + F.col("d") - F.col("h")).alias("d"), "hash", "n_bytes", "n_turns")
    heads = turns.where(f"d < {HEADS} AND conv_id % {FAMILY} = 0").select(F.col("conv_id").alias("base"), "d", "hash", "n_bytes")
    heads = heads.join(convs, "base").where("d <= k").select("conv_id", "d", "hash", "n_bytes", "n_turns")
    return own.unionByName(heads).withColumn("last", F.col("d") == F.col("n_turns")).drop("n_turns"), convs.select("conv_id", "n_turns")


def digest(sums: list[Column]) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(1), *sums), F.xxhash64(F.lit(2), *reversed(sums))


def root_key() -> list[Column]:
    return [c.alias(k) for c, k in zip(digest([F.lit(0).cast("long")] * 4), KEY, strict=True)]


def prefixes(turns: DataFrame, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """``conv_id, seg, d``, the digest of the prefix and of its parent, ``turn, n_bytes, last``; and the segments ``conv_id, seg``."""
    placed = F.md5(F.concat(F.col("d").cast("string"), F.lit(":"), F.col("hash")))
    parts = [F.conv(F.substring(placed, 8 * i + 1, 8), 16, 10).cast("long").alias(f"t{i}") for i in range(4)]
    rows = turns.select("conv_id", F.floor((F.col("d") - 1) / segment).alias("seg"), "d", F.xxhash64("hash").alias("turn"), "n_bytes", "last", *parts)
    running = Window.partitionBy("conv_id", "seg").orderBy("d")
    rows = store(rows.select("*", *[F.sum(f"t{i}").over(running).alias(s) for i, s in enumerate(LIMBS)]), "segments")
    earlier = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    segs = rows.groupBy("conv_id", "seg").agg(*[F.max(s).alias(s) for s in LIMBS])
    carried = store(segs.select("conv_id", "seg", *[F.sum(s).over(earlier).alias(f"c{s}") for s in LIMBS]), "carried")
    rows = rows.join(carried.where("seg > 0"), ["conv_id", "seg"], "left")
    sums = [F.col(s) + F.coalesce(f"c{s}", F.lit(0)) for s in LIMBS]
    above = [s - F.col(f"t{i}") for i, s in enumerate(sums)]
    keys = [c.alias(k) for c, k in zip((*digest(sums), *digest(above)), KEY + PARENT, strict=True)]
    return store(rows.select("conv_id", "seg", "d", *keys, "turn", "n_bytes", "last"), "prefixes"), carried.select("conv_id", "seg")


def node_table(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per digest: smallest member, depth, parent's digest, members, members that end here, bytes of the last turn."""
    same = ["d", *PARENT, "turn", "n_bytes"]
    found = paths.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if("last").alias("n_ends"),
                                    *[f(c).alias(f"{n}_{c}") for c in same for n, f in (("min", F.min), ("max", F.max))])
    clash = F.expr(" OR ".join(f"min_{c} <> max_{c}" for c in same))
    conv = F.when(clash, F.raise_error(F.lit("two prefixes have one digest"))).otherwise(F.col("conv_id"))
    inner = found.select(*KEY, conv.alias("conv_id"), F.col("min_d").alias("depth"), *[F.col(f"min_{p}").alias(p) for p in PARENT],
                         "n_convs", "n_ends", F.col("min_n_bytes").alias("n_bytes"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if(F.col("n_turns") == 0).alias("n_ends")).where("n_convs > 0")
    none = F.lit(None).cast("long")
    root = root.select(*root_key(), "conv_id", F.lit(0).cast("long").alias("depth"), *[none.alias(p) for p in PARENT], "n_convs", "n_ends", F.lit(0).cast("long").alias("n_bytes"))
    return store(inner.unionByName(root), "nodes")


class SlotTable:
    """Minimal perfect hash of distinct 128-bit keys: at each level keys alone at their place stay, the others go on to the next."""

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, base = keys, 0
        while len(left):
            at = self._place(left, len(self.levels), size := len(left) * 3 // 2 + 1)
            alone = np.bincount(at, minlength=size) == 1
            rank = base + np.cumsum(alone) - 1
            self.levels.append((alone, rank))
            base += int(alone.sum())
            left = left[~alone[at]]
        self.keys = np.zeros_like(keys)
        self.keys[self._find(keys)] = keys

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys[:, 0] + mix(keys[:, 1] + np.uint64(level))) % np.uint64(size)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        slot, open_ = np.full(len(keys), -1), np.arange(len(keys))
        for level, (alone, rank) in enumerate(self.levels):
            at = self._place(keys[open_], level, len(alone))
            hit = alone[at]
            slot[open_[hit]] = rank[at[hit]]
            open_ = open_[~hit]
        return slot

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; a key that is not in the table is an error."""
        slot = self._find(keys)
        if (slot < 0).any() or (self.keys[slot] != keys).any():
            raise KeyError("a digest has no slot")
        return slot


def distinct(keys: np.ndarray) -> np.ndarray:
    keys = keys[np.lexsort((keys[:, 1], keys[:, 0]))]
    return keys[np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]]


def shard_sums(rows: dict[str, np.ndarray], segment: int) -> tuple[np.ndarray, np.ndarray]:
    """Digests of a shard and per digest (leaves, saved, children) from what its conversations own."""
    keys, parents = (np.stack([rows[a], rows[b]], 1).view(np.uint64) for a, b in (KEY, PARENT))
    table = SlotTable(distinct(np.concatenate([keys, parents])))
    slot, above = table.slots(keys), table.slots(parents)
    n = len(table.keys)
    parent, depth, sums = np.full(n, -1), np.zeros(n, np.int64), np.zeros((3, n), np.int64)
    depth[slot] = rows["d"]
    # The parent of a segment's first turn is in the segment before, where the sum of what comes later is brought in.
    inside = (rows["d"] == 1) | ((rows["d"] - 1) % segment != 0)
    parent[slot[inside]] = above[inside]
    np.add.at(sums[0], slot, rows["leaf"] + rows["later_leaf"])
    np.add.at(sums[1], slot, rows["saved"] + rows["later_saved"])
    np.add.at(sums[2], above, rows["own"])
    order = np.argsort(-depth, kind="stable")
    order = order[parent[order] >= 0]
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        for s in sums[:2]:
            np.add.at(s, parent[level], s[level])
    some = sums.any(axis=0)
    return table.keys[some], sums[:, some]


def subtree_sums(paths: DataFrame, segs: DataFrame, nodes: DataFrame, segment: int = SEGMENT, size: int = ROWS) -> DataFrame:
    """``k1, k2, leaves, saved, children`` of the nodes that have any."""
    owned = nodes.where("depth > 0").select("conv_id", F.col("depth").alias("d"), F.lit(1).cast("long").alias("own"), (F.col("n_convs") == F.col("n_ends")).cast("long").alias("leaf"),
                                            ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"))
    of_seg = owned.groupBy("conv_id", F.floor((F.col("d") - 1) / segment).alias("seg")).agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    later = Window.partitionBy("conv_id").orderBy(F.desc("seg")).rowsBetween(Window.unboundedPreceding, -1)
    carried = segs.join(of_seg, ["conv_id", "seg"], "left").select(
        "conv_id", ((F.col("seg") + 1) * segment).alias("d"), *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"later_{c}") for c in ("leaf", "saved")])
    carried = carried.where("later_leaf <> 0 OR later_saved <> 0")
    numbers = ["own", "leaf", "saved", "later_leaf", "later_saved"]
    rows = paths.select("conv_id", "seg", "d", *KEY, *PARENT).join(owned, ["conv_id", "d"], "left").join(carried, ["conv_id", "d"], "left")
    rows = rows.select("conv_id", "seg", "d", *KEY, *PARENT, *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers])
    names = [*KEY, "leaves", "saved", "children"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            whole = pa.Table.from_batches(held)
            keys, sums = shard_sums({c: whole.column(c).to_numpy() for c in ("d", *KEY, *PARENT, *numbers)}, segment)
            yield pa.RecordBatch.from_arrays([*map(pa.array, keys.view(np.int64).T), *map(pa.array, sums)], names)

    family = F.xxhash64(F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY)), "seg")
    dealt = rows.withColumn("shard", family).repartition(parts_of(paths, size), "shard").drop("conv_id", "seg", "shard")
    return dealt.mapInArrow(run, ", ".join(f"{c} long" for c in names)).groupBy(*KEY).agg(*[F.sum(c).alias(c) for c in names[2:]])


def end_digests(ends: DataFrame, size: int = ROWS) -> DataFrame:
    """``k1, k2, ends_sha256``: SHA-256 of the ascending ids of each node, joined in pieces by ranges and hashed as a stream."""
    order = [*KEY, "conv_id"]

    def runs(batches: Iterable[pa.RecordBatch], value: str) -> Iterator[tuple[tuple, list]]:
        for batch in batches:
            k1, k2, values = (batch.column(c).to_pylist() for c in (*KEY, value))
            first = 0
            for i in range(1, len(k1) + 1):
                if i == len(k1) or k1[i] != k1[first] or k2[i] != k2[first]:
                    yield (k1[first], k2[first]), values[first:i]
                    first = i

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(*key, ids[0], ",".join(map(str, ids))) for key, ids in runs([batch], "conv_id")]
            if rows:
                yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*rows, strict=True))], [*order, "ids"])

    def hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, last, done = None, None, []
        for key, texts in runs(batches, "ids"):
            if key == last:
                state.update(b",")
            else:
                if state is not None:
                    done.append((*last, state.hexdigest()))
                state, last = sha256(), key
            state.update(",".join(texts).encode())
            if len(done) >= 10_000:
                yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*done, strict=True))], [*KEY, "ends_sha256"])
                done = []
        if state is not None:
            done.append((*last, state.hexdigest()))
            yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*done, strict=True))], [*KEY, "ends_sha256"])

    ranged = ends.repartitionByRange(parts_of(ends, size), *order).sortWithinPartitions(*order)
    kind = ends.schema["conv_id"].dataType.simpleString()
    joined = ranged.mapInArrow(pieces, f"k1 long, k2 long, conv_id {kind}, ids string")
    return joined.repartition(*KEY).sortWithinPartitions(*order).mapInArrow(hashes, "k1 long, k2 long, ends_sha256 string")


def prefix_trie(chats: DataFrame, segment: int = SEGMENT, size: int = ROWS) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` per node, named by smallest member and depth."""
    turns, convs = rebuild(chats, size)
    paths, segs = prefixes(turns, segment)
    nodes = node_table(paths, convs)
    sums = subtree_sums(paths, segs, nodes, segment, size)
    ends = paths.where("last").select(*KEY, "conv_id").unionByName(convs.where("n_turns = 0").select(*root_key(), "conv_id"))
    whole = nodes.join(sums, KEY, "left").join(end_digests(ends, size), KEY, "left")
    leaf_root = ((F.col("depth") == 0) & (F.col("n_convs") == F.col("n_ends"))).cast("long")
    whole = store(whole.select(*KEY, *PARENT, "conv_id", "depth", "n_convs", F.coalesce("children", F.lit(0)).alias("n_children"),
                               (F.coalesce("leaves", F.lit(0)) + leaf_root).alias("n_leaves"), F.coalesce("saved", F.lit(0)).alias("saved_tokens"),
                               F.coalesce("ends_sha256", F.lit(sha256().hexdigest())).alias("ends_sha256")), "whole")
    parents = whole.where("n_children > 0").select(*[F.col(k).alias(p) for k, p in zip(KEY, PARENT, strict=True)], F.col("conv_id").alias("parent_conv_id"), "n_children")
    found = join_groups(whole.withColumnRenamed("n_children", "own_children").drop(*KEY), parents, PARENT, "n_children", "conv_id", "left")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", F.col("own_children").alias("n_children"), "n_leaves", "saved_tokens", "ends_sha256")
