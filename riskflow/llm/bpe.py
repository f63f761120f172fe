"""Byte-level BPE: pieces to ids through a minimal acyclic transducer, exact merges for the rest, and back.

The pieces of the corpus are counted by Spark; the most frequent ones, a bounded number, are compiled with
their ids into a minimal acyclic automaton (shared prefixes and suffixes). Each transition carries the
number of words that sort before those behind it, so a walk adds up to the word's number, which points into
one array of ids. The file lies in the shared folder, Spark hands it to the executors, and workers map
it into memory. Pieces that the automaton does not accept are merged by the vocabulary's own rules. A
bounded table per worker keeps pieces already looked up.

Null and empty texts have no ids and decode to the empty text. Strings of the vocabulary's added tokens
in a text become these tokens, as the public library does by default. Rows are encoded one by one, so
repeated rows and ids give equal rows. An empty table gives an empty result and an empty automaton.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import cache, cached_property, lru_cache
from itertools import chain
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm.codes import code_points, runs, text_blocks
from riskflow.llm.pretokens import distinct_pieces, piece_starts
from riskflow.llm.tables import store, text_of
from riskflow.session import scratch_dir

#: Words in the automaton, pieces that a worker remembers, and ids that are decoded at a time.
LEXICON, REMEMBERED, DECODED = 50_000, 350_000, 500_000


def byte_signs() -> list[str]:
    """The sign that stands for each byte in byte-level vocabularies: printable bytes themselves, others from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Tokens by id, and the merge rules, which are loaded when a piece is first merged."""

    def __init__(self, path: str) -> None:
        self.path = path
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        signs = byte_signs()
        byte = {s: b for b, s in enumerate(signs)}
        self.signs = {b: s for b, s in enumerate(signs)}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*spec["model"]["vocab"].values(), *self.added.values()]) + 1
        self.bytes = [b""] * size
        for token, i in spec["model"]["vocab"].items():
            if token not in self.added:
                self.bytes[i] = bytes(byte[c] for c in token)
        for token, i in self.added.items():
            self.bytes[i] = token.encode()
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None

    @cached_property
    def model(self) -> Any:
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path).model

    def merge(self, piece: str) -> list[int]:
        """Ids of one piece by the merge rules."""
        spelt = piece.encode("utf-8", "replace").decode("latin-1").translate(self.signs)
        return [t.id for t in self.model.tokenize(spelt)]


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Automaton:
    """A walk over arrays: states' first transitions, and per transition its byte, target and number to add."""

    PARTS = ("first", "labels", "targets", "adds", "final", "id_start", "ids")

    def __init__(self, parts: dict[str, np.ndarray]) -> None:
        self.parts = parts
        self.steps: dict[int, dict[int, tuple[int, int]]] = {}

    @classmethod
    def compile(cls, words: dict[bytes, list[int]]) -> Automaton:
        """Words are added in order; a state is shared as soon as no later word can change it."""
        order = sorted(words)
        arcs: list[dict[int, int]] = [{}]
        final = [False]
        register: dict[tuple, int] = {}
        path = [0]                                                    # states of the last word, from the root

        def share(down_to: int, last: bytes) -> None:
            while len(path) > down_to + 1:
                state = path.pop()
                key = (final[state], *arcs[state].items())
                arcs[path[-1]][last[len(path) - 1]] = register.setdefault(key, state)

        last = b""
        for word in order:
            common = next((i for i, (a, b) in enumerate(zip(word, last, strict=False)) if a != b), min(len(word), len(last)))
            share(common, last)
            for b in word[common:]:
                arcs.append({})
                final.append(False)
                arcs[path[-1]][b] = len(arcs) - 1
                path.append(len(arcs) - 1)
            final[path[-1]] = True
            last = word
        share(0, last)

        number, below, todo = {0: 0}, {}, [0]                         # states still in use, and words behind each
        while todo:
            state = todo[-1]
            missing = [t for t in arcs[state].values() if t not in below]
            if missing:
                todo += missing
                continue
            todo.pop()
            below[state] = final[state] + sum(below[t] for t in arcs[state].values())
            number.setdefault(state, len(number))
        states = sorted(number, key=number.get)
        first, labels, targets, adds = [0], [], [], []
        for state in states:
            before = int(final[state])
            for label, target in sorted(arcs[state].items()):
                labels.append(label)
                targets.append(number[target])
                adds.append(before)
                before += below[target]
            first.append(len(labels))
        ids = [words[w] for w in order]
        parts = {"first": first, "labels": labels, "targets": targets, "adds": adds, "final": [final[s] for s in states],
                 "id_start": np.cumsum([0, *map(len, ids)]), "ids": [i for x in ids for i in x]}
        return cls({k: np.asarray(v, np.int32) for k, v in parts.items()})

    def to_bytes(self) -> bytes:
        sizes = np.array([len(self.parts[k]) for k in self.PARTS], np.int32)
        return b"".join([sizes.tobytes(), *(np.ascontiguousarray(self.parts[k], np.int32).tobytes() for k in self.PARTS)])

    @classmethod
    def mapped(cls, path: str) -> Automaton:
        whole = np.memmap(path, np.int32, "r")
        cuts = np.cumsum([len(cls.PARTS), *whole[:len(cls.PARTS)]])
        return cls({k: whole[a:b] for k, a, b in zip(cls.PARTS, cuts[:-1], cuts[1:], strict=True)})

    def _step(self, state: int) -> dict[int, tuple[int, int]]:
        """Transitions of a state, read from the mapped file when it is first visited."""
        a, b = (int(x) for x in self.parts["first"][state:state + 2])
        labels, targets, adds = (self.parts[k][a:b].tolist() for k in ("labels", "targets", "adds"))
        self.steps[state] = found = dict(zip(labels, zip(targets, adds, strict=True), strict=True))
        return found

    def ids(self, word: bytes) -> list[int] | None:
        """Ids of an accepted word, else None."""
        state, number = 0, 0
        steps = self.steps
        for byte in word:
            step = (steps[state] if state in steps else self._step(state)).get(byte)
            if step is None:
                return None
            state, number = step[0], number + step[1]
        p = self.parts
        return p["ids"][p["id_start"][number]:p["id_start"][number + 1]].tolist() if p["final"][state] else None


class Encoder(dict):
    """Piece to its slot; slots point into one growing array of ids."""

    def __init__(self, vocab: Vocabulary, lexicon: Automaton | None) -> None:
        super().__init__()
        self.vocab, self.lexicon = vocab, lexicon
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.flat = np.zeros(0, np.int32)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.new: list[list[int]] = []
        self.slots = 0

    def __missing__(self, piece: str) -> int:
        ids = self.lexicon.ids(piece.encode("utf-8", "replace")) if self.lexicon is not None else None
        self.new.append(self.vocab.merge(piece) if ids is None else ids)
        self[piece] = slot = self.slots
        self.slots += 1
        return slot

    def settle(self) -> None:
        if self.new:
            sizes = np.fromiter(map(len, self.new), np.int64, len(self.new))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(self.new), np.int32, sizes.sum())])
            self.new = []

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the bounds of each text in it."""
        if self.slots > REMEMBERED:
            self.forget()
        parts, owners, special = texts, None, {}
        if self.vocab.split is not None and any(t in x for t in self.vocab.added for x in texts):
            parts, owners = [], []
            for i, text in enumerate(texts):
                for j, part in enumerate(self.vocab.split.split(text)):
                    if j % 2:
                        special[len(parts)] = self.vocab.added[part]
                    parts.append("" if j % 2 else part)
                    owners.append(i)
        whole, (codes, edges) = "".join(parts), code_points(parts)
        starts = piece_starts(codes, edges)
        pieces, kind = distinct_pieces(whole, codes, starts)
        slots = np.fromiter(map(self.__getitem__, pieces), np.int64, len(pieces))[kind]
        self.settle()
        sizes = self.sizes[slots]
        done = np.append(0, np.cumsum(sizes))
        ids = self.flat[np.repeat(self.starts[slots] - done[:-1], sizes) + np.arange(done[-1])] if len(slots) else np.zeros(0, np.int32)
        bounds = done[np.searchsorted(starts, edges)]
        if owners is None:
            return ids, bounds
        at = np.array(sorted(special), np.int64)
        ids = np.insert(ids, bounds[at], [special[i] for i in at])
        grown = np.diff(bounds)
        grown[at] = 1
        per_text = np.bincount(owners, grown, len(texts)).astype(np.int64)
        return ids, np.append(0, np.cumsum(per_text))


@lru_cache(1)                                                        # another lexicon's table of pieces makes room first
def worker_encoder(vocab_path: str, lexicon_file: str | None) -> Encoder:
    return Encoder(vocabulary(vocab_path), Automaton.mapped(SparkFiles.get(lexicon_file)) if lexicon_file else None)


def piece_counts(docs: DataFrame) -> DataFrame:
    """``piece, n`` over all texts."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, texts in text_blocks(batch.column(0), 1 << 20):
                whole, (codes, edges) = "".join(texts), code_points(texts)
                pieces, kind = distinct_pieces(whole, codes, piece_starts(codes, edges))
                # longer pieces are not worth a place in the automaton
                found = [(p, n) for p, n in zip(pieces, np.bincount(kind, minlength=len(pieces)).tolist(), strict=True) if len(p) <= 64]
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], ["piece", "n"])

    return (docs.select(text_of().alias("text")).mapInArrow(run, "piece string, n long")
            .groupBy("piece").agg(F.sum("n").alias("n")))


def build_lexicon(docs: DataFrame, vocab_path: str, size: int = LEXICON) -> str:
    """Compile the most frequent pieces, at most ``size``, and hand the file to the executors; gives its name there.

    Pieces of one frequency are all in or all out, so the choice is the same in every run.
    """
    spark = docs.sparkSession
    counts = store(piece_counts(docs), "piece-counts")
    least, room = 1, size
    for row in counts.groupBy("n").agg(F.count("*").alias("pieces")).orderBy(F.desc("n")).toLocalIterator():
        room -= row.pieces
        if room < 0:
            least = row.n + 1
            break
    frequent = counts.where(F.col("n") >= least).collect()          # at most size pieces of 64 characters
    vocab = vocabulary(vocab_path)
    automaton = Automaton.compile({r.piece.encode("utf-8", "replace"): vocab.merge(r.piece) for r in frequent})
    return share_file(spark, automaton.to_bytes())


def share_file(spark: SparkSession, content: bytes) -> str:
    uri = scratch_dir(spark, "lexicon") + ".bin"
    fs, path = pyarrow.fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(path, compression=None) as out:
        out.write(content)
    spark.sparkContext.addFile(uri)
    return uri.rpartition("/")[2]


@cache
def token_bytes(vocab_path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and start of each token's bytes, and the bytes of all."""
    tokens = vocabulary(vocab_path).bytes
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    return sizes, np.cumsum(sizes) - sizes, np.frombuffer(b"".join(tokens), np.uint8)


def texts_of(ids: np.ndarray, bounds: np.ndarray, vocab_path: str) -> pa.Array:
    """The texts of the ids between the bounds."""
    sizes, starts, flat = token_bytes(vocab_path)
    grown = np.append(0, np.cumsum(sizes[ids]))
    own = flat[np.repeat(starts[ids] - grown[:-1], sizes[ids]) + np.arange(grown[-1])]
    ends = grown[bounds].tolist()
    return pa.array([own[i:j].tobytes().decode("utf-8", "replace") for i, j in zip(ends[:-1], ends[1:], strict=True)], pa.string())


def encoded(batch: pa.RecordBatch, encoder: Encoder) -> Iterator[tuple[list[pa.Array], np.ndarray, np.ndarray]]:
    """Per block of texts its ``doc_id`` and ``ids``, the ids in one array and the bounds of each text in it."""
    for a, b, texts in text_blocks(batch.column("text"), 1 << 19):
        ids, bounds = encoder.encode(texts)
        yield [batch.column("doc_id").slice(a, b - a), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))], ids, bounds


def encode(docs: DataFrame, vocab_path: str, lexicon_file: str | None = None) -> DataFrame:
    """``doc_id, ids`` of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(vocab_path, lexicon_file)
        for batch in batches:
            for columns, _, _ in encoded(batch, encoder):
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def round_trip(docs: DataFrame, vocab_path: str, lexicon_file: str | None = None) -> DataFrame:
    """``doc_id, ids, text``: as ``decode`` of ``encode``, in one step, since each Python step of a stage has workers of its own."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(vocab_path, lexicon_file)
        for batch in batches:
            for columns, ids, bounds in encoded(batch, encoder):
                yield pa.RecordBatch.from_arrays([*columns, texts_of(ids, bounds, vocab_path)], ["doc_id", "ids", "text"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")


def decode(encoded: DataFrame, vocab_path: str) -> DataFrame:
    """``doc_id, ids, text``: the tokens' bytes put together; bytes that are no UTF-8 become the replacement sign."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column("ids").value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b in runs(counts, DECODED):
                part = batch.slice(a, b - a)
                texts = texts_of(part.column("ids").flatten().to_numpy(), np.append(0, np.cumsum(counts[a:b])), vocab_path)
                yield pa.RecordBatch.from_arrays([*part.columns, texts], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")
