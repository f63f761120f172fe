"""Substring dedup by hashing the sentences of lines.

A line is cut into sentences behind ``.!?`` with white space, or behind their full-width forms; a line without such marks is one sentence. A
sentence is normalised (lower case, white space runs as one space) and hashed to 128 bits. One of fewer than ``min_words`` words, none of them
of ``LONG_WORD`` characters (scripts without spaces, addresses, encoded data), says too little by itself and is hashed together with the
sentence before and with the one behind it in its line, as far as both have ``min_words`` words. Of all sentences with one digest the earliest
stays, ranked by document id and then by place in the document; the others are cut out of their documents, and where they stood
is kept as offsets (code points of the original text, with the white space behind them). A line of which nothing stays goes with its line end.

Null texts count as empty and stay documents with an empty text, as do texts all of whose lines are cut.
Rows that repeat id and text are one document and get equal results. Rows without an id rank after all
others, and among themselves all keep their sentences. An empty table gives an empty result. Columns beside
``doc_id`` and ``text`` are passed through ``drop_repeats`` whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.shares import join_groups
from riskflow.llm.tables import store, text_of

MIN_WORDS, LONG_WORD = 12, 40
WORD = re.compile(r"[^\x20\x09-\x0D]+")
STOP = re.compile(r"[.!?][\x20\x09-\x0D]+|[\u3002\uff01\uff1f][\x20\x09-\x0D]*")
CUT = "array<struct<start:int,end:int>>"


def sentences(line: str) -> list[str]:
    """The sentences of a line, each with the white space behind it."""
    cuts = [0, *(m.end() for m in STOP.finditer(line)), len(line)]
    return [line[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b]


def keys_of(line: list[str], min_words: int = MIN_WORDS) -> list[list[str]]:
    """What each sentence of a line is compared by."""
    split = [WORD.findall(s.lower()) for s in line]
    norm, out = [" ".join(w) for w in split], []
    for i, words in enumerate(split):
        if len(words) >= min_words or any(len(w) >= LONG_WORD for w in words):
            out.append(["=" + norm[i]])
            continue
        keys = []
        if words and i and len(split[i - 1]) + len(words) >= min_words:
            keys.append(f"<{norm[i - 1]}\n{norm[i]}")
        if words and i + 1 < len(split) and len(words) + len(split[i + 1]) >= min_words:
            keys.append(f">{norm[i]}\n{norm[i + 1]}")
        out.append(keys)
    return out


def sentence_units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, text_key, place, unit, again``: digests of each sentence by its number in the text; ``again`` marks those seen before in their own text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "text_key", "place", "unit", "again"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for i, text in enumerate(batch.column("text").to_pylist()):
                seen, place = set(), 0
                for line in text.split("\n"):
                    for keys in keys_of(sentences(line), min_words):
                        for key in keys:
                            unit = blake2b(key.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                            rows.append((i, place, unit, unit in seen))
                            seen.add(unit)
                        place += 1
            if rows:
                at, place, unit, again = zip(*rows, strict=True)
                at = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("text_key").take(at), pa.array(place, pa.int32()),
                                                  pa.array(unit, pa.binary()), pa.array(again, pa.bool_())], names)

    read = docs.select("doc_id", F.xxhash64(text_of()).alias("text_key"), text_of().alias("text"))
    return read.mapInArrow(run, f"doc_id {kind}, text_key long, place int, unit binary, again boolean")


def repeated_sentences(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, text_key, places``: numbers of the sentences to cut, one row per document that has any."""
    units = store(sentence_units(docs, min_words), "sentences")
    once = units.where(~F.col("again")).drop("again")
    shared = store(once.groupBy("unit").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).where("n > 1 AND first_id IS NOT NULL"), "shared")
    later = join_groups(once, shared, "unit", "n", "doc_id").where(~F.col("doc_id").eqNullSafe(F.col("first_id")))
    cut = later.select("doc_id", "text_key", "place").unionByName(units.where("again").select("doc_id", "text_key", "place"))
    return cut.groupBy("doc_id", "text_key").agg(F.collect_set("place").alias("places"))


def drop_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``row, text, removed``: each row of ``docs`` as a struct, its text without repeats, and the offsets cut."""
    places = repeated_sentences(docs, min_words).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "places")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64(text_of()).alias("_own"))
    found = row.join(places, F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_key")), "left")
    cut = F.arrow_udf(_cut, f"text string, removed {CUT}")
    done = cut(F.coalesce(F.col("row.text").cast("string"), F.lit("")), F.coalesce("places", F.array().cast("array<int>")))
    return found.select("row", done.alias("done")).select("row", "done.text", "done.removed")


def _cut(text: pa.Array, places: pa.Array) -> pa.Array:
    texts, removed = [], []
    for whole, numbers in zip(text.to_pylist(), places.to_pylist(), strict=True):
        if not numbers:
            texts.append(whole)
            removed.append([])
            continue
        gone, kept, spans, at, place = set(numbers), [], [], 0, 0
        for line in whole.split("\n"):
            parts, stays = sentences(line), []
            for part in parts:
                if place in gone:
                    spans.append({"start": at, "end": at + len(part)})
                else:
                    stays.append(part)
                at, place = at + len(part), place + 1
            at += 1
            if stays or not parts:
                kept.append("".join(stays))
        texts.append("\n".join(kept))
        removed.append(spans)
    spans = pa.array(removed, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
    return pa.StructArray.from_arrays([pa.array(texts, pa.string()), spans], ["text", "removed"])
