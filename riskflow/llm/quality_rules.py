"""Quality rules by divergence of distributions.

A document has a histogram of character classes and one of the common words of its language. Both are
compared with those of the language by Jensen-Shannon distance (base 2, 0 to 1); a text too short for
a histogram is not judged by it. References are counted over all documents of a language, whatever its
share of the table. Words are not judged (null distance) where the language is null or has too few words
for a reference. Rows without a language are held against the character classes of all documents.

Null texts have no words. Rows are judged one by one, so repeated rows get equal results and a null
id stays null. An empty table gives an empty result. Only ``doc_id``, ``text`` and ``lang`` are read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskflow.llm.codes import blocks, code_points, mix, prefix, run_hashes, span_hashes, word_spans
from riskflow.llm.tables import store, text_of

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "letter", "digit", "space", "punctuation", "symbol", "other")
PROFILE = ("doc_id {id}, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
           "n_repeat_words long, n_chars long, class_counts array<long>, word_counts array<long>")


@dataclass(frozen=True)
class Limits:
    """Least lengths and largest distances; ``common`` words make a language's word histogram.

    A language of ``min_reference_words`` words or more has a word reference. A thousand add a hundredth to
    the chance distance of a text of 100 words.
    """

    common: int = 50
    min_chars: int = 200
    max_class_distance: float = 0.28
    min_words: int = 100
    max_word_distance: float = 0.4
    min_reference_words: int = 1000


@cache
def class_table() -> np.ndarray:
    """Class of each code point by its Unicode category."""
    place = {"Ll": 0, "Lu": 1, "Lt": 1, "Lm": 2, "Lo": 2, "Nd": 3, "Nl": 3, "No": 3, "Zs": 4, "Zl": 4, "Zp": 4}
    group = {"P": 5, "S": 6}
    kinds = (unicodedata.category(chr(c)) for c in range(0x110000))
    table = np.fromiter((place.get(k, group.get(k[0], 7)) for k in kinds), np.uint8, 0x110000)
    table[9:14] = 4
    return table


def common_words(docs: DataFrame, limits: Limits) -> DataFrame:
    """One row per language with words enough: hashes of its most frequent words (lower case), and their counts.

    ``word_ref`` ends with the count of all other words and is filled up with zeros before it.
    """
    words = docs.where(F.col("lang").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"),
        F.explode(F.regexp_extract_all(F.lower(text_of()), F.lit(WORD), F.lit(0))).alias("word"))
    counts = store(words.groupBy("lang", "word").agg(F.count("*").alias("n")), "word-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).where(F.col("total") >= limits.min_reference_words)
    top = W.partitionBy("lang").orderBy(F.desc("n"), "word")
    best = (counts.withColumn("place", F.row_number().over(top)).where(F.col("place") <= limits.common).groupBy("lang")
            .agg(F.sort_array(F.collect_list(F.struct("place", "word", "n"))).alias("best")))     # ``common`` entries at most
    listed = F.transform("best", lambda x: x["n"])
    rest = F.col("total") - F.aggregate(listed, F.lit(0).cast("long"), lambda s, x: s + x)
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(limits.common) - F.size("best"))
    lists = best.join(totals, "lang").select("lang", F.transform("best", lambda x: x["word"]).alias("words"),
                                             F.concat(listed, zeros, F.array(rest)).alias("word_ref"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys = [hashes_of(list(w)).view(np.int64) for w in frame["words"]]
            yield pd.DataFrame({"lang": frame["lang"], "keys": keys, "word_ref": frame["word_ref"]})

    return store(lists.mapInPandas(run, "lang string, keys array<long>, word_ref array<long>"), "word-references")


def _per_text(values: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(places, values, n).astype(np.int64)


def text_counts(texts: list[str]) -> dict[str, np.ndarray]:
    """The base counts and class histograms of each text, and the words' texts and hashes of their lower case."""
    n = len(texts)
    codes, edges = code_points(texts)
    owner = np.repeat(np.arange(n), np.diff(edges))
    starts, ends = word_spans(codes, edges)
    word_owner = owner[starts] if len(starts) else np.zeros(0, np.int64)
    sums = prefix(codes)
    hashes = span_hashes(sums, starts, ends)

    repeated = np.zeros(len(starts), bool)
    windows = run_hashes(hashes, 3)
    if len(windows):
        inside = word_owner[2:] == word_owner[:-2]
        keys = mix(windows[inside] + mix(word_owner[2:][inside].astype(np.uint64) + np.uint64(1)))
        _, back, times = np.unique(keys, return_inverse=True, return_counts=True)
        first = np.flatnonzero(inside)[times[back] > 1]
        for k in range(3):
            repeated[first + k] = True

    line_cut = np.unique(np.concatenate([edges, np.flatnonzero(codes == 10), np.flatnonzero(codes == 10) + 1]))
    line_start, line_end = line_cut[:-1], line_cut[1:]
    with_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end = line_start[with_word], line_end[with_word]
    line_owner = owner[line_start] if len(line_start) else np.zeros(0, np.int64)
    keys = mix(span_hashes(sums, line_start, line_end) + mix(line_owner.astype(np.uint64) + np.uint64(1)))
    _, where = np.unique(keys, return_index=True)

    symbol = np.isin(codes, np.array([ord(c) for c in SYMBOLS], np.uint32))
    classes = class_table()[codes].astype(np.int64) + owner * len(CLASSES)
    return {
        "n_words": np.bincount(word_owner, minlength=n), "word_chars": _per_text(ends - starts, word_owner, n),
        "n_symbols": np.bincount(owner[symbol], minlength=n), "n_repeat_words": np.bincount(word_owner[repeated], minlength=n),
        "n_dup_lines": np.bincount(line_owner, minlength=n) - np.bincount(line_owner[where], minlength=n),
        "n_chars": np.diff(edges), "classes": np.bincount(classes, minlength=n * len(CLASSES)).reshape(n, -1)}


def word_histograms(texts: list[str], langs: list[str | None], lexicon: dict[str, np.ndarray], common: int) -> list[np.ndarray | None]:
    """Counts of the language's common words in each text; the last entry holds all other words. None without a reference."""
    lowered = [t.lower() for t in texts]
    codes, edges = code_points(lowered)
    starts, ends = word_spans(codes, edges)
    owner = np.searchsorted(edges, starts, "right") - 1
    hashes = span_hashes(prefix(codes), starts, ends)
    out = np.zeros((len(texts), common + 1), np.int64)
    names = np.array(langs, object)
    for lang, keys in lexicon.items():
        mine = (names == lang)[owner]
        order = np.argsort(keys)
        at = np.minimum(np.searchsorted(keys[order], hashes[mine]), max(len(keys) - 1, 0))
        place = np.where(keys[order][at] == hashes[mine], order[at], common) if len(keys) else np.full(mine.sum(), common)
        np.add.at(out, (owner[mine], place), 1)
    return [row if lang in lexicon else None for lang, row in zip(langs, out, strict=True)]


def hashes_of(words: list[str]) -> np.ndarray:
    codes, edges = code_points(words)
    return span_hashes(prefix(codes), edges[:-1], edges[1:])


def profiles(docs: DataFrame, references: DataFrame, limits: Limits) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts, langs, keys = frame["text"].tolist(), frame["lang"].tolist(), frame["keys"].tolist()
            for a, b in blocks(texts, 1 << 19):
                got = text_counts(texts[a:b])
                classes = got.pop("classes")
                lexicon = {lang: np.asarray(k, np.int64).view(np.uint64) for lang, k in zip(langs[a:b], keys[a:b], strict=True) if k is not None}
                yield pd.DataFrame({"doc_id": frame["doc_id"].iloc[a:b].array, "lang": langs[a:b], **got, "class_counts": list(classes),
                                    "word_counts": word_histograms(texts[a:b], langs[a:b], lexicon, limits.common)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    read = docs.select("doc_id", text_of().alias("text"), F.col("lang").cast("string").alias("lang"))
    return read.join(references.select("lang", "keys"), "lang", "left").select("doc_id", "text", "lang", "keys").mapInPandas(
        run, PROFILE.format(id=kind))


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distances of the rows of two tables of counts; not a number where either row is empty."""
    with np.errstate(divide="ignore", invalid="ignore"):
        p, q = (x / x.sum(axis=1, keepdims=True) for x in (left, right))
        terms = [np.where(x > 0, x * np.log2(2 * x / (p + q)), 0.0).sum(axis=1) for x in (p, q)]
        out = np.sqrt(np.maximum((terms[0] + terms[1]) / 2, 0.0))
    out[(left.sum(axis=1) == 0) | (right.sum(axis=1) == 0)] = np.nan
    return out


def js_distance(left: Column, right: Column) -> Column:
    """Jensen-Shannon distance of two histograms of equal length; null if either is null or empty."""
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        both = pc.and_(left.is_valid(), right.is_valid())
        out, n = np.full(len(left), np.nan), pc.sum(both).as_py() or 0
        if n:
            tables = [x.filter(both).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, -1) for x in (left, right)]
            out[both.to_numpy(zero_copy_only=False)] = distances(*tables)
        return pa.array(out, mask=np.isnan(out))

    return F.arrow_udf(run, "double")(left, right)


def quality_rules(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Base counts, distances and verdict, one row per row of ``docs``."""
    words = common_words(docs, limits)
    found = store(profiles(docs, words, limits), "profiles")
    sums = [F.sum(F.get("class_counts", F.lit(i))).alias(f"c{i}") for i in range(len(CLASSES))]
    as_list = F.array(*[f"c{i}" for i in range(len(CLASSES))]).alias("class_ref")
    classes = (found.where(F.col("lang").isNotNull()).groupBy("lang").agg(*sums)
               .unionByName(found.agg(*sums).select(F.lit(None).cast("string").alias("lang"), "*")).select("lang", as_list))
    refs = store(classes.join(words.select("lang", "word_ref"), "lang", "left").withColumnRenamed("lang", "of"), "references")
    joined = found.join(refs, F.col("lang").eqNullSafe(F.col("of")), "left")

    class_distance = F.when(F.col("n_chars") >= limits.min_chars, js_distance(F.col("class_counts"), F.col("class_ref")))
    word_distance = F.when(F.col("n_words") >= limits.min_words, js_distance(F.col("word_counts"), F.col("word_ref")))
    joined = joined.select("*", class_distance.alias("class_distance"), word_distance.alias("word_distance"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    far = ((F.coalesce("class_distance", F.lit(0.0)) > limits.max_class_distance)
           | (F.coalesce("word_distance", F.lit(0.0)) > limits.max_word_distance))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), (~failed & ~far).alias("kept"), "class_distance", "word_distance")
