"""Quality classifier on subword embeddings, trained by numpy stochastic gradient descent.

A document's features are its words, pairs of neighbouring words (all pairs of a word with itself are
one feature) and the character n-grams of words with their edges, each hashed to a bucket. Buckets have learned vectors; their average goes through a
softmax of two classes. The fit reads a bounded sample of labelled rows of the training folds
(``Settings.sample_rows`` rows and ``sample_chars`` characters, the same share of both classes as far
as there are such rows, weighted back to their true shares). Scoring reads every whole text.

Null and empty texts get the score of the bias alone. Without labelled rows every score is 0.5. Labels
that are null are left out, of repeated labels of one document the smallest counts, and repeated rows
get equal scores. A null id is in no fold: it is never trained on and counts as held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.codes import blocks, code_points, mix, prefix, run_hashes, span_hashes, word_spans
from riskflow.llm.tables import text_of


#: Characters of texts taken at a time; a family of features needs some fifty bytes for each.
SMALL = 1 << 18
REPEAT = np.uint64(0x5DEECE66D << 27)


@dataclass(frozen=True)
class Settings:
    bits: int = 18
    dim: int = 8
    grams: tuple[int, ...] = (3, 4, 5)
    epochs: int = 6
    rate: float = 2.0
    sample_rows: int = 3000
    sample_chars: int = 24_000_000
    folds: int = 5
    seed: int = 7
    threshold: float = 0.3


@dataclass(frozen=True)
class Model:
    """What scoring needs: each bucket's part of the score, as averages and softmax of two classes are linear in them."""

    parts: np.ndarray
    bias: float
    settings: Settings


def fold(column: str = "doc_id", folds: int = 5) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def feature_parts(texts: list[str], settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket and text index of every feature, family by family."""
    shift = np.uint64(64 - settings.bits)
    padded = [f" {t} " for t in texts]
    codes, edges = code_points(padded)
    codes = np.where((codes >= 9) & (codes <= 13), np.uint32(32), codes)
    owner = np.repeat(np.arange(len(texts)), np.diff(edges))
    sums = prefix(codes)
    starts, ends = word_spans(codes, edges)
    words = span_hashes(sums, starts, ends)
    yield (words >> shift).astype(np.int64), owner[starts]
    pairs = np.where(words[1:] == words[:-1], REPEAT, run_hashes(words, 2))    # a word said twice, whichever it is
    inside = owner[starts[1:]] == owner[starts[:-1]] if len(starts) > 1 else np.zeros(0, bool)
    yield (pairs[inside] >> shift).astype(np.int64), owner[starts[:-1]][inside] if len(starts) > 1 else np.zeros(0, np.int64)
    solid = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(codes != 32, out=solid[1:])
    for n in settings.grams:                       # only the first and last place may be a word's edge
        at = np.arange(max(0, len(codes) - n + 1))
        at = at[solid[at + n - 1] - solid[at + 1] == n - 2]
        yield (span_hashes(sums, at, at + n) >> shift).astype(np.int64), owner[at]


#: Buckets of a text and their shares.
Bag = tuple[np.ndarray, np.ndarray]


def bags(texts: list[str], settings: Settings) -> Iterator[Bag]:
    """Per text its different buckets and the share of each among the text's features."""
    size = 1 << settings.bits
    for a, b in blocks(texts, SMALL):
        ids, owners = map(np.concatenate, zip(*feature_parts(texts[a:b], settings), strict=True))
        keys, counts = np.unique(owners * size + ids, return_counts=True)
        cuts = np.searchsorted(keys, np.arange(b - a + 1) * size)
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            yield (keys[i:j] % size).astype(np.int32), (counts[i:j] / max(1, counts[i:j].sum())).astype(np.float32)


def fit(docs: list[Bag], labels: list[int], weights: dict[int, float], settings: Settings) -> Model:
    """Stochastic gradient descent, one document at a time, with a falling rate."""
    rng = np.random.default_rng(settings.seed)
    vectors = rng.uniform(-1 / settings.dim, 1 / settings.dim, (1 << settings.bits, settings.dim)).astype(np.float32)
    out, bias = np.zeros((2, settings.dim), np.float32), np.zeros(2, np.float32)
    if not docs:
        return Model(np.zeros(1 << settings.bits, np.float32), 0.0, settings)
    steps, step = settings.epochs * len(docs), 0
    for _ in range(settings.epochs):
        for i in rng.permutation(len(docs)):
            ids, share = docs[i]
            rate = settings.rate * weights[labels[i]] * (1 - step / steps)
            step += 1
            hidden = share @ vectors[ids] if len(ids) else np.zeros(settings.dim, np.float32)
            logits = out @ hidden + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = p @ out
            out -= rate * np.outer(p, hidden)
            bias -= rate * 0.1 * p
            if len(ids):
                vectors[ids] -= (rate * share)[:, None] * back[None, :]
    return Model(vectors @ (out[1] - out[0]), float(bias[1] - bias[0]), settings)


def training_sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> tuple[list[Bag], list[int], dict[int, float]]:
    """Bags and labels of the sample, and the weight of a row of each class.

    Each text becomes its bag as it arrives. One that does not fit the bound of characters any more is passed over, so a few very long
    texts leave the others in.
    """
    known = (labels.where(F.col("quality").isin(0, 1) & (fold(folds=settings.folds) != 0))
             .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")))
    total = {r.quality: r.n for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64(F.col("doc_id").cast("string"))
    half = [known.where(F.col("quality") == q).orderBy(order, "doc_id").limit(settings.sample_rows // 2) for q in (0, 1)]
    chosen = half[0].unionByName(half[1])                           # at most sample_rows ids
    rows = (docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id", "quality").agg(F.min("text").alias("text")).orderBy(order, "doc_id"))
    kept, found, chars = [], [], 0
    for row in rows.toLocalIterator():
        if chars + len(row.text) > settings.sample_chars and kept:
            continue
        chars += len(row.text)
        kept += bags([row.text], settings)
        found.append(row.quality)
    weights = {q: (total.get(q, 0) / sum(total.values())) / max(1, found.count(q)) * len(found) for q in (0, 1)} if total else {}
    return kept, found, weights


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    return fit(*training_sample(docs, labels, settings), settings)


def scores(texts: list[str], model: Model) -> np.ndarray:
    """Probability of label 1 for each text."""
    out = np.zeros(len(texts))
    for a, b in blocks(texts, SMALL):
        total, count = np.zeros(b - a), np.zeros(b - a)
        for ids, owners in feature_parts(texts[a:b], model.settings):
            total += np.bincount(owners, model.parts[ids], b - a)
            count += np.bincount(owners, minlength=b - a)
        out[a:b] = total / np.maximum(count, 1)
    return 1 / (1 + np.exp(-(out + model.bias)))


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` reduced to ``doc_id, held_out, score, predicted``, one row per row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"].array, "score": scores(frame["text"].tolist(), model)})

    scored = docs.select("doc_id", text_of().alias("text")).mapInPandas(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", F.coalesce(fold(folds=model.settings.folds) == 0, F.lit(True)).alias("held_out"), "score",
                         (F.col("score") >= model.settings.threshold).cast("int").alias("predicted"))


def keep_accepted(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows that the model rejects; scored in place, so that no text is shuffled."""
    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(scores(text.tolist(), model))

    return docs.where(score(text_of()) >= model.settings.threshold)
