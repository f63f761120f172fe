"""What each feature adds to a row's score: path-dependent attribution over the fitted trees.

A leaf counts for a row as far as the features on its path are known: a known feature leads to the leaf or away from it, an unknown one
follows the shares of the training rows. The Shapley value of a feature in that game depends only on which of the path's features lead to the leaf, so
each leaf has a table over these patterns, and rows look theirs up. Contributions and the base add up to the margin of the model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.models.ensemble import Booster
from riskflow.models.prepare import bucket
from riskflow.session import scratch_dir


@dataclass
class Leaf:
    """Features of the path with the tests that must hold, and the contributions per pattern of tests that do."""

    features: list[int]
    tests: list[list[tuple[float, bool]]]        # per feature: threshold, and whether the value must be at most that
    table: np.ndarray


@dataclass
class Node:
    count: float
    value: float = 0.0
    feature: int = -1
    threshold: float = 0.0
    left: Node | None = None
    right: Node | None = None


def pattern_table(shares: list[float], value: float) -> np.ndarray:
    """Contributions of m features for each of the 2**m patterns; `shares` are the training rows that pass a feature's tests."""
    m = len(shares)
    out = np.zeros((1 << m, m))
    weight = [factorial(k) * factorial(m - k - 1) / factorial(m) for k in range(m)] if m else []
    for code in range(1 << m):
        passes = [(code >> j) & 1 for j in range(m)]
        for i in range(m):
            sums = np.array([1.0])                # by the number of known features among the others
            for j in range(m):
                if j != i:
                    sums = np.append(sums * shares[j], 0) + np.append(0, sums * passes[j])
            out[code, i] = value * (passes[i] - shares[i]) * float(np.dot(sums, weight))
    return out


def leaves_of(root: Node, scale: float = 1.0) -> tuple[list[Leaf], float]:
    """The leaves of a tree and its mean over the training rows."""
    leaves, base = [], 0.0
    todo: list[tuple[Node, list[tuple[int, float, bool, float]]]] = [(root, [])]
    while todo:
        node, path = todo.pop()
        if node.left is None:
            features = sorted({f for f, *_ in path})
            shares = [float(np.prod([s for f, _, _, s in path if f == g])) for g in features]
            leaves.append(Leaf(features, [[(t, low) for f, t, low, _ in path if f == g] for g in features], pattern_table(shares, scale * node.value)))
            base += scale * node.value * float(np.prod([s for *_, s in path]))
            continue
        for child, low in ((node.left, True), (node.right, False)):
            todo.append((child, [*path, (node.feature, node.threshold, low, child.count / node.count)]))
    return leaves, base


def attribute(leaves: list[Leaf], x: np.ndarray) -> np.ndarray:
    """Contributions of all leaves to the rows of `x`."""
    out = np.zeros(x.shape)
    for leaf in leaves:
        code = np.zeros(len(x), np.int64)
        for j, (f, tests) in enumerate(zip(leaf.features, leaf.tests, strict=True)):
            passes = np.ones(len(x), bool)
            for threshold, low in tests:
                passes &= (x[:, f] <= threshold) == low
            code |= passes.astype(np.int64) << j
        if leaf.features:
            out[:, leaf.features] += leaf.table[code]
    return out


def stored_trees(spark: SparkSession, model: Booster) -> list[tuple[Node, float]]:
    """Trees of the model's last stage with their weights, read from its stored form: a bounded number of small trees."""
    path, last = scratch_dir(spark, "trees"), model.stages.stages[-1]
    last.write().overwrite().save(path)
    weights = list(last.treeWeights)
    trees = []
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").toPandas().sort_values(["treeID", "id"])
    for tree, part in rows.groupby("treeID"):
        nodes = {r.id: r for r in part.itertuples()}

        def grow(i: int) -> Node:
            r = nodes[i]
            if r.leftChild < 0:
                return Node(float(r.rawCount), r.prediction)
            # Continuous features hold their threshold as the only number.
            return Node(float(r.rawCount), r.prediction, r.split["featureIndex"], r.split["leftCategoriesOrThreshold"][0], grow(r.leftChild), grow(r.rightChild))

        trees.append((grow(0), float(weights[tree])))
    return trees


def contributions(model: Booster, df: DataFrame, key: str = "transaction_id", rows: int | None = 2000, seed: int = 42) -> DataFrame:
    """`key, feature, contribution, base, margin` per row and feature, of the first `rows` in hash order or of all."""
    sample = df.select(key, *model.columns)
    if rows is not None:
        sample = sample.orderBy(bucket(key, seed, 1 << 30), key).limit(rows)
    forest = [leaves_of(root, weight) for root, weight in stored_trees(df.sparkSession, model)]
    leaves, base, columns = [leaf for tree, _ in forest for leaf in tree], float(sum(b for _, b in forest)), list(model.columns)
    made = model.features(sample).select(key, vector_to_array("features").alias("x"), vector_to_array("rawPrediction")[1].alias("margin"))
    kind = df.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                found = attribute(leaves, np.stack(pdf["x"].to_numpy()))
                yield pd.DataFrame({key: np.repeat(pdf[key].to_numpy(), len(columns)), "feature": columns * len(pdf), "contribution": found.ravel(),
                                    "base": base, "margin": np.repeat(pdf["margin"].to_numpy(), len(columns))})

    return made.mapInPandas(run, f"{key} {kind}, feature string, contribution double, base double, margin double")


def mean_contributions(rows: DataFrame, top: int = 15) -> DataFrame:
    """Features by mean absolute contribution."""
    return (rows.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance"))
            .orderBy(F.col("importance").desc(), "feature").limit(top))
