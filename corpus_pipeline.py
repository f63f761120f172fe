"""Documents to packed training sequences; each stage is written as Parquet and reread by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm.exact_dedup import drop_copies
from riskflow.llm.line_dedup import drop_repeats
from riskflow.llm.near_dups import one_of_each_group
from riskflow.llm.packing import pack_documents
from riskflow.llm.quality_model import keep_accepted, train
from riskflow.llm.tables import store, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_accepted(docs, train(docs, table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest id stays."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the smallest id stays."""
    return one_of_each_group(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines are cut; ``n_chars`` follows the text."""
    done, row = drop_repeats(docs), F.col("row")
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return done.select(*[new.get(c, row.getField(c)).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its sequence and place there."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality), ("exact_dedup", exact), ("near_duplicates", near), ("line_dedup", lines), ("best_fit_packing", packing)]

#: The classifier, the near-duplicate join and the packing are no SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
