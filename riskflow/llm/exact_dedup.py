"""Exact dedup by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its content says so, each different chunk moves once to be verified, and from
then on a document is the ordered list of its chunk identifiers. Lists are compared, texts are not.

Null texts count as empty and are equal to each other. White space runs count as one space. A row
repeated with id and text is one document that weighs as often as it occurs. Rows without an id are
documents of their own text; they stay only where no equal text has an id. An empty table gives an
empty result. Only ``doc_id`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskflow.llm.tables import store, text_of

SPACE = r"[\x20\x09-\x0D]+"
#: 512 characters at least, then up to the next word that starts with a, b or c; 4,096 at most.
CHUNK = r"(?s).{512,4093}?[^ ] [a-cA-C]|.{1,4096}"


def chunk_digest(chunk: Column) -> Column:
    return F.unhex(F.md5(chunk))


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(text_of(column), SPACE, " ")


def chunks_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def clashing_chunks(docs: DataFrame, digest: Callable[[Column], Column] = chunk_digest) -> DataFrame:
    """Digests that stand for several chunks: every different chunk is moved once, copies meet in the map side."""
    chunks = docs.select(F.explode(chunks_of(normalised())).alias("chunk"))
    different = chunks.select(digest(F.col("chunk")).alias("id"), "chunk").distinct()
    return different.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")


def recipes(docs: DataFrame, digest: Callable[[Column], Column] = chunk_digest) -> DataFrame:
    """One row per document: ``doc_id, recipe, text_sha256, n_rows``; recipes hold verified identifiers."""
    clashes = store(clashing_chunks(docs, digest), "clashes")
    row = docs.select("doc_id", normalised().alias("norm"))
    if clashes.isEmpty():                        # each digest stands for one chunk: it is the identifier
        row = row.select("doc_id", F.transform(chunks_of(F.col("norm")), digest).alias("recipe"),
                         F.sha2("norm", 256).alias("text_sha256"))
        return row.groupBy("doc_id", "recipe", "text_sha256").agg(F.count("*").alias("n_rows"))

    # Chunks that share a digest are told apart by their rank among those of the digest.
    row = row.groupBy("doc_id", F.sha2("norm", 256).alias("text_sha256"), "norm").agg(F.count("*").alias("n_rows"))
    piece = row.select("doc_id", "text_sha256", "n_rows", F.posexplode_outer(chunks_of(F.col("norm"))).alias("pos", "chunk"))
    piece = piece.withColumn("id", digest(F.col("chunk")))
    ranked = (piece.join(clashes.select("id"), "id", "left_semi").select("id", "chunk").distinct()
              .withColumn("rank", F.row_number().over(W.partitionBy("id").orderBy("chunk"))))
    piece = piece.join(ranked, ["id", "chunk"], "left")
    verified = F.concat(F.col("id").cast("binary"), F.encode(F.concat(F.lit("#"), F.coalesce("rank", F.lit(0)).cast("string")), "utf-8"))
    listed = F.collect_list(F.when(F.col("chunk").isNotNull(), F.struct("pos", verified.alias("id"))))
    return (piece.groupBy("doc_id", "text_sha256", "n_rows").agg(F.sort_array(listed).alias("list"))
            .select("doc_id", F.col("list.id").alias("recipe"), "text_sha256", "n_rows"))


def exact_groups(docs: DataFrame, digest: Callable[[Column], Column] = chunk_digest) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256, n_chunks``, one row per document.

    Only lists that occur more than once are joined back; a list that very many documents share is a
    skewed partition of that join, which adaptive execution splits.
    """
    listed = store(recipes(docs, digest), "recipes")
    groups = (listed.groupBy("recipe").agg(F.min("doc_id").alias("first_id"), F.sum("n_rows").alias("group_rows"),
                                           F.count("*").alias("n_docs")).where("n_docs > 1").drop("n_docs"))
    found = listed.join(groups, "recipe", "left")
    keep = F.when(F.col("group_rows").isNull(), F.col("doc_id")).otherwise(F.col("first_id"))
    return found.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_rows", "n_rows").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256", F.size("recipe").cast("long").alias("n_chunks"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the copies, all columns kept; texts move once, to meet the decision on their id."""
    kept = exact_groups(docs).where("kept").select(F.col("doc_id").alias("_keep"), F.col("text_sha256").alias("_sha"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.sha2(normalised(), 256).alias("_row_sha"))
    same = F.col("_row.doc_id").eqNullSafe(F.col("_keep")) & (F.col("_row_sha") == F.col("_sha"))
    one = W.partitionBy("_row_sha", "_row.doc_id").orderBy("_row.doc_id")
    return (row.join(kept, same, "left_semi").withColumn("_n", F.row_number().over(one)).where("_n = 1").select("_row.*"))
