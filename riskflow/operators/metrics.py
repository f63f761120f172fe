"""Evaluation of scores against labels.

Curves stand on the scores as they are. Rows are first counted per different score; these are dealt
into ranges between quantiles of the scores, running sums are taken within a range, and what lies in
the ranges above is added from one row per range. So no task orders all scores. Where the edges of the
ranges lie has no influence on any result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPS = 1e-8
RANGES = 256


def score_counts(df: DataFrame, score: str, label: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """Positives and rows per score."""
    return (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
            .groupBy((F.col(score).cast("double") + F.lit(0.0)).alias("threshold"))
            .agg(F.sum(F.col(label).cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("n"),
                 *[c.alias(name) for name, c in (extra or {}).items()]))


def _curve(df: DataFrame, score: str, label: str, extra: dict[str, Column] | None = None, ranges: int = RANGES) -> DataFrame:
    """Per score: `tp` and `predicted` at or above it, and the totals `all_pos` and `all_n`."""
    counts = score_counts(df, score, label, extra)
    steps = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    edges = counts.agg(F.percentile_approx("threshold", steps, F.lit(10 * ranges)).alias("e")).scalar()
    placed = counts.withColumn("_edges", F.coalesce(edges, F.array().cast("array<double>"))).withColumn(
        "_range", F.size(F.filter("_edges", lambda e: e < F.col("threshold")))).drop("_edges")
    above = Window.orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    per_range = placed.groupBy("_range").agg(F.sum("pos").alias("_pos"), F.sum("n").alias("_n")).select(
        "_range", F.coalesce(F.sum("_pos").over(above), F.lit(0)).alias("_above_pos"), F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_above_n"),
        F.sum("_pos").over(whole).alias("all_pos"), F.sum("_n").over(whole).alias("all_n"))      # at most `ranges` rows
    down = Window.partitionBy("_range").orderBy(F.col("threshold").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (placed.withColumns({"tp": F.sum("pos").over(down), "predicted": F.sum("n").over(down)}).join(per_range, "_range")
            .withColumns({"tp": F.col("tp") + F.col("_above_pos"), "predicted": F.col("predicted") + F.col("_above_n")})
            .drop("_range", "_above_pos", "_above_n"))


def pr_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """Precision, recall and F1 when all rows at or above the threshold are called positive."""
    precision, recall = F.col("tp") / F.col("predicted"), F.try_divide("tp", "all_pos")
    return _curve(df, score, label).select(
        "threshold", "tp", "predicted", precision.alias("precision"), recall.alias("recall"),
        (2 * precision * recall / (precision + recall + EPS)).alias("f1"))


def average_precision(df: DataFrame, score: str, label: str) -> DataFrame:
    """Sum of precision times step in recall, as one row `pr_auc`."""
    step = F.try_divide("pos", "all_pos")
    return _curve(df, score, label).agg(F.sum(step * F.col("tp") / F.col("predicted")).alias("pr_auc"))


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the ROC curve from rank sums, null when one class is missing."""
    neg = F.col("n") - F.col("pos")
    neg_above = (F.col("predicted") - F.col("tp")) - neg
    all_neg = F.col("all_n") - F.col("all_pos")
    wins = F.col("pos") * (all_neg - neg_above - neg + neg / 2)
    return _curve(df, score, label).agg(
        F.try_divide(F.sum(wins), F.max(F.col("all_pos").cast("double") * all_neg)).alias("roc_auc"))


def confusion(predicted: Column, actual: Column) -> dict[str, Column]:
    return {"true_positives": F.count_if(predicted & (actual == 1)),
            "false_positives": F.count_if(predicted & (actual == 0)),
            "false_negatives": F.count_if(~predicted & (actual == 1)),
            "true_negatives": F.count_if(~predicted & (actual == 0))}


def confusion_matrix(df: DataFrame, predicted: Column, actual: Column) -> DataFrame:
    """Counts, error rates, precision, recall and F1 at a fixed decision: one row."""
    tp, fp, fn, tn = (F.col(c) for c in ("true_positives", "false_positives", "false_negatives", "true_negatives"))
    counts = df.agg(*[c.alias(n) for n, c in confusion(predicted, actual).items()])
    return counts.withColumns({
        "false_positive_rate": fp / (fp + tn + EPS),
        "false_negative_rate": fn / (fn + tp + EPS),
        "precision_at_decision": F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)),
        "recall_at_decision": F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)),
        "f1_score": F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0))})


def best_threshold(df: DataFrame, score: str, label: str, min_recall: float = 0.0, default: float = 0.5) -> DataFrame:
    """Threshold of the greatest F1 among points with enough recall, the lowest one on a tie."""
    point = F.struct("f1", (-F.col("threshold")).alias("low"))
    usable = (F.col("recall") >= min_recall) & (F.col("f1") > 0)
    return pr_curve(df, score, label).agg(
        F.coalesce(F.max_by(F.when(usable, F.col("threshold")), F.when(usable, point)), F.lit(default)).alias("threshold"),
        F.coalesce(F.max(F.when(usable, F.col("f1"))), F.lit(0.0)).alias("f1"))


def evaluate(df: DataFrame, score: str, label: str, decision: Column) -> DataFrame:
    """All metrics in one row: areas, best-F1 point of the curve, and the matrix at the decision.

    One count per score is all that touches the rows.
    """
    y, d = F.col(label) == 1, decision
    g = _curve(df, score, label, {"_tp": F.count_if(d & y), "_fp": F.count_if(d & ~y)})
    precision, recall = F.col("tp") / F.col("predicted"), F.try_divide("tp", "all_pos")
    f1 = 2 * precision * recall / (precision + recall + EPS)
    neg = F.col("n") - F.col("pos")
    all_neg = F.col("all_n") - F.col("all_pos")
    wins = F.col("pos") * (all_neg - (F.col("predicted") - F.col("tp")) + neg / 2)
    at_best = F.struct(f1.alias("f1"), F.col("threshold"))
    out = g.agg(
        F.try_divide(F.sum(wins), F.max(F.col("all_pos").cast("double") * all_neg)).alias("roc_auc"),
        F.sum(F.try_divide("pos", "all_pos") * precision).alias("pr_auc"),
        F.max_by(precision, at_best).alias("precision"), F.max_by(recall, at_best).alias("recall"),
        F.sum("_tp").alias("true_positives"), F.sum("_fp").alias("false_positives"),
        F.sum(F.col("pos") - F.col("_tp")).alias("false_negatives"),
        F.sum(neg - F.col("_fp")).alias("true_negatives"))
    tp, fp, fn, tn = (F.col(c) for c in ("true_positives", "false_positives", "false_negatives", "true_negatives"))
    return out.withColumns({
        "f1_score": F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0)),
        "false_positive_rate": fp / (fp + tn + EPS), "false_negative_rate": fn / (fn + tp + EPS)})
