"""Quality metrics and reports; each is one aggregate over the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow import schemas as S

KEY_COLUMNS = ("transaction_id", "customer_id", "amount", "timestamp")


def null_rate(column: str) -> Column:
    """Share of nulls, 0 for an empty table."""
    return F.coalesce(F.avg(F.col(column).isNull().cast("double")), F.lit(0.0)).alias(f"{column}_null_rate")


def quality_metrics(df: DataFrame, max_null_rate: float = 0.01, max_fraud_rate: float = 0.05) -> DataFrame:
    """Completeness, amount range, label rate, freshness and the warnings they give: one row."""
    out = [null_rate(c) for c in KEY_COLUMNS] + [
        F.min("amount").alias("amount_min"), F.max("amount").alias("amount_max"),
        F.avg("amount").alias("amount_mean"), F.stddev("amount").alias("amount_stddev"),
        F.max("timestamp").alias("max_timestamp")]
    tests = [(F.col(f"{c}_null_rate") > max_null_rate, f"{c}_null_rate") for c in KEY_COLUMNS]
    if S.LABEL in df.columns:
        out.append(F.avg(S.LABEL).alias("fraud_rate"))
        tests.append((F.col("fraud_rate") > max_fraud_rate, "fraud_rate"))
    warnings = F.array_compact(F.array(*[F.when(t, F.lit(name)) for t, name in tests]))
    return df.agg(*out).withColumn("warnings", warnings)


def duplicate_counts(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Rows before and after deduplication.

    Counts per key first, so that a key with many copies is reduced before the exchange.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
                       F.count(F.lit(1)).alias("rows_after")).withColumn(
        "duplicates_removed", F.col("rows_before") - F.col("rows_after"))


def gate_report(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Row count, null rates, negative amounts and repeated ids: one row, counted in one pass."""
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.count("amount").alias("amounts"),
        F.count("customer_id").alias("customers"), F.count_if(F.col("amount") < 0).alias("negative"))
    total = F.sum("n")
    return per_key.agg(
        F.coalesce(total, F.lit(0)).alias("record_count"),
        F.try_divide(total - F.sum("amounts"), total).alias("null_rate_amount"),
        F.try_divide(total - F.sum("customers"), total).alias("null_rate_customer"),
        F.coalesce(F.sum("negative"), F.lit(0)).alias("negative_amounts"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_txn_ids"))


class QualityGateError(ValueError):
    """The stored table breaks a rule that stops the chain."""


def enforce_gate(df: DataFrame, max_null_customer: float = 0.01) -> dict:
    """The gate report as a dict, or an error that names what is broken."""
    report = gate_report(df).first().asDict()
    broken = [name for name, bad in (
        ("null_rate_customer", (report["null_rate_customer"] or 0.0) >= max_null_customer),
        ("duplicate_txn_ids", report["duplicate_txn_ids"] > 0),
        ("negative_amounts", report["negative_amounts"] > 0)) if bad]
    if broken:
        raise QualityGateError(", ".join(f"{b}={report[b]}" for b in broken))
    return report


def band_summary(scored: DataFrame) -> DataFrame:
    """Rows and mean score per risk band, largest band first."""
    return (scored.groupBy("risk_band")
            .agg(F.count(F.lit(1)).alias("count"), F.avg("fraud_risk_score").alias("avg_score"))
            .orderBy(F.col("count").desc(), "risk_band"))


def batch_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("risk_band").isin("CRITICAL", "HIGH")).alias("high_risk_count"),
        F.round(F.coalesce(F.avg("fraud_risk_score"), F.lit(0.0)), 2).alias("avg_score"))


def daily_report(scored: DataFrame, threshold: float = 45.0) -> DataFrame:
    """Per day: volume, detections, alerts, amount at risk and false-positive rate."""
    flagged = F.col("fraud_risk_score") >= threshold
    clean = F.col(S.LABEL) == 0
    hit = F.count_if(flagged)
    return scored.groupBy(F.to_date("timestamp").alias("date")).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        hit.alias("fraud_detected"),
        (hit * 100 / F.count(F.lit(1))).alias("fraud_rate"),
        F.count_if(F.col("risk_band") == "CRITICAL").alias("critical_alerts"),
        F.count_if(F.col("risk_band") == "HIGH").alias("high_alerts"),
        F.coalesce(F.sum(F.when(flagged, F.col("amount_inr").cast("decimal(18,2)"))), F.lit(0))
         .cast("double").alias("amount_at_risk_inr"),
        (F.try_divide(F.count_if(flagged & clean), F.count_if(clean)) * 100).alias("false_positive_rate"))


def topic_counts(routed: DataFrame) -> DataFrame:
    """Messages per topic and share of labelled ones."""
    return routed.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"),
                                       F.avg(F.col(S.LABEL).cast("double")).alias("label_rate"))


def stream_metrics(processed: DataFrame, sla_ms: float = 100.0) -> DataFrame:
    """Counters of a processed batch: rows, alerts, mean latency, late answers, unreadable rows."""
    ok = ~F.col("is_error")
    return processed.agg(
        F.count_if(ok).alias("processed"),
        F.count_if(ok & F.col("rule_severity").isin("CRITICAL", "HIGH")).alias("alerts"),
        F.avg(F.when(ok, F.col("latency_ms"))).alias("avg_latency_ms"),
        F.count_if(F.col("latency_ms") > sla_ms).alias("sla_breaches"),
        F.count_if(F.col("is_error")).alias("errors"))


def dataset_profile(df: DataFrame, features: list[str]) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_samples"), F.lit(len(features)).cast("bigint").alias("n_features"),
                  F.avg(F.col(S.LABEL).cast("double")).alias("fraud_rate"))


def class_ratio(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Negatives per positive, as weight of the positive class."""
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.agg(pos.alias("positives"), neg.alias("negatives"),
                  (neg / F.greatest(pos, F.lit(1))).alias("pos_weight"))


