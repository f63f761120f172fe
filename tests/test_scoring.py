import random

import pytest
from pyspark.sql import functions as F

from riskflow import schemas as S
from riskflow.functions import columns as C
from riskflow.operators import drift, metrics, quality
from riskflow.plans.jobs import score_rows


@pytest.mark.parametrize("score, band", [(0, "LOW"), (44.9, "LOW"), (45, "MEDIUM"), (64.9, "MEDIUM"), (65, "HIGH"),
                                         (84.9, "HIGH"), (85, "CRITICAL"), (100, "CRITICAL")])
def test_bands(spark, score, band):
    row = spark.range(1).select(C.risk_band(F.lit(float(score))).alias("b")).withColumn("r", C.recommendation(F.col("b"))).first()
    assert row["b"] == band and row["r"] == S.RECOMMENDATIONS[band]


FLAGS = ["velocity_spike", "is_impossible_travel", "is_new_device", "is_new_country", "is_mcc_high_risk",
         "multi_account_device", "is_fraud_hour"]


def features(spark, **values):
    row = {**{f: 0 for f in FLAGS}, "amount_ratio_to_avg": 1.0, "amt_zscore_30d": 0.0, "pct_cnp_30d": 0.1, **values}
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in row.items()])


@pytest.mark.parametrize("values, score", [
    ({}, 0.0), ({"is_impossible_travel": 1}, 35.0), ({"amount_ratio_to_avg": 5.0}, 0.0), ({"amount_ratio_to_avg": 5.1}, 20.0),
    ({"amt_zscore_30d": 3.01, "pct_cnp_30d": 0.81}, 25.0), ({f: 1 for f in FLAGS}, 100.0)])
def test_fallback_score(spark, values, score):
    assert features(spark, **values).select(C.fallback_score()).first()[0] == score


def test_model_score_wins_over_fallback(spark):
    df = features(spark, is_new_device=1)
    assert score_rows(df).first()["fraud_risk_score"] == 15.0
    assert score_rows(df, F.lit(88.888)).first()["fraud_risk_score"] == 88.89
    assert score_rows(df, F.lit(None).cast("double")).first()["risk_band"] == "LOW"


def test_contract_defaults_and_violations(spark):
    df = spark.range(1).select(F.lit(-1.0).alias("amount"), *[F.lit(None).cast("double").alias(n) for n in S.FEATURE_DEFAULTS])
    row = df.withColumns(C.contract_defaults()).select("*", C.contract_violations().alias("v")).first()
    assert row["v"] == ["amount"] and row["txn_count_7d"] == 15.0 and row["home_country_pct"] == 0.95
    bad = df.withColumns({**C.contract_defaults(), "txn_hour_sin": F.lit(-1.1), "typical_amount_band": F.lit(5.0),
                          "amt_zscore_30d": F.lit(-99.0)}).select(C.contract_violations()).first()[0]
    assert sorted(bad) == ["amount", "txn_hour_sin", "typical_amount_band"]


def test_metrics_on_a_known_ranking(spark):
    rows = [(0.9, 1), (0.8, 0), (0.7, 1), (0.6, 0), (0.5, 0)]
    df = spark.createDataFrame(rows, "s double, y int")
    row = metrics.evaluate(df, "s", "y", F.col("s") >= 0.65).first()
    assert row["roc_auc"] == pytest.approx(5 / 6)
    assert row["pr_auc"] == pytest.approx(0.5 * 1 + 0.5 * 2 / 3)
    assert (row["true_positives"], row["false_positives"], row["false_negatives"], row["true_negatives"]) == (2, 1, 0, 2)
    assert row["f1_score"] == pytest.approx(0.8)
    assert metrics.best_threshold(df, "s", "y", 0.92).first()["threshold"] == 0.7
    one_class = df.where("y = 0")
    assert metrics.roc_auc(one_class, "s", "y").first()["roc_auc"] is None
    assert metrics.best_threshold(one_class, "s", "y").first()["threshold"] == 0.5


def test_drift_sees_a_shift(spark):
    df = spark.range(20000).select((F.col("id") % 100 + F.when(F.col("id") >= 10000, 50).otherwise(0)).alias("moved"),
                                   (F.col("id") % 100).alias("same"), (F.col("id") >= 10000).alias("cur"))
    scores = {r["feature"]: r for r in drift.drift_scores(drift.bin_shares(df, ["moved", "same"], "cur")).collect()}
    assert scores["moved"]["psi"] > 0.2 > scores["same"]["psi"] and scores["moved"]["kl"] > 0
    decision = drift.retrain_decision(drift.drift_scores(drift.bin_shares(df, ["moved", "same"], "cur"))).first()
    assert decision["retrain"] and decision["feature_drift_pct"] == 50.0


def test_gate_stops_on_duplicates(spark):
    good = spark.createDataFrame([("a", "c", 1.0), ("b", "c", 2.0)], "transaction_id string, customer_id string, amount double")
    assert quality.enforce_gate(good)["record_count"] == 2
    with pytest.raises(quality.QualityGateError, match="duplicate_txn_ids=2"):
        quality.enforce_gate(good.union(good))
    assert quality.gate_report(good.limit(0)).first()["record_count"] == 0


def test_empty_table_has_no_null_rate(spark):
    df = spark.createDataFrame([], "transaction_id string, customer_id string, amount double, timestamp timestamp")
    assert quality.quality_metrics(df).first()["amount_null_rate"] == 0.0


def test_thresholds_are_real_scores(spark):
    rows = [(0.12346, 1)] * 50 + [(0.5 + i * 1e-7, 0) for i in range(40)] + [(0.01 * i, 0) for i in range(10)]
    df = spark.createDataFrame(rows, "s double, y int")
    cut = metrics.best_threshold(df, "s", "y", 0.92).first()["threshold"]
    assert cut == 0.12346 and df.where((F.col("s") >= cut) & (F.col("y") == 1)).count() >= 0.92 * 50


@pytest.mark.parametrize("ranges", [2, 7, 256])
def test_curve_does_not_depend_on_its_ranges(spark, ranges):
    rng = random.Random(4)
    rows = [(rng.choice([round(rng.random(), 3), -5.0, 120.0, 0.3]), int(rng.random() < 0.3)) for _ in range(700)]
    got = metrics._curve(spark.createDataFrame(rows, "s double, y int"), "s", "y", ranges=ranges).collect()
    for r in got:
        above = [y for s, y in rows if s >= r["threshold"]]
        assert (r["tp"], r["predicted"], r["all_pos"], r["all_n"]) == (sum(above), len(above), sum(y for _, y in rows), 700)
    assert len(got) == len({s for s, _ in rows})
