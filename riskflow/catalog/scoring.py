"""Scores, bands, reports, drift and evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskflow import schemas as S
from riskflow.catalog.features import FEAT_CTE
from riskflow.catalog.registry import query, six
from riskflow.catalog.rules import BAND, RULES_CTE, ruled
from riskflow.functions import columns as C
from riskflow.operators import cleanse, drift, metrics, quality
from riskflow.operators import features as X
from riskflow.plans.jobs import score_rows
from riskflow.session import scratch_dir
from riskflow.sources.testdata import TX_CTE, transactions


def _gold(spark, sf_dir):
    return X.gold_table(X.build_features(transactions(spark, sf_dir)))


_FALLBACK = ("CAST(least(20 * velocity_spike + 35 * is_impossible_travel + 15 * is_new_device + 25 * is_new_country"
             " + 15 * is_mcc_high_risk + 30 * multi_account_device + 10 * is_fraud_hour"
             " + CASE WHEN amount_ratio_to_avg > 5 THEN 20 ELSE 0 END + CASE WHEN amt_zscore_30d > 3 THEN 15 ELSE 0 END"
             " + CASE WHEN pct_cnp_30d > 0.8 THEN 10 ELSE 0 END, 100) AS DOUBLE)")
#: `scored`: fallback score and band of every transaction.
SCORED_CTE = FEAT_CTE + f""", fb AS (SELECT *, {_FALLBACK} AS fraud_risk_score FROM feat),
scored AS (SELECT *, {BAND.format('fraud_risk_score')} AS risk_band FROM fb)
"""


@query("fallback_score", SCORED_CTE + "SELECT transaction_id, fraud_risk_score, risk_band FROM scored")
def fallback_score(spark, sf_dir):
    return score_rows(_gold(spark, sf_dir)).select("transaction_id", "fraud_risk_score", "risk_band")


@query("band_summary", SCORED_CTE + "SELECT risk_band, count(*) AS count, round(avg(fraud_risk_score), 6) AS avg_score FROM scored GROUP BY 1")
def band_summary(spark, sf_dir):
    return quality.band_summary(score_rows(_gold(spark, sf_dir))).select("risk_band", "count", six("avg_score"))


_RULE_SCORED = RULES_CTE + ", scored AS (SELECT *, CAST(score AS DOUBLE) AS fraud_risk_score, band AS risk_band FROM banded)\n"


def _rule_scored(spark, sf_dir):
    return ruled(spark, sf_dir).select(
        "transaction_id", "timestamp", "currency", "amount", "is_fraud", F.col("rule_based_score").cast("double").alias("fraud_risk_score"),
        F.col("rule_severity").alias("risk_band"))


@query("risk_band", _RULE_SCORED + "SELECT transaction_id, risk_band FROM scored")
def risk_band(spark, sf_dir):
    return _rule_scored(spark, sf_dir).select("transaction_id", C.risk_band(F.col("fraud_risk_score")).alias("risk_band"))


_REC = "CASE risk_band " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.RECOMMENDATIONS.items()) + " END"


@query("recommendation", _RULE_SCORED + f"SELECT transaction_id, {_REC} AS recommendation FROM scored")
def recommendation(spark, sf_dir):
    return _rule_scored(spark, sf_dir).select("transaction_id", C.recommendation(F.col("risk_band")).alias("recommendation"))


@query("batch_summary", _RULE_SCORED + "SELECT count(*) AS total, count(*) FILTER (risk_band IN ('CRITICAL', 'HIGH')) AS high_risk_count, round(avg(fraud_risk_score), 2) AS avg_score FROM scored")
def batch_summary(spark, sf_dir):
    return quality.batch_summary(_rule_scored(spark, sf_dir))


@query("daily_report", _RULE_SCORED + """, inr AS (SELECT *, round(CAST(amount AS DECIMAL(18,4)) * CASE currency WHEN 'USD' THEN 83.50 WHEN 'GBP' THEN 105.20 WHEN 'EUR' THEN 90.15 ELSE 1.00 END, 2) AS amount_inr FROM scored)
SELECT strftime("timestamp", '%Y-%m-%d') AS date, count(*) AS total_transactions, count(*) FILTER (fraud_risk_score >= 45) AS fraud_detected,
  round(count(*) FILTER (fraud_risk_score >= 45) * 100e0 / count(*), 6) AS fraud_rate,
  count(*) FILTER (risk_band = 'CRITICAL') AS critical_alerts, count(*) FILTER (risk_band = 'HIGH') AS high_alerts,
  round(CAST(coalesce(sum(amount_inr) FILTER (fraud_risk_score >= 45), 0) AS DOUBLE), 2) AS amount_at_risk_inr,
  round(count(*) FILTER (fraud_risk_score >= 45 AND is_fraud = 0) * 100e0 / nullif(count(*) FILTER (is_fraud = 0), 0), 6) AS false_positive_rate
FROM inr GROUP BY 1""")
def daily_report(spark, sf_dir):
    out = quality.daily_report(cleanse.normalize_currency(_rule_scored(spark, sf_dir)))
    return out.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "total_transactions", "fraud_detected", six("fraud_rate"),
                      "critical_alerts", "high_alerts", F.round("amount_at_risk_inr", 2).alias("amount_at_risk_inr"),
                      six("false_positive_rate"))


# -- score arithmetic ---------------------------------------------------------------------

_A, _B, _Z = ("(transaction_id * 37 % 1000) / 1000e0", "(transaction_id * 91 % 1000) / 1000e0", "(transaction_id * 53 % 1000) / 1000e0")


@query("ensemble_score", TX_CTE + f""", e AS (SELECT transaction_id, least(greatest((({_A}) * 0.55e0 + ({_B}) * 0.35e0 + ({_Z}) * 0.10e0) * 100, 0), 100) AS s FROM tx)
SELECT transaction_id, round(s, 6) AS score, CAST(s >= 45 AS INT) AS prediction FROM e""")
def ensemble_score(spark, sf_dir):
    score = C.ensemble_score(F.expr(_A), F.expr(_B), F.expr(_Z))
    return transactions(spark, sf_dir).select("transaction_id", F.round(score, 6).alias("score"),
                                              (score >= 45).cast("int").alias("prediction"))


@query("score_scale", TX_CTE + "SELECT transaction_id, round(least(greatest(((transaction_id * 37 % 1500) / 1000e0 - 0.25e0) * 100, 0), 100), 2) AS score FROM tx")
def score_scale(spark, sf_dir):
    raw = F.expr("(transaction_id * 37 % 1500) / 1000e0 - 0.25e0")
    return transactions(spark, sf_dir).select("transaction_id", F.round(C.scale_score(raw), 2).alias("score"))


@query("score_choice", SCORED_CTE + f"""SELECT transaction_id, round(CASE WHEN transaction_id % 4 = 0 THEN fraud_risk_score ELSE least(greatest(({_A}) * 100, 0), 100) END, 2) AS fraud_risk_score FROM scored""")
def score_choice(spark, sf_dir):
    """A model score where there is one, for every fourth row the fallback."""
    model = F.when(F.col("transaction_id") % 4 != 0, C.scale_score(F.expr(_A)))
    return score_rows(_gold(spark, sf_dir), model).select("transaction_id", "fraud_risk_score")


@query("contract_check", FEAT_CTE + """SELECT transaction_id, concat_ws(',', CASE WHEN NOT amount > 0 THEN 'amount' END,
  CASE WHEN txn_count_1h - 2 < 0 THEN 'txn_count_1h' END, CASE WHEN home_country_pct * 1.2 > 1 THEN 'home_country_pct' END) AS violations,
  CASE WHEN transaction_id % 3 = 0 THEN 5000.0 ELSE round(median_txn_amount_30d, 6) END AS median_txn_amount_30d FROM feat""")
def contract_check(spark, sf_dir):
    broken = _gold(spark, sf_dir).withColumns({
        "txn_count_1h": F.col("txn_count_1h") - 2, "home_country_pct": F.col("home_country_pct") * 1.2,
        "median_txn_amount_30d": F.expr("if(transaction_id % 3 = 0, null, median_txn_amount_30d)")})
    out = broken.withColumns(C.contract_defaults())
    return out.select("transaction_id", F.concat_ws(",", C.contract_violations()).alias("violations"), six("median_txn_amount_30d"))


@query("minmax_invert", TX_CTE + ", m AS (SELECT min(amount) AS lo, max(amount) AS hi FROM tx) SELECT transaction_id, round(1 - (amount - lo) / (hi - lo + 1e-8), 6) AS anomaly FROM tx, m")
def minmax_invert(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    lo, hi = tx.agg(F.min("amount"), F.max("amount")).first()
    return tx.select("transaction_id", F.round(1 - (F.col("amount") - lo) / F.lit(hi - lo + 1e-8), 6).alias("anomaly"))


# -- drift --------------------------------------------------------------------------------

_SHARES = TX_CTE + """, longf AS (
  SELECT t >= 1705276800 AS cur, 'amount' AS feature, amount AS value FROM tx UNION ALL
  SELECT t >= 1705276800, 'latitude', latitude FROM tx UNION ALL
  SELECT t >= 1705276800, 'hour_of_day', CAST(hour_of_day AS DOUBLE) FROM tx),
edges AS (SELECT feature, quantile_disc(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM longf WHERE NOT cur GROUP BY 1),
binned AS (SELECT feature, cur, """ + " + ".join(f"CAST(e[{i}] < value AS INT)" for i in range(1, 10)) + """ AS bin FROM longf JOIN edges USING (feature)),
counts AS (SELECT feature, bin, count(*) FILTER (NOT cur) AS n_ref, count(*) FILTER (cur) AS n_cur FROM binned GROUP BY 1, 2),
shares AS (SELECT feature, bin, greatest(n_ref * 1e0 / sum(n_ref) OVER (PARTITION BY feature), 1e-4) AS p,
  greatest(n_cur * 1e0 / sum(n_cur) OVER (PARTITION BY feature), 1e-4) AS q FROM counts),
drift AS (SELECT feature, sum((q - p) * ln(q / p)) AS psi, sum(p * ln(p / q)) AS kl FROM shares GROUP BY 1)
"""


def _drift(spark, sf_dir):
    tx = transactions(spark, sf_dir).withColumn("is_current", C.epoch("timestamp") >= 1705276800)
    return drift.drift_scores(drift.bin_shares(tx, ["amount", "latitude", "hour_of_day"], "is_current"))


@query("psi_drift", _SHARES + "SELECT feature, round(psi, 6) AS psi FROM drift")
def psi_drift(spark, sf_dir):
    return _drift(spark, sf_dir).select("feature", six("psi"))


@query("kl_drift", _SHARES + "SELECT feature, round(kl, 6) AS kl FROM drift")
def kl_drift(spark, sf_dir):
    return _drift(spark, sf_dir).select("feature", six("kl"))


@query("retrain_decision", _SHARES + "SELECT round(max(psi), 6) AS psi_score, round(avg(CASE WHEN psi > 0.2 THEN 1e0 ELSE 0 END) * 100, 6) AS feature_drift_pct, CAST(max(psi) > 0.2 AS INT) AS retrain FROM drift")
def retrain_decision(spark, sf_dir):
    out = drift.retrain_decision(_drift(spark, sf_dir))
    return out.select(six("psi_score"), six("feature_drift_pct"), F.col("retrain").cast("int"))


@query("stored_baseline", _SHARES + """SELECT feature, (SELECT count(*) FROM longf l WHERE l.feature = drift.feature AND NOT cur) AS n_ref,
  count(*) AS bins, true AS near FROM drift JOIN shares USING (feature) GROUP BY 1, 2""")
def stored_baseline(spark, sf_dir):
    """Drift of the current slice against sketches kept per hour of the reference slice: as far from the exact index as the sketch allows."""
    names, tx = ["amount", "latitude", "hour_of_day"], transactions(spark, sf_dir).withColumn("slice", F.hour("timestamp"))
    current = C.epoch("timestamp") >= 1705276800
    path = scratch_dir(spark, "baseline")
    parts = drift.baseline_sketches(tx.where(~current), names, by=["slice"])
    drift.merge_sketches(parts).write.parquet(path)
    stored = spark.read.parquet(path)
    shares = drift.shares_against(tx.where(current), stored)
    found = drift.drift_scores(shares).join(_drift(spark, sf_dir).select("feature", F.col("psi").alias("exact")), "feature")
    bins = shares.groupBy("feature").agg(F.count("*").alias("bins"))
    return found.join(stored, "feature").join(bins, "feature").select("feature", F.col("n").alias("n_ref"), "bins", (F.abs(F.col("psi") - F.col("exact")) < 0.01).alias("near"))


# -- evaluation ---------------------------------------------------------------------------

SCORE = "(transaction_id * 37 % 1000 + 400 * is_fraud) / 1400e0"
_CURVE = TX_CTE + f""", s AS (SELECT {SCORE} AS threshold, is_fraud AS y FROM tx),
g AS (SELECT threshold, sum(y) AS pos, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT *, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(n) OVER (ORDER BY threshold DESC) AS predicted,
  sum(pos) OVER () AS all_pos, sum(n) OVER () AS all_n FROM g),
curve AS (SELECT *, tp * 1e0 / predicted AS precision, tp * 1e0 / all_pos AS recall FROM c),
f AS (SELECT *, 2 * precision * recall / (precision + recall + 1e-8) AS f1 FROM curve)
"""
_AUC = f"""(SELECT sum(CASE WHEN a.y = 1 AND b.y = 0 AND a.threshold > b.threshold THEN 1e0
  WHEN a.y = 1 AND b.y = 0 AND a.threshold = b.threshold THEN 0.5 ELSE 0 END) / (sum(CASE WHEN a.y = 1 AND b.y = 0 THEN 1e0 ELSE 0 END))
  FROM s a JOIN s b ON a.y = 1 AND b.y = 0)"""


def _scores(spark, sf_dir):
    return transactions(spark, sf_dir).select("transaction_id", "timestamp", F.expr(SCORE).alias("score"), "is_fraud")


@query("pr_curve", _CURVE + "SELECT round(threshold, 9) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(predicted AS BIGINT) AS predicted, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM f")
def pr_curve(spark, sf_dir):
    return metrics.pr_curve(_scores(spark, sf_dir), "score", "is_fraud").select(
        F.round("threshold", 9).alias("threshold"), "tp", "predicted", six("precision"), six("recall"), six("f1"))


@query("pr_auc", _CURVE + "SELECT round(sum(pos * 1e0 / all_pos * precision), 6) AS pr_auc FROM f")
def pr_auc(spark, sf_dir):
    return metrics.average_precision(_scores(spark, sf_dir), "score", "is_fraud").select(six("pr_auc"))


@query("roc_auc", _CURVE + f"SELECT round({_AUC}, 6) AS roc_auc")
def roc_auc(spark, sf_dir):
    return metrics.roc_auc(_scores(spark, sf_dir), "score", "is_fraud").select(six("roc_auc"))


_MATRIX = """count(*) FILTER (d AND y = 1) AS true_positives, count(*) FILTER (d AND y = 0) AS false_positives,
  count(*) FILTER (NOT d AND y = 1) AS false_negatives, count(*) FILTER (NOT d AND y = 0) AS true_negatives"""
_COUNTS = ["true_positives", "false_positives", "false_negatives", "true_negatives"]
_RATES = """round(false_positives / (false_positives + true_negatives + 1e-8), 6) AS false_positive_rate,
  round(false_negatives / (false_negatives + true_positives + 1e-8), 6) AS false_negative_rate,
  round(coalesce(2e0 * true_positives / nullif(2 * true_positives + false_positives + false_negatives, 0), 0), 6) AS f1_score"""


@query("confusion_matrix", TX_CTE + f", m AS (SELECT {_MATRIX} FROM (SELECT {SCORE} >= 0.6 AS d, is_fraud AS y FROM tx)) SELECT *, {_RATES} FROM m")
def confusion_matrix(spark, sf_dir):
    out = metrics.confusion_matrix(_scores(spark, sf_dir), F.col("score") >= 0.6, F.col("is_fraud"))
    return out.select(*_COUNTS, six("false_positive_rate"), six("false_negative_rate"), six("f1_score"))


@query("threshold_recall", _CURVE + "SELECT round(threshold, 9) AS threshold, round(f1, 6) AS f1 FROM f WHERE recall >= 0.92 ORDER BY f.f1 DESC, f.threshold LIMIT 1")
def threshold_recall(spark, sf_dir):
    return metrics.best_threshold(_scores(spark, sf_dir), "score", "is_fraud", 0.92).select(
        F.round("threshold", 9).alias("threshold"), six("f1"))


@query("threshold_f1", _CURVE + "SELECT round(threshold, 9) AS threshold, round(f1, 6) AS f1 FROM f ORDER BY f.f1 DESC, f.threshold LIMIT 1")
def threshold_f1(spark, sf_dir):
    return metrics.best_threshold(_scores(spark, sf_dir), "score", "is_fraud").select(
        F.round("threshold", 9).alias("threshold"), six("f1"))


@query("evaluate", _CURVE + f""", m AS (SELECT {_MATRIX} FROM (SELECT {SCORE} >= 0.6 AS d, is_fraud AS y FROM tx)),
top AS (SELECT precision, recall FROM f ORDER BY f1 DESC, threshold DESC LIMIT 1)
SELECT round({_AUC}, 6) AS roc_auc, (SELECT round(sum(pos * 1e0 / all_pos * precision), 6) FROM f) AS pr_auc,
  (SELECT round(precision, 6) FROM top) AS precision, (SELECT round(recall, 6) FROM top) AS recall, m.*, {_RATES} FROM m""")
def evaluate(spark, sf_dir):
    out = metrics.evaluate(_scores(spark, sf_dir), "score", "is_fraud", F.col("score") >= 0.6)
    return out.select(six("roc_auc"), six("pr_auc"), six("precision"), six("recall"), *_COUNTS,
                      six("false_positive_rate"), six("false_negative_rate"), six("f1_score"))


@query("performance_drop", TX_CTE + f""", s0 AS (SELECT t >= 1705276800 AS cur, {SCORE} AS threshold, is_fraud AS y FROM tx),
auc AS (SELECT a.cur, avg(CASE WHEN a.threshold > b.threshold THEN 1e0 WHEN a.threshold = b.threshold THEN 0.5 ELSE 0 END) AS auc
  FROM s0 a JOIN s0 b ON a.cur = b.cur AND a.y = 1 AND b.y = 0 GROUP BY 1)
SELECT round(max(auc) FILTER (NOT cur) - max(auc) FILTER (cur), 6) AS performance_drop,
  (SELECT CAST(abs(avg(y) FILTER (NOT cur) - avg(y) FILTER (cur)) > 0.05 AS INT) FROM s0) AS concept_drift FROM auc""")
def performance_drop(spark, sf_dir):
    rows = _scores(spark, sf_dir).withColumn("is_current", C.epoch("timestamp") >= 1705276800)
    out = drift.performance_drop(rows, "score", "is_fraud", "is_current")
    return out.select(six("performance_drop"), F.col("concept_drift").cast("int"))
