"""Model queries: the operators with their defaults on all model features of the gold table.

Splitting, sampling, scaling and calibration are checked on features that need no frame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from riskflow.catalog.registry import query, six
from riskflow.functions import columns as C
from riskflow.models import attribution as A
from riskflow.models import ensemble as E
from riskflow.models import forest as I
from riskflow.models import prepare as P
from riskflow.operators import features as X
from riskflow.operators.rules import run_rules
from riskflow.plans import jobs
from riskflow.schemas import MODEL_FEATURES
from riskflow.session import remove_scratch, scratch_dir
from riskflow.sources import tables as IO
from riskflow.sources.testdata import TX_CTE, transactions

COLUMNS = ["amount", "hour_of_day", "day_of_week", "is_international", "card_present", "latitude", "longitude",
           "typical_amount_band", "merchant_risk_tier", "is_atm"]


def training_rows(spark, sf_dir):
    tx = transactions(spark, sf_dir).withColumns({
        "typical_amount_band": C.amount_band(F.col("amount")),
        "merchant_risk_tier": C.merchant_risk_tier(F.col("is_high_risk_merchant"), F.col("merchant_category")),
        "is_atm": C.flag(F.col("transaction_type") == "ATM_WITHDRAWAL")})
    return P.assign_split(tx.select("transaction_id", "timestamp", *COLUMNS, "is_fraud"))


def gold_rows(spark, sf_dir):
    """The gold table, stored once, as the fits read it many times."""
    path, ruled = scratch_dir(spark, "gold"), scratch_dir(spark, "ruled")
    # As jobs.build_gold: the frames read the rows once per part.
    IO.write_layer(run_rules(transactions(spark, sf_dir)).drop(
        "rules_triggered", "rule_reasons", "rule_severity", "requires_ml_scoring", "prior_count", "prior_amount"), ruled)
    IO.write_layer(X.gold_table(X.build_features(IO.read_layer(spark, ruled))), path)
    remove_scratch(spark, ruled)
    return IO.read_layer(spark, path)


def _parts(spark, sf_dir):
    rows = P.assign_split(gold_rows(spark, sf_dir))
    return [rows.where(F.col("split") == s).drop("split") for s in ("train", "validation", "test")]


_BUCKET = "(('0x' || substr(md5('{seed}:' || CAST(transaction_id AS VARCHAR)), 1, 8))::BIGINT % 10000)"


@query("stratified_split", TX_CTE + f"SELECT transaction_id, CASE WHEN b < 1500 THEN 'test' WHEN b < 2775 THEN 'validation' ELSE 'train' END AS split FROM (SELECT transaction_id, {_BUCKET.format(seed=42)} AS b FROM tx)")
def stratified_split(spark, sf_dir):
    return P.assign_split(transactions(spark, sf_dir)).select("transaction_id", "split")


@query("kfold_assign", TX_CTE + f"SELECT transaction_id, CAST({_BUCKET.format(seed=43)} % 3 AS INT) AS fold FROM tx")
def kfold_assign(spark, sf_dir):
    return P.assign_fold(transactions(spark, sf_dir)).select("transaction_id", "fold")


@query("standardize", TX_CTE + """, m AS (SELECT avg(amount) AS ma, stddev_pop(amount) AS sa, avg(latitude) AS ml, stddev_pop(latitude) AS sl FROM tx)
SELECT transaction_id, round((amount - ma) / sa, 6) AS amount, round((latitude - ml) / sl, 6) AS latitude FROM tx, m""")
def standardize(spark, sf_dir):
    return P.standardize(transactions(spark, sf_dir), ["amount", "latitude"]).select("transaction_id", six("amount"), six("latitude"))


@query("bounded_sample", TX_CTE + f"SELECT transaction_id FROM tx ORDER BY ('0x' || substr(md5('42:' || CAST(transaction_id AS VARCHAR)), 1, 8))::BIGINT % 1073741824, transaction_id LIMIT 1000")
def bounded_sample(spark, sf_dir):
    """The explanation sample: the first 1000 rows in hash order."""
    tx = transactions(spark, sf_dir)
    return tx.orderBy(P.bucket("transaction_id", 42, 1 << 30), "transaction_id").limit(1000).select("transaction_id")


_WANTED = TX_CTE + """, c AS (SELECT count(*) FILTER (is_fraud = 1) AS few, count(*) FILTER (is_fraud = 0) AS many FROM tx),
w AS (SELECT few, many, greatest(CAST(floor(0.15::DOUBLE * many) AS BIGINT) - few, 0) AS made FROM c)
"""


@query("oversample", _WANTED + "SELECT 0 AS is_fraud, many AS n FROM w UNION ALL SELECT 1, few + made FROM w")
def oversample(spark, sf_dir):
    """Rows of both classes afterwards; the synthetic ones are counted by their values, so that they are made."""
    out = P.oversample(training_rows(spark, sf_dir), COLUMNS)
    return out.groupBy("is_fraud").agg(F.count("amount").alias("n"))


@query("oversample_minority", _WANTED + """SELECT CAST(made AS BIGINT) AS made, made AS within FROM w""")
def oversample_minority(spark, sf_dir):
    """Synthetic rows, and how many of them lie within the range of the minority in every column."""
    rows = training_rows(spark, sf_dir)
    made = P.oversample(rows, COLUMNS).where("is_synthetic")
    few = rows.where("is_fraud = 1")
    ends = few.agg(*[F.struct(F.min(F.col(c).cast("double")).alias("lo"), F.max(F.col(c).cast("double")).alias("hi")).alias(c) for c in COLUMNS]).first()
    inside = reduce(lambda a, b: a & b, [F.col(c).between(ends[c].lo - 1e-9, ends[c].hi + 1e-9) for c in COLUMNS])
    return made.agg(F.count(F.lit(1)).alias("made"), F.count_if(inside).alias("within"))


@query("gbt_primary")
def gbt_primary(spark, sf_dir):
    train, validation, test = _parts(spark, sf_dir)
    model = E.fit_primary(train, validation, MODEL_FEATURES)
    return model.probability(test, "p").select("transaction_id", six("p"), (F.col("p") >= model.threshold).cast("int").alias("prediction"))


@query("gbt_challenger")
def gbt_challenger(spark, sf_dir):
    train, validation, test = _parts(spark, sf_dir)
    model = E.fit_challenger(train, validation, MODEL_FEATURES)
    return model.probability(test, "p").select("transaction_id", six("p"), (F.col("p") >= model.threshold).cast("int").alias("prediction"))


@query("iforest_score")
def iforest_score(spark, sf_dir):
    rows = gold_rows(spark, sf_dir)
    forest = I.fit_forest(rows, MODEL_FEATURES)
    return forest.transform(rows.select("transaction_id", *MODEL_FEATURES)).select("transaction_id", six("anomaly_score"))


@query("platt")
def platt(spark, sf_dir):
    """Calibrated form of a raw score, fitted on the validation rows."""
    rows = training_rows(spark, sf_dir).withColumn("raw", F.expr("(transaction_id * 37 % 1000 + 400 * is_fraud) / 1400e0"))
    a, b = E.calibrate(rows.where("split = 'validation'"), "raw")
    return rows.where("split = 'test'").select("transaction_id", F.round(1 / (1 + F.exp(-(F.col("raw") * a + b))), 6).alias("p"))


@query("param_search", "SELECT CAST(trial AS INT) AS trial, true AS in_range, true AS folds_run FROM range(30) t(trial)")
def param_search(spark, sf_dir):
    """Every trial has its parameters in their ranges, a score, and all three folds."""
    train, _, _ = _parts(spark, sf_dir)
    inside = reduce(lambda a, b: a & b, [F.col(r.name).between(r.low, r.high) for r in E.search_space()])
    return E.search(train, MODEL_FEATURES).select("trial", (inside & F.col("pr_auc").between(0, 1)).alias("in_range"), (F.col("folds") == 3).alias("folds_run"))


def _ensemble(train, validation):
    return E.Ensemble(MODEL_FEATURES).fit(train, validation)


@query("ensemble_fit")
def ensemble_fit(spark, sf_dir):
    train, validation, test = _parts(spark, sf_dir)
    return _ensemble(train, validation).predict(test).groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))


@query("train_e2e", TX_CTE + f"""SELECT count(*) AS n, CAST(0 AS BIGINT) AS changed FROM (SELECT {_BUCKET.format(seed=42)} AS b FROM tx) WHERE b < 1500""")
def train_e2e(spark, sf_dir):
    """Split, fit, evaluate, store metrics and models; the stored models score the test rows as the fitted ones do."""
    train, validation, test = _parts(spark, sf_dir)
    model = _ensemble(train, validation)
    path = scratch_dir(spark, "training-run")
    model.save(spark, path)
    IO.write_layer(model.report(test), f"{path}/metrics")
    both = E.Ensemble.load(spark, path).score(model.score(test, "live"), "stored")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("live").eqNullSafe(F.col("stored"))).alias("changed"))


@query("batch_score", TX_CTE + "SELECT count(*) AS n, CAST(0 AS BIGINT) AS other_band FROM tx")
def batch_score(spark, sf_dir):
    """The scoring job on a stored ensemble: all rows are scored, each in the band of its score."""
    gold = gold_rows(spark, sf_dir)
    rows = P.assign_split(gold)
    train, validation = [rows.where(F.col("split") == s).drop("split") for s in ("train", "validation")]
    path = scratch_dir(spark, "scoring")
    _ensemble(train, validation).save(spark, f"{path}/model")
    IO.write_layer(gold, f"{path}/gold")
    summary = jobs.batch_score(spark, f"{path}/gold", f"{path}/scored", f"{path}/model")
    assert set(summary.columns) >= {"risk_band"}
    stored = IO.read_layer(spark, f"{path}/scored")
    right = C.risk_band(F.col("fraud_risk_score"))
    return stored.agg(F.count("fraud_risk_score").alias("n"), F.count_if(~F.col("risk_band").eqNullSafe(right)).alias("other_band"))


@query("top_features")
def top_features(spark, sf_dir):
    """The importance table, by way of its file."""
    train, validation, test = _parts(spark, sf_dir)
    path = scratch_dir(spark, "importance")
    IO.write_csv(E.importance(E.fit_primary(train, validation, MODEL_FEATURES), test), path)
    return spark.read.option("header", "true").schema("feature string, importance double").csv(path)


@query("row_contributions", TX_CTE + f"""SELECT transaction_id, CAST(10 AS BIGINT) AS features, true AS adds_up FROM (
  SELECT transaction_id, {_BUCKET.format(seed=42)} AS b FROM tx) WHERE b < 1500""")
def row_contributions(spark, sf_dir):
    """For every test row, the contributions of the ten features and the base add up to the margin."""
    rows, path = training_rows(spark, sf_dir), scratch_dir(spark, "rows")
    # Stored once in parts of 100,000 rows, as the input may have fewer parts than there are cores.
    IO.write_layer(rows.repartition(-(-rows.count() // 100_000) or 1), path)
    rows = IO.read_layer(spark, path)
    train, validation, test = [rows.where(F.col("split") == s).drop("split") for s in ("train", "validation", "test")]
    found = A.contributions(E.fit_primary(train, validation, COLUMNS), test, rows=None)
    return found.groupBy("transaction_id").agg(F.count("*").alias("features"), (
        F.abs(F.sum("contribution") + F.first("base") - F.first("margin")) < 1e-6).alias("adds_up"))
