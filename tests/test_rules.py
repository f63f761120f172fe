import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskflow.operators import rules as R

SCHEMA = ("transaction_id string, customer_id string, amount double, timestamp timestamp, transaction_type string,"
          "is_high_risk_merchant boolean, card_present boolean, is_international boolean, merchant_category string,"
          "hour_of_day int")
BASE = {"customer_id": "c", "amount": 1000.0, "transaction_type": "CREDIT_CARD", "is_high_risk_merchant": False,
        "card_present": True, "is_international": False, "merchant_category": "GROCERY", "hour_of_day": 14}


def frame(spark, rows, step=1):
    t0 = dt.datetime(2024, 1, 1, 12)
    names = [c.split()[0] for c in SCHEMA.split(",")]
    data = [{**BASE, "transaction_id": f"{i:05d}", "timestamp": t0 + dt.timedelta(seconds=i * step), **r}
            for i, r in enumerate(rows)]
    return spark.createDataFrame([tuple(d[n] for n in names) for d in data], SCHEMA)


@pytest.mark.parametrize("override, rules, score", [
    ({}, [], 0),
    ({"is_high_risk_merchant": True}, ["HIGH_RISK_MERCHANT"], 20),
    ({"card_present": False, "is_international": True}, ["CNP_INTERNATIONAL"], 40),
    ({"transaction_type": "ATM_WITHDRAWAL", "hour_of_day": 2}, ["OFF_HOURS_ATM"], 25),
    ({"transaction_type": "ATM_WITHDRAWAL", "hour_of_day": 5}, [], 0),
    ({"transaction_type": "ATM_WITHDRAWAL", "hour_of_day": None}, [], 0),
    ({"amount": 100_000.0}, [], 0),
    ({"amount": 100_000.01}, ["VELOCITY_AMOUNT"], 30),
    ({"amount": 1_500_000.0}, ["VELOCITY_AMOUNT", "LARGE_TRANSACTION"], 45),
    ({"amount": 75_000.0, "card_present": False}, ["CNP_HIGH_AMOUNT"], 30),
    ({"amount": 75_000.0, "card_present": None}, ["CNP_HIGH_AMOUNT"], 30),
    ({"card_present": None, "is_international": True}, [], 0),
    ({"amount": 0.0}, [], 0),
    ({"is_high_risk_merchant": True, "card_present": False, "is_international": True, "amount": 2_000_000.0},
     ["VELOCITY_AMOUNT", "HIGH_RISK_MERCHANT", "CNP_INTERNATIONAL", "LARGE_TRANSACTION", "CNP_HIGH_AMOUNT"], 100),
])
def test_each_rule(spark, override, rules, score):
    row = R.run_rules(frame(spark, [override])).first()
    assert row["rules_triggered"] == rules and row["rule_based_score"] == score
    assert row["requires_ml_scoring"] == (score >= 20)
    assert row["rule_severity"] == ("CRITICAL" if score >= 85 else "HIGH" if score >= 65 else "MEDIUM" if score >= 45 else "LOW")


def test_velocity_counts_earlier_rows_only(spark):
    out = R.run_rules(frame(spark, [{"amount": 100.0}] * 10)).orderBy("transaction_id").collect()
    assert [r["prior_count"] for r in out] == list(range(10))
    assert [("HIGH_VELOCITY" in r["rules_triggered"]) for r in out] == [False] * 8 + [True] * 2
    assert out[9]["rule_reasons"] == [">8 txns in 5 min (actual: 9)"]


def test_prior_amount_fires_the_amount_rule(spark):
    out = R.run_rules(frame(spark, [{"amount": 99_000.0}, {"amount": 5_000.0}])).orderBy("transaction_id").collect()
    assert out[1]["rules_triggered"] == ["VELOCITY_AMOUNT"]
    assert out[1]["rule_reasons"] == ["Amount velocity exceeded ₹100,000 in 5 min"]


def test_window_edge_slice_border_and_history_limit(spark):
    # 5 s apart: 60 earlier rows lie within 300 s, across the borders of the hourly slices.
    out = R.prior_activity(frame(spark, [{"amount": 1.0}] * 1500, step=5)).orderBy("transaction_id").collect()
    assert [r["prior_count"] for r in out] == [min(i, 60) for i in range(1500)]
    rows = frame(spark, [{"amount": 2.0}] * 300, step=0)
    dense = R.prior_activity(rows).orderBy("transaction_id").collect()
    assert [(r["prior_count"], r["prior_amount"]) for r in dense] == [(i, 2.0 * i) for i in range(300)]
    capped = R.prior_activity(rows, R.RuleLimits(history=100)).orderBy("transaction_id").collect()
    assert [r["prior_count"] for r in capped] == [min(i, 100) for i in range(300)] and capped[-1]["prior_amount"] == 200.0


def test_prior_activity_of_odd_rows(spark):
    rows = frame(spark, [{"amount": a, "customer_id": c} for a, c in
                         [(0.004, "c"), (None, "c"), (0.004, None), (0.0125, "c"), (1.0, None)]])
    rows = rows.unionByName(rows.limit(1).withColumn("timestamp", F.lit(None).cast("timestamp")).withColumn("transaction_id", F.lit("x")))
    got = {r["transaction_id"]: (r["prior_count"], r["prior_amount"]) for r in R.prior_activity(rows).collect()}
    assert got == {"00000": (0, 0.0), "00001": (1, 0.004), "00002": (0, 0.0), "00003": (2, 0.004), "00004": (1, 0.004), "x": (0, 0.0)}


def test_repeats_of_null_and_large_keys(spark):
    rows = spark.createDataFrame([(None, 0), (None, 30), (None, 61), (2**60 + 1, 0), (2**60 + 1, 10), (2**60 + 3, 10)], "k long, s long")
    out = R.first_within(rows.withColumn("timestamp", F.timestamp_seconds("s")), "k", 60)
    assert sorted(((r["k"] or 0), r["_t"]) for r in out.collect()) == [(0, 0), (0, 61), (2**60 + 1, 0), (2**60 + 3, 10)]


def test_session_mode_of_the_engine(spark):
    rows = frame(spark, [{"amount": 60_000.0}] * 3, step=200)
    assert [r["prior_count"] for r in R.run_rules(rows, mode="ttl_session").orderBy("transaction_id").collect()] == [0, 1, 2]
    with pytest.raises(ValueError):
        R.run_rules(rows, mode="other")


def test_session_counter_starts_again_after_idle_time(spark):
    rows = frame(spark, [{"amount": 10.0}] * 4).withColumn("timestamp", F.expr(
        "timestamp + make_interval(0, 0, 0, 0, 0, 0, element_at(array(0, 200, 450, 800), int(transaction_id) + 1))"))
    out = R.prior_in_session(rows).orderBy("transaction_id").collect()
    # Seconds 0, 201, 452, 803: only the last gap is 300 s or more.
    assert [(r["prior_count"], r["prior_amount"]) for r in out] == [(0, 0.0), (1, 10.0), (2, 20.0), (0, 0.0)]


def test_answers_are_reused_until_they_expire(spark):
    rows = frame(spark, [{}] * 6).withColumn("timestamp", F.expr(
        "timestamp_seconds(1000000 + element_at(array(0, 30, 59, 60, 100, 121), int(transaction_id) + 1))"))
    out = sorted(r["_t"] - 1_000_000 for r in R.first_within(rows, "customer_id", 60).collect())
    assert out == [0, 60, 121]


def test_sessions_go_on_over_blocks(spark):
    """Blocks of a day change nothing, with sessions that last several blocks, rows without a customer and rows without a time."""
    import random

    from riskflow.operators.rules import prior_in_session

    rng = random.Random(9)
    rows = [(i, rng.choice(["a", "b", None]), 3600 * rng.randrange(0, 24 * 12) + rng.randrange(2), float(rng.randrange(1, 9))) for i in range(300)]
    df = spark.createDataFrame(rows, "transaction_id long, customer_id string, s long, amount double").withColumn("timestamp", F.timestamp_seconds(F.col("s") + 1_700_000_000))
    df = df.unionByName(df.limit(1).withColumns({"timestamp": F.lit(None).cast("timestamp"), "transaction_id": F.lit(999).cast("long")}))
    whole, cut = ({r.transaction_id: (r.prior_count, r.prior_amount) for r in prior_in_session(df, 4 * 3600, block_days=b).collect()} for b in (10_000, 1))
    want = {}
    for c in ("a", "b", None):
        last, n, total = None, 0, 0.0
        for i, _, s, amount in sorted((r for r in rows if r[1] == c), key=lambda r: (r[2], r[0])):
            if last is None or s - last >= 4 * 3600:
                n, total = 0, 0.0
            want[i] = (n, total)
            last, n, total = s, n + 1, total + amount
    assert {i: v for i, v in cut.items() if i != 999} == want and whole == cut and max(n for n, _ in want.values()) > 10
