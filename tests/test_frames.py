"""Frame totals against brute force over all pairs of rows."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from riskflow import schemas as S
from riskflow.operators import features as X
from riskflow.operators.frames import KeyedFrames, units
from riskflow.operators.quantiles import frame_median

DAY = 86400
START = 1_704_067_200


def make_rows(n=400, seed=7):
    """One key has a third of the rows; some keys are null, some rows share a second or lie on a frame edge."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rnd.choice(["a", "b", None])
        t = START + rnd.choice([rnd.randrange(0, 95 * DAY), 3600 * rnd.randrange(0, 48)])
        rows.append((i, key, t, round(rnd.uniform(0.01, 5000), 2), rnd.choice(["x", "y", "z", None])))
    return rows


@pytest.fixture(scope="module")
def table(spark):
    rows = make_rows()
    df = spark.createDataFrame(rows, "transaction_id long, k string, _t long, amount double, v string")
    return rows, df


@pytest.mark.parametrize("block_days", [1, 7, 400])
def test_totals_distincts_and_sole_values(table, block_days):
    rows, df = table
    frames = (KeyedFrames("k", block_days).count("n_1h", 3600).count("n_30d", 30 * DAY)
              .total("s_7d", 7 * DAY, units("amount")).distinct("d_7d", 7 * DAY, "v").distinct("d_1h", 3600, "v")
              .sole_values("sole", 30 * DAY, "coalesce(v, '')").first_second("first"))
    got = {r["transaction_id"]: r for r in frames.attach(df).collect()}
    assert len(got) == len(rows)
    for i, k, t, _, v in rows:
        def frame(s):
            return [r for r in rows if r[1] == k and t - s <= r[2] <= t]
        g = got[i]
        assert g["n_1h"] == len(frame(3600))
        assert g["n_30d"] == len(frame(30 * DAY))
        assert g["s_7d"] == sum(round(r[3] * 10_000) for r in frame(7 * DAY))
        assert g["d_7d"] == len({r[4] for r in frame(7 * DAY)} - {None})
        assert g["d_1h"] == len({r[4] for r in frame(3600)} - {None})
        alone = len([r for r in frame(30 * DAY) if r[4] == v]) <= 1
        assert ((v or "") in (g["sole"] or [])) == alone
        assert g["first"] == min(r[2] for r in rows if r[1] == k)


@pytest.mark.parametrize("block_days", [1, 30])
def test_previous_row_and_day_totals(table, block_days):
    rows, df = table
    frames = (KeyedFrames("k", block_days).previous_row("struct(_t as ts, transaction_id as id)")
              .max_day_total("top", units("amount")).total_today("today", units("amount")))
    got = {r["transaction_id"]: r for r in frames.attach(df).collect()}
    for i, k, t, _, _ in rows:
        mine = [r for r in rows if r[1] == k]
        before = [(r[2], r[0]) for r in mine if r[2] < t]
        assert (tuple(got[i]["_prev"]) if got[i]["_prev"] else None) == (max(before) if before else None)
        totals = {}
        for r in mine:
            totals[r[2] // DAY] = totals.get(r[2] // DAY, 0) + round(r[3] * 10_000)
        assert got[i]["top"] == max(totals[r[2] // DAY] for r in mine if t - 30 * DAY <= r[2] <= t)
        assert got[i]["today"] == sum(round(r[3] * 10_000) for r in mine if r[2] // DAY == t // DAY and r[2] <= t)


@pytest.mark.parametrize("hot_rows", [10_000, 50, 0])
def test_median_is_the_same_by_both_ways(table, hot_rows):
    rows, df = table
    keyed = df.withColumn("_key", F.col("k"))
    got = {(r["_key"], r["_t"]): r["m"] for r in frame_median(keyed, 30 * DAY, "m", hot_rows).collect()}
    for _, k, t, _, _ in rows:
        inside = [r[3] for r in rows if r[1] == k and t - 30 * DAY <= r[2] <= t]
        assert got[(k, t)] == pytest.approx(statistics.median_low(inside))


def transactions(spark, rows):
    base = {"transaction_type": "UPI", "is_international": False, "card_present": True, "is_high_risk_merchant": False,
            "merchant_id": "m1", "merchant_category": "GROCERY", "device_id": "d1", "ip_address": "i1",
            "country_code": "IND", "latitude": 10.0, "longitude": 20.0, "card_bin": "c1", "is_fraud": 0}
    full = [{**base, "customer_id": "c", "transaction_id": str(i), **r} for i, r in enumerate(rows)]
    schema = ("transaction_id string, customer_id string, amount double, timestamp timestamp, transaction_type string,"
              "is_international boolean, card_present boolean, is_high_risk_merchant boolean, merchant_id string,"
              "merchant_category string, device_id string, ip_address string, country_code string, latitude double,"
              "longitude double, card_bin string, is_fraud int")
    names = [c.split()[0] for c in schema.split(",")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], schema).withColumns(
        {"hour_of_day": F.hour("timestamp"), "day_of_week": F.dayofweek("timestamp")})


def at(hours):
    return dt.datetime(2024, 3, 1) + dt.timedelta(hours=hours)


def test_all_features_on_a_small_history(spark):
    df = transactions(spark, [
        {"amount": 100.0, "timestamp": at(0)},
        {"amount": 300.0, "timestamp": at(1), "latitude": 40.0, "country_code": "USA", "is_international": True},
        {"amount": 200.0, "timestamp": at(30), "is_fraud": 1, "card_present": None},
        {"amount": 50.0, "timestamp": at(2), "customer_id": "other", "card_bin": "c2", "merchant_id": None},
    ])
    g = {r["transaction_id"]: r.asDict() for r in X.gold_table(X.build_features(df)).collect()}
    assert len(S.ENGINEERED_FEATURES) == 43 and set(S.ENGINEERED_FEATURES) <= set(g["0"])
    assert [g[i]["txn_count_1h"] for i in "012"] == [1, 2, 1]          # the edge of the hour is inside
    assert [g[i]["velocity_spike"] for i in "012"] == [1, 1, 1]
    assert g["0"]["amt_zscore_30d"] == 0.0 and g["1"]["amt_zscore_30d"] == pytest.approx(100 / 141.4213562)
    assert g["1"]["max_single_day"] == 400.0 and g["0"]["max_single_day"] == 400.0
    assert g["2"]["median_txn_amount_30d"] == 200.0 and g["2"]["pct_cnp_30d"] == 0.0
    assert g["1"]["is_impossible_travel"] == 1 and g["1"]["distance_from_last_txn_km"] == pytest.approx(3330.0)
    assert [g[i]["is_new_country"] for i in "012"] == [1, 1, 0]
    assert g["2"]["home_country_pct"] == pytest.approx(2 / 3)
    assert [g[i]["days_since_last_txn"] for i in "012"] == [30.0, 0.0, 1.0]
    assert g["3"]["device_customer_count_7d"] == 2 and g["3"]["merchant_txn_count_7d"] == 1
    assert g["2"]["device_fraud_rate_30d"] == pytest.approx(0.25)
    assert g["2"]["customer_risk_score_hist"] == 0.0
    later = X.add_velocity_features(df, as_of=True).where("transaction_id = '0'").first()
    assert later["max_single_day"] == 100.0
    clean = X.add_device_features(df, exclude_current=True).where("transaction_id = '2'").first()
    assert clean["device_fraud_rate_30d"] == 0.0


def test_columns_that_are_absent_are_left_out(spark):
    df = transactions(spark, [{"amount": 1.0, "timestamp": at(0)}]).drop("is_fraud")
    gold = X.gold_table(X.build_features(df))
    assert "is_fraud" not in gold.columns
    assert gold.first()["device_fraud_rate_30d"] == 0.0
    filled = X.backfill_features(df).first()
    assert filled["txn_count_1h"] == 0.0 and filled["is_fraud"] == 0


def test_sketches_are_near_the_exact_counts(spark):
    """Within 5 % on all keys, also where frames hold thousands of values; the slices can be kept and given."""
    from riskflow.operators.sketches import approx_distinct, second_sketches, slice_sketches

    rows = spark.range(60_000).select((F.col("id") % 4).alias("k"), (F.col("id") * 7 - F.col("id") % 11).alias("_t"), F.col("id").alias("transaction_id"),
                                      F.when(F.col("id") % 4 == 0, F.pmod(F.xxhash64("id"), F.lit(9000))).when(F.col("id") % 4 == 1, F.col("id") % 12)
                                      .when(F.col("id") % 4 == 2, F.lit(None)).otherwise(F.col("id")).alias("v"))
    exact = KeyedFrames("k").distinct("n", 86_400, "v").compute(rows)
    length = 86_400 // 24
    kept = slice_sketches(second_sketches(rows, "k", "v"), length)
    for state in (None, kept):
        near = approx_distinct(rows, "k", "v", 86_400, "about", 24, state=state)
        both = exact.join(near, ["_key", "_t"], "full")
        assert both.where("about is null or n is null or abs(about - n) > 0.05 * n").count() == 0
        assert both.count() == 60_000 and both.agg(F.max("n")).first()[0] > 2000
    assert kept.count() == kept.select("_key", "slice").distinct().count() < 600


def test_confirmed_sketches_are_exact_and_wrong_ones_stay_visible(spark):
    from riskflow.operators.sketches import approx_distinct, confirmed_distinct

    rows = spark.range(9_000).select((F.col("id") % 2).alias("k"), (F.col("id") * 7).alias("_t"), F.col("id").alias("transaction_id"), F.pmod(F.xxhash64("id"), F.lit(2500)).alias("v"))
    exact = {tuple(r) for r in KeyedFrames("k").distinct("n", 86_400, "v").compute(rows).collect()}
    assert {tuple(r) for r in confirmed_distinct(rows, "k", "v", 86_400, "n", 24).collect()} == exact
    assert {tuple(r) for r in approx_distinct(rows, "k", "v", 86_400, "n", 24).collect()} != exact
    assert {tuple(r) for r in confirmed_distinct(rows, "k", "v", 86_400, "n", 24, error=0).collect()} != exact


def test_median_does_not_depend_on_the_size_of_a_key(spark):
    from riskflow.operators.quantiles import frame_median

    rows = spark.range(400).select((F.col("id") % 3).alias("_key"), (F.col("id") * 9000).alias("_t"), (F.pmod(F.xxhash64("id"), F.lit(10**9)) / 1e6).alias("amount"))
    few, many = ({tuple(r) for r in frame_median(rows, 30 * 86400, "m", hot).collect()} for hot in (10_000, 1))
    assert few == many and len(few) == 400


@pytest.mark.parametrize("block_days", [1, 7])
def test_short_blocks_add_one_event_per_block_that_has_rows(spark, monkeypatch, block_days):
    rows = spark.range(300).selectExpr("id % 3 as k", f"id * {DAY} as _t", "id as transaction_id", "id % 2 as v")
    seen = []
    sweep = KeyedFrames._sweep
    monkeypatch.setattr(KeyedFrames, "_sweep", lambda self, events: (seen.append(events), sweep(self, events))[1])
    KeyedFrames("k", block_days).count("n_30d", 30 * DAY).count("n_90d", 90 * DAY).compute(rows)
    assert seen[0].count() <= 300 * 3 + 3 * (300 // block_days + 1)         # rows, exits, blocks; 90 and more per row before


def test_sliding_median_by_streams_of_keys(spark):
    nan = float("nan")
    rows = spark.createDataFrame([(None, 0, 5.0), (None, 1, 3.0), (None, 1, 4.0), (None, 100, 9.0), ("a", 0, nan), ("a", 1, 2.0), ("a", 2, nan)],
                                 "_key string, _t long, amount double")
    out = {(r["_key"], r["_t"]): r["m"] for r in frame_median(rows, 99, "m").collect()}
    assert out.pop(("a", 0)) != 0 and out.pop(("a", 2)) != 0               # not a number
    assert out == {(None, 0): 5.0, (None, 1): 4.0, (None, 100): 4.0, ("a", 1): 2.0}


def test_ranks_of_values_count_the_different_values_of_a_key(spark):
    from riskflow.operators.quantiles import _ranked

    codes = [-70_000, -1, 0, 3, 65_536, 65_537, 10**11]
    rows = spark.createDataFrame([(k, c) for k in (None, "a") for c in codes[:4 if k else 7] for _ in range(3)], "_key string, _c long")
    got = {(r["_key"], r["_c"]): r["_rank"] for r in _ranked(rows).collect()}
    assert got == {(k, c): i for k in (None, "a") for i, c in enumerate(codes[:4 if k else 7])}


def test_rounds_of_the_median_search_follow_the_number_of_values(spark, monkeypatch):
    from riskflow.operators import quantiles

    calls = []
    run = quantiles._running
    monkeypatch.setattr(quantiles, "_running", lambda *args: (calls.append(1), run(*args))[1])
    rows = spark.range(40).selectExpr("cast(null as string) as _key", "id as _t", "1e6D * (id % 5 - 2) as amount")
    out = {r["_t"]: r["m"] for r in frame_median(rows, 9, "m", hot_rows=0).collect()}
    want = {t: sorted(1e6 * (i % 5 - 2) for i in range(max(0, t - 9), t + 1))[(min(t + 1, 10) - 1) // 2] for t in range(40)}
    assert out == want and len(calls) == 2                                  # the sizes and one round of four bits; eleven rounds before


def test_rows_of_one_second_are_looked_up_where_the_customer_join_has_them(spark):
    """Equal seconds, null customers and null times give what the geographic features alone give, without an exchange for the look-up."""
    import re

    from riskflow.operators import features as X
    from riskflow.sources.testdata import transactions

    tx = transactions(spark, "/root/testdata/sf0.001").where("transaction_id < 300").withColumns({
        "customer_id": F.expr("if(transaction_id % 7 = 0, null, customer_id % 3)"),
        "timestamp": F.expr("if(transaction_id % 11 = 0, null, timestamp_seconds(floor(unix_timestamp(timestamp) / 86400) * 86400))")})
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        done = X.build_features(tx)
        assert not re.search(r"Exchange hashpartitioning\(customer_id#\w+, _t#", done._jdf.queryExecution().executedPlan().toString())
        wanted = ["transaction_id", "time_since_last_txn_min", "distance_from_last_txn_km", "implied_travel_speed_kmph", "is_new_country"]
        got, want = (sorted(map(tuple, x.select(wanted).collect())) for x in (done, X.add_geo_features(tx)))
        assert got == want and len(got) > 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_distinct_counts_of_the_query_are_stored_one_by_one(spark):
    """All four in one plan would keep the shuffle files of all of them until its end."""
    from riskflow.catalog.registry import QUERIES
    import riskflow.catalog.features  # noqa: F401

    plan = QUERIES["unique_counts_sketch"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 4 and "Window" not in plan and "hll" not in plan
