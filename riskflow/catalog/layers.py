"""Sources, sinks, cleansing, joins and quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskflow import schemas as S
from riskflow.catalog.registry import big, query, six
from riskflow.functions import columns as C
from riskflow.operators import cleanse, quality
from riskflow.plans import jobs
from riskflow.session import scratch_dir
from riskflow.sources import tables as IO
from riskflow.sources.testdata import RAW_CTE, TX_CTE, raw_transactions, table, transactions

_ORDER = ("ingest_seq",)


def _text_ts():
    return F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp")


_TXT = "strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S')"

# -- sources ------------------------------------------------------------------------------


@query("src_json_roundtrip", TX_CTE + f"""SELECT CAST(transaction_id AS VARCHAR) AS transaction_id,
  round(amount, 6) AS amount, {_TXT} AS "timestamp", country_code, CAST(card_present AS INT) AS card_present FROM tx""")
def src_json_roundtrip(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    path = scratch_dir(spark, "raw-json")
    tx.select(F.col("transaction_id").cast("string"), F.col("amount").cast("string"), _text_ts(),
              "country_code", "card_present").write.json(path)
    raw = IO.read_raw(spark, path)
    return raw.select("transaction_id", F.round(F.col("amount").try_cast("double"), 6).alias("amount"), "timestamp",
                      "country_code", F.col("card_present").cast("int"))


@query("scan_layer", "SELECT event_id, user_id, round(value, 6) AS value FROM events WHERE event_type = 'purchase'")
def scan_layer(spark, sf_dir):
    return IO.read_layer(spark, f"{sf_dir}/events.parquet").where("event_type = 'purchase'").select(
        "event_id", "user_id", six("value"))


@query("scan_recursive", TX_CTE + "SELECT transaction_id, round(amount, 6) AS amount, transaction_type FROM tx")
def scan_recursive(spark, sf_dir):
    path = scratch_dir(spark, "training")
    tx = transactions(spark, sf_dir).select("transaction_id", "amount", "transaction_type")
    IO.write_layer(tx.where("transaction_id % 2 = 0"), f"{path}/a/even")
    IO.write_layer(tx.where("transaction_id % 2 = 1"), f"{path}/b/c/odd")
    return IO.read_training(spark, path).select("transaction_id", six("amount"), "transaction_type")


@query("union_segments", """SELECT event_type, count(*) AS n, count(value) AS n_value FROM (
  SELECT event_type, value FROM events WHERE user_id % 2 = 0 UNION ALL
  SELECT event_type, NULL AS value FROM events WHERE user_id % 2 = 1) GROUP BY event_type""")
def union_segments(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    both = IO.union_all([events.where("user_id % 2 = 0").select("event_type", "value"),
                         events.where("user_id % 2 = 1").select("event_type")])
    return both.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("n_value"))


@query("scan_month", """SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice FROM orders
WHERE strftime(o_orderdate, '%Y-%m') = '1996-03'""")
def scan_month(spark, sf_dir):
    path = scratch_dir(spark, "months")
    orders = table(spark, sf_dir, "orders").withColumn("year_month", F.date_format("o_orderdate", "yyyy-MM"))
    IO.write_layer(orders, path, ["year_month"])
    return IO.read_month(spark, path, "1996-03").select("o_orderkey", six("o_totalprice"))


@query("arrival_check", """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS rows, CAST(1 AS BIGINT) AS files FROM events GROUP BY 1""")
def arrival_check(spark, sf_dir):
    events = IO.read_layer(spark, f"{sf_dir}/events.parquet")
    return IO.arrivals(events, F.date_format("ts", "yyyy-MM-dd"))


# -- sinks --------------------------------------------------------------------------------

@query("write_partitioned", TX_CTE + "SELECT transaction_type, count(*) AS n, round(CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE), 2) AS amount FROM tx GROUP BY 1")
def write_partitioned(spark, sf_dir):
    path = scratch_dir(spark, "partitioned")
    tx = transactions(spark, sf_dir).select("transaction_id", "amount", "transaction_type")
    IO.write_layer(tx, path, ["transaction_type"])
    # A rerun replaces the partitions it holds and no others.
    IO.write_layer(tx.where("transaction_type = 'UPI'"), path, ["transaction_type"])
    return IO.read_layer(spark, path).groupBy("transaction_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("amount").cast("decimal(18,2)")).cast("double"), 2).alias("amount"))


_SILVER = RAW_CTE + """, latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY ingest_seq DESC) AS rn FROM raw) WHERE rn = 1),
typed AS (SELECT *, try_cast("timestamp" AS TIMESTAMP) AS ts2, try_cast(amount AS DOUBLE) AS amt, try_cast(latitude AS DOUBLE) AS lat FROM latest),
flagged AS (SELECT *, coalesce(amt > 0 AND amt < 10000000, false) AS dq_amount_valid,
  coalesce(ts2 > TIMESTAMP '2020-01-01', false) AS dq_timestamp_valid,
  coalesce(length(customer_id) > 0, false) AS dq_customer_valid FROM typed),
silver AS (SELECT *, dq_amount_valid AND dq_timestamp_valid AND dq_customer_valid AS dq_passed,
  CASE currency WHEN 'USD' THEN 83.50 WHEN 'GBP' THEN 105.20 WHEN 'EUR' THEN 90.15 WHEN 'SGD' THEN 62.40
    WHEN 'AED' THEN 22.73 WHEN 'CNY' THEN 11.52 ELSE 1.00 END AS rate FROM flagged)
"""


def _silver(spark, sf_dir):
    return cleanse.silver(raw_transactions(spark, sf_dir), order=_ORDER)


@query("silver_null_ids", RAW_CTE + """SELECT count(DISTINCT transaction_id) AS n,
  count(DISTINCT transaction_id) FILTER (transaction_id % 3 = 0) AS without_id FROM raw""")
def silver_null_ids(spark, sf_dir):
    """Rows without an id stay, each content once."""
    raw = raw_transactions(spark, sf_dir).drop("ingest_seq").withColumn("account_number", F.col("transaction_id").cast("string"))
    bare = raw.withColumn("transaction_id", F.when(F.col("transaction_id") % 3 != 0, F.col("transaction_id")))
    silver = cleanse.silver(bare, order=("account_number",))
    return silver.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("transaction_id").isNull()).alias("without_id"))


@query("quarantine_rerun", _SILVER + "SELECT count(*) FILTER (NOT dq_passed) AS quarantined, count(*) FILTER (dq_passed) AS clean FROM silver")
def quarantine_rerun(spark, sf_dir):
    """The silver job run twice leaves both tables as one run does."""
    root = scratch_dir(spark, "rerun")
    IO.write_layer(cleanse.with_metadata(raw_transactions(spark, sf_dir), "b"), f"{root}/bronze")
    for _ in range(2):
        jobs.transform_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/quarantine")
    bad, clean = (IO.read_layer(spark, f"{root}/{t}").select(F.lit(t).alias("t")) for t in ("quarantine", "silver"))
    return bad.unionByName(clean).agg(F.count_if(F.col("t") == "quarantine").alias("quarantined"), F.count_if(F.col("t") == "silver").alias("clean"))


@query("quarantine_rows", _SILVER + "SELECT transaction_id, customer_id, CAST(dq_amount_valid AS INT) AS dq_amount_valid, CAST(dq_timestamp_valid AS INT) AS dq_timestamp_valid, CAST(dq_customer_valid AS INT) AS dq_customer_valid FROM silver WHERE NOT dq_passed")
def quarantine_rows(spark, sf_dir):
    path = scratch_dir(spark, "quarantine")
    _, bad = cleanse.split_by_quality(_silver(spark, sf_dir))
    IO.write_layer(bad, path, mode="append")
    flags = [F.col(c).cast("int") for c in ("dq_amount_valid", "dq_timestamp_valid", "dq_customer_valid")]
    return IO.read_layer(spark, path).select("transaction_id", "customer_id", *flags)


@query("merge_insert_only", """SELECT l_orderkey, count(*) AS n, round(sum(CAST(price AS DECIMAL(18,2))), 2)::DOUBLE AS price FROM (
  SELECT l_orderkey, l_linenumber, max(l_extendedprice) AS price FROM lineitem GROUP BY 1, 2) GROUP BY 1""")
def merge_insert_only(spark, sf_dir):
    """The first half is stored, then the whole table is merged twice; nothing is stored twice."""
    path = scratch_dir(spark, "merged")
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"), "l_orderkey", "l_extendedprice")
    order = ("l_extendedprice",)
    IO.write_layer(cleanse.latest_per_key(rows.where("l_orderkey % 2 = 0"), order=order), path, mode="append")
    for _ in range(2):
        IO.write_layer(cleanse.not_yet_stored(rows, IO.read_layer(spark, path), order=order), path, mode="append")
    # Few lines an order, stored apart: sums made before the exchange would hold nearly every row.
    stored = IO.read_layer(spark, path).select("l_orderkey", "l_extendedprice").repartition("l_orderkey")
    return stored.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("price"))


@query("schema_evolve", TX_CTE + "SELECT transaction_id, round(amount, 6) AS amount, CASE WHEN transaction_id % 2 = 1 THEN country_code END AS country_code FROM tx")
def schema_evolve(spark, sf_dir):
    path = scratch_dir(spark, "evolved")
    tx = transactions(spark, sf_dir)
    IO.write_layer(tx.where("transaction_id % 2 = 0").select("transaction_id", "amount"), path)
    IO.write_layer(tx.where("transaction_id % 2 = 1").select("transaction_id", "amount", "country_code"), path, mode="append")
    return spark.read.option("mergeSchema", "true").parquet(path).select("transaction_id", six("amount"), "country_code")


@query("write_csv", TX_CTE + f"SELECT count(*) AS n_samples, {len(S.MODEL_FEATURES)}::BIGINT AS n_features, round(avg(is_fraud), 6) AS fraud_rate FROM tx")
def write_csv(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    IO.write_csv(quality.dataset_profile(transactions(spark, sf_dir), S.MODEL_FEATURES), path)
    stored = spark.read.option("header", "true").schema("n_samples bigint, n_features bigint, fraud_rate double").csv(path)
    return stored.select("n_samples", "n_features", six("fraud_rate"))


# -- cleansing ----------------------------------------------------------------------------

@query("bronze_metadata", RAW_CTE + """SELECT transaction_id, ingest_seq, 'batch-1' AS _batch_id,
  strftime(try_cast("timestamp" AS TIMESTAMP), '%Y-%m-%d') AS _partition_date FROM raw""")
def bronze_metadata(spark, sf_dir):
    out = cleanse.with_metadata(raw_transactions(spark, sf_dir), "batch-1")
    return out.select("transaction_id", "ingest_seq", "_batch_id", F.date_format("_partition_date", "yyyy-MM-dd").alias("_partition_date"))


_PARTS = ["CAST(transaction_id AS VARCHAR)", "transaction_type", "CAST(merchant_id AS VARCHAR)", "country_code"]


@query("record_hash", TX_CTE + "SELECT transaction_id, sha256(" + " || ".join(
    f"coalesce(length({p}) || ':' || {p}, '-')" for p in _PARTS) + ") AS record_hash FROM tx")
def record_hash(spark, sf_dir):
    return transactions(spark, sf_dir).select("transaction_id", C.record_hash(
        ["transaction_id", "transaction_type", "merchant_id", "country_code"]).alias("record_hash"))


@query("record_hash_odd_values", TX_CTE + """, odd AS (SELECT transaction_id % 3 AS a, CASE transaction_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'x|y' ELSE 'x' END AS b,
  CASE transaction_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '|' WHEN 3 THEN 'y' ELSE '1:y' END AS c FROM tx)
SELECT count(*) AS n, count(DISTINCT (a, b, c)) AS hashes FROM odd""")
def record_hash_odd_values(spark, sf_dir):
    """As many hashes as different rows, with nulls, empty texts and separators in the values."""
    odd = transactions(spark, sf_dir).selectExpr(
        "transaction_id % 3 as a", "case transaction_id % 4 when 0 then null when 1 then '' when 2 then 'x|y' else 'x' end as b",
        "case transaction_id % 5 when 0 then null when 1 then '' when 2 then '|' when 3 then 'y' else '1:y' end as c")
    return odd.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(C.record_hash(["a", "b", "c"])).alias("hashes"))


@query("dedup_latest", RAW_CTE + "SELECT transaction_id, max(ingest_seq) AS ingest_seq FROM raw GROUP BY 1")
def dedup_latest(spark, sf_dir):
    return cleanse.latest_per_key(raw_transactions(spark, sf_dir), order=_ORDER).select("transaction_id", "ingest_seq")


@query("silver_cast", _SILVER + "SELECT transaction_id, coalesce(CAST(floor(epoch(ts2)) AS BIGINT), -1) AS t, round(amt, 6) AS amount, round(lat, 6) AS latitude FROM silver")
def silver_cast(spark, sf_dir):
    return _silver(spark, sf_dir).select("transaction_id", F.coalesce(C.epoch("timestamp"), F.lit(-1)).alias("t"), six("amount"), six("latitude"))


@query("calendar_parts", TX_CTE + """SELECT transaction_id, CAST(hour("timestamp") AS INT) AS hour_of_day, CAST(dayofweek("timestamp") + 1 AS INT) AS day_of_week,
  CAST(weekofyear("timestamp") AS INT) AS week_of_year, strftime("timestamp", '%Y-%m') AS year_month FROM tx""")
def calendar_parts(spark, sf_dir):
    return transactions(spark, sf_dir).withColumns(C.calendar_parts()).select("transaction_id", *C.calendar_parts())


@query("dq_flags", _SILVER + "SELECT transaction_id, CAST(dq_amount_valid AS INT) AS dq_amount_valid, CAST(dq_timestamp_valid AS INT) AS dq_timestamp_valid, CAST(dq_customer_valid AS INT) AS dq_customer_valid, CAST(dq_passed AS INT) AS dq_passed FROM silver")
def dq_flags(spark, sf_dir):
    names = ("dq_amount_valid", "dq_timestamp_valid", "dq_customer_valid", "dq_passed")
    return _silver(spark, sf_dir).select("transaction_id", *[F.col(c).cast("int") for c in names])


@query("silver_clean", _SILVER + "SELECT transaction_id, customer_id, strftime(ts2, '%Y-%m') AS year_month, round(CAST(round(CAST(amt AS DECIMAL(18,4)) * rate, 2) AS DOUBLE), 6) AS amount_inr FROM silver WHERE dq_passed")
def silver_clean(spark, sf_dir):
    clean, _ = cleanse.split_by_quality(_silver(spark, sf_dir))
    return clean.select("transaction_id", "customer_id", "year_month", six("amount_inr"))


@query("fx_normalize", TX_CTE + """, r AS (SELECT *, CASE currency WHEN 'USD' THEN 83.50 WHEN 'GBP' THEN 105.20 WHEN 'EUR' THEN 90.15 WHEN 'INR' THEN 1.00 END AS rate FROM tx)
SELECT transaction_id, CAST(rate IS NOT NULL AS INT) AS fx_known, round(CAST(coalesce(rate, 1.00) AS DOUBLE), 6) AS fx_rate_to_inr,
  round(CAST(round(CAST(amount AS DECIMAL(18,4)) * coalesce(rate, 1.00), 2) AS DOUBLE), 6) AS amount_inr FROM r""")
def fx_normalize(spark, sf_dir):
    return cleanse.normalize_currency(transactions(spark, sf_dir)).select(
        "transaction_id", F.col("fx_known").cast("int"), six("fx_rate_to_inr"), six("amount_inr"))


# Dated rates derived from the orders: per priority class and month, a rate from its mean price.
_RATES = """rates AS (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'USD' WHEN '2-HIGH' THEN 'GBP' ELSE 'EUR' END AS currency,
  CAST({trunc} AS DATE) AS valid_from, round(CAST(count(*) AS DOUBLE) / 8 + 50, 2) AS rate FROM orders GROUP BY 1, 2)"""


@query("fx_asof", TX_CTE + ", " + _RATES.format(trunc="date_trunc('month', o_orderdate)") + """,
ranged AS (SELECT *, lead(valid_from) OVER (PARTITION BY currency ORDER BY valid_from) AS valid_to FROM rates),
j AS (SELECT tx.*, rate FROM tx LEFT JOIN ranged r ON tx.currency = r.currency
  AND CAST("timestamp" AS DATE) - CAST(4 + 365 * (transaction_id % 20) AS INTEGER) >= r.valid_from
  AND (valid_to IS NULL OR CAST("timestamp" AS DATE) - CAST(4 + 365 * (transaction_id % 20) AS INTEGER) < valid_to))
SELECT transaction_id, CAST(rate IS NOT NULL AS INT) AS fx_known, round(coalesce(rate, 1.0), 6) AS fx_rate_to_inr,
  round(CAST(round(CAST(amount AS DECIMAL(18,4)) * CAST(coalesce(rate, 1.0) AS DECIMAL(12,4)), 2) AS DOUBLE), 6) AS amount_inr FROM j""")
def fx_asof(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    rates = orders.groupBy(
        F.expr("CASE o_orderpriority WHEN '1-URGENT' THEN 'USD' WHEN '2-HIGH' THEN 'GBP' ELSE 'EUR' END").alias("currency"),
        F.trunc("o_orderdate", "month").alias("valid_from")).agg(
            F.round(F.count(F.lit(1)).cast("double") / 8 + 50, 2).alias("rate"))
    tx = transactions(spark, sf_dir)
    day = F.expr("date_sub(to_date(timestamp), cast(4 + 365 * (transaction_id % 20) as int))")
    return cleanse.convert_as_of(tx, rates, day).select(
        "transaction_id", F.col("fx_known").cast("int"), six("fx_rate_to_inr"), six("amount_inr"))


# -- joins --------------------------------------------------------------------------------

def customer_reference(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("customer_segment"),
        F.expr("CASE WHEN c_acctbal < 0 THEN 'REVIEW' ELSE 'VERIFIED' END").alias("kyc_status"),
        (F.col("c_custkey") % 3650).cast("int").alias("account_age_days"),
        (F.col("c_nationkey") * 20 + 300).alias("credit_score"))


@query("enrich_customer", TX_CTE + """SELECT transaction_id, c_mktsegment AS customer_segment,
  CASE WHEN c_acctbal < 0 THEN 'REVIEW' ELSE 'VERIFIED' END AS kyc_status, CAST(c_custkey % 3650 AS BIGINT) AS account_age_days,
  CAST(c_nationkey * 20 + 300 AS BIGINT) AS credit_score FROM tx LEFT JOIN customer ON c_custkey = customer_id""")
def enrich_customer(spark, sf_dir):
    out = cleanse.enrich(transactions(spark, sf_dir), customer_reference(spark, sf_dir), "customer_id", S.CUSTOMER_ATTRIBUTES)
    return out.select("transaction_id", "customer_segment", "kyc_status", big("account_age_days"), big("credit_score"))


@query("enrich_merchant", TX_CTE + """SELECT transaction_id, 'm' || CAST(merchant_id AS VARCHAR) AS merchant_name, s_name AS ref_merchant_name,
  CASE WHEN s_acctbal < 0 THEN 'HIGH' WHEN s_acctbal IS NOT NULL THEN 'LOW' END AS merchant_risk_band,
  coalesce(CAST(s_nationkey + 5000 AS BIGINT), -1) AS mcc_code, coalesce(CAST(s_suppkey % 7 = 0 AS INT), -1) AS on_watchlist
FROM tx LEFT JOIN supplier ON s_suppkey = merchant_id""")
def enrich_merchant(spark, sf_dir):
    reference = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("merchant_id"), F.col("s_name").alias("merchant_name"),
        F.expr("CASE WHEN s_acctbal < 0 THEN 'HIGH' ELSE 'LOW' END").alias("merchant_risk_band"),
        (F.col("s_nationkey") + 5000).alias("mcc_code"), (F.col("s_suppkey") % 7 == 0).alias("on_watchlist"))
    tx = transactions(spark, sf_dir).withColumn("merchant_name", F.concat(F.lit("m"), F.col("merchant_id").cast("string")))
    out = cleanse.enrich(tx, reference, "merchant_id", S.MERCHANT_ATTRIBUTES, "ref_")
    return out.select("transaction_id", "merchant_name", "ref_merchant_name", "merchant_risk_band",
                      F.coalesce(F.col("mcc_code").cast("bigint"), F.lit(-1)).alias("mcc_code"),
                      F.coalesce(F.col("on_watchlist").cast("int"), F.lit(-1)).alias("on_watchlist"))


# -- quality ------------------------------------------------------------------------------

def _typed(spark, sf_dir):
    return cleanse.cast_fields(raw_transactions(spark, sf_dir))


_TYPED = RAW_CTE + ", typed AS (SELECT *, try_cast(\"timestamp\" AS TIMESTAMP) AS ts2, try_cast(amount AS DOUBLE) AS amt FROM raw)\n"


@query("dq_null_rates", _TYPED + """SELECT round(avg(CASE WHEN transaction_id IS NULL THEN 1e0 ELSE 0 END), 6) AS transaction_id_null_rate,
  round(avg(CASE WHEN customer_id IS NULL THEN 1e0 ELSE 0 END), 6) AS customer_id_null_rate,
  round(avg(CASE WHEN amt IS NULL THEN 1e0 ELSE 0 END), 6) AS amount_null_rate,
  round(avg(CASE WHEN ts2 IS NULL THEN 1e0 ELSE 0 END), 6) AS timestamp_null_rate FROM typed""")
def dq_null_rates(spark, sf_dir):
    out = quality.quality_metrics(_typed(spark, sf_dir))
    return out.select(*[six(f"{c}_null_rate") for c in quality.KEY_COLUMNS])


@query("dq_amount_stats", _TYPED + "SELECT round(min(amt), 6) AS amount_min, round(max(amt), 6) AS amount_max, round(CAST(sum(CAST(amt AS DECIMAL(18,2))) AS DOUBLE) / count(amt), 4) AS amount_mean, round(stddev_samp(amt), 3) AS amount_stddev FROM typed")
def dq_amount_stats(spark, sf_dir):
    out = quality.quality_metrics(_typed(spark, sf_dir))
    return out.select(six("amount_min"), six("amount_max"), F.round("amount_mean", 4).alias("amount_mean"),
                      F.round("amount_stddev", 3).alias("amount_stddev"))


@query("dq_fraud_rate", TX_CTE + "SELECT round(avg(is_fraud), 6) AS fraud_rate, CAST(avg(is_fraud) > 0.05 AS INT) AS warned FROM tx")
def dq_fraud_rate(spark, sf_dir):
    out = quality.quality_metrics(transactions(spark, sf_dir))
    return out.select(six("fraud_rate"), F.array_contains("warnings", "fraud_rate").cast("int").alias("warned"))


@query("dq_freshness", "SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS max_timestamp FROM events")
def dq_freshness(spark, sf_dir):
    out = quality.quality_metrics(transactions(spark, sf_dir))
    return out.select(F.date_format("max_timestamp", "yyyy-MM-dd HH:mm:ss").alias("max_timestamp"))


@query("dq_pass_rate", _SILVER + "SELECT count(*) AS rows, count(*) FILTER (dq_passed) AS passed, round(avg(CAST(dq_passed AS INT)), 6) AS pass_rate FROM silver")
def dq_pass_rate(spark, sf_dir):
    return _silver(spark, sf_dir).agg(F.count(F.lit(1)).alias("rows"), F.count_if("dq_passed").alias("passed"),
                                      F.round(F.avg(F.col("dq_passed").cast("int")), 6).alias("pass_rate"))


@query("dedup_counts", """SELECT count(*) AS rows_before, count(DISTINCT (l_orderkey, l_linenumber)) AS rows_after,
  count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates_removed FROM lineitem""")
def dedup_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.struct("l_orderkey", "l_linenumber").alias("transaction_id"))
    return quality.duplicate_counts(rows)


@query("dq_gate", _TYPED + """SELECT count(*) AS record_count, round(avg(CASE WHEN amt IS NULL THEN 1e0 ELSE 0 END), 6) AS null_rate_amount,
  round(avg(CASE WHEN customer_id IS NULL THEN 1e0 ELSE 0 END), 6) AS null_rate_customer,
  count(*) FILTER (amt < 0) AS negative_amounts, count(*) - count(DISTINCT transaction_id) AS duplicate_txn_ids FROM typed""")
def dq_gate(spark, sf_dir):
    return quality.gate_report(_typed(spark, sf_dir)).select(
        "record_count", six("null_rate_amount"), six("null_rate_customer"), "negative_amounts", "duplicate_txn_ids")


@query("dataset_profile", TX_CTE + f"SELECT count(*) AS n_samples, CAST({len(S.MODEL_FEATURES)} AS BIGINT) AS n_features, round(avg(is_fraud), 6) AS fraud_rate FROM tx")
def dataset_profile(spark, sf_dir):
    return quality.dataset_profile(transactions(spark, sf_dir), S.MODEL_FEATURES).select("n_samples", "n_features", six("fraud_rate"))


@query("class_ratio", """SELECT count(*) FILTER (quality = 1) AS positives, count(*) FILTER (quality = 0) AS negatives,
  round(count(*) FILTER (quality = 0) * 1e0 / greatest(count(*) FILTER (quality = 1), 1), 6) AS pos_weight FROM labels""")
def class_ratio(spark, sf_dir):
    return quality.class_ratio(table(spark, sf_dir, "labels"), "quality").select("positives", "negatives", six("pos_weight"))
