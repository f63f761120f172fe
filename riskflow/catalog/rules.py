"""Rules, routing and stream queries. The check SQL finds prior rows with a self-join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from riskflow import schemas as S
from riskflow.catalog.registry import big, query, six
from riskflow.operators import features as X
from riskflow.operators import quality
from riskflow.operators import rules as R
from riskflow.session import scratch_dir
from riskflow.sources.testdata import TX_CTE, table, transactions
from riskflow.streaming import answers as A
from riskflow.streaming import engine as E
from riskflow.streaming import messages as M
from riskflow.streaming import rules_job as J

#: The test events are sparse, so the velocity rules look back a day here.
LIMITS = R.RuleLimits(window_s=86400, max_txn=4)

PRIOR_CTE = TX_CTE + """, prior AS (
  SELECT a.transaction_id AS id, count(b.transaction_id) AS prior_count,
    CAST(coalesce(sum(CAST(b.amount AS DECIMAL(18,2))), 0) AS DOUBLE) AS prior_amount
  FROM tx a LEFT JOIN tx b ON a.customer_id = b.customer_id AND b.t >= a.t - 86400
    AND (b."timestamp" < a."timestamp" OR (b."timestamp" = a."timestamp" AND b.transaction_id < a.transaction_id))
  GROUP BY 1)
"""
_FLAGS = {
    "HIGH_VELOCITY": "prior_count >= 4",
    "VELOCITY_AMOUNT": "prior_amount + amount > 100000",
    "HIGH_RISK_MERCHANT": "is_high_risk_merchant",
    "CNP_INTERNATIONAL": "NOT card_present AND is_international",
    "OFF_HOURS_ATM": "transaction_type = 'ATM_WITHDRAWAL' AND hour_of_day BETWEEN 1 AND 4",
    "LARGE_TRANSACTION": "amount > 1000000",
    "CNP_HIGH_AMOUNT": "NOT card_present AND amount > 50000",
}
_POINTS = " + ".join(f"CASE WHEN {test} THEN {R.POINTS[name]} ELSE 0 END" for name, test in _FLAGS.items())
_NAMES = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in _FLAGS.items())
BAND = "CASE WHEN {0} >= 85 THEN 'CRITICAL' WHEN {0} >= 65 THEN 'HIGH' WHEN {0} >= 45 THEN 'MEDIUM' ELSE 'LOW' END"
RULES_CTE = PRIOR_CTE + f""", ruled AS (SELECT tx.*, prior_count, prior_amount, least({_POINTS}, 100) AS score,
  concat_ws(',', {_NAMES}) AS names FROM tx JOIN prior ON id = transaction_id),
banded AS (SELECT *, {BAND.format('score')} AS band FROM ruled)
"""


def ruled(spark, sf_dir):
    return R.run_rules(transactions(spark, sf_dir), LIMITS)


@query("velocity_prior", PRIOR_CTE + "SELECT id AS transaction_id, prior_count, round(prior_amount, 6) AS prior_amount FROM prior")
def velocity_prior(spark, sf_dir):
    return R.prior_activity(transactions(spark, sf_dir), LIMITS).select("transaction_id", "prior_count", six("prior_amount"))


@query("velocity_prior_dense", TX_CTE + """, few AS (SELECT transaction_id AS id, customer_id % 3 AS k, amount, t, "timestamp" AS ts FROM tx)
SELECT a.id AS transaction_id, count(b.id) AS prior_count, round(CAST(coalesce(sum(CAST(b.amount AS DECIMAL(18,2))), 0) AS DOUBLE), 6) AS prior_amount
FROM few a LEFT JOIN few b ON a.k = b.k AND b.t >= a.t - 172800 AND (b.ts < a.ts OR (b.ts = a.ts AND b.id < a.id)) GROUP BY 1""")
def velocity_prior_dense(spark, sf_dir):
    """Three customers, whose windows of two days hold far more than a hundred rows."""
    few = transactions(spark, sf_dir).withColumn("customer_id", F.col("customer_id") % 3)
    return R.prior_activity(few, R.RuleLimits(window_s=172800)).select("transaction_id", "prior_count", six("prior_amount"))


_SESSION_CTE = TX_CTE + """, g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY customer_id ORDER BY "timestamp", transaction_id) < 21600 THEN 0 ELSE 1 END AS brk FROM tx),
s AS (SELECT *, sum(brk) OVER (PARTITION BY customer_id ORDER BY "timestamp", transaction_id) AS sess FROM g),
ruled AS (SELECT *, row_number() OVER (PARTITION BY customer_id, sess ORDER BY "timestamp", transaction_id) - 1 AS prior_count,
  CAST(coalesce(sum(CAST(amount AS DECIMAL(18,2))) OVER (PARTITION BY customer_id, sess ORDER BY "timestamp", transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS prior_amount FROM s)
"""


@query("rule_engine_ttl", _SESSION_CTE + f"SELECT transaction_id, CAST(least({_POINTS}, 100) AS INT) AS rule_based_score FROM ruled".replace("prior_count >= 4", "prior_count >= 1"))
def rule_engine_ttl(spark, sf_dir):
    """The rules on activity since the customer was last idle."""
    limits = R.RuleLimits(window_s=21600, max_txn=1)
    return R.run_rules(transactions(spark, sf_dir), limits, mode="ttl_session").select("transaction_id", "rule_based_score")


@query("velocity_ttl_session", TX_CTE + """, g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY customer_id ORDER BY "timestamp", transaction_id) < 21600 THEN 0 ELSE 1 END AS brk FROM tx),
s AS (SELECT *, sum(brk) OVER (PARTITION BY customer_id ORDER BY "timestamp", transaction_id) AS sess FROM g)
SELECT transaction_id, row_number() OVER (PARTITION BY customer_id, sess ORDER BY "timestamp", transaction_id) - 1 AS prior_count,
  round(CAST(coalesce(sum(CAST(amount AS DECIMAL(18,2))) OVER (PARTITION BY customer_id, sess ORDER BY "timestamp", transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE), 6) AS prior_amount FROM s""")
def velocity_ttl_session(spark, sf_dir):
    return R.prior_in_session(transactions(spark, sf_dir), 21600).select("transaction_id", big("prior_count"), six("prior_amount"))


@query("rule_engine", RULES_CTE + "SELECT transaction_id, " + ", ".join(
    f"CASE WHEN {t} THEN 1 ELSE 0 END AS {n.lower()}" for n, t in _FLAGS.items()) + " FROM ruled")
def rule_engine(spark, sf_dir):
    out = ruled(spark, sf_dir)
    return out.select("transaction_id", *[F.array_contains("rules_triggered", n).cast("int").alias(n.lower()) for n in _FLAGS])


_REASONS = """concat_ws('; ', CASE WHEN prior_count >= 4 THEN '>4 txns in 1440 min (actual: ' || prior_count || ')' END,
  CASE WHEN prior_amount + amount > 100000 THEN 'Amount velocity exceeded ₹100,000 in 1440 min' END,
  CASE WHEN is_high_risk_merchant THEN 'High-risk merchant category: ' || merchant_category END,
  CASE WHEN NOT card_present AND is_international THEN 'Card-not-present international transaction' END,
  CASE WHEN transaction_type = 'ATM_WITHDRAWAL' AND hour_of_day BETWEEN 1 AND 4 THEN 'ATM withdrawal at 0' || hour_of_day || ':00' END,
  CASE WHEN amount > 1000000 THEN 'Transaction amount ₹' || format('{:,}', CAST(round_even(amount, 0) AS BIGINT)) || ' exceeds threshold' END,
  CASE WHEN NOT card_present AND amount > 50000 THEN 'CNP transaction with high amount ₹' || format('{:,}', CAST(round_even(amount, 0) AS BIGINT)) END)"""


@query("rule_results", RULES_CTE + f"SELECT transaction_id, names AS rules, {_REASONS} AS reasons FROM ruled")
def rule_results(spark, sf_dir):
    return ruled(spark, sf_dir).select("transaction_id", F.concat_ws(",", "rules_triggered").alias("rules"),
                                       F.concat_ws("; ", "rule_reasons").alias("reasons"))


@query("enrich_score", RULES_CTE + "SELECT transaction_id, CAST(score AS INT) AS rule_based_score, band AS rule_severity, CAST(score >= 20 AS INT) AS requires_ml_scoring FROM banded")
def enrich_score(spark, sf_dir):
    return ruled(spark, sf_dir).select("transaction_id", "rule_based_score", "rule_severity", F.col("requires_ml_scoring").cast("int"))


@query("risk_history", RULES_CTE + """SELECT transaction_id, round(CAST(sum(score) OVER w AS DOUBLE) / count(*) OVER w, 6) AS customer_risk_score_hist
FROM ruled WINDOW w AS (PARTITION BY customer_id ORDER BY t RANGE BETWEEN 2592000 PRECEDING AND CURRENT ROW)""")
def risk_history(spark, sf_dir):
    return X.add_risk_history(ruled(spark, sf_dir)).select("transaction_id", six("customer_risk_score_hist"))


@query("route_topic", TX_CTE + """SELECT transaction_id, CAST(customer_id AS VARCHAR) AS key, CASE WHEN amount > 500000 THEN 'banking.transactions.high_value'
  WHEN is_international THEN 'banking.transactions.international' ELSE 'banking.transactions.raw' END AS topic FROM tx""")
def route_topic(spark, sf_dir):
    return M.to_input_topics(transactions(spark, sf_dir)).select(
        F.get_json_object("value", "$.transaction_id").cast("bigint").alias("transaction_id"), "key", "topic")


_ROUTED = """SELECT transaction_id, CAST(customer_id AS VARCHAR) AS key, CAST(score AS INT) AS score, topic FROM (
  SELECT *, 'banking.fraud.scored' AS topic FROM banded UNION ALL
  SELECT *, 'banking.fraud.alerts' AS topic FROM banded WHERE band IN ('CRITICAL', 'HIGH'))"""


def _routed(messages):
    return messages.select(F.get_json_object("value", "$.transaction_id").cast("bigint").alias("transaction_id"), "key",
                           F.get_json_object("value", "$.rule_based_score").cast("int").alias("score"), "topic")


@query("route_alerts", RULES_CTE + _ROUTED)
def route_alerts(spark, sf_dir):
    return _routed(M.to_output_topics(ruled(spark, sf_dir)))


@query("topic_counts", TX_CTE + """SELECT CASE WHEN amount > 500000 THEN 'banking.transactions.high_value'
  WHEN is_international THEN 'banking.transactions.international' ELSE 'banking.transactions.raw' END AS topic,
  count(*) AS messages, round(avg(is_fraud), 6) AS label_rate FROM tx GROUP BY 1""")
def topic_counts(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    routed = tx.select(M.C.input_topic(F.col("amount"), F.col("is_international")).alias("topic"), "is_fraud")
    return quality.topic_counts(routed).select("topic", "messages", six("label_rate"))


# -- messages -----------------------------------------------------------------------------

def message_text(spark, sf_dir, spread=False):
    """Transactions as JSON messages; some are cut short, some have an amount that is no number. `spread`: dealt over the tasks anew."""
    tx = transactions(spark, sf_dir)
    tx = (tx.repartition("transaction_id") if spread else tx).select(
        F.col("transaction_id").cast("string"), F.col("customer_id").cast("string"),
        F.when(F.col("transaction_id") % 101 == 0, "abc").otherwise(F.col("amount").cast("string")).alias("amount"),
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"), "transaction_type",
        "merchant_category", "is_high_risk_merchant", "card_present", "is_international", "hour_of_day")
    text = F.to_json(F.struct(*tx.columns))
    return tx.select(F.when(F.col("transaction_id").cast("bigint") % 103 == 0,
                            F.substring(text, 1, 30)).otherwise(text).alias("value"))


def stored_messages(spark, sf_dir):
    """The messages with the time that they carry (`sent`, null where it cannot be read), made once and by all cores, as the parts read them often."""
    path = scratch_dir(spark, "messages")
    wide = message_text(spark, sf_dir, spread=True)
    stamp = F.regexp_extract("value", '"timestamp":"([^"]*)"', 1)
    wide.withColumn("sent", F.when(stamp != "", F.to_timestamp(stamp, "yyyy-MM-dd HH:mm:ss.SSSSSS"))).write.parquet(path)
    return spark.read.parquet(path)


_GOOD = "transaction_id % 101 <> 0 AND transaction_id % 103 <> 0"


@query("decode_json", TX_CTE + f"SELECT transaction_id, round(amount, 6) AS amount, t, CAST(hour_of_day AS INT) AS hour_of_day FROM tx WHERE {_GOOD}")
def decode_json(spark, sf_dir):
    rows = M.readable(M.decode(message_text(spark, sf_dir)))
    return rows.select(F.col("transaction_id").cast("bigint").alias("transaction_id"), six("amount"),
                       F.unix_timestamp("timestamp").alias("t"), "hour_of_day")


@query("dead_letter", TX_CTE + """SELECT 'banking.transactions.dlq' AS topic, CASE WHEN transaction_id % 103 = 0 THEN 'malformed' ELSE 'amount' END AS reason,
  count(*) AS n FROM tx WHERE transaction_id % 101 = 0 OR transaction_id % 103 = 0 GROUP BY 1, 2""")
def dead_letter(spark, sf_dir):
    return M.dead_letters(M.decode(message_text(spark, sf_dir))).groupBy("topic", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("stream_metrics", RULES_CTE + f"""SELECT count(*) FILTER (ok) AS processed, count(*) FILTER (ok AND band IN ('CRITICAL', 'HIGH')) AS alerts,
  round(avg(CASE WHEN ok THEN transaction_id % 130 END), 6) AS avg_latency_ms, count(*) FILTER (transaction_id % 130 > 100) AS sla_breaches,
  count(*) FILTER (NOT ok) AS errors FROM (SELECT *, {_GOOD} AS ok FROM banded)""")
def stream_metrics(spark, sf_dir):
    processed = ruled(spark, sf_dir).withColumns({
        "is_error": ~F.expr(_GOOD), "latency_ms": (F.col("transaction_id") % 130).cast("double")})
    return quality.stream_metrics(processed).select("processed", "alerts", six("avg_latency_ms"), "sla_breaches", "errors")


@query("repeat_suppress", TX_CTE.replace("WITH tx", "WITH RECURSIVE tx") + """, recursive_seed AS (SELECT customer_id, min(t) AS t FROM tx GROUP BY 1),
secs AS (SELECT customer_id, t, count(*) AS requests FROM tx GROUP BY 1, 2),
chain AS (SELECT customer_id, t FROM recursive_seed UNION ALL
  SELECT c.customer_id, (SELECT min(s.t) FROM secs s WHERE s.customer_id = c.customer_id AND s.t >= c.t + 21600) AS t
  FROM chain c WHERE c.t IS NOT NULL)
SELECT c.customer_id, c.t, s.requests FROM chain c JOIN secs s USING (customer_id, t)""")
def repeat_suppress(spark, sf_dir):
    return R.first_within(transactions(spark, sf_dir), "customer_id", 21600).select(
        "customer_id", F.col("_t").alias("t"), "requests")


# -- streams ------------------------------------------------------------------------------

def _event_stream(spark, sf_dir):
    """The events file as a stream of transactions."""
    from riskflow.sources.testdata import _TX
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    tx = events.selectExpr(*[f"{e} AS `{n}`" for n, e in _TX.items()])
    return tx.withColumns({"timestamp": F.col("timestamp").cast("timestamp"), "hour_of_day": F.hour("timestamp")})


@query("stream_source", "SELECT event_id AS transaction_id, user_id AS customer_id FROM events")
def stream_source(spark, sf_dir):
    return J.run_to_table(_event_stream(spark, sf_dir).select("transaction_id", "customer_id"), "stream-source")


@query("stream_session_velocity", TX_CTE + """, g AS (SELECT *, CASE WHEN "timestamp" - lag("timestamp") OVER (PARTITION BY customer_id ORDER BY "timestamp", transaction_id) <= INTERVAL 21600 SECONDS THEN 0 ELSE 1 END AS brk FROM tx),
s AS (SELECT *, sum(brk) OVER (PARTITION BY customer_id ORDER BY "timestamp", transaction_id) AS sess FROM g),
a AS (SELECT customer_id, sess, count(*) AS txn_count, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount, max("timestamp") AS last_ts FROM s GROUP BY 1, 2)
SELECT customer_id, txn_count, round(amount, 6) AS amount FROM a WHERE last_ts + INTERVAL 21600 SECONDS <= (SELECT max("timestamp") FROM tx) - INTERVAL 600 SECONDS""")
def stream_session_velocity(spark, sf_dir):
    """Sessions that the watermark has closed."""
    out = J.run_to_table(J.session_velocity(_event_stream(spark, sf_dir), 21600), "session-velocity")
    return out.select("customer_id", "txn_count", six("amount"))


@query("stream_repeat_suppress", "SELECT DISTINCT event_id AS transaction_id FROM events")
def stream_repeat_suppress(spark, sf_dir):
    """Every request is sent twice in one second; each id is answered once."""
    twice = _event_stream(spark, sf_dir).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    return J.run_to_table(J.suppress_repeats(twice.select("transaction_id", "timestamp")), "repeats").select("transaction_id")


def _run_rules_stream(spark, sf_dir, parts: int = 1):
    """Messages as files, one trigger per part; the stream is stopped and restarted between parts."""
    base = scratch_dir(spark, "rules-stream")
    text = stored_messages(spark, sf_dir)
    # Consecutive time ranges of about as many messages arrive one after the other, unreadable ones with the first.
    seconds = F.unix_timestamp("sent")
    edges = text.agg(F.percentile_approx(seconds, [i / parts for i in range(1, parts)]) if parts > 1 else F.array()).first()[0]
    place = F.coalesce(reduce(lambda a, b: a + b, [(seconds >= e).cast("int") for e in edges], F.lit(0)), F.lit(0))
    for part in range(parts):
        cut = text.where(place == part).select("value")
        cut.write.mode("append").text(f"{base}/in")
        source = M.message_stream(spark, "text", path=f"{base}/in", maxFilesPerTrigger="1000")
        for q in J.start_rules(source, f"{base}/out", f"{base}/checkpoint", LIMITS):
            q.awaitTermination()
    return J.read_sink(spark, f"{base}/out", "routed", "topic string, key string, value string")


_GOOD_CTE = RULES_CTE.replace("FROM events)", f"FROM (SELECT * FROM events WHERE {_GOOD.replace('transaction_id', 'event_id')}))", 1)


@query("stream_rules_e2e", _GOOD_CTE + _ROUTED)
def stream_rules_e2e(spark, sf_dir):
    return _routed(_run_rules_stream(spark, sf_dir))


@query("stream_restart", _GOOD_CTE + _ROUTED)
def stream_restart(spark, sf_dir):
    """Two runs over one checkpoint: state and progress carry over, nothing is sent twice."""
    return _routed(_run_rules_stream(spark, sf_dir, parts=2))


# -- the settled stream -------------------------------------------------------------------

_LATE_S = 3 * 86400


def _arrivals(spark, sf_dir, parts, jitter_s=0):
    """The messages in parts of about equal size as they arrive, out of order by up to `jitter_s`; a last one moves the clock on."""
    text = stored_messages(spark, sf_dir).withColumn("at", F.unix_timestamp("sent") + F.pmod(F.xxhash64("value"), F.lit(jitter_s + 1)))
    edges, last = text.agg(F.percentile_approx("at", [i / parts for i in range(1, parts)] or [1.0]), F.max("at")).first()
    place = F.coalesce(reduce(lambda a, b: a + b, [(F.col("at") >= e).cast("int") for e in edges[:parts - 1]], F.lit(0)), F.lit(0))
    end = F.to_json(F.struct(F.lit("0").alias("transaction_id"), F.lit("clock").alias("customer_id"), F.lit("1").alias("amount"),
                             F.date_format(F.timestamp_seconds(F.lit(last + 10 * 86400)), "yyyy-MM-dd HH:mm:ss").alias("timestamp")))
    done = [text.where(place == part).select("value") for part in range(parts)]
    done[-1] = done[-1].unionByName(spark.range(1).select(end.alias("value")))
    return done


@query("stream_settled", _GOOD_CTE + _ROUTED)
def stream_settled(spark, sf_dir):
    """Messages out of order by up to two days, in three starts of one query over one checkpoint."""
    out, _ = E.run_parts(spark, _arrivals(spark, sf_dir, 3, 2 * 86400), LIMITS, late_s=_LATE_S)
    return _routed(E.committed(spark, out, "scored").unionByName(E.committed(spark, out, "alerts")))


_GOOD_SESSION_CTE = _SESSION_CTE.replace("FROM events)", f"FROM (SELECT * FROM events WHERE {_GOOD.replace('transaction_id', 'event_id')}))", 1)


@query("stream_ttl_rules", _GOOD_SESSION_CTE + f"SELECT transaction_id, prior_count, CAST(least({_POINTS}, 100) AS INT) AS rule_based_score FROM ruled".replace("prior_count >= 4", "prior_count >= 1"))
def stream_ttl_rules(spark, sf_dir):
    """The rules on activity since the customer was last idle, over a restart."""
    limits = R.RuleLimits(window_s=21600, max_txn=1)
    out, _ = E.run_parts(spark, _arrivals(spark, sf_dir, 2, 86400), limits, "ttl_session", _LATE_S)
    return E.committed(spark, out, "scored").select(*[F.get_json_object("value", f"$.{c}").cast(t).alias(c) for c, t in (
        ("transaction_id", "bigint"), ("prior_count", "bigint"), ("rule_based_score", "int"))])


@query("stream_sinks", _GOOD_CTE + """SELECT topic, NULL AS reason, count(*) AS n FROM (SELECT 'banking.fraud.scored' AS topic FROM banded UNION ALL
  SELECT 'banking.fraud.alerts' FROM banded WHERE band IN ('CRITICAL', 'HIGH')) GROUP BY 1
UNION ALL SELECT 'banking.transactions.dlq', CASE WHEN event_id % 103 = 0 THEN 'malformed' ELSE 'amount' END, count(*)
  FROM events WHERE event_id % 101 = 0 OR event_id % 103 = 0 GROUP BY 2""")
def stream_sinks(spark, sf_dir):
    """Messages per topic and reason in the three sinks of one query."""
    out, _ = E.run_parts(spark, _arrivals(spark, sf_dir, 1), LIMITS, late_s=_LATE_S)
    sinks = reduce(lambda a, b: a.unionByName(b), [E.committed(spark, out, kind) for kind in E.SINKS])
    return sinks.groupBy("topic", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("stream_counters", RULES_CTE.replace("FROM events)", f"FROM (SELECT * FROM events WHERE {_GOOD.replace('transaction_id', 'event_id')}))", 1) + """
SELECT count(*) AS processed, count(*) FILTER (band IN ('CRITICAL', 'HIGH')) AS alerts, count(*) FILTER (score >= 20) AS for_model,
  (SELECT count(*) FROM events WHERE event_id % 101 = 0 OR event_id % 103 = 0) AS errors, 0::BIGINT AS late, true AS has_latency FROM banded""")
def stream_counters(spark, sf_dir):
    """Totals of the stored counters over a restart; latencies are those of the run."""
    _, table = E.run_parts(spark, _arrivals(spark, sf_dir, 2), LIMITS, late_s=_LATE_S, counters=True)
    return table.totals().select("processed", "alerts", "for_model", "errors", "late", (F.col("avg_latency_ms") >= 0).alias("has_latency"))


@query("stream_answers", TX_CTE.replace("WITH tx", "WITH RECURSIVE tx") + """,
q AS (SELECT customer_id AS request_id, transaction_id, epoch_us("timestamp") AS us FROM tx),
chain AS (SELECT request_id, min(us) AS us FROM q GROUP BY 1 UNION ALL
  SELECT c.request_id, (SELECT min(q.us) FROM q WHERE q.request_id = c.request_id AND q.us >= c.us + 21600000000) FROM chain c WHERE c.us IS NOT NULL),
given AS (SELECT c.request_id, c.us, min(q.transaction_id) AS answer FROM chain c JOIN q USING (request_id, us) GROUP BY ALL)
SELECT q.transaction_id, CAST(q.request_id AS VARCHAR) AS request_id, CAST(g.answer AS VARCHAR) AS answer, g.answer <> q.transaction_id AS reused
FROM q ASOF JOIN given g ON g.request_id = q.request_id AND q.us >= g.us""")
def stream_answers(spark, sf_dir):
    """Requests under the customer's id, six hours to live: every request has one answer, repeats the first one's."""
    base = scratch_dir(spark, "requests")
    tx = transactions(spark, sf_dir).select(F.col("customer_id").cast("string").alias("request_id"), "timestamp", F.col("transaction_id").alias("rank"))
    cut = tx.agg(F.timestamp_seconds(F.percentile_approx(F.unix_timestamp("timestamp"), 0.5))).first()[0]
    for part in (F.col("timestamp") < cut, F.col("timestamp") >= cut):
        tx.where(part).write.mode("append").parquet(f"{base}/in")
        source = spark.readStream.schema(tx.schema).option("maxFilesPerTrigger", "1000").parquet(f"{base}/in")
        answered = A.answer_requests(source.withColumn("answer", F.to_json(F.struct("rank", "request_id"))), 21600, _LATE_S)
        answered.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(
            availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out").select(F.col("rank").alias("transaction_id"), "request_id", F.get_json_object("answer", "$.rank").alias("answer"), "reused")
