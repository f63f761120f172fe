import json

from pyspark.sql import functions as F

from riskflow import schemas as S
from riskflow.operators.rules import RuleLimits, run_rules
from riskflow.streaming import messages as M
from riskflow.streaming import rules_job as J


def lines(start, n, **over):
    return [json.dumps({"transaction_id": str(start + i), "customer_id": "c" if i % 3 else "d", "amount": "60000.5",
                        "timestamp": f"2024-01-01 10:{(start + i) // 60:02d}:{(start + i) % 60:02d}",
                        "transaction_type": "UPI", "is_high_risk_merchant": i % 4 == 0, "card_present": i % 2 == 0,
                        "is_international": False, "hour_of_day": 10, "device_id": "dev", "latitude": 1.25, **over}) for i in range(n)]


def test_stream_equals_batch_over_a_restart(spark, tmp_path):
    """Two runs over one checkpoint send what the batch form finds, once each."""
    limits = RuleLimits(window_s=60, max_txn=5, history=10)
    inbox = tmp_path / "in"
    inbox.mkdir()
    everything = []
    for part in range(2):
        text = lines(part * 90, 90) + (["{cut", json.dumps({"transaction_id": "x", "amount": "abc"})] if part else [])
        everything += text
        (inbox / f"{part}.txt").write_text("\n".join(text))
        stream = M.message_stream(spark, "text", path=str(inbox))
        for q in J.start_rules(stream, str(tmp_path / "out"), str(tmp_path / "cp"), limits):
            q.awaitTermination()
    sent = J.read_sink(spark, str(tmp_path / "out"), "routed", "topic string, key string, value string")
    batch = spark.createDataFrame([(t,) for t in everything], "value string")
    rows = M.readable(M.decode(batch)).withColumn("n", F.col("transaction_id").cast("int"))
    expected = run_rules(rows.withColumn("transaction_id", F.format_string("%05d", "n")), limits)
    want = {(int(r["transaction_id"]), r["prior_count"], r["rule_based_score"]) for r in expected.collect()}
    scored = sent.where(F.col("topic") == S.TOPIC_SCORED).select(*[
        F.get_json_object("value", f"$.{c}").cast("int") for c in ("transaction_id", "prior_count", "rule_based_score")]).collect()
    assert len(scored) == 180 and {tuple(r) for r in scored} == want
    record = json.loads(sent.where(F.col("topic") == S.TOPIC_SCORED).first()["value"])
    assert record["device_id"] == "dev" and record["latitude"] == 1.25 and "enriched_at" in record
    alerts = sent.where(F.col("topic") == S.TOPIC_ALERTS).count()
    assert alerts == expected.where("rule_severity in ('HIGH', 'CRITICAL')").count() > 0
    dead = J.read_sink(spark, str(tmp_path / "out"), "dead", "topic string, value string, reason string")
    assert sorted(r["reason"] for r in dead.collect()) == ["amount", "malformed"]


def test_late_rows_count_their_own_window_or_are_dead_letters(spark, tmp_path):
    def message(i, time):
        return json.dumps({"transaction_id": str(i), "customer_id": "c", "amount": "10", "timestamp": f"2024-01-01 {time}"})

    inbox = tmp_path / "in"
    inbox.mkdir()
    for part, text in enumerate([[message(1, "10:00:00"), message(2, "10:01:00"), message(3, "10:09:30")], [message(4, "10:01:30"), message(5, "09:59:00")]]):
        (inbox / f"{part}.txt").write_text("\n".join(text))
        for q in J.start_rules(M.message_stream(spark, "text", path=str(inbox)), str(tmp_path / "out"), str(tmp_path / "cp"), RuleLimits(window_s=60)):
            q.awaitTermination()
    sent = J.read_sink(spark, str(tmp_path / "out"), "routed", "topic string, key string, value string").where(F.col("topic") == S.TOPIC_SCORED)
    found = [json.loads(r["value"]) for r in sent.collect()]
    assert {(r["transaction_id"], r["prior_count"]) for r in found} == {("1", 0), ("2", 1), ("3", 0), ("4", 1)}
    dead = J.read_sink(spark, str(tmp_path / "out"), "dead", "topic string, value string, reason string").collect()
    assert [(json.loads(r["value"])["transaction_id"], r["reason"]) for r in dead] == [("5", "late")]


def test_input_topics(spark):
    df = spark.sql("""select * from values ('a', 500000.0D, true), ('b', 500000.01D, true), ('c', 1.0D, false), ('d', 1.0D, null)
                      t(customer_id, amount, is_international)""")
    out = {r["key"]: r["topic"] for r in M.to_input_topics(df).collect()}
    assert out == {"a": S.TOPIC_INTERNATIONAL, "b": S.TOPIC_HIGH_VALUE, "c": S.TOPIC_RAW, "d": S.TOPIC_RAW}
