"""The settled stream: order, batch cuts, lateness, state that ends, sinks that commit, counters."""

import json
import random

import pytest
from pyspark.sql import functions as F

from riskflow import schemas as S
from riskflow.operators.rules import RuleLimits, run_rules
from riskflow.streaming import engine as E
from riskflow.streaming import messages as M

END = "2024-01-02 00:00:00"


def message(i, second, customer="c", **over):
    return json.dumps({"transaction_id": str(i), "customer_id": customer, "amount": "60000.5",
                       "timestamp": f"2024-01-01 {second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}", "transaction_type": "UPI",
                       "is_high_risk_merchant": i % 4 == 0, "card_present": i % 2 == 0, "is_international": False, "hour_of_day": 10, **over})


def arrivals(n, jitter, seed=1):
    """Messages of some seconds each, out of order by up to `jitter` seconds."""
    rng = random.Random(seed)
    rows = [(i, rng.randrange(0, 4 * 3600), rng.choice("abc")) for i in range(n)]
    return [message(i, s, c) for i, s, c in sorted(rows, key=lambda r: r[1] + rng.uniform(0, jitter))]


def scored(spark, out):
    columns = ("transaction_id", "prior_count", "rule_based_score")
    rows = E.committed(spark, out, "scored").select(*[F.get_json_object("value", f"$.{c}").cast("int") for c in columns]).collect()
    assert len(rows) == len({r[0] for r in rows})
    return {tuple(r) for r in rows}


def batch_form(spark, texts, limits, mode):
    rows = M.readable(M.decode(spark.createDataFrame([(t,) for t in texts], "value string"))).withColumn("n", F.col("transaction_id").cast("int"))
    found = run_rules(rows.withColumn("transaction_id", F.format_string("%06d", "n")), limits, mode=mode)
    return {(int(r.transaction_id), r.prior_count, r.rule_based_score) for r in found.collect()}


def parts_of(spark, texts, n):
    size = -(-len(texts) // n)
    return [spark.createDataFrame([(t,) for t in texts[i:i + size]], "value string").coalesce(1) for i in range(0, len(texts), size)]


@pytest.mark.parametrize("mode", ["window", "ttl_session"])
def test_cuts_and_order_make_no_difference(spark, mode):
    texts, limits = arrivals(400, 500), RuleLimits(window_s=300, max_txn=3)
    want = batch_form(spark, texts, limits, mode)
    assert any(n > 0 for _, n, _ in want)
    for n in (1, 4) if mode == "window" else (3,):
        out, _ = E.run_parts(spark, parts_of(spark, [*texts, message(9999, 0, timestamp=END)], n), limits, mode, late_s=600)
        assert scored(spark, out) == want
        assert E.committed(spark, out, "dead").count() == 0


def test_rows_behind_the_watermark_are_dead_letters_and_unreadable_ones_too(spark):
    first = [message(1, 100), message(2, 5000), "{cut", message(3, 5000, amount="abc")]
    second = [message(4, 4399, "new"), message(5, 4401), message(6, 5001)]
    out, counters = E.run_parts(spark, [spark.createDataFrame([(t,) for t in p], "value string") for p in (first, second, [message(7, 0, timestamp=END)])],
                                RuleLimits(window_s=60), late_s=600, counters=True)
    dead = {(r.reason, r.value) for r in E.committed(spark, out, "dead").collect()}
    assert dead == {("late", second[0]), ("malformed", "{cut"), ("amount", first[3])}
    assert {i for i, _, _ in scored(spark, out)} == {1, 2, 5, 6}
    total = counters.totals().first()
    assert (total.processed, total.errors, total.late) == (4, 2, 1) and total.avg_latency_ms > 0


def test_state_of_idle_customers_ends(spark, tmp_path):
    limits, inbox, cp = RuleLimits(window_s=60), str(tmp_path / "in"), str(tmp_path / "cp")

    def run(*texts):
        spark.createDataFrame([(t,) for t in texts], "value string").write.mode("append").text(inbox)
        E.start_engine(M.message_stream(spark, "text", path=inbox), str(tmp_path / "out"), cp, limits, late_s=600).awaitTermination()
        state = spark.read.format("statestore").option("path", cp).option("stateVarName", "seconds").load()
        return {r[0] for r in state.select(F.col("key.owner")).distinct().collect()} if state.columns else set()

    run(message(1, 0, "idle"), message(2, 5, "idle"), message(3, 0, "busy"))
    assert {"idle", "busy"} <= run(message(4, 640, "busy"))           # the watermark is at 40 seconds: still looked back to
    assert run(message(5, 2000, "busy"), message(6, 2000, "last")) & {"idle"} == set()


def test_a_batch_that_dies_between_sinks_is_repeated_without_doubles(spark, tmp_path, monkeypatch):
    texts = [*arrivals(60, 100), message(9999, 0, timestamp=END)]
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(t,) for t in texts], "value string").write.text(inbox)

    def run():
        E.start_engine(M.message_stream(spark, "text", path=inbox), out, str(tmp_path / "cp"), RuleLimits(window_s=60)).awaitTermination()

    class Broken(dict):
        def items(self):
            yield from list(super().items())[:2]
            raise RuntimeError("a sink is away")

    with monkeypatch.context() as m:
        m.setattr(E, "SINKS", Broken(E.SINKS))
        with pytest.raises(Exception, match="sink"):
            run()
        assert E.committed(spark, out, "scored").count() == 0
    run()
    assert {i for i, _, _ in scored(spark, out)} == set(range(60))


def test_one_query_reads_the_source_once(spark, tmp_path):
    spark.createDataFrame([(message(1, 5),)], "value string").write.text(str(tmp_path / "in"))
    query = E.start_engine(M.message_stream(spark, "text", path=str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    assert [s["numInputRows"] for p in query.recentProgress for s in p["sources"]][0] == 1
    assert S.TOPIC_SCORED in E.SINKS.values()


@pytest.mark.parametrize("mode", ["window", "ttl_session"])
def test_groups_of_customers_give_what_single_ones_do(spark, tmp_path, mode):
    texts, found = [*arrivals(60, 100), message(9999, 0, timestamp=END)], []
    spark.createDataFrame([(t,) for t in texts], "value string").write.text(str(tmp_path / "in"))
    for buckets in (None, 2):
        out, cp = str(tmp_path / f"out{buckets}"), str(tmp_path / f"cp{buckets}")
        source = M.message_stream(spark, "text", path=str(tmp_path / "in"))
        E.start_engine(source, out, cp, RuleLimits(window_s=60), mode, buckets=buckets).awaitTermination()
        found.append(sorted(map(str, scored(spark, out))))
    assert found[0] == found[1] and found[0]
