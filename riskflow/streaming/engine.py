"""One streaming query from messages to all sinks, with a commit record per batch and stored counters.

The source is read and decoded once, the state is passed once, and a micro-batch is written to scored, alerts and dead letters before
its commit record. A batch that dies between sinks is run again from the checkpoint and replaces what it wrote; readers take
committed batches only.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from riskflow import schemas as S
from riskflow.operators.rules import RuleLimits, score_rules
from riskflow.session import scratch_dir
from riskflow.sources.tables import table_exists
from riskflow.streaming import messages as M
from riskflow.streaming.settled import BUCKETS, settled_activity

SINKS = {"scored": S.TOPIC_SCORED, "alerts": S.TOPIC_ALERTS, "dead": S.TOPIC_DEAD_LETTER}
ROUTED = "topic string, key string, value string, reason string"
COUNTERS = "batch long, processed long, alerts long, for_model long, errors long, late long, latency_ms double, sla_breaches long"


def enriched_stream(messages: DataFrame, limits: RuleLimits = RuleLimits(), mode: str = "window", late_s: int = 600, sla_ms: int = 100,
                    buckets: int | None = None) -> DataFrame:
    """Every message once, enriched or with the reason why it is a dead letter; counters are observed under `engine`.

    Latency is measured from the arrival that the source tells (`arrived`, epoch milliseconds) to the batch in which the answer leaves.
    """
    has_arrival = "arrived" in messages.columns
    decoded = M.decode(messages, keep="arrived" if has_arrival else None)
    reason = F.when(M.is_dead_letter(), M.dead_reason())
    rows = decoded.withColumns({"dead": reason, "payload": F.col("_raw"), "arrived": F.col("arrived") if has_arrival else F.lit(None).cast("long")})
    found = settled_activity(rows.drop(M.CORRUPT, "_raw"), limits, mode, late_s, buckets)
    gone = F.coalesce("dead", F.when(F.col("late").isNotNull(), "late"))
    out = M.whole_record(score_rules(found, limits), keep=["payload"]).withColumn("reason", gone).drop("late", "dead")
    fine, wait = F.col("reason").isNull(), F.unix_millis("enriched_at") - F.nullif("arrived", F.lit(0))
    return out.observe(
        "engine", F.count_if(fine).alias("processed"), F.count_if(fine & F.col("rule_severity").isin("CRITICAL", "HIGH")).alias("alerts"),
        F.count_if(fine & F.col("requires_ml_scoring")).alias("for_model"), F.count_if(~fine & (F.col("reason") != "late")).alias("errors"),
        F.count_if(F.col("reason") == "late").alias("late"), F.coalesce(F.sum(F.when(fine, wait)), F.lit(0)).cast("double").alias("latency_ms"),
        F.count_if(fine & (wait > sla_ms)).alias("sla_breaches"))


def routed(enriched: DataFrame) -> DataFrame:
    """One message per topic that a record goes to, or the message itself to the dead letters."""
    dead = F.col("reason").isNotNull()
    record = F.to_json(F.struct(*[c for c in enriched.columns if c not in ("payload", "reason", "arrived")]))
    return enriched.select(
        F.explode(F.when(dead, F.array(F.lit(S.TOPIC_DEAD_LETTER))).otherwise(M.C.output_topics(F.col("rule_severity")))).alias("topic"),
        F.coalesce(F.col("customer_id").cast("string"), F.lit("unknown")).alias("key"),
        F.when(dead, F.col("payload")).otherwise(record).alias("value"), "reason")


def start_engine(messages: DataFrame, out: str, checkpoint: str, limits: RuleLimits = RuleLimits(), mode: str = "window", late_s: int = 600,
                 available_now: bool = True, name: str | None = None, buckets: int | None = None) -> StreamingQuery:
    """Start the query; `out` gets a folder per sink and `commits`."""
    def sink(df: DataFrame, batch_id: int) -> None:
        sent = routed(df).persist()                            # the state is passed once
        try:
            rows = {}
            for kind, topic in SINKS.items():
                of_topic = sent.where(F.col("topic") == topic)
                of_topic.write.mode("overwrite").parquet(f"{out}/{kind}/batch={batch_id}")
                rows[kind] = of_topic.count()
            record = [(batch_id, *rows.values())]
            df.sparkSession.createDataFrame(record, "id long, " + ", ".join(f"{k} long" for k in rows)).coalesce(1).write.mode("overwrite").parquet(
                f"{out}/commits/batch={batch_id}")
        finally:
            sent.unpersist()

    writer = enriched_stream(messages, limits, mode, late_s, buckets=buckets).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def committed(spark: SparkSession, out: str, kind: str) -> DataFrame:
    """What a sink has of batches with a commit record."""
    if not table_exists(spark, f"{out}/commits"):
        return spark.createDataFrame([], ROUTED)
    done = spark.read.parquet(f"{out}/commits").select("batch").distinct()
    return spark.read.schema(f"{ROUTED}, batch int").parquet(f"{out}/{kind}").join(done, "batch", "left_semi").drop("batch")


class CounterTable(StreamingQueryListener):
    """Writes the observed counters of each batch to a table; a batch that is run again replaces its row."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.done: set[tuple[str, int]] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = progress.observedMetrics.get("engine")
        if found is not None:
            row = (progress.batchId, *[found[c.split()[0]] for c in COUNTERS.split(", ")[1:]])
            self.spark.createDataFrame([row], COUNTERS).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/id={progress.batchId}")
        self.done.add((str(progress.runId), progress.batchId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.done.add((str(event.runId), -1))

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the events of an ended query have arrived."""
        end = time.monotonic() + seconds
        while (str(query.runId), -1) not in self.done and time.monotonic() < end:
            time.sleep(0.05)

    def totals(self) -> DataFrame:
        """Counters over all batches, with the mean latency of what was processed."""
        rows = self.spark.read.schema(COUNTERS).parquet(self.path) if table_exists(self.spark, self.path) else self.spark.createDataFrame([], COUNTERS)
        sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("processed", "alerts", "for_model", "errors", "late", "sla_breaches")]
        return rows.agg(*sums, F.try_divide(F.sum("latency_ms"), F.sum("processed")).alias("avg_latency_ms"))


def run_parts(spark: SparkSession, parts: list[DataFrame], limits: RuleLimits, mode: str = "window", late_s: int = 600,
              label: str = "engine", counters: bool = False, buckets: int | None = BUCKETS) -> tuple[str, CounterTable | None]:
    """Append the parts to an inbox one after the other, each with a start of the query of its own over one checkpoint."""
    base = scratch_dir(spark, label)
    table = CounterTable(spark, f"{base}/counters") if counters else None
    if table:
        spark.streams.addListener(table)
    try:
        for part in parts:
            part.write.mode("append").text(f"{base}/in")
            query = start_engine(M.message_stream(spark, "text", path=f"{base}/in", maxFilesPerTrigger="1000"), f"{base}/out", f"{base}/checkpoint", limits, mode, late_s, buckets=buckets)
            query.awaitTermination()
            if table:
                table.wait(query)
    finally:
        if table:
            spark.streams.removeListener(table)
    return f"{base}/out", table
