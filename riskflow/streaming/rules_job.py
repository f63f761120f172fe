"""The rule engine on a stream: decode, prior activity from keyed state, rules, routing."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from riskflow.operators.frames import UNIT, units
from riskflow.operators.rules import RuleLimits, score_rules
from riskflow.session import ROCKSDB, STATE_STORE, scratch_dir
from riskflow.sources.tables import table_exists
from riskflow.streaming import messages as M

_OUT = T.StructType([
    T.StructField("transaction_id", T.StringType()), T.StructField("customer_id", T.StringType()),
    T.StructField("amount", T.DoubleType()), T.StructField("timestamp", T.TimestampType()),
    T.StructField("transaction_type", T.StringType()), T.StructField("merchant_category", T.StringType()),
    T.StructField("is_high_risk_merchant", T.BooleanType()), T.StructField("card_present", T.BooleanType()),
    T.StructField("is_international", T.BooleanType()), T.StructField("hour_of_day", T.IntegerType()),
    T.StructField("prior_count", T.LongType()), T.StructField("prior_amount", T.DoubleType()),
    T.StructField("payload", T.StringType()), T.StructField("late", T.StringType()),
])
_STATE = T.StructType([T.StructField("micros", T.LongType()), T.StructField("units", T.LongType())])


class PriorActivity(StatefulProcessor):
    """Keeps the (time, amount) pairs of a customer that a later row can still look back to.

    A row may come up to `late_s` seconds behind the newest one that earlier micro-batches brought for its
    customer, and counts the rows before its own time. One that is further behind carries its message in
    `late`, for the dead letters, and is not counted. A micro-batch brings the rows of a customer in no order,
    so they are put in order of time and id first; the trigger limits of the source bound how many there can be.
    """

    def __init__(self, window_s: int, history: int | None, late_s: int):
        self.window_s, self.history, self.late_s = window_s, history, late_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getListState("seen", _STATE)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(["micros", "id_number", "transaction_id"], ignore_index=True)
        old = list(self.seen.get())
        at_old, at_new = np.array([r[0] for r in old], "int64"), pdf["micros"].to_numpy("int64")
        late = at_new < (at_old.max() - self.late_s * 1_000_000 if len(old) else np.iinfo("int64").min)
        at = np.concatenate([at_old, at_new[~late]])
        c = np.concatenate([np.array([r[1] for r in old], "int64"), pdf["units"].to_numpy("int64")[~late]])
        order = np.argsort(at, kind="stable")
        t, c = at[order] // 1_000_000, c[order]
        total = np.concatenate([[0], np.cumsum(c)])
        here = np.empty(len(at), "int64")
        here[order] = np.arange(len(at))
        here = here[len(old):]                    # places of the new rows among all, in order of time
        start = np.searchsorted(t, t[here] - self.window_s)
        first = np.searchsorted(t, t[-1] - self.late_s - self.window_s) if len(t) else 0
        if self.history is not None:
            start = np.maximum(start, here - self.history)
            first = max(first, np.searchsorted(t, t[-1] - self.late_s) - self.history) if len(t) else 0
        pdf["prior_count"], pdf["prior_amount"] = 0, 0.0
        pdf.loc[~late, "prior_count"] = here - start
        pdf.loc[~late, "prior_amount"] = (total[here] - total[start]) / UNIT
        pdf["late"] = pdf["payload"].astype(object).where(late, None)
        self.seen.put([(int(a), int(b)) for a, b in zip(at[order][first:], c[first:], strict=True)])
        yield pdf[_OUT.fieldNames()]

    def close(self) -> None:
        pass


def stream_prior_activity(transactions: DataFrame, limits: RuleLimits = RuleLimits(), late_s: int = 600) -> DataFrame:
    """Stream form of `operators.rules.prior_activity`; `late` holds the message of a row that came too late."""
    prepared = transactions.withColumns({
        "micros": F.unix_micros("timestamp"),
        "units": F.expr(units("amount")),
        # Ids that are numbers are ordered as numbers.
        "id_number": F.coalesce(F.col("transaction_id").try_cast("bigint"), F.lit(0)),
    })
    return prepared.groupBy("customer_id").transformWithStateInPandas(
        statefulProcessor=PriorActivity(limits.window_s, limits.history, late_s), outputStructType=_OUT,
        outputMode="append", timeMode="none")


def session_velocity(transactions: DataFrame, idle_s: int = 300, late: str = "10 minutes") -> DataFrame:
    """Rows and amount per customer and session that ends after `idle_s` idle seconds."""
    return (transactions.withWatermark("timestamp", late)
            .groupBy("customer_id", F.session_window("timestamp", f"{idle_s} seconds").alias("s"))
            .agg(F.count(F.lit(1)).alias("txn_count"),
                 F.sum(F.expr(units("amount"))).alias("units"))
            .select("customer_id", F.col("s.start").alias("session_start"), "txn_count",
                    (F.col("units") / float(UNIT)).alias("amount")))


def suppress_repeats(requests: DataFrame, ttl: str = "60 seconds") -> DataFrame:
    """First request of each transaction id; repeats within the time to live are dropped."""
    return requests.withWatermark("timestamp", ttl).dropDuplicatesWithinWatermark(["transaction_id"])


def write_batch(decoded: DataFrame, out: str, batch_id: int | str, kind: str) -> None:
    """One micro-batch into its own folder; a batch that is run again replaces what it wrote."""
    decoded.write.mode("overwrite").parquet(f"{out}/{kind}/batch={batch_id}")


def rules_stream(messages: DataFrame, limits: RuleLimits = RuleLimits()) -> tuple[DataFrame, DataFrame]:
    """Decoded messages and, of the readable ones, the enriched records.

    Rows, alerts and records for the model are observed per micro-batch under the name `rules`
    and appear in the progress of the query.
    """
    # List state needs this store.
    messages.sparkSession.conf.set(STATE_STORE, ROCKSDB)
    decoded = M.decode(messages)
    enriched = M.whole_record(score_rules(stream_prior_activity(M.readable(decoded, keep_raw=True), limits), limits))
    return decoded, enriched.observe(
        "rules", F.count_if(F.col("late").isNull()).alias("processed"),
        F.count_if(F.col("late").isNull() & F.col("rule_severity").isin("CRITICAL", "HIGH")).alias("alerts"),
        F.count_if(F.col("late").isNull() & F.col("requires_ml_scoring")).alias("for_model"))


def start_kafka(messages: DataFrame, servers: str, checkpoint: str, limits: RuleLimits = RuleLimits()) -> list[StreamingQuery]:
    """As `start_rules`, with Kafka topics as output; the connector must be on the class path."""
    decoded, enriched = rules_stream(messages, limits)
    return [df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("checkpointLocation", f"{checkpoint}/{name}").start()
            for name, df in (("routed", M.to_topics_or_dead(enriched).drop("reason")), ("dead", M.dead_letters(decoded).drop("reason")))]


def start_rules(messages: DataFrame, out: str, checkpoint: str, limits: RuleLimits = RuleLimits(),
                available_now: bool = True) -> list[StreamingQuery]:
    """Start decode -> prior activity -> rules -> topics, and the dead-letter branch.

    Output folders are written per batch id, so a restart from the checkpoint repeats no message.
    """
    decoded, enriched = rules_stream(messages, limits)

    def sink(kind: str):
        return lambda df, batch_id: write_batch(df, out, batch_id, kind)

    def both(df: DataFrame, batch_id: int) -> None:
        """Late rows join the dead letters, in folders beside those of the other query."""
        df.persist()                              # the state is read once
        write_batch(df.where(F.col("reason").isNull()).drop("reason"), out, batch_id, "routed")
        write_batch(df.where(F.col("reason").isNotNull()).select("topic", "value", "reason"), out, f"late-{batch_id}", "dead")
        df.unpersist()

    queries = []
    for kind, df in (("routed", M.to_topics_or_dead(enriched)), ("dead", M.dead_letters(decoded))):
        writer = df.writeStream.foreachBatch(both if kind == "routed" else sink(kind)).option("checkpointLocation", f"{checkpoint}/{kind}")
        queries.append((writer.trigger(availableNow=True) if available_now else writer).start())
    return queries


def run_to_table(df: DataFrame, label: str) -> DataFrame:
    """Run a stream over what is available now and return what it wrote."""
    spark = df.sparkSession
    base = scratch_dir(spark, label)
    query = (df.writeStream.format("parquet").option("path", f"{base}/out")
             .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def read_sink(spark: SparkSession, out: str, kind: str, schema: str) -> DataFrame:
    """All batches that a sink has written."""
    path = f"{out}/{kind}"
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/batch=*")
