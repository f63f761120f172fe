"""Prior activity on a stream in order of event time, with watermark, timers and state that ends.

Customers can be dealt into groups that keep their state together, so that a micro-batch costs calls to the state per group and
not per customer, and rows wait as one value per group and batch of them. Rows wait in the state until the watermark has passed their time, so each is judged when everything before it is
there, and in the same way however the stream is cut into micro-batches. A row behind the watermark comes out at once with its message in
`late`, for the dead letters. What a customer's later rows can look back to is kept per second, at most window and lateness of them,
and a timer clears it when the watermark has passed the last second by the window.

Spark drops rows behind the watermark before they reach a stateful operator. So the rows themselves carry no event time; `with_ticks` adds a
row per partition and micro-batch that does, and moves the watermark.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskflow.operators.frames import UNIT, units
from riskflow.operators.rules import RuleLimits
from riskflow.session import ROCKSDB, STATE_STORE

CLOCK = "clock"
_DAY_S = 86_400
# A transaction as it waits and, with what was found, as it leaves.
WAITING = T.StructType([
    T.StructField("transaction_id", T.StringType()), T.StructField("customer_id", T.StringType()),
    T.StructField("amount", T.DoubleType()), T.StructField("micros", T.LongType()), T.StructField("units", T.LongType()),
    T.StructField("id_number", T.LongType()), T.StructField("transaction_type", T.StringType()),
    T.StructField("merchant_category", T.StringType()), T.StructField("is_high_risk_merchant", T.BooleanType()),
    T.StructField("card_present", T.BooleanType()), T.StructField("is_international", T.BooleanType()),
    T.StructField("hour_of_day", T.IntegerType()), T.StructField("payload", T.StringType()),
    T.StructField("arrived", T.LongType()),
])
FOUND = T.StructType(WAITING.fields + [T.StructField("prior_count", T.LongType()), T.StructField("prior_amount", T.DoubleType()),
                                       T.StructField("late", T.StringType()), T.StructField("dead", T.StringType())])
_PACKED = T.StructType([T.StructField("rows", T.BinaryType())])
#: Groups of customers whose state is passed at once.
BUCKETS = 1024
_SHIFT = 1 << 39                                               # makes seconds before 1970 positive
_CUSTOMER = T.StructType([T.StructField("customer", T.StringType())])
_SECOND = T.StructType([T.StructField("customer", T.StringType()), T.StructField("s", T.LongType())])
_SUM = T.StructType([T.StructField("n", T.LongType()), T.StructField("units", T.LongType())])
_SESSION = T.StructType([T.StructField("last", T.LongType()), T.StructField("n", T.LongType()), T.StructField("units", T.LongType())])


def with_ticks(rows: DataFrame, late_s: int, at: str = "timestamp") -> DataFrame:
    """The rows with an empty `clock`, and rows of which only the `clock` is set, watermarked `late_s` behind it.

    A time more than a day ahead of the machine's does not move the clock.
    """
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields] + [T.StructField(CLOCK, T.TimestampType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        newest = last = None
        for batch in batches:
            times = batch.column(at)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.nulls(batch.num_rows, times.type)], schema.fieldNames())
            top = pc.max(times.filter(pc.less_equal(times, pa.scalar(int((time.time() + _DAY_S) * 1e6), times.type))))
            if top.is_valid and (newest is None or top.value > newest.value):
                newest = top
            last = batch
        if newest is not None:
            # A missing whole number would turn the column into floats on the way to pandas.
            none = [pa.array([0], f.type) if f.type == pa.int64() else pa.nulls(1, f.type) for f in last.schema]
            yield pa.RecordBatch.from_arrays([*none, pa.array([newest.as_py()], newest.type)], schema.fieldNames())

    return rows.mapInArrow(run, schema).withWatermark(CLOCK, f"{late_s} seconds")


def _packed(rows: pd.DataFrame) -> tuple[bytes]:
    """Rows as one value of the state."""
    out = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_pandas(rows[WAITING.fieldNames()], to_arrow_schema(WAITING), preserve_index=False)
    with pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)
    return (out.getvalue().to_pybytes(),)


def _unpacked(values: Iterable[tuple]) -> pd.DataFrame:
    parts = [pa.ipc.open_stream(v[0]).read_all() for v in values] or [to_arrow_schema(WAITING).empty_table()]
    return pa.concat_tables(parts).to_pandas(integer_object_nulls=True)


def _customers(rows: pd.DataFrame) -> np.ndarray:
    """Customers as keys of the state; a missing one is one of its own kind."""
    return np.array(["" if pd.isna(c) else f"={c}" for c in rows["customer_id"].tolist()], dtype=object)


class _Settled(StatefulProcessor):
    """Rows of a group of customers wait until the watermark has passed them; subclasses judge them in order."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _PACKED)
        self.due = handle.getValueState("due", T.StructType([T.StructField("ms", T.LongType())]))
        self.open(handle)

    def wake(self, ms: int | None) -> None:
        """Set the one timer of the group."""
        if self.due.exists():
            self.handle.deleteTimer(self.due.get()[0])
        if ms is None:
            self.due.clear()
        else:
            self.due.update((ms,))
            self.handle.registerTimer(ms)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        mark, first = timerValues.getCurrentWatermarkInMs() * 1000, None
        for pdf in rows:
            pdf = pdf[pdf[CLOCK].isna()]
            late = pdf["dead"].notna() | (pdf["micros"] < mark)
            if late.any():
                gone = pdf[late].copy()
                gone["prior_count"], gone["prior_amount"] = 0, 0.0
                gone["late"] = gone["payload"].where(gone["dead"].isna(), None)
                yield gone[FOUND.fieldNames()]
            stays = pdf.loc[~late, WAITING.fieldNames()]
            if len(stays):
                self.waiting.appendValue(_packed(stays))
                first = min(int(stays["micros"].min()), first if first is not None else np.iinfo("int64").max)
        if first is not None:
            ms = first // 1000 + 1
            # A later timer is that of a later row, or the one that ends the state.
            if not self.due.exists() or ms < self.due.get()[0]:
                self.wake(ms)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        rows = _unpacked(list(self.waiting.get()) if self.waiting.exists() else [])
        now = rows["micros"] < mark
        ready, rest = rows[now].sort_values(["micros", "id_number", "transaction_id"], ignore_index=True), rows[~now]
        self.due.clear()                                       # the timer is spent
        if len(rest):
            self.waiting.put([_packed(rest)])
        else:
            self.waiting.clear()
        end = self.judge(ready, mark // 1_000_000)
        if len(rest):
            self.wake(int(rest["micros"].min()) // 1000 + 1)
        elif end is not None:
            self.wake(end * 1000)
        if len(ready):
            ready["late"], ready["dead"] = None, None
            yield ready[FOUND.fieldNames()]

    def open(self, handle: StatefulProcessorHandle) -> None:
        raise NotImplementedError

    def judge(self, ready: pd.DataFrame, mark_s: int) -> int | None:
        """Add prior activity to rows in order; the second at which the state that is left has no use any more."""
        raise NotImplementedError

    def close(self) -> None:
        pass


class WindowActivity(_Settled):
    """Earlier rows of the last `window_s` seconds."""

    def __init__(self, window_s: int):
        self.window_s = window_s

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.seconds = handle.getMapState("seconds", _SECOND, _SUM)

    def judge(self, ready: pd.DataFrame, mark_s: int) -> int | None:
        kept = [(k[0], k[1], v[0], v[1]) for k, v in self.seconds.iterator()] if self.seconds.exists() else []
        kept.sort(key=lambda k: k[:2])
        at = ready["micros"].to_numpy("int64") // 1_000_000
        code, names = pd.factorize(np.concatenate([np.array([k[0] for k in kept], dtype=object), _customers(ready)]))
        old = np.array([k[1] for k in kept], "int64")
        # Customer and second as one number, which orders the seconds within each customer.
        place_of = code.astype("int64") << 40
        sec = place_of + np.concatenate([old, at]) + _SHIFT
        count = np.concatenate([np.array([k[2] for k in kept], "int64"), np.ones(len(at), "int64")])
        amount = np.concatenate([np.array([k[3] for k in kept], "int64"), ready["units"].to_numpy("int64")])
        order = np.argsort(sec, kind="stable")                 # what is kept of a second comes before its new rows
        n, total = np.append(0, np.cumsum(count[order])), np.append(0, np.cumsum(amount[order]))
        place = np.empty(len(order), "int64")
        place[order] = np.arange(len(order))
        place, ordered = place[len(old):], sec[order]
        start = np.searchsorted(ordered, np.maximum(sec[len(old):] - self.window_s, place_of[len(old):]))
        ready["prior_count"], ready["prior_amount"] = n[place] - n[start], (total[place] - total[start]) / UNIT
        first = mark_s - self.window_s                         # rows still to come are at or behind the watermark
        for customer, s, _, _ in kept:
            if s < first:
                self.seconds.removeKey((customer, s))
        fresh = np.unique(sec[len(old):][at >= first])
        lo, hi = np.searchsorted(ordered, fresh), np.searchsorted(ordered, fresh, side="right")
        for c, s, a, b in zip((fresh >> 40).tolist(), ((fresh & ((1 << 40) - 1)) - _SHIFT).tolist(), lo.tolist(), hi.tolist(), strict=True):
            self.seconds.updateValue((names[c], s), (int(n[b] - n[a]), int(total[b] - total[a])))
        last = max([int(s.max()) for s in (old, at) if len(s)], default=None)
        return last + self.window_s + 1 if last is not None and last >= first else None


class SessionActivity(_Settled):
    """Earlier rows since the customer was last idle for `idle_s` seconds."""

    def __init__(self, idle_s: int):
        self.idle_s = idle_s

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.sessions = handle.getMapState("sessions", _CUSTOMER, _SESSION)

    def judge(self, ready: pd.DataFrame, mark_s: int) -> int | None:
        kept = {k[0]: tuple(v) for k, v in self.sessions.iterator()} if self.sessions.exists() else {}
        now, counts, amounts = dict(kept), [], []
        for customer, at, amount in zip(_customers(ready).tolist(), (ready["micros"] // 1_000_000).tolist(), ready["units"].tolist(), strict=True):
            last, n, total = now.get(customer, (None, 0, 0))
            if last is None or at - last >= self.idle_s:
                n = total = 0
            counts.append(n)
            amounts.append(total / UNIT)
            now[customer] = at, n + 1, total + amount
        ready["prior_count"], ready["prior_amount"] = counts, amounts
        end = None
        for customer, session in now.items():
            if session[0] + self.idle_s <= mark_s:
                if customer in kept:
                    self.sessions.removeKey((customer,))
                continue
            if session != kept.get(customer):
                self.sessions.updateValue((customer,), session)
            end = max(session[0] + self.idle_s, end or session[0] + self.idle_s)
        return end


def settled_activity(decoded: DataFrame, limits: RuleLimits = RuleLimits(), mode: str = "window", late_s: int = 600,
                     buckets: int | None = None) -> DataFrame:
    """Transactions with their prior activity, once the watermark has passed them; unreadable and late ones at once.

    `decoded` has `payload`, `dead` (why a message is unreadable, else null) and `arrived` (epoch milliseconds) beside the message's columns.
    With `buckets`, as many groups of customers share their state; it changes no result, and stays as it is over the life of a checkpoint.
    """
    if limits.history is not None:
        raise ValueError("the state is kept per second, so the latest rows cannot be told apart")
    processors = {"window": lambda: WindowActivity(limits.window_s), "ttl_session": lambda: SessionActivity(limits.window_s)}
    decoded.sparkSession.conf.set(STATE_STORE, ROCKSDB)
    # Unreadable messages touch no state; they are spread, not gathered under the missing customer.
    if buckets:
        owner = F.pmod(F.when(F.col("dead").isNull(), F.xxhash64("customer_id")).otherwise(F.xxhash64("payload")), F.lit(buckets))
    else:
        owner = F.when(F.col("dead").isNull(), F.col("customer_id")).otherwise(F.concat(F.lit("?"), F.pmod(F.xxhash64("payload"), F.lit(4096))))
    prepared = decoded.withColumns({
        "micros": F.coalesce(F.unix_micros("timestamp"), F.lit(0)), "arrived": F.coalesce("arrived", F.lit(0)), "units": F.coalesce(F.expr(units("amount")), F.lit(0)),
        # Ids that are numbers are ordered as numbers.
        "id_number": F.coalesce(F.col("transaction_id").try_cast("bigint"), F.lit(0)),
        "owner": owner})
    rows = with_ticks(prepared.select(*WAITING.fieldNames(), "dead", "owner", F.when(F.col("dead").isNull(), F.col("timestamp")).alias("timestamp")), late_s)
    found = rows.groupBy("owner").transformWithStateInPandas(
        statefulProcessor=processors[mode](), outputStructType=FOUND, outputMode="append", timeMode="eventTime")
    return found.withColumn("timestamp", F.timestamp_micros("micros")).drop("micros", "units", "id_number")
