"""Answers to requests, with the one already given where a request is repeated."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskflow.session import ROCKSDB, STATE_STORE
from riskflow.streaming.settled import CLOCK, with_ticks

_GIVEN = T.StructType([T.StructField("micros", T.LongType()), T.StructField("answer", T.StringType())])
_OUT = T.StructType([T.StructField("request_id", T.StringType()), T.StructField("micros", T.LongType()), T.StructField("rank", T.LongType()),
                     T.StructField("answer", T.StringType()), T.StructField("reused", T.BooleanType())])


class GivenAnswers(StatefulProcessor):
    """The answer that counts for a request id, until `ttl_s` seconds after it was worked out."""

    def __init__(self, ttl_s: int):
        self.ttl = ttl_s * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.given = handle.getValueState("given", _GIVEN)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        mark, named = timerValues.getCurrentWatermarkInMs() * 1000, key[0] is not None
        kept = before = self.given.get() if named and self.given.exists() else None
        frames = [pdf[pdf[CLOCK].isna()] for pdf in rows] if named else (pdf[pdf[CLOCK].isna()] for pdf in rows)
        for pdf in [pd.concat(frames)] if named else frames:       # requests without an id are no repeats of each other
            pdf = pdf.sort_values(["micros", "rank"], ignore_index=True)
            answers, reused = [], []
            for at, answer in zip(pdf["micros"].tolist(), pdf["answer"].tolist(), strict=True):
                again = kept is not None and kept[0] <= at < kept[0] + self.ttl
                answers.append(kept[1] if again else answer)
                reused.append(again)
                if named and (kept is None or at >= kept[0] + self.ttl):
                    kept = (at, answer)
            pdf["answer"], pdf["reused"] = pd.Series(answers, pdf.index, dtype=object), np.array(reused, bool)
            yield pdf[_OUT.fieldNames()]
        if kept != before:
            if before is not None:
                self.handle.deleteTimer((before[0] + self.ttl) // 1000)
            if kept[0] + self.ttl > mark:
                self.given.update(kept)
                self.handle.registerTimer((kept[0] + self.ttl) // 1000)
            else:
                self.given.clear()

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.given.clear()
        return iter([])

    def close(self) -> None:
        pass


def answer_requests(requests: DataFrame, ttl_s: int = 60, late_s: int = 600) -> DataFrame:
    """One answer per request `(request_id, timestamp, rank, answer)`: its own, or that of the first request with its id in the last `ttl_s` seconds.

    Requests of a micro-batch are taken in order of time and `rank`; one that comes after a later one with an answer of its own keeps its own,
    as do requests without an id. None is dropped, however late it is. State ends when the watermark has passed the time to live.
    """
    requests.sparkSession.conf.set(STATE_STORE, ROCKSDB)
    rows = requests.select("request_id", F.coalesce(F.unix_micros("timestamp"), F.lit(0)).alias("micros"), F.col("rank").cast("long").alias("rank"), "answer", "timestamp")
    found = with_ticks(rows, late_s).groupBy("request_id").transformWithStateInPandas(
        statefulProcessor=GivenAnswers(ttl_s), outputStructType=_OUT, outputMode="append", timeMode="eventTime")
    return found.withColumn("timestamp", F.timestamp_micros("micros")).drop("micros")
