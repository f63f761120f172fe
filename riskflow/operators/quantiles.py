"""Median over a trailing frame.

Keys with few rows are read in order with their frame kept sorted.
Keys with more than `hot_rows` rows are resolved by a search over the digits of the value's rank among
the different values of its key, so the rounds are as many as that number has digits: per round, running counts (as in `frames`) say how many values of the frame lie under each digit, and
every second narrows its prefix to the digit that holds its middle value. A fixed number of rounds
ends at the exact value, and each round is spread over (key, prefix, block).
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from riskflow.operators.frames import UNIT
from riskflow.session import checkpoints

DIGIT_BITS = 4
_FANOUT = 1 << DIGIT_BITS


def frame_median(rows: DataFrame, seconds: int, name: str, hot_rows: int = 2000,
                 value: str = "amount", scale: int = UNIT) -> DataFrame:
    """Lower median of `value` per (`_key`, `_t`), as columns `_key`, `_t`, `name`.

    Values are rounded to multiples of 1/`scale` first, so the size of a key changes no result. Whether there are hot keys
    is asked first in one aggregate over the key column.
    """
    points = rows.where(F.col(value).isNotNull()).select("_key", "_t", (F.round(F.col(value) * scale, 0) / scale).alias("_v"))
    hot_keys = points.groupBy("_key").agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
    if hot_keys.isEmpty():
        return _sliding_median(points, seconds, name)
    marks = hot_keys.select(F.col("_key").alias("_hot"), F.lit(True).alias("_is_hot"))
    marked = points.join(marks, F.col("_key").eqNullSafe(F.col("_hot")), "left")
    few = _sliding_median(marked.where(F.col("_is_hot").isNull()), seconds, name)
    many = _digit_search(marked.where(F.col("_is_hot")), seconds, name, scale)
    return few.unionByName(many)


def _sliding_median(points: DataFrame, seconds: int, name: str) -> DataFrame:
    """Keys are read in order, as a stream: a task holds one batch and the sorted frame of one key."""
    ordered = points.repartition("_key").sortWithinPartitions("_key", "_t")
    schema = T.StructType([ordered.schema["_key"], ordered.schema["_t"], T.StructField(name, T.DoubleType())])

    def medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, last = object(), None
        frame: deque[tuple[int, float]] = deque()
        values: list[float] = []                    # NaN counts as greater than all others and is not among them
        found: tuple[list, list, list] = ([], [], [])

        def close() -> None:
            if last is not None:
                middle = (len(frame) - 1) // 2
                for column, value in zip(found, (key, last, values[middle] if middle < len(values) else math.nan), strict=True):
                    column.append(value)

        def out() -> pa.RecordBatch:
            arrow = to_arrow_schema(schema)
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(found, arrow, strict=True)], schema=arrow)
            for c in found:
                c.clear()
            return made

        for batch in batches:
            for k, t, v in zip(*[batch.column(c).to_pylist() for c in ("_key", "_t", "_v")], strict=True):
                if k != key or t != last:
                    close()
                if k != key:
                    key = k
                    frame.clear()
                    values.clear()
                while frame and frame[0][0] < t - seconds:
                    gone = frame.popleft()[1]
                    if gone == gone:
                        del values[bisect_left(values, gone)]
                frame.append((t, v))
                if v == v:
                    insort(values, v)
                last = t
            yield out()
        close()
        yield out()

    return ordered.select("_key", "_t", "_v").mapInArrow(medians, schema)


def _ranked(values: DataFrame) -> DataFrame:
    """`_key, _c, _rank`: the different values of each key, numbered in order from 0.

    Numbered inside ranges of 65,536 possible values; the offset of a range is a running sum over one row per key and range.
    """
    different = values.select("_key", "_c", F.shiftright("_c", 16).alias("_g")).distinct()
    sizes = different.groupBy("_key", "_g").agg(F.count(F.lit(1)).alias("_of"))
    offsets = sizes.selectExpr("_key as _k", "_g as _og", "sum(_of) over (partition by _key order by _g) - _of as _offset")
    placed = different.withColumn("_at", F.row_number().over(Window.partitionBy("_key", "_g").orderBy("_c")) - 1)
    same = F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_g") == F.col("_og"))
    return placed.join(offsets, same).select("_key", "_c", (F.col("_offset") + F.col("_at")).cast("bigint").alias("_rank"))


def _digit_search(points: DataFrame, seconds: int, name: str, scale: int, block_days: int = 30) -> DataFrame:
    block = block_days * 86400
    checkpoints(points.sparkSession)
    code = F.round(F.col("_v").cast("decimal(20,4)") * scale, 0).cast("bigint").alias("_c")
    counted = points.select("_key", "_t", code).groupBy("_key", "_t", "_c").agg(F.count(F.lit(1)).alias("_n")).checkpoint()
    ranks = _ranked(counted).checkpoint()
    named = ranks.select(F.col("_key").alias("_k"), F.col("_c").alias("_rc"), "_rank")
    values = counted.join(named, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_c") == F.col("_rc"))).select(
        "_key", "_t", F.col("_rank").alias("_c"), "_n").checkpoint()
    bits = max(1, int(ranks.agg(F.max("_rank")).first()[0] or 0).bit_length())
    bits += -bits % DIGIT_BITS

    # Rank wanted in the frame: the lower middle of its rows.
    changes = values.groupBy("_key", "_t").agg(F.sum("_n").alias("_n"))
    sizes = _running(changes, changes, [], {"_size": F.col("_n")}, seconds, block)
    search = sizes.select("_key", "_t", F.lit(0).cast("bigint").alias("_p"),
                          F.ceil(F.col("_size") / 2).cast("bigint").alias("_r"))
    for low in range(bits - DIGIT_BITS, -1, -DIGIT_BITS):
        digit = F.shiftright("_c", low).bitwiseAND(_FANOUT - 1)
        prefix = F.shiftright("_c", low + DIGIT_BITS)
        level = (values.groupBy("_key", prefix.alias("_p"), "_t", digit.alias("_d")).agg(F.sum("_n").alias("_n")))
        counts = {f"_d{d}": F.when(F.col("_d") == d, F.col("_n")) for d in range(_FANOUT)}
        found = _running(level, search, ["_p"], counts, seconds, block)
        # First digit whose cumulative count reaches the rank.
        upto = F.array(*[sum((F.col(f"_d{i}") for i in range(1, d + 1)), F.col("_d0")) for d in range(_FANOUT)])
        found = found.withColumn("_upto", upto).withColumn(
            "_hit", F.size(F.filter("_upto", lambda c: c < F.col("_r"))))
        below = F.when(F.col("_hit") > 0, F.get("_upto", F.col("_hit") - 1)).otherwise(F.lit(0))
        search = found.select("_key", "_t", (F.col("_p") * _FANOUT + F.col("_hit")).cast("bigint").alias("_p"),
                              (F.col("_r") - below).cast("bigint").alias("_r")).checkpoint()
    found = search.join(named, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_p") == F.col("_rank")))
    return found.select("_key", "_t", (F.col("_rc") / F.lit(float(scale))).cast("double").alias(name))


def _running(data: DataFrame, ask: DataFrame, within: list[str], counts: dict, seconds: int, block: int) -> DataFrame:
    """Running frame counts of `data` by (`_key`, *within), read at the rows of `ask`."""
    keys = ["_key", *within]
    keep = [c for c in ask.columns if c not in (*keys, "_t", "_n")]
    rows = data.select(*keys, "_t", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(n) for n, c in counts.items()])
    moves = rows.withColumn("_sign", F.explode(F.array(F.lit(1), F.lit(-1)))).select(
        *keys, F.when(F.col("_sign") > 0, F.col("_t")).otherwise(F.col("_t") + seconds + 1).alias("_t"),
        F.lit(1).alias("_kind"), *[(F.col(n) * F.col("_sign")).alias(n) for n in counts])
    asked = ask.select(*keys, "_t", *keep, F.lit(2).alias("_kind"))
    blk = F.expr(f"_t div {block}")
    moves = moves.withColumn("_b", blk)
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    # A block that only asks must also start from the total before it.
    per_block = moves.select(*keys, "_b", *counts).unionByName(
        asked.select(*keys, blk.alias("_b")), allowMissingColumns=True
    ).groupBy(*keys, "_b").agg(*[F.sum(n).alias(n) for n in counts])
    carried = per_block.select(*keys, "_b", (F.col("_b") * block).alias("_t"), F.lit(0).alias("_kind"),
                               *[F.sum(n).over(before).alias(n) for n in counts])
    events = moves.unionByName(asked.withColumn("_b", blk), allowMissingColumns=True).unionByName(
        carried, allowMissingColumns=True)
    w = (Window.partitionBy(*keys, "_b").orderBy("_t", "_kind")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = events.select(*keys, "_t", "_kind", *keep, *[F.coalesce(F.sum(n).over(w), F.lit(0)).alias(n) for n in counts])
    return out.where(F.col("_kind") == 2).drop("_kind")
