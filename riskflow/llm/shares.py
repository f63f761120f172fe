"""Joins of rows with one row per group, when a group may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARES = 1024


def join_groups(rows: DataFrame, groups: DataFrame, key: str | list[str], size: str, spread: str, how: str = "inner", shares: int = SHARES) -> DataFrame:
    """``rows`` with the columns of their group; ``groups`` has one stored row per ``key`` and its number of ``rows`` in ``size``.

    A group of more than a ``shares``-th of all rows is dealt into slices of about that many by the hash of ``spread``, and its
    row repeated per slice. Only such groups are broadcast, and there are fewer than ``shares`` of them. A null key finds no group.
    """
    keys = [key] if isinstance(key, str) else key
    total = groups.agg(F.sum(size)).first()[0] or 1
    sliced = groups.withColumn("_slices", F.least(F.ceil(F.col(size) * F.lit(shares) / F.lit(total)), F.col(size)).cast("int"))
    hot = sliced.where("_slices > 1").select(*keys, F.col("_slices").alias("_n"))
    marked = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "_slice", F.when(F.col("_n").isNull(), 0).otherwise(F.pmod(F.xxhash64(spread), F.col("_n"))).cast("int")).drop("_n")
    copies = sliced.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.greatest(F.col("_slices"), F.lit(1)) - 1))).drop("_slices")
    return marked.join(copies, [*keys, "_slice"], how).drop("_slice")
