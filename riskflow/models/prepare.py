"""Splits, scaling and oversampling of training rows."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.schemas import LABEL

_BUCKETS = 10_000


def bucket(key: Column | str, seed: int, buckets: int = _BUCKETS) -> Column:
    """Bucket of a key that depends only on the key and the seed."""
    text = F.concat_ws(":", F.lit(str(seed)), (F.col(key) if isinstance(key, str) else key).cast("string"))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(buckets)).cast("bigint")


def assign_split(df: DataFrame, key: str = "transaction_id", test: float = 0.15, validation: float = 0.15,
                 seed: int = 42) -> DataFrame:
    """`split` as test, validation (a share of the rest) or train.

    Every class is cut by the same hash thresholds, so its share is kept without sorting it.
    """
    b = bucket(key, seed)
    upper = test + (1 - test) * validation
    return df.withColumn("split", F.when(b < round(test * _BUCKETS), "test")
                         .when(b < round(upper * _BUCKETS), "validation").otherwise("train"))


def assign_fold(df: DataFrame, folds: int = 3, key: str = "transaction_id", seed: int = 42) -> DataFrame:
    """`fold` in [0, folds), spread evenly over every class."""
    return df.withColumn("fold", F.pmod(bucket(key, seed + 1), F.lit(folds)).cast("int"))


def standardize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns minus mean over population deviation; a constant column becomes 0.

    The statistics are two numbers per column, fetched once and put into the plan.
    """
    row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns],
                 *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).first()
    return df.withColumns({c: (F.col(c) - F.lit(row[f"m_{c}"])) / F.lit(row[f"s_{c}"] or 1.0) for c in columns})


def assemble(df: DataFrame, columns: list[str], output: str = "features") -> DataFrame:
    cast = df.withColumns({c: F.col(c).cast("double") for c in columns})
    return VectorAssembler(inputCols=columns, outputCol=output, handleInvalid="keep").transform(cast)


def first_by_hash(df: DataFrame, key: str, n: int, seed: int, buckets: int = 1 << 16) -> DataFrame:
    """Exactly `n` rows in the order of the key's hash: whole buckets, and of the bucket in which the n-th row lies as many as are missing.

    Only the counts per bucket reach the driver, and only one bucket is sorted.
    """
    placed, left, last = df.withColumn("_b", bucket(key, seed, buckets)), n, -1
    for row in placed.groupBy("_b").count().orderBy("_b").toLocalIterator():
        if row["count"] > left:
            rest = placed.where(F.col("_b") == row["_b"]).orderBy(key).limit(left)
            return placed.where(F.col("_b") <= last).unionByName(rest).drop("_b")
        left, last = left - row["count"], row["_b"]
    return placed.drop("_b")


def oversample(df: DataFrame, columns: list[str], ratio: float = 0.15, label: str = LABEL,
               key: str = "transaction_id", projections: int = 4, neighbours: int = 5, seed: int = 42,
               rows_per_cell: int = 2000) -> DataFrame:
    """Input rows plus synthetic minority rows, until minority / majority reaches the ratio.

    The feature columns come out as double.

    A synthetic row lies between a minority row and one of its near ones. Near rows are looked for
    along random projections: the minority is ordered along each, and the next two rows on both
    sides are candidates, so each row has a fixed number of them and no pairs are formed. The
    order is taken inside quantile cells of the projection, so no task sorts the whole class.
    """
    df = df.withColumns({c: F.col(c).cast("double") for c in columns})
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    minority, majority = counts.get(1, 0), counts.get(0, 0)
    wanted = int(ratio * majority) - minority
    if minority < 2 or wanted <= 0:
        return df.withColumn("is_synthetic", F.lit(False))
    few = df.where(F.col(label) == 1)
    scales = few.agg(*[F.stddev_pop(c).alias(c) for c in columns]).first()
    scaled = F.array(*[F.coalesce(F.col(c), F.lit(0.0)) / F.lit(scales[c] or 1.0) for c in columns])
    points = few.select(F.col(key).alias("_id"), F.array(*[F.coalesce(F.col(c), F.lit(0.0)) for c in columns]).alias("_x"))
    # The hash tells rows apart that share an id.
    places = few.select(F.col(key).alias("_id"), scaled.alias("_z"), F.xxhash64(*[F.coalesce(F.col(c), F.lit(0.0)) for c in columns]).alias("_h"))

    def weight(p: int, i: int) -> float:
        # Signs of a fixed pattern: a random +-1 projection that is the same everywhere.
        return 1.0 if (seed * 7919 + p * 104729 + i * 1299709) % 1013 % 2 else -1.0

    axes = F.array(*[F.struct(F.lit(p).alias("axis"), reduce(lambda a, b: a + b, [
        F.get("_z", F.lit(i)) * weight(p, i) for i in range(len(columns))]).alias("pos")) for p in range(projections)])
    # A trace of noise, so that equal rows do not all fall into one cell.
    placed = places.select("_id", "_h", "_z", F.inline(axes)).withColumn(
        "pos", F.col("pos") + (F.abs("pos") + 1) * bucket("_id", seed, 1 << 30) / F.lit(1e18))
    # No more cuts than are cheap to search for each row; beyond that the cells grow.
    cells = min(max(1, minority // rows_per_cell), 1000)
    if cells > 1:
        cuts = placed.groupBy("axis").agg(F.percentile_approx("pos", [i / cells for i in range(1, cells)]).alias("cuts"))
        placed = placed.join(F.broadcast(cuts), "axis").withColumn(
            "cell", F.size(F.filter("cuts", lambda c: c < F.col("pos")))).drop("cuts")
    else:
        placed = placed.withColumn("cell", F.lit(0))
    w = Window.partitionBy("axis", "cell").orderBy("pos", "_id")
    other = F.struct("_id", "_h", "_z")

    def found(o: Column) -> Column:
        apart = F.aggregate(F.zip_with("_z", o["_z"], lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, d: a + d)
        return F.when(o.isNotNull(), F.struct(o["_id"].alias("_nid"), o["_h"].alias("_nh"), apart.alias("_d")))

    # Only ids, hashes and distances are exchanged from here on; the values of the near rows that are drawn are looked up in the end.
    sides = {f"_o{i}": step for i, step in enumerate(f(other, k).over(w) for f in (F.lag, F.lead) for k in (1, 2))}
    near = placed.withColumns(sides).select("_id", F.explode(F.array_compact(F.array(*[found(F.col(o)) for o in sides]))).alias("o"))
    near = near.select("_id", "o.*").where(F.col("_id") != F.col("_nid"))
    best = (near.groupBy("_id", "_nid").agg(F.first("_nh").alias("_nh"), F.min("_d").alias("_d"))
            .groupBy("_id").agg(F.slice(F.sort_array(F.collect_list(F.struct("_d", "_nid", "_nh"))), 1, neighbours).alias("near")))
    best = points.join(best, "_id", "left")
    # Copies per row: the whole part for all, one more for as many as are left.
    whole, part = divmod(wanted, minority)
    extra = first_by_hash(points.select("_id"), "_id", part, seed + 2).select("_id", F.lit(1).alias("_more"))
    best = best.join(extra, "_id", "left")
    copies = F.lit(whole) + F.coalesce("_more", F.lit(0))
    made = best.select("_id", "_x", "near", F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies))).alias("c"))
    draw = lambda tag, n: bucket(F.concat_ws(":", F.lit(tag), F.col("_id").cast("string"), F.col("c").cast("string")),
                                 seed, n)
    drawn = F.get("near", draw("n", 1 << 20) % F.size("near"))
    made = made.select("_x", drawn["_nid"].alias("_nid"), drawn["_nh"].alias("_nh"), (draw("u", _BUCKETS) / F.lit(float(_BUCKETS))).alias("u"))
    # A row without a near one is repeated as it is.
    others = points.select(F.col("_id").alias("_nid"), F.xxhash64(*[F.get("_x", F.lit(i)) for i in range(len(columns))]).alias("_nh"), F.col("_x").alias("n"))
    made = made.join(others.dropDuplicates(["_nid", "_nh"]), ["_nid", "_nh"], "left").withColumn("n", F.coalesce("n", "_x"))
    mixed = F.zip_with("_x", "n", lambda a, b: a + F.col("u") * (b - a))
    synthetic = made.select(mixed.alias("_v")).select(
        *[F.get("_v", F.lit(i)).alias(c) for i, c in enumerate(columns)], F.lit(1).alias(label),
        F.lit(True).alias("is_synthetic"))
    return df.withColumn("is_synthetic", F.lit(False)).unionByName(synthetic, allowMissingColumns=True)
