"""Raw records to clean, enriched transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow import schemas as S
from riskflow.functions import columns as C

METADATA = ("_ingestion_ts", "_source_path", "_record_hash", "_batch_id", "_partition_date")


def with_metadata(raw: DataFrame, batch_id: str, source_path: Column | None = None) -> DataFrame:
    """Ingestion columns. The hash covers the business columns only, so it is the same in every run."""
    business = [c for c in raw.columns if c not in METADATA]
    return raw.withColumns({
        "_ingestion_ts": F.current_timestamp(),
        "_source_path": F.lit(None).cast("string") if source_path is None else source_path,
        "_record_hash": C.record_hash(business),
        "_batch_id": F.lit(batch_id),
        "_partition_date": F.to_date(F.expr("try_to_timestamp(cast(timestamp as string))")),
    })


def latest_per_key(df: DataFrame, key: str = "transaction_id",
                   order: tuple[str, ...] = ("_ingestion_ts", "_record_hash")) -> DataFrame:
    """The last row of each key by `order`; of rows alike there, the one with the greatest other values.

    An aggregate rather than a ranking: copies of a key are reduced before the exchange, so a key
    that repeats without end costs no more than one that does not. The row is one struct led by the
    order, so each column is compared, sorted and moved once.
    """
    rest = [c for c in df.columns if c != key]
    place = {c: f"_{i}" for i, c in enumerate([*order, *[c for c in rest if c not in order]])}
    row = F.struct(*[F.col(c).alias(p) for c, p in place.items()])
    # Maps and variants have no order; with them rows alike in `order` are left to chance.
    unordered = any(t in kind for _, kind in df.select(*place).dtypes for t in ("map<", "variant"))
    last = (F.max_by(row, F.struct(*order)) if unordered else F.max(row)).alias("_row")
    return df.groupBy(key).agg(last).select(*[F.col(f"_row.{place[c]}").alias(c) if c != key else F.col(key)
                                             for c in df.columns])


def cast_fields(df: DataFrame) -> DataFrame:
    """Text to types, null where a value cannot be read, plus calendar columns."""
    typed = df.withColumns({
        "timestamp": F.expr("try_to_timestamp(cast(timestamp as string))"),
        **{c: F.col(c).cast("string").try_cast("double") for c in ("amount", "latitude", "longitude")
           if c in df.columns},
    })
    return typed.withColumns(C.calendar_parts())


def flag_quality(df: DataFrame, **limits) -> DataFrame:
    return df.withColumns(C.dq_flags(**limits)).withColumn("dq_passed", C.dq_passed())


def normalize_currency(df: DataFrame, rates: dict[str, str] = S.FX_TO_INR) -> DataFrame:
    """Amount in INR at fixed rates; an unknown currency counts as 1.0 and is marked."""
    rate = C.fx_rate("currency", rates)
    return df.withColumns({
        "fx_known": rate.isNotNull(),
        "fx_rate_to_inr": F.coalesce(rate, F.lit("1.0").cast("decimal(12,4)")).cast("double"),
    }).withColumn("amount_inr", C.convert(F.col("amount"), F.col("fx_rate_to_inr")))


def convert_as_of(df: DataFrame, rates: DataFrame, day: Column) -> DataFrame:
    """Amount at the rate in force on the day, from dated rates (currency, valid_from, rate).

    The rate is looked up once per currency and day that occur, of which there are few, by filling
    the dated rates forward. The rows then need an equi-join only, never a search over ranges.
    """
    dated = df.withColumn("_day", day)
    asked = dated.select("currency", "_day").distinct().selectExpr("currency", "_day", "1 as _kind")
    known = rates.selectExpr("currency", "valid_from as _day", "0 as _kind", "rate")
    over = "over (partition by currency order by _day, _kind rows between unbounded preceding and current row)"
    found = (asked.unionByName(known, allowMissingColumns=True)
             .selectExpr("currency", "_day", "_kind", f"last(rate, true) {over} as rate").where("_kind = 1").drop("_kind"))
    out = dated.join(found, ["currency", "_day"], "left").drop("_day")
    return out.withColumns({"fx_known": F.col("rate").isNotNull(),
                            "fx_rate_to_inr": F.coalesce(F.col("rate"), F.lit(1.0))}).drop("rate").withColumn(
        "amount_inr", C.convert(F.col("amount"), F.col("fx_rate_to_inr")))


def enrich(df: DataFrame, reference: DataFrame, key: str, attributes: list[str], prefix: str = "") -> DataFrame:
    """Left join with a reference table that has one row per key.

    No broadcast hint: adaptive execution broadcasts the table if its measured size allows, and
    otherwise splits a hot key on the transaction side. Attributes that the transactions already
    have get the prefix.
    """
    names = {a: (prefix + a if a in df.columns else a) for a in attributes}
    right = reference.select(F.col(key), *[F.col(a).alias(n) for a, n in names.items()])
    return df.join(right, key, "left")


def split_by_quality(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that pass and rows for quarantine."""
    return df.where("dq_passed"), df.where("not dq_passed")


def merge_key(columns: list[str], key: str = "transaction_id") -> Column:
    """The key, or for rows without one their content, so that these are kept but stored once."""
    content = F.col("_record_hash") if "_record_hash" in columns else C.record_hash(
        [c for c in columns if c not in METADATA])
    return F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.concat(F.lit("#"), content))


def latest_per_merge_key(df: DataFrame, key: str = "transaction_id",
                         order: tuple[str, ...] = ("_ingestion_ts", "_record_hash")) -> DataFrame:
    """The last row of each merge key, which stays as the column `_merge`.

    A text key is read back from `_merge`, so that the exchange does not move it twice.
    """
    keyed = df.withColumn("_merge", merge_key(df.columns, key))
    if key in order or dict(df.dtypes)[key] != "string":
        return latest_per_key(keyed, "_merge", order)
    own = F.when(F.col("_merge").startswith("="), F.expr("substring(_merge, 2)")).alias(key)
    return latest_per_key(keyed.drop(key), "_merge", order).select(*[own if c == key else c for c in df.columns], "_merge")


def not_yet_stored(batch: DataFrame, stored: DataFrame | None, key: str = "transaction_id",
                   order: tuple[str, ...] = ("_ingestion_ts", "_record_hash")) -> DataFrame:
    """Rows of an insert-only merge: one per key that the stored table does not hold."""
    keyed = latest_per_merge_key(batch, key, order)
    if stored is not None:
        keyed = keyed.join(stored.select(merge_key(batch.columns, key).alias("_merge")), "_merge", "left_anti")
    return keyed.drop("_merge")


def silver(bronze: DataFrame, customers: DataFrame | None = None, merchants: DataFrame | None = None,
           order: tuple[str, ...] = ("_ingestion_ts", "_record_hash"), **limits) -> DataFrame:
    """Deduplicated, typed, flagged, converted and enriched; not yet split by quality, whose limits are those of `dq_flags`."""
    latest = latest_per_merge_key(bronze, order=order).drop("_merge")
    df = normalize_currency(flag_quality(cast_fields(latest), **limits))
    if customers is not None:
        df = enrich(df, customers, "customer_id", S.CUSTOMER_ATTRIBUTES, "ref_")
    if merchants is not None:
        df = enrich(df, merchants, "merchant_id", S.MERCHANT_ATTRIBUTES, "ref_")
    return df
