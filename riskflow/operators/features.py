"""Per-transaction features.

Each group is a pair: what it asks of a key's frames, and the columns derived from the answers.
`build_features` lets all groups of one key share a single pass, so the rows are exchanged once
per key: customer, device, address, merchant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow import schemas as S
from riskflow.functions import columns as C
from riskflow.operators.frames import T, UNIT, KeyedFrames, units
from riskflow.operators.quantiles import frame_median


def with_second(df: DataFrame) -> DataFrame:
    return df if T in df.columns else df.withColumn(T, C.epoch("timestamp"))


def _bool_counts(frames: KeyedFrames, name: str, seconds: int, condition: str) -> None:
    """Numerator and denominator of a share that leaves nulls out."""
    frames.total(f"_{name}_hits", seconds, f"cast({condition} as int)")
    frames.count(f"_{name}_of", seconds, condition)


def _share(name: str) -> Column:
    return C.ratio(F.col(f"_{name}_hits"), F.col(f"_{name}_of"))


# -- velocity ---------------------------------------------------------------------------

def _ask_velocity(f: KeyedFrames, as_of: bool = False) -> None:
    f.count("txn_count_1h", S.HOUR).count("txn_count_24h", S.DAY).count("txn_count_7d", S.WEEK)
    f.total("txn_amount_1h", S.HOUR, units("amount")).total("txn_amount_24h", S.DAY, units("amount"))
    _ask_amount_moments(f)
    exact = f"cast({units('amount')} as decimal(18,0))"
    f.total("_sq_30d", S.DAYS_30, f"{exact} * {exact}")
    f.max_day_total("max_single_day", units("amount"))
    if as_of:
        f.total_today("_today", units("amount"))


def _ask_amount_moments(f: KeyedFrames) -> None:
    f.count("_n_30d", S.DAYS_30, "amount").total("_sum_30d", S.DAYS_30, units("amount"))


def _mean_30d() -> Column:
    return C.ratio(_units("_sum_30d"), F.col("_n_30d"))


def _units(total: str | Column) -> Column:
    """A total of ten-thousandths as an amount."""
    return (F.col(total) if isinstance(total, str) else total) / F.lit(float(UNIT))


def _velocity(df: DataFrame, as_of: bool = False) -> DataFrame:
    # Sample deviation from exact sums: the subtraction is done in decimals.
    n = F.col("_n_30d").cast("double")
    squares = F.expr("cast(_sq_30d * cast(_n_30d as decimal(12,0))"
                     " - cast(_sum_30d as decimal(19,0)) * cast(_sum_30d as decimal(19,0)) as double)")
    spread = F.when(n > 1, F.sqrt(squares / (n * (n - 1))) / float(UNIT))
    day_total = F.col("max_single_day")
    if as_of:
        # Drop the current day's whole total and use what it had reached by now.
        day_total = F.greatest(F.col("_past_days"), F.col("_today"))
    return df.withColumns({
        "amt_zscore_30d": F.when(spread > 0, (F.col("amount") - _mean_30d()) / spread).otherwise(0.0),
        "velocity_spike": C.flag((F.col("txn_count_24h") > 0)
                                 & (F.col("txn_count_1h") * 24 > F.col("txn_count_24h") * 2)),
        "max_single_day": _units(day_total),
        "txn_amount_1h": _units("txn_amount_1h"),
        "txn_amount_24h": _units("txn_amount_24h"),
    })


# -- behaviour --------------------------------------------------------------------------

def _ask_behavior(f: KeyedFrames, columns: list[str], hot_rows: int) -> None:
    _ask_amount_moments(f)
    _bool_counts(f, "intl_30d", S.DAYS_30, "is_international")
    _bool_counts(f, "cnp_30d", S.DAYS_30, "(not card_present)")
    f.distinct("unique_merchants_7d", S.WEEK, "merchant_id")
    f.distinct("unique_countries_30d", S.DAYS_30, "country_code")
    f.first_second("_first_t")
    f.per_second_value("median_txn_amount_30d",
                       lambda rows: frame_median(rows, S.DAYS_30, "median_txn_amount_30d", hot_rows))
    _ask_history(f, columns)


def _ask_history(f: KeyedFrames, columns: list[str]) -> None:
    if "rule_based_score" in columns:
        f.total("_risk_30d", S.DAYS_30, "cast(coalesce(rule_based_score, 0) as bigint)")
        f.count("_rows_30d", S.DAYS_30, "1")


def _behavior(df: DataFrame) -> DataFrame:
    return _tenure(_history(df.withColumns({
        "avg_txn_amount_30d": _mean_30d(),
        "amount_ratio_to_avg": C.ratio(F.col("amount"), _mean_30d(), 1.0),
        "pct_international_30d": _share("intl_30d"),
        "pct_cnp_30d": _share("cnp_30d"),
        "typical_amount_band": C.amount_band(F.col("amount")),
    })))


def _history(df: DataFrame) -> DataFrame:
    score = C.ratio(F.col("_risk_30d"), F.col("_rows_30d")) if "_risk_30d" in df.columns else F.lit(0.0)
    return df.withColumn("customer_risk_score_hist", score)


def _tenure(df: DataFrame) -> DataFrame:
    first = F.timestamp_seconds("_first_t")
    return df.withColumn("days_since_first_txn", F.datediff("timestamp", first))


# -- geography --------------------------------------------------------------------------

# Country as a value of its own kind, so that unknown is one of them.
_COUNTRY = "coalesce(concat('=', country_code), '')"
_PAYLOAD = "struct(timestamp as ts, transaction_id as id, latitude as lat, longitude as lon)"
_PEERS = ("timestamp", "transaction_id")


def _ask_previous(f: KeyedFrames) -> None:
    f.previous_row(_PAYLOAD)


def _ask_geo(f: KeyedFrames, home: str) -> None:
    _ask_previous(f)
    f.sole_values("_new_countries", S.DAYS_30, _COUNTRY)
    f.count("_home_90d", S.DAYS_90, f"if(country_code = '{home}', 1, null)")
    f.count("_all_90d", S.DAYS_90)


def _resolve_previous(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """The row before this one: within its second if there is one, else `_prev` of the frames."""
    return _with_peer(df, key).withColumn("_prev", F.coalesce("_peer", "_prev")).drop("_peer")


def _with_peer(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """`_peer`: the row before this one within its second."""
    return df.withColumn("_peer", F.lag(F.expr(_PAYLOAD)).over(Window.partitionBy(key, T).orderBy(*_PEERS)))


def _geo(df: DataFrame, max_kmph: float) -> DataFrame:
    prev = F.col("_prev")
    km = F.when(prev["lat"].isNotNull(), C.planar_km(F.col("latitude"), F.col("longitude"), prev["lat"], prev["lon"]))
    minutes = (F.col(T) - C.epoch(prev["ts"])) / 60.0
    km, minutes = F.coalesce(km, F.lit(0.0)), F.coalesce(minutes, F.lit(0.0))
    speed = F.when((minutes > 0) & (km > 0), km / (minutes / 60.0)).otherwise(0.0)
    return df.withColumns({
        "distance_from_last_txn_km": km,
        "time_since_last_txn_min": minutes,
        "implied_travel_speed_kmph": speed,
        "is_impossible_travel": C.flag(speed > max_kmph),
        "is_new_country": C.flag(F.expr(f"array_contains(_new_countries, {_COUNTRY})")),
        "home_country_pct": C.ratio(F.col("_home_90d"), F.col("_all_90d"), 1.0),
    })


# -- devices, addresses, merchants ------------------------------------------------------

def _ask_label(f: KeyedFrames, name: str, columns: list[str]) -> None:
    if S.LABEL in columns:
        f.total(f"_{name}_hits", S.DAYS_30, S.LABEL).count(f"_{name}_of", S.DAYS_30, S.LABEL)


def _label_rate(df: DataFrame, name: str, exclude_current: bool) -> Column:
    """Share of positive labels in the frame, with or without the row's own label."""
    if f"_{name}_hits" not in df.columns:
        return F.lit(0.0)
    if not exclude_current:
        return _share(name)
    own = F.col(S.LABEL)
    return C.ratio(F.col(f"_{name}_hits") - F.coalesce(own, F.lit(0)),
                   F.col(f"_{name}_of") - own.isNotNull().cast("int"), 0.0)


def _ask_device(f: KeyedFrames, columns: list[str]) -> None:
    f.count("device_txn_count_24h", S.DAY).count("_device_30d", S.DAYS_30)
    f.distinct("device_customer_count_7d", S.WEEK, "customer_id")
    _ask_label(f, "device_label", columns)


def _device(df: DataFrame, max_customers: int, exclude_current: bool) -> DataFrame:
    return df.withColumns({
        "is_new_device": C.flag(F.col("_device_30d") <= 1),
        "device_fraud_rate_30d": _label_rate(df, "device_label", exclude_current),
        "multi_account_device": C.flag(F.col("device_customer_count_7d") > max_customers),
    })


def _ask_merchant(f: KeyedFrames, columns: list[str]) -> None:
    f.count("merchant_txn_count_7d", S.WEEK)
    f.count("_merchant_n", S.DAYS_30, "amount").total("_merchant_sum", S.DAYS_30, units("amount"))
    f.distinct("merchant_unique_cards_7d", S.WEEK, "card_bin")
    _ask_label(f, "merchant_label", columns)


def _merchant(df: DataFrame, exclude_current: bool) -> DataFrame:
    mean = C.ratio(_units("_merchant_sum"), F.col("_merchant_n"))
    return df.withColumns({
        "merchant_fraud_rate_30d": _label_rate(df, "merchant_label", exclude_current),
        "merchant_avg_amount_30d": mean,
        "merchant_amount_deviation": C.ratio(F.abs(F.col("amount") - mean), mean, 0.0),
        "merchant_risk_tier": C.merchant_risk_tier(F.col("is_high_risk_merchant"), F.col("merchant_category")),
        "is_mcc_high_risk": C.flag(F.col("is_high_risk_merchant")),
    })


def _temporal(df: DataFrame, fraud_hours, weekend) -> DataFrame:
    hour = C.hour_angle(F.col("hour_of_day"))
    days = F.datediff("timestamp", F.col("_prev")["ts"]).cast("double")
    return df.withColumns({
        "is_fraud_hour": C.flag(F.col("hour_of_day").isin(*fraud_hours)),
        "is_weekend": C.flag(F.col("day_of_week").isin(*weekend)),
        "is_month_end": C.is_month_end("timestamp"),
        "days_since_last_txn": F.coalesce(days, F.lit(30.0)),
        "txn_hour_sin": F.sin(hour),
        "txn_hour_cos": F.cos(hour),
    })


# -- public -----------------------------------------------------------------------------

def _finish(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop helper columns, which all start with an underscore."""
    return df.drop(*[c for c in df.columns if c.startswith("_") and c not in columns])


def add_velocity_features(df: DataFrame, as_of: bool = False) -> DataFrame:
    """Counts and sums over 1 h to 7 d, z-score, spike flag and greatest day total.

    `max_single_day` counts the current day whole, also what follows the row; with `as_of` only
    what it had reached by then.
    """
    f = KeyedFrames("customer_id")
    _ask_velocity(f, as_of)
    return _finish(_velocity(f.attach(with_second(df)), as_of), df.columns)


def add_behavioral_features(df: DataFrame, hot_rows: int = 2000) -> DataFrame:
    """Spending level, shares, variety and tenure of the customer."""
    f = KeyedFrames("customer_id")
    _ask_behavior(f, df.columns, hot_rows)
    return _finish(_behavior(f.attach(with_second(df))), df.columns)


def add_risk_history(df: DataFrame) -> DataFrame:
    """Mean rule score of the customer over 30 days, 0 where rules were not run."""
    f = KeyedFrames("customer_id")
    _ask_history(f, df.columns)
    return _finish(_history(f.attach(with_second(df))), df.columns)


def add_geo_features(df: DataFrame, home_country: str = "IND", max_kmph: float = 900) -> DataFrame:
    """Distance, time and speed since the previous row, new country, home share."""
    f = KeyedFrames("customer_id")
    _ask_geo(f, home_country)
    return _finish(_geo(_resolve_previous(f.attach(with_second(df))), max_kmph), df.columns)


def add_device_features(df: DataFrame, max_customers: int = 2, exclude_current: bool = False) -> DataFrame:
    """Use of the device and of the address."""
    device = KeyedFrames("device_id")
    _ask_device(device, df.columns)
    address = KeyedFrames("ip_address").count("ip_txn_count_1h", S.HOUR)
    out = _device(address.attach(device.attach(with_second(df))), max_customers, exclude_current)
    return _finish(out, df.columns)


def add_merchant_features(df: DataFrame, exclude_current: bool = False) -> DataFrame:
    """Volume, label rate, price level and cards of the merchant."""
    f = KeyedFrames("merchant_id")
    _ask_merchant(f, df.columns)
    return _finish(_merchant(f.attach(with_second(df)), exclude_current), df.columns)


def add_temporal_features(df: DataFrame, fraud_hours=S.FRAUD_HOURS, weekend=S.WEEKEND) -> DataFrame:
    """Hour and day flags, days since the previous row, hour as an angle."""
    f = KeyedFrames("customer_id")
    _ask_previous(f)
    return _finish(_temporal(_resolve_previous(f.attach(with_second(df))), fraud_hours, weekend), df.columns)


def build_features(df: DataFrame, *, home_country: str = "IND", max_kmph: float = 900,
                   max_customers: int = 2, as_of: bool = False, exclude_current: bool = False,
                   hot_rows: int = 2000, fraud_hours=S.FRAUD_HOURS, weekend=S.WEEKEND, block_days: int = 30) -> DataFrame:
    """All feature groups; the rows themselves are exchanged once per key.

    `df` is read once per part of a frame, so what is expensive to make should be stored before.
    `block_days` bounds what one task sees of a key; it changes no result.
    """
    customer = KeyedFrames("customer_id", block_days)
    _ask_velocity(customer, as_of)
    _ask_behavior(customer, df.columns, hot_rows)
    _ask_geo(customer, home_country)
    device, merchant = KeyedFrames("device_id", block_days), KeyedFrames("merchant_id", block_days)
    _ask_device(device, df.columns)
    _ask_merchant(merchant, df.columns)
    address = KeyedFrames("ip_address", block_days).count("ip_txn_count_1h", S.HOUR)

    base = with_second(df)
    # The frames are computed from the input, not from the widened rows; the rows are exchanged with the few columns first.
    out = base
    for frames in (address, device, merchant):
        out = frames.attach(out, source=base)
    # The row before this one within its second needs no exchange of its own.
    out = customer.attach(out, source=base, peers=_PEERS)
    out = out.withColumn("_prev", F.coalesce("_peer", "_prev")).drop("_peer")
    out = _geo(_behavior(_velocity(out, as_of)), max_kmph)
    out = _merchant(_device(out, max_customers, exclude_current), exclude_current)
    return _finish(_temporal(out, fraud_hours, weekend), df.columns)


def gold_table(features: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Final columns and `extra` ones (absent ones are left out) with null numbers set to 0."""
    kept = features.select(*[c for c in (*S.GOLD_COLUMNS, *extra) if c in features.columns])
    return fill_numeric(kept)


def fill_numeric(df: DataFrame, value: float = 0.0) -> DataFrame:
    """Nulls of double, int and long columns replaced; other types stay as they are."""
    names = [n for n, t in df.dtypes if t in ("double", "int", "bigint")]
    return df.fillna(value, subset=names)


def backfill_features(df: DataFrame) -> DataFrame:
    """Model inputs all present as double, the label as int, nulls as 0."""
    known = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0)
             for c in S.MODEL_FEATURES}
    label = F.coalesce(F.col(S.LABEL).cast("int"), F.lit(0)) if S.LABEL in df.columns else F.lit(0)
    return df.withColumns({**known, S.LABEL: label})
