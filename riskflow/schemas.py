"""Record layouts, feature lists and fixed reference values."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and types of a transaction.
TRANSACTION_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("account_number", T.StringType(), False),
    T.StructField("transaction_type", T.StringType(), False),
    T.StructField("amount", T.DoubleType(), False),
    T.StructField("currency", T.StringType()),
    T.StructField("merchant_id", T.StringType()),
    T.StructField("merchant_category", T.StringType()),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("device_id", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("card_present", T.BooleanType()),
    T.StructField("card_bin", T.StringType()),
    T.StructField("bank_code", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("is_international", T.BooleanType()),
    T.StructField("is_high_risk_merchant", T.BooleanType()),
    T.StructField("hour_of_day", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("is_fraud", T.IntegerType()),
])

# The message carries its time and amount as text, so that a bad value can be told
# apart from an absent one.
RAW_SCHEMA = T.StructType([
    T.StructField(f.name, T.StringType() if f.name in ("timestamp", "amount", "latitude", "longitude")
                  else f.dataType, True)
    for f in TRANSACTION_SCHEMA.fields
] + [
    T.StructField("merchant_name", T.StringType()),
    T.StructField("local_timestamp", T.StringType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("schema_version", T.StringType()),
])

# Feature names, in the order of the stored table.
VELOCITY_FEATURES = [
    "txn_count_1h", "txn_count_24h", "txn_count_7d", "txn_amount_1h", "txn_amount_24h",
    "amt_zscore_30d", "velocity_spike", "max_single_day",
]
BEHAVIORAL_FEATURES = [
    "avg_txn_amount_30d", "median_txn_amount_30d", "amount_ratio_to_avg",
    "pct_international_30d", "pct_cnp_30d", "unique_merchants_7d", "unique_countries_30d",
    "typical_amount_band", "days_since_first_txn", "customer_risk_score_hist",
]
GEO_FEATURES = [
    "distance_from_last_txn_km", "time_since_last_txn_min", "implied_travel_speed_kmph",
    "is_impossible_travel", "is_new_country", "home_country_pct",
]
DEVICE_FEATURES = [
    "device_txn_count_24h", "device_customer_count_7d", "is_new_device",
    "device_fraud_rate_30d", "ip_txn_count_1h", "multi_account_device",
]
MERCHANT_FEATURES = [
    "merchant_txn_count_7d", "merchant_fraud_rate_30d", "merchant_avg_amount_30d",
    "merchant_amount_deviation", "merchant_unique_cards_7d", "merchant_risk_tier",
    "is_mcc_high_risk",
]
TEMPORAL_FEATURES = [
    "is_fraud_hour", "is_weekend", "is_month_end", "days_since_last_txn",
    "txn_hour_sin", "txn_hour_cos",
]
ENGINEERED_FEATURES = (VELOCITY_FEATURES + BEHAVIORAL_FEATURES + GEO_FEATURES
                       + DEVICE_FEATURES + MERCHANT_FEATURES + TEMPORAL_FEATURES)
MODEL_FEATURES = ENGINEERED_FEATURES + ["amount", "is_international", "is_high_risk_merchant"]
LABEL = "is_fraud"

IDENTITY_COLUMNS = [
    "transaction_id", "customer_id", "timestamp", "amount", "transaction_type",
    "is_international", "card_present", "is_high_risk_merchant", "hour_of_day", "day_of_week",
]
GOLD_COLUMNS = IDENTITY_COLUMNS + ENGINEERED_FEATURES + [LABEL]

CUSTOMER_ATTRIBUTES = ["customer_segment", "kyc_status", "account_age_days", "credit_score"]
MERCHANT_ATTRIBUTES = ["merchant_name", "merchant_risk_band", "mcc_code", "on_watchlist"]

# Fixed values.
HOUR, DAY, WEEK = 3600, 86400, 604800
DAYS_30, DAYS_90 = 30 * DAY, 90 * DAY
FRAUD_HOURS = (1, 2, 3, 4)
WEEKEND = (1, 7)                     # Spark's dayofweek: Sunday is 1, Saturday is 7
HIGH_RISK_CATEGORIES = ("CASINO", "CRYPTO_EXCHANGE", "MONEY_TRANSFER", "ONLINE_GAMING", "ADULT_CONTENT")
FX_TO_INR = {"USD": "83.50", "GBP": "105.20", "EUR": "90.15", "SGD": "62.40",
             "AED": "22.73", "CNY": "11.52", "INR": "1.00"}
BANDS = (("CRITICAL", 85), ("HIGH", 65), ("MEDIUM", 45), ("LOW", None))
RECOMMENDATIONS = {
    "CRITICAL": "BLOCK transaction immediately. Trigger fraud alert. Freeze card.",
    "HIGH": "FLAG for manual review within 15 minutes. Enable step-up authentication.",
    "MEDIUM": "Enhanced monitoring. Request OTP verification. Log for review.",
    "LOW": "APPROVE. Continue normal transaction processing.",
}
TOPIC_RAW = "banking.transactions.raw"
TOPIC_HIGH_VALUE = "banking.transactions.high_value"
TOPIC_INTERNATIONAL = "banking.transactions.international"
TOPIC_ALERTS = "banking.fraud.alerts"
TOPIC_SCORED = "banking.fraud.scored"
TOPIC_DEAD_LETTER = "banking.transactions.dlq"

# Request defaults. Ranges follow from the kind of the feature (below).
FEATURE_DEFAULTS = {
    "txn_count_1h": 1.0, "txn_count_24h": 3.0, "txn_count_7d": 15.0,
    "txn_amount_1h": 15000.0, "txn_amount_24h": 35000.0, "amt_zscore_30d": 0.0,
    "velocity_spike": 0.0, "max_single_day": 50000.0, "avg_txn_amount_30d": 8000.0,
    "median_txn_amount_30d": 5000.0, "amount_ratio_to_avg": 1.0,
    "pct_international_30d": 0.05, "pct_cnp_30d": 0.3, "unique_merchants_7d": 4.0,
    "unique_countries_30d": 1.0, "typical_amount_band": 2.0, "days_since_first_txn": 180.0,
    "customer_risk_score_hist": 5.0, "distance_from_last_txn_km": 10.0,
    "time_since_last_txn_min": 120.0, "implied_travel_speed_kmph": 50.0,
    "is_impossible_travel": 0.0, "is_new_country": 0.0, "home_country_pct": 0.95,
    "device_txn_count_24h": 2.0, "device_customer_count_7d": 1.0, "is_new_device": 0.0,
    "device_fraud_rate_30d": 0.001, "ip_txn_count_1h": 1.0, "multi_account_device": 0.0,
    "merchant_txn_count_7d": 500.0, "merchant_fraud_rate_30d": 0.002,
    "merchant_avg_amount_30d": 5000.0, "merchant_amount_deviation": 0.2,
    "merchant_unique_cards_7d": 200.0, "merchant_risk_tier": 1.0, "is_mcc_high_risk": 0.0,
    "is_fraud_hour": 0.0, "is_weekend": 0.0, "is_month_end": 0.0, "days_since_last_txn": 1.0,
    "txn_hour_sin": 0.0, "txn_hour_cos": 1.0, "is_international": 0.0,
    "is_high_risk_merchant": 0.0,
}
_UNIT = ("pct_international_30d", "pct_cnp_30d", "home_country_pct", "velocity_spike",
         "multi_account_device")
_TIER = ("typical_amount_band", "merchant_risk_tier")


def feature_range(name: str) -> tuple[float | None, float | None]:
    """Allowed range of a model input: flags and shares, tiers, cyclical terms, the rest."""
    if name == "amt_zscore_30d":
        return None, None
    if name.startswith("is_") or name in _UNIT:
        return 0.0, 1.0
    if name in _TIER:
        return 0.0, 4.0
    if name.startswith("txn_hour_"):
        return -1.0, 1.0
    return 0.0, None
