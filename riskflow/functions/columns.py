"""Row-level expressions. All are built-in functions, so they stay inside generated code."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskflow import schemas as S

MONEY = "decimal(18,4)"


def epoch(ts: Column | str) -> Column:
    """Whole seconds since 1970; the order key of every time frame."""
    return F.unix_timestamp(ts)


def money(value: Column | str) -> Column:
    """Exact decimal form of an amount, so that sums do not depend on row order."""
    return (F.col(value) if isinstance(value, str) else value).cast(MONEY)


def ratio(num: Column, den: Column, otherwise: float | None = None) -> Column:
    """num / den as double, `otherwise` where den is null or not positive."""
    out = F.when(den > 0, num.cast("double") / den.cast("double"))
    return out if otherwise is None else out.otherwise(F.lit(otherwise))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for null)."""
    return F.when(condition, 1).otherwise(0)


# -- calendar ---------------------------------------------------------------------------

def calendar_parts(ts: str = "timestamp") -> dict[str, Column]:
    return {
        "hour_of_day": F.hour(ts),
        "day_of_week": F.dayofweek(ts),
        "week_of_year": F.weekofyear(ts),
        "year_month": F.date_format(ts, "yyyy-MM"),
    }


def hour_angle(hour: Column) -> Column:
    return hour * F.lit(2 * math.pi / 24)


def is_month_end(ts: Column | str, first_day: int = 28) -> Column:
    return flag(F.dayofmonth(ts) >= first_day)


# -- data quality -----------------------------------------------------------------------

def dq_flags(max_amount: float = 10_000_000, earliest: str = "2020-01-01", zero_amounts: bool = False) -> dict[str, Column]:
    """Validity flags; a null input is never valid, an amount of 0 only with `zero_amounts`."""
    amount, ts, customer = F.col("amount"), F.col("timestamp"), F.col("customer_id")
    return {
        "dq_amount_valid": F.coalesce((amount >= 0 if zero_amounts else amount > 0) & (amount < max_amount), F.lit(False)),
        "dq_timestamp_valid": F.coalesce(ts > F.lit(earliest).cast("timestamp"), F.lit(False)),
        "dq_customer_valid": F.coalesce(F.length(customer.cast("string")) > 0, F.lit(False)),
    }


def dq_passed(names: Iterable[str] = ("dq_amount_valid", "dq_timestamp_valid", "dq_customer_valid")) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n) for n in names])


def record_hash(columns: Iterable[str]) -> Column:
    """SHA-256 of the business columns, each with its length before it and a sign of its own for null.

    Neither separators within values nor nulls make different rows alike.
    """
    texts = [F.col(c).cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


# -- currency ---------------------------------------------------------------------------

def fx_rate(currency: Column | str = "currency", rates: Mapping[str, str] = S.FX_TO_INR) -> Column:
    """Rate from a fixed table, null for a currency it does not list."""
    table = F.create_map(*[x for k, v in rates.items() for x in (F.lit(k), F.lit(v).cast("decimal(12,4)"))])
    return F.try_element_at(table, F.col(currency) if isinstance(currency, str) else currency)


def convert(amount: Column, rate: Column) -> Column:
    """Amount times rate, rounded to cents in decimal arithmetic."""
    return F.round(amount.cast(MONEY) * rate.cast("decimal(12,4)"), 2).cast("double")


# -- feature encodings ------------------------------------------------------------------

def amount_band(amount: Column, edges: Iterable[float] = (500, 5000, 50000, 500000)) -> Column:
    """Number of band edges at or below the amount; the top band also takes nulls."""
    edges = list(edges)
    below = reduce(lambda a, b: a + b, [(amount >= e).cast("int") for e in edges])
    return F.coalesce(below, F.lit(len(edges)))


def merchant_risk_tier(high_risk: Column, category: Column) -> Column:
    return (F.when(high_risk, 4)
            .when(category.isin("JEWELRY", "TRAVEL"), 3)
            .when(category.isin("ELECTRONICS", "FUEL"), 2)
            .when(category.isin("RESTAURANT", "GROCERY"), 0)
            .otherwise(1))


def planar_km(lat: Column, lon: Column, lat0: Column, lon0: Column) -> Column:
    """Distance on a local plane: 111 km per degree, longitude shortened by latitude."""
    north = (lat - lat0) * 111.0
    east = (lon - lon0) * 111.0 * F.cos(F.radians(lat))
    return F.sqrt(north * north + east * east)


# -- scores -----------------------------------------------------------------------------

def risk_band(score: Column) -> Column:
    out = F
    for name, floor in S.BANDS:
        out = out.when(score >= floor, name) if floor is not None else out.otherwise(name)
    return out


def recommendation(band: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in S.RECOMMENDATIONS.items() for x in kv])
    return F.try_element_at(table, band)


def scale_score(raw: Column) -> Column:
    """Model output in [0, 1] to a score in [0, 100]."""
    return F.least(F.greatest(raw * 100, F.lit(0.0)), F.lit(100.0))


def ensemble_score(primary: Column, challenger: Column, anomaly: Column,
                   weights: tuple[float, float, float] = (0.55, 0.35, 0.10)) -> Column:
    return scale_score(primary * weights[0] + challenger * weights[1] + anomaly * weights[2])


# Points of the fallback scorer.
FALLBACK_POINTS = {
    "velocity_spike": 20, "is_impossible_travel": 35, "is_new_device": 15, "is_new_country": 25,
    "is_mcc_high_risk": 15, "multi_account_device": 30, "is_fraud_hour": 10,
    "amount_ratio_to_avg > 5": 20, "amt_zscore_30d > 3": 15, "pct_cnp_30d > 0.8": 10,
}


def fallback_score() -> Column:
    """Additive score over ten flags, at most 100."""
    terms = [F.when(F.expr(test if ">" in test else f"{test} <> 0"), points).otherwise(0)
             for test, points in FALLBACK_POINTS.items()]
    return F.least(reduce(lambda a, b: a + b, terms), F.lit(100)).cast("double")


def contract_violations() -> Column:
    """Names of the model inputs that are outside their allowed range."""
    checks = [F.when(~(F.col("amount") > 0), F.lit("amount"))]
    for name in S.FEATURE_DEFAULTS:
        lo, hi = S.feature_range(name)
        value = F.col(name).cast("double")
        bounds = [value < lo] * (lo is not None) + [value > hi] * (hi is not None)
        if bounds:
            checks.append(F.when(reduce(lambda a, b: a | b, bounds), F.lit(name)))
    return F.filter(F.array(*checks), lambda c: c.isNotNull())


def contract_defaults() -> dict[str, Column]:
    return {name: F.coalesce(F.col(name).cast("double"), F.lit(default))
            for name, default in S.FEATURE_DEFAULTS.items()}


# -- routing ----------------------------------------------------------------------------

def input_topic(amount: Column, international: Column, high_value: float = 500_000) -> Column:
    return (F.when(amount > high_value, S.TOPIC_HIGH_VALUE)
            .when(international, S.TOPIC_INTERNATIONAL)
            .otherwise(S.TOPIC_RAW))


def output_topics(severity: Column) -> Column:
    """Every record is queued for scoring, the two top severities also raise an alert."""
    scored, alerts = F.lit(S.TOPIC_SCORED), F.lit(S.TOPIC_ALERTS)
    return F.when(severity.isin("CRITICAL", "HIGH"), F.array(alerts, scored)).otherwise(F.array(scored))
