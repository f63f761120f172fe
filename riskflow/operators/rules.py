"""Rule engine: prior activity of the customer, seven rules, score, severity.

The expressions that judge a row are the same in batch and on a stream; only the way to
`prior_count` and `prior_amount` differs.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.functions import columns as C
from riskflow.operators.frames import UNIT, T, KeyedFrames, units


@dataclass(frozen=True)
class RuleLimits:
    window_s: int = 300
    max_txn: int = 8
    max_amount: float = 100_000
    large_amount: float = 1_000_000
    cnp_amount: float = 50_000
    history: int | None = None   # the latest so many earlier rows count; None: all of the window
    ml_score: int = 20


# Points per rule.
POINTS = {"HIGH_VELOCITY": 35, "VELOCITY_AMOUNT": 30, "HIGH_RISK_MERCHANT": 20, "CNP_INTERNATIONAL": 40,
          "OFF_HOURS_ATM": 25, "LARGE_TRANSACTION": 15, "CNP_HIGH_AMOUNT": 30}


def prior_activity(df: DataFrame, limits: RuleLimits = RuleLimits(), key: str = "customer_id") -> DataFrame:
    """Count and sum of the key's earlier rows of the last `window_s` seconds. Earlier means ordered by time, then id.

    The totals of the window come from running sums over one row per key and second (see `frames`);
    what is not earlier within the own second is taken off again.
    """
    if limits.history is not None:
        return _latest_activity(df, limits, key)
    rows = df.withColumns({T: C.epoch("timestamp"), "_c": F.expr(f"coalesce({units('amount')}, 0)")})
    frames = KeyedFrames(key, block_days=max(1, -(-limits.window_s // 86400))).count("_n", limits.window_s, "1").total("_s", limits.window_s, "_c")
    peers = Window.partitionBy(key, T).orderBy("timestamp", "transaction_id").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    timed = F.col(T).isNotNull()
    return frames.attach(rows).withColumns({
        "prior_count": F.when(timed, F.col("_n") - F.count(F.lit(1)).over(peers)).otherwise(F.lit(0)),
        "prior_amount": F.when(timed, F.col("_s") - F.sum("_c").over(peers)).otherwise(F.lit(0)) / F.lit(float(UNIT)),
    }).drop("_n", "_s", "_c", T)


def _latest_activity(df: DataFrame, limits: RuleLimits, key: str) -> DataFrame:
    """As `prior_activity`, of the latest `history` earlier rows only.

    A key is cut into time slices. The rows that the next slice still looks back to are copied
    into it, so a slice is complete in itself and a hot key spreads over as many tasks as it has
    slices. Earlier means ordered by time, then id.
    """
    w_s = limits.window_s
    length = max(12 * w_s, 3600)
    t = F.col("_rt")
    rows = df.withColumn("_rt", C.epoch("timestamp"))
    # A look-back reaches one slice at most, because a slice is longer than the window.
    rows = rows.withColumn("_slice", F.explode(F.expr(
        f"if(_rt is null, array(cast(null as bigint)),"
        f" if((_rt + {w_s}) div {length} > _rt div {length},"
        f" array(_rt div {length}, _rt div {length} + 1), array(_rt div {length})))")))
    before = (Window.partitionBy(key, "_slice").orderBy("timestamp", "transaction_id")
              .rowsBetween(-limits.history, -1))
    recent = F.filter(F.collect_list(F.struct(t.alias("t"), F.expr(units("amount")).alias("c")))
                      .over(before), lambda e: e["t"] >= t - w_s)
    out = rows.withColumn("_recent", recent).where(F.expr(f"_rt is null or _slice = _rt div {length}"))
    return out.withColumns({
        "prior_count": F.size("_recent").cast("bigint"),
        "prior_amount": F.aggregate("_recent", F.lit(0).cast("bigint"),
                                    lambda a, e: a + F.coalesce(e["c"], F.lit(0).cast("bigint"))) / float(UNIT),
    }).drop("_recent", "_slice", "_rt")


def prior_in_session(df: DataFrame, idle_s: int = 300, key: str = "customer_id", block_days: int = 30) -> DataFrame:
    """Count and sum of the key's earlier rows since it was last idle for `idle_s` seconds.

    Worked out on one row per key and second, in blocks of `block_days` per key; what an open session has so far is carried from block
    to block over one row per key and block. Rows then add what came before them within their own second.
    """
    block = block_days * 86400
    rows = df.withColumns({"_rt": C.epoch("timestamp"), "_c": F.expr(units("amount"))})
    seconds = (rows.where("_rt is not null").groupBy(F.col(key).alias("_key"), "_rt")
               .agg(F.count(F.lit(1)).alias("_n"), F.coalesce(F.sum("_c"), F.lit(0)).alias("_sum"))
               .withColumn("_b", F.expr(f"_rt div {block}")))
    ends = seconds.groupBy("_key", "_b").agg(F.max("_rt").alias("_end")).selectExpr(
        "_key as _ek", "_b as _eb", "lag(_end) over (partition by _key order by _b) as _seen")
    known = seconds.join(ends, F.col("_key").eqNullSafe(F.col("_ek")) & (F.col("_b") == F.col("_eb"))).drop("_ek", "_eb")
    in_block = "over (partition by _key, _b order by _rt"
    started = known.selectExpr("*", f"coalesce(_rt - coalesce(lag(_rt) {in_block}), _seen) >= {idle_s}, true) as _new")
    numbered = started.selectExpr("*", f"count_if(_new) {in_block}) as _session")
    # What the last session of a block holds; one without a start in its block goes on from the block before.
    open_at_end = numbered.groupBy("_key", "_b", "_session").agg(F.sum("_n").alias("_tn"), F.sum("_sum").alias("_ts")).groupBy("_key", "_b").agg(
        F.max("_session").alias("_starts"), F.max_by(F.struct("_tn", "_ts"), "_session").alias("_tail"))
    chains = open_at_end.selectExpr("*", "sum(cast(_starts > 0 as int)) over (partition by _key order by _b) as _chain")
    so_far = "over (partition by _key, _chain order by _b)"
    carried = chains.selectExpr("_key", "_b", f"sum(_tail._tn) {so_far} as _on", f"sum(_tail._ts) {so_far} as _os").selectExpr(
        "_key as _ck", "_b as _cb", "lag(_on) over (partition by _key order by _b) as _cn", "lag(_os) over (partition by _key order by _b) as _cs")
    before = "over (partition by _key, _b, _session order by _rt rows between unbounded preceding and 1 preceding)"
    found = numbered.join(carried, F.col("_key").eqNullSafe(F.col("_ck")) & (F.col("_b") == F.col("_cb"))).selectExpr(
        "_key", "_rt as _st", f"coalesce(sum(_n) {before}, 0) + if(_session = 0, _cn, 0) as _n0", f"coalesce(sum(_sum) {before}, 0) + if(_session = 0, _cs, 0) as _s0")
    joined = rows.join(found, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_rt") == F.col("_st")), "left")
    peers = Window.partitionBy(key, "_rt").orderBy("timestamp", "transaction_id")
    earlier = peers.rowsBetween(Window.unboundedPreceding, -1)
    return joined.withColumns({
        "prior_count": F.col("_n0") + F.row_number().over(peers) - 1,
        "prior_amount": (F.col("_s0") + F.coalesce(F.sum("_c").over(earlier), F.lit(0))) / float(UNIT),
    }).drop("_key", "_st", "_n0", "_s0", "_rt", "_c")


def _thousands(value: Column) -> Column:
    return F.format_number(value, 0)


def rule_results(limits: RuleLimits = RuleLimits()) -> Column:
    """Array of (rule_name, risk_points, reason) of the rules that fire."""
    amount = F.coalesce(F.col("amount"), F.lit(0.0))
    # A missing flag means present for one rule and absent for the other.
    present = F.coalesce(F.col("card_present"), F.lit(True))
    absent = ~F.coalesce(F.col("card_present"), F.lit(False))
    hour = F.coalesce(F.col("hour_of_day"), F.lit(12))
    minutes = limits.window_s // 60
    # Names and wording of the rules.
    tests = {
        "HIGH_VELOCITY": (F.col("prior_count") >= limits.max_txn, F.concat(
            F.lit(f">{limits.max_txn} txns in {minutes} min (actual: "), F.col("prior_count").cast("string"), F.lit(")"))),
        "VELOCITY_AMOUNT": (F.col("prior_amount") + amount > limits.max_amount,
                            F.lit(f"Amount velocity exceeded ₹{limits.max_amount:,.0f} in {minutes} min")),
        "HIGH_RISK_MERCHANT": (F.col("is_high_risk_merchant"), F.concat(
            F.lit("High-risk merchant category: "), F.coalesce(F.col("merchant_category"), F.lit("None")))),
        "CNP_INTERNATIONAL": (~present & F.col("is_international"), F.lit("Card-not-present international transaction")),
        "OFF_HOURS_ATM": ((F.col("transaction_type") == "ATM_WITHDRAWAL") & hour.between(1, 4),
                          F.format_string("ATM withdrawal at %02d:00", hour)),
        "LARGE_TRANSACTION": (amount > limits.large_amount, F.concat(
            F.lit("Transaction amount ₹"), _thousands(amount), F.lit(" exceeds threshold"))),
        "CNP_HIGH_AMOUNT": (absent & (amount > limits.cnp_amount), F.concat(
            F.lit("CNP transaction with high amount ₹"), _thousands(amount))),
    }
    fired = [F.when(test, F.struct(F.lit(name).alias("rule_name"), F.lit(POINTS[name]).alias("risk_points"),
                                   reason.alias("reason"))) for name, (test, reason) in tests.items()]
    return F.array_compact(F.array(*fired))


def score_rules(df: DataFrame, limits: RuleLimits = RuleLimits()) -> DataFrame:
    """Score, names, reasons, severity and whether a model should look, from the prior activity."""
    out = df.withColumn("_rules", rule_results(limits))
    points = F.aggregate(F.col("_rules.risk_points"), F.lit(0), lambda a, p: a + p)
    out = out.withColumn("rule_based_score", F.least(points, F.lit(100)))
    return out.withColumns({
        "rules_triggered": F.col("_rules.rule_name"),
        "rule_reasons": F.col("_rules.reason"),
        "rule_severity": C.risk_band(F.col("rule_based_score")),
        "requires_ml_scoring": F.col("rule_based_score") >= limits.ml_score,
    }).drop("_rules")


def run_rules(df: DataFrame, limits: RuleLimits = RuleLimits(), mode: str = "window") -> DataFrame:
    """The batch form of the rule engine; `mode` is `window`, or `ttl_session` for activity since the key was last idle."""
    if mode not in ("window", "ttl_session"):
        raise ValueError(f"unknown mode {mode}")
    prior = prior_activity(df, limits) if mode == "window" else prior_in_session(df, limits.window_s)
    return score_rules(prior, limits)


def first_within(df: DataFrame, key: str, ttl_s: int = 60) -> DataFrame:
    """Which seconds of a key are answered anew: each at least `ttl_s` after the last one answered.

    Columns `key`, `_t`, `requests`. Requests are counted per key and second first. Every answer
    depends on the one before, so a key is read in order, but as a stream: a task holds one batch
    and the last answer, never a whole key.
    """
    per_second = (df.withColumn("_t", C.epoch("timestamp")).where("_t is not null")
                  .groupBy(key, "_t").agg(F.count(F.lit(1)).alias("requests")))
    ordered = per_second.repartition(key).sortWithinPartitions(key, "_t")

    def answered(batches):
        last_key, last_t = object(), 0
        for batch in batches:                      # Arrow keeps null keys equal and whole numbers whole
            keep = []
            for k, t in zip(batch.column(key).to_pylist(), batch.column("_t").to_pylist(), strict=True):
                fresh = k != last_key or t >= last_t + ttl_s
                if fresh:
                    last_key, last_t = k, t
                keep.append(fresh)
            yield batch.filter(pa.array(keep))

    return ordered.mapInArrow(answered, ordered.schema)
