import json

import pytest
from pyspark.sql import functions as F

from riskflow.operators import cleanse
from riskflow.plans import jobs
from riskflow.sources import tables as IO


def raw(i, **over):
    row = {"transaction_id": f"t{i}", "customer_id": f"c{i % 3}", "account_number": "a", "transaction_type": "UPI",
           "amount": str(100.0 + i), "currency": "USD" if i % 2 else "INR", "merchant_id": f"m{i % 2}",
           "merchant_category": "GROCERY", "timestamp": f"2024-02-0{1 + i % 3} 10:00:{i:02d}", "device_id": "d",
           "device_type": "POS", "ip_address": "i", "latitude": "1.5", "longitude": "2.5", "country_code": "IND",
           "city": "X", "card_present": True, "card_bin": "b", "bank_code": "k", "channel": "POS",
           "is_international": False, "is_high_risk_merchant": False, "is_fraud": 0}
    return {**row, **over}


@pytest.fixture
def source(tmp_path):
    rows = [raw(i) for i in range(12)] + [
        raw(0), raw(20, amount="abc"), raw(21, amount="-5"), raw(22, timestamp="bad"), raw(23, customer_id=""),
        raw(24, timestamp="2019-01-01 00:00:00"), raw(25, amount="10000000"), raw(26, customer_id=None)]
    path = tmp_path / "in"
    path.mkdir()
    (path / "a.json").write_text("\n".join(json.dumps(r) for r in rows) + "\n{broken\n")
    return str(path)


def test_bronze_is_idempotent_and_silver_splits(spark, source, tmp_path):
    bronze, silver, bad = (str(tmp_path / n) for n in ("bronze", "silver", "quarantine"))
    for _ in range(2):
        jobs.ingest_bronze(spark, source, bronze, multi_line=False)
    stored = spark.read.parquet(bronze)
    assert stored.where("transaction_id is not null").count() == 19
    assert stored.where("_corrupt_record is not null").count() == 1      # without a key, told apart by content
    counts = jobs.transform_silver(spark, bronze, silver, bad)
    clean = spark.read.parquet(silver)
    assert counts["clean"] == clean.count() == 12
    assert counts["quarantined"] == spark.read.parquet(bad).count() == 8
    row = clean.where("transaction_id = 't1'").first()
    assert row["amount_inr"] == pytest.approx(101 * 83.5) and row["year_month"] == "2024-02"
    assert set(clean.select("hour_of_day").distinct().toPandas()["hour_of_day"]) == {10}


def test_record_hash_ignores_ingestion_columns(spark, source):
    df = IO.read_raw(spark, source, multi_line=False)
    first = cleanse.with_metadata(df, "one").select("transaction_id", "_record_hash")
    again = cleanse.with_metadata(cleanse.with_metadata(df, "x"), "two").select("transaction_id", "_record_hash")
    assert first.exceptAll(again).isEmpty()


def test_latest_copy_of_a_key_wins_also_for_a_hot_key(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1000, F.lit(0)).otherwise(F.col("id")).alias("transaction_id"),
                                  F.col("id").alias("seq"), F.lit("x").alias("payload"))
    out = cleanse.latest_per_key(df, order=("seq",))
    assert out.columns == df.columns and out.count() == 2001
    assert out.where("transaction_id = 0").first()["seq"] == 999


def test_copies_alike_in_order_leave_the_same_row_in_any_sequence(spark):
    rows = [("k", 1, "a", None), ("k", 1, "b", 2), ("k", 1, "b", 1), ("k", 0, "z", 9)]
    schema = "transaction_id string, seq int, payload string, n int"
    for given in (rows, rows[::-1], rows[1:] + rows[:1]):
        df = spark.createDataFrame(given, schema).coalesce(1)
        assert [tuple(r) for r in cleanse.latest_per_key(df, order=("seq",)).collect()] == [("k", 1, "b", 2)]
        assert [tuple(r) for r in cleanse.not_yet_stored(df, None, order=("seq",)).collect()] == [("k", 1, "b", 2)]


def test_a_text_key_is_moved_once_and_comes_back_as_it_was(spark):
    keys = ["a", "=a", "#a", "", "=", "\u00e4 1", None, None]
    df = spark.createDataFrame([(i % 2, k, f"p{i}") for i, k in enumerate(keys)] * 2, "seq int, transaction_id string, payload string")
    out = cleanse.not_yet_stored(df, None, order=("seq",))
    assert out.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(repr, out.collect())) == sorted(map(repr, df.distinct().collect()))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    moved = next(line for line in plan.splitlines() if line.lstrip(" +-:").startswith("Aggregate"))
    assert "max(" in moved and "payload" in moved and "transaction_id" not in moved.split("max(")[1]
    assert cleanse.not_yet_stored(df, out, order=("seq",)).isEmpty()
    assert cleanse.not_yet_stored(df, out.where("transaction_id = '=a'"), order=("seq",)).count() == 7


def test_merge_takes_keys_and_columns_of_other_types(spark):
    df = spark.sql("select * from values (1L, 1, map('a', 1)), (1L, 2, map('b', 2)), (2L, 1, null) t(transaction_id, seq, attributes)")
    out = cleanse.not_yet_stored(df, None, order=("seq",)).orderBy("transaction_id").collect()
    assert [tuple(r) for r in out] == [(1, 2, {"b": 2}), (2, 1, None)]
    by_key = cleanse.not_yet_stored(df.selectExpr("cast(transaction_id as string) transaction_id", "seq"), None, order=("transaction_id", "seq"))
    assert sorted(map(tuple, by_key.collect())) == [("1", 2), ("2", 1)]


def test_enrichment_keeps_unmatched_rows_and_own_columns(spark):
    tx = spark.createDataFrame([("m1", "own"), ("m2", "own"), (None, "own")], "merchant_id string, merchant_name string")
    ref = spark.createDataFrame([("m1", "ref", "LOW", 5411, False)],
                                "merchant_id string, merchant_name string, merchant_risk_band string, mcc_code int, on_watchlist boolean")
    out = cleanse.enrich(tx, ref, "merchant_id", ["merchant_name", "merchant_risk_band"], "ref_")
    assert out.count() == 3
    assert out.where("merchant_id = 'm1'").first()["ref_merchant_name"] == "ref"
    assert {r["merchant_name"] for r in out.collect()} == {"own"}


def test_unknown_currency_counts_as_one_and_is_marked(spark):
    df = spark.createDataFrame([("XXX", 2.0), ("AED", 2.0), (None, 2.0)], "currency string, amount double")
    out = {r["currency"]: r for r in cleanse.normalize_currency(df).collect()}
    assert (out["XXX"]["amount_inr"], out["XXX"]["fx_known"]) == (2.0, False)
    assert (out["AED"]["amount_inr"], out["AED"]["fx_known"]) == (45.46, True)
    assert out[None]["amount_inr"] == 2.0


def test_rates_in_force_on_the_day(spark):
    rates = spark.sql("select * from values ('USD', date'2024-01-01', 80.0D), ('USD', date'2024-02-01', 90.0D) t(currency, valid_from, rate)")
    tx = spark.sql("select * from values ('USD', date'2023-12-31', 1.0D), ('USD', date'2024-01-31', 1.0D), ('USD', date'2024-02-01', 1.0D) t(currency, d, amount)")
    out = cleanse.convert_as_of(tx, rates, F.col("d")).orderBy("d").collect()
    assert [(r["amount_inr"], r["fx_known"]) for r in out] == [(1.0, False), (80.0, True), (90.0, True)]


def test_partition_overwrite_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).withColumn("p", F.col("id") % 2)
    IO.write_layer(df, path, ["p"])
    IO.write_layer(df.where("p = 1").withColumn("id", F.col("id") * 10), path, ["p"])
    assert spark.read.parquet(path).agg(F.sum("id")).first()[0] == 20 + 250


def test_month_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "m")
    df = spark.range(100).select("id", F.concat(F.lit("2024-0"), (F.col("id") % 5 + 1).cast("string")).alias("year_month"))
    IO.write_layer(df, path, ["year_month"])
    month = IO.read_month(spark, path, "2024-03")
    assert month.count() == 20
    plan = month._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan


def test_missing_day_is_an_error(spark):
    df = spark.sql("select date'2024-01-01' as d")
    IO.require_day(df, "d", "2024-01-01")
    with pytest.raises(IO.NoSourceData):
        IO.require_day(df, "d", "2024-01-02")


def test_training_reader_formats(spark, tmp_path):
    df = spark.range(5).withColumn("is_fraud", F.lit(0))
    df.write.parquet(str(tmp_path / "tree/x/y"))
    df.write.parquet(str(tmp_path / "tree/z"))
    df.toPandas().to_csv(tmp_path / "t.csv", index=False)
    df.toPandas().to_parquet(tmp_path / "t.parquet")
    assert IO.read_training(spark, str(tmp_path / "tree")).count() == 10
    assert IO.read_training(spark, str(tmp_path / "t.csv")).count() == 5
    assert IO.read_training(spark, str(tmp_path / "t.parquet")).count() == 5


def test_daily_chain(spark, source, tmp_path):
    out = jobs.daily_chain(spark, source, str(tmp_path / "lake"), "2024-02-02", multi_line=False)
    assert out["gate"]["duplicate_txn_ids"] == 0 and out["counts"]["clean"] == 12
    report = spark.read.parquet(str(tmp_path / "lake/report"))
    assert report.count() == 1 and report.first()["total_transactions"] == 4
    scored = spark.read.parquet(str(tmp_path / "lake/scored"))
    assert scored.count() == 12 and "fraud_risk_score" in scored.columns
    assert scored.where("transaction_id = 't1'").first()["amount_inr"] == pytest.approx(101 * 83.5)


def test_a_written_layer_leaves_no_shuffle_files(spark, tmp_path):
    """They would stay until the driver collects its garbage, one set for each layer."""
    import time

    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.length()) if found.apply(i).getName().startswith("shuffle_")}

    before = files()
    df = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).agg(F.count("*").alias("n"))
    IO.write_layer(df, str(tmp_path / "t"))
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.2)
    assert files() <= before
    assert IO.read_layer(spark, str(tmp_path / "t")).count() == 700
