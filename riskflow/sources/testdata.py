"""Transactions derived from the test tables.

The same expressions are valid in Spark SQL and DuckDB, except for the weekday, which the two
count from different days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.session import HUGE_METHOD, SQL_SETTINGS

_TX = {
    "transaction_id": "event_id",
    "customer_id": "user_id",
    "amount": """CAST(CAST(value AS DECIMAL(12,2)) *
        CASE event_id % 20 WHEN 0 THEN 10000 WHEN 1 THEN 1000 WHEN 2 THEN 1000 WHEN 3 THEN 100
                           WHEN 4 THEN 100 WHEN 5 THEN 100 ELSE 10 END AS DOUBLE)""",
    "timestamp": "ts",
    "transaction_type": """CASE event_type WHEN 'purchase' THEN 'CREDIT_CARD' WHEN 'click' THEN 'UPI'
        WHEN 'view' THEN 'MOBILE_BANKING' WHEN 'signup' THEN 'ONLINE_TRANSFER'
        ELSE 'ATM_WITHDRAWAL' END""",
    "merchant_id": "CASE WHEN event_type = 'error' THEN NULL ELSE event_id % 40 END",
    "merchant_category": """CASE event_id % 6 WHEN 0 THEN 'GROCERY' WHEN 1 THEN 'ELECTRONICS'
        WHEN 2 THEN 'JEWELRY' WHEN 3 THEN 'CASINO' WHEN 4 THEN 'TRAVEL' ELSE 'UTILITY' END""",
    "is_high_risk_merchant": "event_id % 6 = 3",
    "device_id": "CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT)",
    "ip_address": "(user_id * 7 + event_id % 3) % 64",
    "currency": """CASE event_id % 11 WHEN 0 THEN 'USD' WHEN 1 THEN 'GBP' WHEN 2 THEN 'EUR'
        WHEN 3 THEN 'XXX' ELSE 'INR' END""",
    "country_code": "CASE event_id % 12 WHEN 0 THEN 'USA' WHEN 1 THEN 'GBR' ELSE 'IND' END",
    "is_international": "event_id % 12 < 2",
    "card_present": "event_id % 3 <> 0",
    "latitude": "CAST(event_id % 50 AS DOUBLE) - 25.0",
    "longitude": "CAST(event_id % 120 AS DOUBLE) - 60.0",
    "card_bin": "event_id % 97",
    "is_fraud": "CASE WHEN event_type = 'error' AND event_id % 7 = 0 THEN 1 ELSE 0 END",
}
_TX_LIST = ",\n       ".join(f"{expr} AS {name}" for name, expr in _TX.items())
_INNER = ("SELECT *, CAST(hour(\"timestamp\") AS INT) AS hour_of_day, "
          "CAST(dayofweek(\"timestamp\") + 1 AS INT) AS day_of_week, "
          "CAST(floor(epoch(\"timestamp\")) AS BIGINT) AS t FROM "
          f"(SELECT {_TX_LIST.replace(' AS timestamp', ' AS \"timestamp\"')} FROM events)")

#: `WITH tx AS (...)` prefix of the check queries.
TX_CTE = f"WITH tx AS ({_INNER})\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as transactions."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set(HUGE_METHOD, SQL_SETTINGS[HUGE_METHOD])
    return _transactions(table(spark, sf_dir, "events"))


def stretched_transactions(spark: SparkSession, sf_dir: str, times: int) -> DataFrame:
    """The same, with the time since the start of 2024 made longer."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    ts = F.col("ts").cast("timestamp_ntz")
    return _transactions(table(spark, sf_dir, "events").withColumn("ts", start + (ts - start) * times))


def _transactions(events: DataFrame) -> DataFrame:
    tx = events.selectExpr(*[f"{e} AS `{n}`" for n, e in _TX.items()])
    return tx.withColumns({
        "timestamp": F.col("timestamp").cast("timestamp"),
        "hour_of_day": F.hour("timestamp"),
        "day_of_week": F.dayofweek("timestamp"),
    })


#: Text-typed variant with bad amounts, times and customers, and repeats that arrive later.
_RAW = {
    "transaction_id": "event_id",
    "customer_id": "CASE WHEN event_id % 109 = 0 THEN '' ELSE CAST(user_id AS STRING) END",
    "amount": """CASE WHEN event_id % 101 = 0 THEN 'abc'
        WHEN event_id % 103 = 0 THEN concat('-', CAST(CAST(value AS DECIMAL(12,2)) AS STRING))
        ELSE CAST(CAST(value AS DECIMAL(12,2)) * CASE WHEN event_id % 997 = 1 THEN 1000000 ELSE 10 END AS STRING) END""",
    "timestamp": "CASE WHEN event_id % 107 = 0 THEN 'bad' ELSE TSTEXT END",
    "latitude": "CASE WHEN event_id % 113 = 0 THEN 'n/a' ELSE CAST(event_id % 50 - 25 AS STRING) END",
    "longitude": "CAST(event_id % 120 - 60 AS STRING)",
    "currency": _TX["currency"],
    "transaction_type": _TX["transaction_type"],
    "merchant_id": _TX["merchant_id"],
    "country_code": _TX["country_code"],
    "is_fraud": _TX["is_fraud"],
}


def _raw_select(copy: str, ts_text: str) -> str:
    cols = ", ".join(f"{e.replace('TSTEXT', ts_text)} AS {n}" for n, e in _RAW.items())
    return f"SELECT {cols.replace(' AS timestamp', ' AS \"timestamp\"')}, {copy} AS ingest_seq FROM events"


RAW_CTE = ("WITH raw AS (" + _raw_select("0", "strftime(ts, '%Y-%m-%d %H:%M:%S')").replace("AS STRING", "AS VARCHAR")
           + " UNION ALL " + _raw_select("1", "strftime(ts, '%Y-%m-%d %H:%M:%S')").replace("AS STRING", "AS VARCHAR")
           + " WHERE event_id % 50 = 0)\n")


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty text records; every 50th is delivered twice, the copy with a later sequence."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = table(spark, sf_dir, "events")
    copies = F.when(F.col("event_id") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = events.withColumn("ingest_seq", F.explode(copies))
    ts_text = "date_format(ts, 'yyyy-MM-dd HH:mm:ss')"
    return rows.selectExpr(*[f"{e.replace('TSTEXT', ts_text)} AS `{n}`" for n, e in _RAW.items()], "ingest_seq")
