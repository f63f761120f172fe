"""Stream sources, decoding, and routing to topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow import schemas as S
from riskflow.functions import columns as C

CORRUPT = "_corrupt_record"
INPUT_TOPICS = (S.TOPIC_RAW, S.TOPIC_HIGH_VALUE, S.TOPIC_INTERNATIONAL)

#: What the rules read from a message. Numbers come as text, so that one that cannot be read is
#: sent to the dead letters and does not void the whole message.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("amount", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("merchant_category", T.StringType()),
    T.StructField("is_high_risk_merchant", T.BooleanType()),
    T.StructField("card_present", T.BooleanType()),
    T.StructField("is_international", T.BooleanType()),
    T.StructField("hour_of_day", T.IntegerType()),
])


def message_stream(spark: SparkSession, kind: str = "kafka", **options: str) -> DataFrame:
    """Messages with a `value`: from Kafka topics, or lines of text files.

    Trigger limits (`maxOffsetsPerTrigger`, `maxFilesPerTrigger`) bound a micro-batch. `arrived` is when the broker or the
    file system got the message, in epoch milliseconds.
    """
    reader = spark.readStream
    if kind == "kafka":
        options = {"subscribe": ",".join(INPUT_TOPICS), "startingOffsets": "latest",
                   "maxOffsetsPerTrigger": "2000000", **options}
        return reader.format("kafka").options(**options).load().select(
            F.col("value").cast("string").alias("value"), "topic", F.unix_millis("timestamp").alias("arrived"))
    path = options.pop("path")
    return reader.format("text").options(**{"maxFilesPerTrigger": "16", **options}).load(path).select(
        "value", F.unix_millis("_metadata.file_modification_time").alias("arrived"))


def decode(messages: DataFrame, value: str = "value", keep: str | None = None) -> DataFrame:
    """Message text to typed columns; text that is no record stays in `_corrupt_record`. `keep` is a column that stays beside them."""
    schema = T.StructType(MESSAGE_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(value), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    beside = [keep] if keep else []
    rows = messages.select(F.col(value).alias("_raw"), *beside, parsed.alias("_m")).select("_raw", *beside, "_m.*")
    ts = F.expr("try_to_timestamp(timestamp)")
    return rows.withColumns({
        "amount": F.col("amount").try_cast("double"),
        "timestamp": ts,
    })


def is_dead_letter() -> Column:
    """Unreadable message, amount or time."""
    return F.col(CORRUPT).isNotNull() | F.col("amount").isNull() | F.col("timestamp").isNull()


def dead_reason() -> Column:
    return F.when(F.col(CORRUPT).isNotNull(), "malformed").when(F.col("amount").isNull(), "amount").otherwise("timestamp")


def dead_letters(decoded: DataFrame) -> DataFrame:
    return decoded.where(is_dead_letter()).select(
        F.lit(S.TOPIC_DEAD_LETTER).alias("topic"), F.col("_raw").alias("value"), dead_reason().alias("reason"))


def readable(decoded: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Records that can be judged; `keep_raw` carries the message along as `payload`, for `whole_record`."""
    rows = decoded.where(~is_dead_letter()).drop(CORRUPT)
    return rows.withColumnRenamed("_raw", "payload") if keep_raw else rows.drop("_raw")


def whole_record(enriched: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """All fields of the message beside what the rules found, and when that was; of `payload`, only with `keep`."""
    rest = [T.StructField(f.name, T.DoubleType() if f.name in ("latitude", "longitude") else f.dataType)
            for f in S.RAW_SCHEMA.fields if f.name != S.LABEL and f.name not in enriched.columns]
    found = enriched.withColumn("_rest", F.from_json("payload", T.StructType(rest)))
    own = [c for c in enriched.columns if c != "payload" or c in (keep or [])]
    return found.select(*own, *[F.col(f"_rest.{f.name}").alias(f.name) for f in rest], F.current_timestamp().alias("enriched_at"))


def to_input_topics(transactions: DataFrame) -> DataFrame:
    """Topic, key and JSON value of each transaction, keyed by customer."""
    return transactions.select(
        C.input_topic(F.col("amount"), F.col("is_international")).alias("topic"),
        F.col("customer_id").cast("string").alias("key"),
        F.to_json(F.struct(*transactions.columns)).alias("value"))


def to_output_topics(enriched: DataFrame) -> DataFrame:
    """One message per topic that the record goes to."""
    return enriched.select(
        F.explode(C.output_topics(F.col("rule_severity"))).alias("topic"),
        F.coalesce(F.col("customer_id").cast("string"), F.lit("unknown")).alias("key"),
        F.to_json(F.struct(*enriched.columns)).alias("value"))


def to_topics_or_dead(enriched: DataFrame) -> DataFrame:
    """As `to_output_topics`, with the message of a late row to the dead letters, and the reason of that."""
    late = F.col("late").isNotNull()
    return enriched.select(
        F.explode(F.when(late, F.array(F.lit(S.TOPIC_DEAD_LETTER))).otherwise(C.output_topics(F.col("rule_severity")))).alias("topic"),
        F.coalesce(F.col("customer_id").cast("string"), F.lit("unknown")).alias("key"),
        F.when(late, F.col("late")).otherwise(F.to_json(F.struct(*[c for c in enriched.columns if c != "late"]))).alias("value"),
        F.when(late, "late").alias("reason"))
