"""Answers to repeated requests: one each, the first one's while it lives, over batches and restarts."""

from pyspark.sql import functions as F

from riskflow.streaming.answers import answer_requests


def test_every_request_has_one_answer(spark, tmp_path):
    parts = [
        [("a", 0, 1), ("a", 59, 2), ("a", 60, 3), ("b", 10, 4), (None, 5, 5), (None, 6, 6)],
        [("a", 100, 7), ("b", 5, 8), ("b", 75, 9), ("c", 2000, 10)],          # b at 5 comes after the answer given at 10
        [("a", 110, 11), ("b", 2500, 12)],                                     # the watermark is at 1,400: late ones are answered, too
    ]
    answers = {}
    for n, rows in enumerate(parts):
        df = spark.createDataFrame([(i, s, r, f"answer {r}") for i, s, r in rows], "request_id string, s long, rank long, answer string")
        df.withColumn("timestamp", F.timestamp_seconds(F.col("s") + 1_700_000_000)).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema("request_id string, s long, rank long, answer string, timestamp timestamp").parquet(str(tmp_path / "in"))
        answer_requests(source).writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
            "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    for r in spark.read.parquet(str(tmp_path / "out")).collect():
        assert r["rank"] not in answers
        answers[r["rank"]] = (r.answer, r.reused)
    own = {n: (f"answer {n}", False) for n in (1, 3, 4, 5, 6, 8, 9, 10, 11, 12)}
    assert answers == {**own, 2: ("answer 1", True), 7: ("answer 3", True)}
