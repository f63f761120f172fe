"""Reading the text tables and keeping intermediate ones in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back, so that a lost executor costs no recomputation."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The column as a string, null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
