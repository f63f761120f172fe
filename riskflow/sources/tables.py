"""Batch readers and writers for the layers. Parquet throughout."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.schemas import RAW_SCHEMA
from riskflow.session import shuffles_released

CORRUPT = "_corrupt_record"


def read_raw(spark: SparkSession, path: str, fmt: str = "json", schema: T.StructType = RAW_SCHEMA,
             multi_line: bool = False) -> DataFrame:
    """Raw records under an explicit schema; unreadable ones keep their text in `_corrupt_record`.

    One record per line, so that files can be split. Files that hold an array or records over
    several lines need `multi_line=True`; each is then read whole by one task.
    """
    reader = spark.read.format(fmt)
    if fmt in ("json", "csv"):
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        reader = reader.option("multiLine", str(multi_line).lower())
    return reader.schema(schema).load(path)


def read_layer(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_training(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Training rows from a Parquet file, a CSV file, or a directory tree of Parquet files."""
    if path.endswith(".csv"):
        reader = spark.read.option("header", "true")
        return (reader.schema(schema) if schema else reader.option("inferSchema", "true")).csv(path)
    reader = spark.read.schema(schema) if schema else spark.read
    if path.endswith(".parquet"):
        return reader.parquet(path)
    return reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(path)


def read_month(spark: SparkSession, path: str, year_month: str) -> DataFrame:
    """One month of a table partitioned by `year_month`; the filter prunes partitions."""
    return read_layer(spark, path).where(F.col("year_month") == year_month)


class NoSourceData(ValueError):
    """The day has no data."""


def arrivals(df: DataFrame, day: Column) -> DataFrame:
    """Rows and files per day, of a table read from files."""
    per_file = df.groupBy(day.alias("day"), F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"))
    return per_file.groupBy("day").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"))


def require_day(df: DataFrame, column: str, day: str) -> None:
    """Fail unless the partition of the day holds a row; stops at the first one."""
    if df.where(F.col(column) == F.lit(day).cast("date")).isEmpty():
        raise NoSourceData(f"no source data for {day}")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Rows of all tables by column name; a column that one lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def write_layer(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite",
                whole_table: bool = False) -> None:
    """Write a layer table.

    Overwriting replaces the partitions that `df` holds; `whole_table` replaces everything, also
    the schema. REBALANCE evens out file sizes and splits a hot partition value. What the write has
    shuffled is removed with its end.
    """
    writer = df
    if partition_by:
        writer = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = writer.write.mode(mode).option(
        "partitionOverwriteMode", "static" if whole_table else "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_released(df.sparkSession):
        writer.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)
