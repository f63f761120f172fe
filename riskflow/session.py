"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    STATE_STORE: ROCKSDB,
    HUGE_METHOD: "8000",                   # the JVM never compiles larger methods; the wide feature rows would be interpreted
}


def build_session(app_name: str = "riskflow", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Session for the jobs; cluster memory and storage access are left to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoints(spark: SparkSession) -> None:
    """Make `DataFrame.checkpoint` usable; a folder named by the cluster is kept."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "checkpoint"))


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate tables and stream checkpoints.

    It lies under ``spark.checkpoint.dir``, which on a cluster names shared storage. Only a
    local session without that setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="riskflow-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """A write inside removes its shuffle files when it ends; else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that nothing reads any more; only what `scratch_dir` named."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root or not path.startswith(f"{root.rstrip('/')}/"):
        raise ValueError(f"{path} is no scratch folder")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
