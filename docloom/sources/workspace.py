"""Intermediate tables in a folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir.

    Where that is unset, a session on one machine (a local master, as in tests)
    gets a temporary folder as its checkpoint folder; any other session is
    refused, since its executors could not see such a folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="docloom-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/docloom-{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet in the shared folder and read again: cuts lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Bounds the bytes of an Arrow batch that goes to Python workers: ten thousand long texts would be too much for one.

    It is a setting of the session and stays, since plans run after their operator has returned.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) != str(most):
        spark.conf.set(name, str(most))
