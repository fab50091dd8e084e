"""Streams: deduplication, windows, merging micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom.sources.deltas import DeltaTable


def event_time(df: DataFrame, column: str = "ts") -> DataFrame:
    """Watermarks need a timestamp with time zone; files may hold one without."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def first_seen(df: DataFrame, keys: list[str], time: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Each key once within the watermark's delay; works on streams and tables."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys) if df.isStreaming else df.dropDuplicates(keys)


def tumbling(df: DataFrame, width: str, keys: list[str], value: str, time: str = "ts", delay: str = "1 hour") -> DataFrame:
    rows = df.withWatermark(time, delay) if df.isStreaming else df
    out = rows.groupBy(F.window(time, width), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("window.start").alias("window_start"), *keys, "n", "total")


def sessions(df: DataFrame, gap: str, keys: list[str], time: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Runs of events of a key with less than gap between them; a session ends gap after its last event."""
    rows = df.withWatermark(time, delay) if df.isStreaming else df
    out = rows.groupBy(F.session_window(time, gap).alias("s"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return out.select(*keys, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")


def drain(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Hands what there is now to batch(df, batch_id), and ends; a restart goes on after the last committed batch."""
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(batch).start()
    query.awaitTermination()
    return query


def merging(table: DeltaTable, seq: str) -> Callable[[DataFrame, int], None]:
    """A batch function that adds each batch to a table of deltas; a repeated batch changes nothing."""
    return lambda rows, batch_id: table.write(rows, batch_id, seq)


def queue(spark: SparkSession, folder: str, schema: str, per_batch: int = 1) -> DataFrame:
    """Files of work (JSON lines) that are put into a folder, taken so many at a time, each once; drain() works them off and may be restarted."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).json(folder)
