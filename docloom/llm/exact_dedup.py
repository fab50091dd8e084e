"""Exact deduplication as a stateful stream.

Texts are equal when they are identical after lower-casing A-Z only. Rows are
kept in a content folder; a stream reads what is new there. Its state is keyed
by digest, lives in RocksDB (disk-backed, bounded memory) and never expires; for
each digest it retains the stable identifier of the row that stays, that row's
content locator (file and row in the file) and the number of rows seen. The rows
of digests that were hit more than once are then fetched by their locators and
compared in full; if texts that differ share a digest, rows are grouped by their
full text instead.

Folder, state and checkpoint last as long as the caller keeps them: a later call
with the same folder goes on where the last one ended.

Only DataFrame and SQL functions run: no Python on executors.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.shared import ascii_lower, scratch, written

#: State on disk, with a bound on the memory of all stores of an executor; a store is closed once its batch is committed, so that idle stores hold neither memory nor preallocated files.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
}
#: What stands for a row where locators are broadcast: the row in its file, and 64 bits each for the file's name and the digest.
PLACE = ("_file", "at", "_digest")


def normal(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def keyed_state(stream: DataFrame) -> DataFrame:
    """Streaming aggregate over (digest, locator): its keyed state is the dedup table, kept for ever."""
    return stream.groupBy("digest").agg(F.max("locator").alias("keeper"), F.count(F.lit(1)).alias("group_size"))


def located(rows: DataFrame, id_col: str) -> DataFrame:
    """(digest, locator, call) of rows of the content folder; a locator begins with the id, so the largest one is that of the row that stays."""
    place = F.struct(F.col("doc")[id_col].alias("id"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    return rows.select("digest", place.alias("locator"), "call")


def placed(file: Column, at: Column, digest: Column) -> list[Column]:
    return [c.alias(n) for c, n in zip((F.xxhash64(file), at, F.xxhash64(digest)), PLACE, strict=True)]


def content_places(content: DataFrame, *columns: Column) -> DataFrame:
    return content.select(*columns, *placed(F.col("_metadata.file_name"), F.col("_metadata.row_index"), F.col("digest")))


class Decided(NamedTuple):
    content: DataFrame
    rows: DataFrame
    call: str


def run_stream(content: DataFrame, folder: str, id_col: str, files_per_batch: int | None) -> DataFrame:
    """Streams the new files of the content folder through the keyed state; returns (digest, keeper, group_size) of all files so far.

    Every micro-batch writes the states it changed. keeper and group_size only
    grow, so the latest state of a digest is the maximum over the batches. A
    batch that runs again after a failure overwrites its own folder.
    """
    spark, out = content.sparkSession, f"{folder}/states"
    reader = spark.readStream.schema(content.schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    keyed = keyed_state(located(reader.parquet(f"{folder}/content"), id_col).select("digest", "locator"))
    none = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in keyed.schema])
    none.coalesce(1).write.mode("ignore").parquet(f"{out}/batch=-1")
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        query = (
            keyed.writeStream.outputMode("update")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .foreachBatch(lambda rows, n: rows.write.mode("overwrite").parquet(f"{out}/batch={n}"))
            .start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)
    states = spark.read.schema(keyed.schema).option("basePath", out).parquet(f"{out}/batch=*")
    return states.groupBy("digest").agg(F.max("keeper").alias("keeper"), F.max("group_size").alias("group_size"))


def collided(content: DataFrame, rows: DataFrame, text_col: str, most: int) -> bool:
    """Whether texts that differ share a digest.

    Rows of digests with more than one row are fetched by their locators: up to
    most locators are broadcast, after counting them; more meet the content in
    a shuffle join. Of each digest the least and the greatest text are found,
    combined before the shuffle; they are equal if all are.
    """
    hits = rows.where("group_size > 1").select(*placed(F.col("locator.file"), F.col("locator.at"), F.col("digest")))
    few = hits.limit(most + 1).count() <= most
    texts = content_places(content, F.col("digest"), normal(F.col("doc")[text_col]).alias("text"))
    fetched = texts.join(F.broadcast(hits) if few else hits, list(PLACE), "left_semi").select("digest", "text")
    return not fetched.groupBy("digest").agg(F.min("text").alias("lo"), F.max("text").alias("hi")).where("lo <> hi").isEmpty()


def decide(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column], files_per_batch: int | None, folder: str | None, columns: list[str], most: int) -> Decided:
    """The content folder, and one row for each row of docs: locator, keeper, group_size, digest."""
    spark, call = docs.sparkSession, uuid.uuid4().hex
    folder = folder or scratch(spark, "dedup")
    text = normal(F.col(f"`{text_col}`"))
    kept = F.struct(*[F.col(f"`{c}`") for c in columns])
    docs.select(kept.alias("doc"), F.unhex(digest(text)).alias("digest"), F.lit(call).alias("call")).write.mode("append").parquet(f"{folder}/content")
    content = spark.read.parquet(f"{folder}/content")
    states = written(run_stream(content, folder, id_col, files_per_batch), "dedup-states")
    rows = written(located(content, id_col).join(states, "digest"), "dedup-rows")
    if collided(content, rows, text_col, most):
        rows = written(by_content(content, id_col, text_col), "dedup-rows")
    return Decided(content, rows.where(F.col("call") == call).drop("call"), call)


def by_content(content: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The same rows when digests have collided: groups are the texts themselves."""
    own = located(content.withColumn("digest", normal(F.col("doc")[text_col])), id_col).withColumnRenamed("digest", "text")
    groups = own.groupBy("text").agg(F.max("locator").alias("keeper"), F.count(F.lit(1)).alias("group_size"))
    return own.join(groups, "text").select(F.unhex(sha256(F.col("text"))).alias("digest"), "locator", "call", "keeper", "group_size")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256, files_per_batch: int | None = None, folder: str | None = None, most: int = 200_000) -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, digest (hexadecimal).

    The row with the largest id of each group of equal texts stays. Null text
    counts as empty. Ids may be of any type that has an order; null counts as
    smallest. If an id occurs more than once with one text, one of those rows
    stays. An empty table gives an empty result. Further columns of docs are
    not read, whatever their names. A text may be of any length that fits a
    row. digest may be replaced (tests use one that collides); the result does
    not depend on it.

    folder holds content, state and checkpoint; it has to be shared. With a
    folder of earlier calls, groups go over all rows seen so far, and rows that
    stayed before may have been replaced by those of this call. Without one, a
    fresh folder is used.
    """
    rows = decide(docs, id_col, text_col, digest, files_per_batch, folder, list(dict.fromkeys([id_col, text_col])), most).rows
    return rows.select(F.col("locator.id").alias(id_col), F.col("keeper.id").alias("keep_id"), "group_size", (F.col("locator") == F.col("keeper")).alias("kept"), F.lower(F.hex("digest")).alias("digest"))


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None, most: int = 200_000) -> DataFrame:
    """The rows of docs that stay, with all their columns; of rows with one id and one text, one stays. They are fetched by their locators."""
    content, rows, call = decide(docs, id_col, text_col, sha256, None, folder, docs.columns, most)
    gone = rows.where(~F.col("locator").eqNullSafe(F.col("keeper"))).select(*placed(F.col("locator.file"), F.col("locator.at"), F.col("digest")))
    few = gone.limit(most + 1).count() <= most
    own = content.where(F.col("call") == call) if folder else content
    left = content_places(own, F.col("doc")).join(F.broadcast(gone) if few else gone, list(PLACE), "left_anti")
    return left.select(*[F.col("doc")[c].alias(c) for c in docs.columns])
