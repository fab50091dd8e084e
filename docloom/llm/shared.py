"""Small expressions and helpers that several training-data operators use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from docloom.sources.workspace import scratch as scratch
from docloom.sources.workspace import small_batches as small_batches
from docloom.sources.workspace import written as written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words are runs of anything but ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """A-Z become a-z; every other character stays as it is."""
    return F.translate(text, UPPER, LOWER)


def count_words(text: Column) -> Column:
    """Number of WORD runs; null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def running_total(df: DataFrame, group: list[str], bucket: str, order: list, value: str, out: str) -> DataFrame:
    """Adds out: the sum of value over the rows of the group before this one, in the order (bucket, order).

    No task sees a whole group: rows are summed by (group, bucket) with map-side
    combining, the bucket sums (few rows) are accumulated per group, and the
    running sum inside a bucket is a window over that bucket alone.
    """
    sums = df.groupBy(*group, bucket).agg(F.sum(value).alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(*[F.col(c).alias(f"_{c}") for c in [*group, bucket]], before.alias("_before"))
    inside = F.coalesce(F.sum(value).over(Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*group, bucket]]
    joined = df.withColumn("_inside", inside).join(sums, same, "left")
    return joined.withColumn(out, F.col("_before") + F.col("_inside")).select(*df.columns, out)


def without(docs: DataFrame, drop: DataFrame, most: int = 500_000) -> DataFrame:
    """The rows of docs whose (doc_id, text) is not among those of drop (doc_id, key); key is text_key(text).

    Up to most rows are broadcast, after counting them; more are joined by a shuffle.
    """
    drop = drop.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).distinct()
    few = drop.limit(most + 1).count() <= most
    return docs.join(F.broadcast(drop) if few else drop, F.col("doc_id").eqNullSafe(F.col("_id")) & (text_key(F.col("text")) == F.col("_key")), "left_anti")


def text_key(text: Column) -> Column:
    """A 64-bit hash that tells the texts of one id apart; null differs from empty."""
    return F.xxhash64(text, text.isNull())
