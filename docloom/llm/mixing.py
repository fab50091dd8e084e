"""Mixing sources to target weights with a low-discrepancy schedule.

A source's target is cut into blocks of equally many words; the blocks of all
sources, one source after the other, own the points 0 .. n - 1. Slot i of the
schedule takes the point that is i's van der Corput image (i with its bits
reversed; images from n on own nothing and their slots stay empty), so the
slots of every source are spread evenly over the schedule. The k-th slot of a
source, in slot order, takes the k-th block of the source's shuffled documents;
the stream of a source starts over when its target exceeds its size, and the
last block is cut to the target. Words are taken at slots only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.shared import count_words, running_total, written

WEIGHTS = (5.0, 2.0, 1.0)


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """From rows (source, size): one row per source with source_size and target.

    Sources take the weights in turn, by code point, null last. The targets add
    up to share times all sizes; a target stops at most times its source's size
    and the excess goes to the others by weight (water filling: the common
    level is found from running sums over the sources by size for weight).
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    turn = (F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    ratio = everything.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    full = F.coalesce(F.sum("cap").over(ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(ratio.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    per = per.withColumn("level", (total - full) / open_weight)
    # Levels fall along the order, so the highest one that its own source's cap allows is the common level; if there is none, all stop at their caps.
    level = F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(everything)
    target = F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap")))
    return per.select("source", "source_size", "weight", target.alias("target"))


def reversed_bits(point: Column, bits: int) -> Column:
    """The van der Corput image of point among 2^bits."""
    return F.conv(F.reverse(F.lpad(F.bin(point), bits, "0")), 2, 10).cast("long")


def schedule(blocks: DataFrame, bits: int, per_row: int = 1 << 16) -> DataFrame:
    """From (source, n_blocks): (source, block, slot), the slots of each source, numbered by slot order.

    2^bits must be at least the sum of n_blocks. A source's points are made in
    runs of at most per_row, each a row of its own.
    """
    before = Window.partitionBy().orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    own = blocks.where("n_blocks > 0").select("source", "n_blocks", F.coalesce(F.sum("n_blocks").over(before), F.lit(0)).alias("first"))
    runs = own.select("source", (F.col("first") + F.col("n_blocks")).alias("_end"), F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n_blocks") - 1, F.lit(per_row))).alias("_begin"))
    points = runs.repartition("_begin").select("source", F.explode(F.sequence(F.col("_begin"), F.least(F.col("_begin") + per_row, F.col("_end")) - 1)).alias("point"))
    slots = points.select("source", reversed_bits(F.col("point"), bits).alias("slot"))
    chunk = 2 ** (bits - bits // 2)
    slots = slots.withColumn("_chunk", F.floor(F.col("slot") / chunk)).withColumn("_one", F.lit(1))
    return running_total(slots, ["source"], "_chunk", ["slot"], "_one", "block").select("source", "block", "slot")


def planned(docs: DataFrame, weights: tuple[float, ...], share: float, most: float, seed: str, docs_per_block: int, least_bits: int) -> tuple[DataFrame, DataFrame]:
    """(rows, placed): the documents with their place in their source's stream, and what each slot takes of them."""
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")))
    rows = docs.select(F.col("doc_id"), F.col("source"), count_words(F.col("text")).alias("size"))
    rows = written(rows.withColumn("key", key), "mix-sizes")
    n = max(rows.count(), 1)
    targets = source_targets(rows, weights, share, most)
    digits = max(1, math.ceil(math.log(n, 16) / 2))
    bits = max(least_bits, math.ceil(math.log2(n / docs_per_block)) if n > docs_per_block else 0)

    per = targets.select("source", "source_size", "target", F.round("target").cast("long").alias("quota"))
    sources, words = per.agg(F.count(F.lit(1)), F.coalesce(F.sum("quota"), F.lit(0))).first()
    bits = max(bits, math.ceil(math.log2(2 * sources + 1)))
    block_size = max(1, -(-words // (2**bits - sources)))
    per = written(per.withColumn("n_blocks", F.ceil(F.col("quota") / block_size).cast("long")), "mix-targets")

    rows = rows.withColumn("bucket", F.substring("key", 1, digits))
    rows = running_total(rows, ["source"], "bucket", ["key", "doc_id", "size"], "size", "start")
    rows = rows.join(per.withColumnRenamed("source", "_source").drop("n_blocks"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "bucket", "key")
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "mix-rows")

    turns = F.explode(F.sequence(F.lit(0), F.lit(math.ceil(most) - 1))).alias("turn")
    pieces = rows.where("size > 0").select("row", "doc_id", "source", "quota", "source_size", "start", "size", turns)
    pieces = pieces.withColumn("from", F.col("start") + F.col("turn") * F.col("source_size")).withColumn("to", F.least(F.col("from") + F.col("size"), F.col("quota"))).where("from < to")
    pieces = pieces.withColumn("block", F.explode(F.expr(f"sequence(from div {block_size}, (to - 1) div {block_size})")))
    begin = F.greatest(F.col("from"), F.col("block") * block_size)
    end = F.least(F.col("to"), (F.col("block") + 1) * block_size)
    pieces = pieces.select("row", "doc_id", "source", "block", (begin - F.col("from")).alias("begin"), (end - begin).alias("words"))
    slots = schedule(per.select("source", "n_blocks"), bits).select(F.col("source").alias("_source"), F.col("block").alias("_block"), "slot")
    placed = pieces.join(slots, F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block")))
    return rows, placed.select("slot", "row", "doc_id", "source", "begin", "words")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: str = "mix-1", docs_per_block: int = 64, least_bits: int = 12) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, first_slot.

    size counts words (null text: 0). taken is the number of words that slots
    of the schedule take from the document, repeats counted: never above most
    times its size. The words taken from a source are its target, rounded.
    first_slot is where the document first appears (null: not taken). Documents
    are shuffled by a hash of the seed and doc_id, so that reruns agree; equal
    ids are ordered by size. Null ids count as one id. Repeated rows each have
    their own place. A document may span blocks, however long it is. An empty
    table gives an empty result; where all texts are empty, nothing is taken.
    Columns of docs other than doc_id, source and text are not read.
    """
    rows, placed = planned(docs, weights, share, most, seed, docs_per_block, least_bits)
    taken = placed.groupBy("row").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    return rows.join(taken, "row", "left").select("doc_id", "source", "size", "source_size", F.col("target"), F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot")


def mixed_pieces(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: str = "mix-1", docs_per_block: int = 64, least_bits: int = 12) -> DataFrame:
    """The mix itself, as mix(): (slot, doc_id, source, begin, words), words of a document from word begin on; in slot order they are the training stream."""
    return planned(docs, weights, share, most, seed, docs_per_block, least_bits)[1].drop("row")
