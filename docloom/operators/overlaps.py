"""Joins inside a document that don't pair all its rows: intervals that overlap, and texts that contain others' words."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.functions.arrays import rows_of
from docloom.sources.workspace import written


def overlapping(left: DataFrame, right: DataFrame, keys: list[str], left_span: tuple[str, str] = ("chunk_start", "chunk_end"), right_span: tuple[str, str] = ("entry_start", "entry_end")) -> DataFrame:
    """Rows of left and right with equal keys whose intervals overlap (each begins before the other ends), as left.join(right, keys) would have them.

    Positions are whole numbers, ends exclusive. Every document is cut into bins,
    about as many as it has intervals on the right, and at least as wide as these
    are on average: an interval stands in the bins that it touches, and a pair is
    made in the bin of its later start only. So a document of any size is spread
    over tasks, and work follows its intervals and overlaps, not their product.
    Documents whose short intervals crowd in a small part of a long extent have
    fuller bins. Empty intervals overlap what they lie strictly inside of.
    """
    (a, b), (c, d) = left_span, right_span
    length = F.col(d) - F.col(c)
    width = F.ceil(F.greatest(F.avg(length), (F.max(d) - F.min(c)) / F.count(F.lit(1)), F.lit(1.0)))
    widths = right.groupBy(*keys).agg(width.cast("bigint").alias("_width"))

    def in_bins(rows: DataFrame, start: str, end: str) -> DataFrame:
        bins = F.sequence(F.floor(F.col(start) / F.col("_width")), F.floor(F.greatest(F.col(end) - 1, F.col(start)) / F.col("_width")))
        return rows.join(widths, keys).select("*", F.explode(bins).alias("_bin"))

    met = in_bins(left, a, b).join(in_bins(right, c, d).drop("_width"), [*keys, "_bin"])
    met = met.where((F.col(a) < F.col(d)) & (F.col(b) > F.col(c)) & (F.col("_bin") == F.floor(F.greatest(a, c) / F.col("_width"))))
    return met.drop("_bin", "_width")


def numbered(rows: DataFrame, keys: list[str], text: Column, name: str) -> DataFrame:
    """rows that have their keys, with a number and their distinct words, written once so that both stay what they are."""
    return written(rows.dropna(subset=keys).select(F.monotonically_increasing_id().alias(f"_{name}"), "*", tx.word_set(text).alias(f"_{name}_words")), name)


def containing(left: DataFrame, right: DataFrame, keys: list[str], left_text: str, right_text: str, least: float) -> DataFrame:
    """Rows of left and right with equal keys where left_text has more than the given part of right_text's distinct words (column share), as left.join(right, keys) would have them.

    Of the n words of a right text, more than least * n have to be met; so at
    least one of any n - floor(least * n) of them is. Those that the fewest left
    texts of the document have are joined with the left texts' words, and only
    pairs met this way are compared. A word of a document travels as one hash of
    both; what collides is sorted out by the comparison. Right texts without
    words are in no pair.
    """
    l, r = numbered(left, keys, F.col(left_text), "left"), numbered(right, keys, F.col(right_text), "right")
    hashes = lambda words: F.transform(words, lambda x: F.xxhash64(*keys, x))
    have = rows_of(l, ["_left"], hashes(F.col("_left_words")), "_h")
    common = have.groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    want = rows_of(r, ["_right"], hashes(F.col("_right_words")), "_h").join(common, "_h", "left")
    ordered = want.groupBy("_right").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_h").alias("h")))).alias("_w"))
    rare = F.slice("_w", F.lit(1), (F.size("_w") - F.floor(F.size("_w") * F.lit(float(least)))).cast("int"))
    near = rows_of(ordered, ["_right"], F.filter(rare, lambda w: w["n"] > 0), "_r").select("_right", F.col("_r.h").alias("_h"))
    pairs = near.join(have, "_h").select("_left", "_right").distinct()
    same = [F.col(k) == F.col(f"_r_{k}") for k in keys]
    both = pairs.join(l, "_left").join(r.withColumnsRenamed({k: f"_r_{k}" for k in keys}), "_right")
    share = F.size(F.array_intersect("_left_words", "_right_words")) / F.size("_right_words")
    rest = [c for c in right.columns if c not in keys]
    return both.where(reduce(Column.__and__, same)).withColumn("share", share).where(F.col("share") > least).select(*left.columns, *rest, "share")
