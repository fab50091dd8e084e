"""Interval and containment joins against all pairs."""

import random
import time

from docloom.operators import chunking
from docloom.operators.overlaps import containing, overlapping
from pyspark.sql import functions as F


def test_intervals_equal_all_pairs(spark):
    rng = random.Random(1)
    span = lambda far, long: (s := rng.randint(-50, far), s + rng.choice([0, 0, 1, 2, long, rng.randint(0, long)]))
    left = [(d, i, *span(400, 60)) for d in range(4) for i in range(80)] + [(None, 1, 0, 10), (9, 1, 0, 10)]
    right = [(d, i, *span(400, 300 if d == 2 else 9)) for d in range(3) for i in range(90)] + [(None, 1, 0, 10), (3, 1, 5, 5)]
    l, r = spark.createDataFrame(left, "k int, chunk_index int, chunk_start int, chunk_end int"), spark.createDataFrame(right, "k int, turn int, entry_start bigint, entry_end bigint")
    got = sorted((x.k, x.chunk_index, x.turn) for x in overlapping(l, r, ["k"]).collect())
    assert got == sorted((d, i, j) for d, i, s, e in left for k, j, t, u in right if d == k and d is not None and s < u and e > t)
    assert overlapping(l, r, ["k"]).columns == l.join(r, ["k"]).columns
    assert overlapping(l.limit(0), r, ["k"]).count() == 0 and overlapping(l, r.limit(0), ["k"]).count() == 0


def test_one_document_of_many_chunks_and_entries(spark):
    """100,000 chunks and 100,000 entries of one document: all pairs would be 10^10."""
    n = 100_000
    chunks = spark.range(n).select(F.lit(1).alias("k"), (F.col("id") + 1).alias("chunk_index"), (F.col("id") * 45).alias("chunk_start"), (F.col("id") * 45 + 50).alias("chunk_end"))
    spans = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("turn"), (F.col("id") * 45).alias("entry_start"), (F.col("id") * 45 + 45).alias("entry_end"))
    began = time.time()
    found = chunking.contributors(chunks, spans, ["k"], "turn").agg(F.count(F.lit(1)), F.sum("first_entry"), F.sum("last_entry")).first()
    assert tuple(found) == (n, n * (n - 1) // 2, n * (n - 1) // 2 + n - 1)
    assert time.time() - began < 60


def test_containment_equals_all_pairs(spark):
    rng = random.Random(2)
    words = ["the", "The", "a", "b", "c", "d", "e", "f", "rare", "x y"]
    left = [(d, i, " ".join(rng.choices(words, k=rng.randint(0, 6)))) for d in range(3) for i in range(40)] + [(0, 99, None), (None, 1, "a")]
    right = [(d, i, " ".join(rng.choices(words, k=rng.randint(0, 5)))) for d in range(3) for i in range(40)] + [(1, 99, None), (None, 1, "a"), (1, 3, "a b"), (1, 3, "a b")]
    l, r = spark.createDataFrame(left, "k int, chunk_index int, chunk_text string"), spark.createDataFrame(right, "k int, turn int, entry_text string")
    of = lambda t: set((t or "").lower().split())
    for least in (0.0, 0.34, 0.5, 0.99):
        got = sorted((x.k, x.chunk_index, x.turn, round(x.share, 9)) for x in containing(l, r, ["k"], "chunk_text", "entry_text", least).collect())
        want = [(d, i, j, round(len(of(t) & of(u)) / len(of(u)), 9)) for d, i, t in left for k, j, u in right if d == k and d is not None and of(u) and len(of(t) & of(u)) / len(of(u)) > least]
        assert got == sorted(want)


def test_no_pair_without_a_rare_word(spark):
    """A word that every chunk has makes no pairs where a rarer one decides."""
    chunks = spark.range(2000).select(F.lit(1).alias("k"), F.col("id").alias("chunk_index"), F.concat(F.lit("the w"), F.col("id")).alias("chunk_text"))
    entries = spark.range(2000).select(F.lit(1).alias("k"), F.col("id").alias("turn"), F.concat(F.lit("the w"), F.col("id"), F.lit(" v"), F.col("id")).alias("entry_text"))
    began = time.time()
    assert containing(chunks, entries, ["k"], "chunk_text", "entry_text", 0.5).where("chunk_index = turn").count() == 2000
    assert time.time() - began < 60
