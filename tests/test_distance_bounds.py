"""Percentiles of distances to the last bit: a bound between two neighbours that differ in it decides a cut."""

import math
import random

import compare
import pytest
from pyspark.sql import functions as F

from docloom import queries as q
from docloom.functions.vectors import fused
from docloom.operators.chunking import interpolated

#: Lengths of units in conversations whose 80th percentile lies between such neighbours.
SENTENCES = {
    3793: [17, 19, 26, 35, 24, 67, 16, 42, 68, 20, 17, 35, 20, 160, 30, 8, 12, 101, 56, 99, 151, 144, 440, 41, 14, 61, 8, 106, 37, 12, 16, 49, 14, 21],
    1497: [53, 42, 58, 17, 35, 23, 62, 22, 11, 26, 25, 56, 206, 58, 143, 127, 32, 29, 15, 39, 21, 17, 34, 14, 41, 8, 137, 120, 216, 26, 26, 22, 55, 42, 29, 10, 59, 56, 5, 32, 200, 58, 7, 27],
}
WORDS = {
    3476: [66, 76, 72, 71, 63, 64, 65, 67, 65, 73, 65, 78, 100, 72, 70, 74, 70, 70, 67, 83, 70, 67, 77, 70, 72, 71, 86, 72, 84, 70, 68, 77, 85, 76, 72, 66, 76, 72, 63, 68, 87, 65, 70, 70, 64, 62, 86, 73, 71, 71, 76, 72, 77, 39],
    4676: [74, 86, 87, 93, 68, 70, 61, 85, 73, 77, 63, 76, 57, 75, 85, 70, 64, 66, 78, 71, 97, 56, 68, 64, 65, 54, 68, 86, 71, 89, 71, 65, 77, 79, 72, 66, 87, 62, 66, 70, 93, 87, 63, 58],
}


def same(spark, path, name, texts):
    rows = [(i, 0, "user", text) for i, text in texts.items()]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{path}/conversations.parquet")
    return compare.differences(q.QUERIES[name](spark, str(path)), compare.connect(str(path)), q.ORACLES[name])


def test_sentences(spark, tmp_path):
    texts = {i: " ".join("x" * (n - 1) + "." for n in sizes) for i, sizes in SENTENCES.items()}
    assert same(spark, tmp_path, "distance_chunks", texts) == ""


def test_units_of_words(spark, tmp_path):
    texts = {i: " ".join("a " * 11 + "x" * (n - 22) for n in sizes) for i, sizes in WORDS.items()}
    assert same(spark, tmp_path, "distance_chunks_of_words", texts) == ""


def test_one_rounding(spark):
    draw = random.Random(3)
    rows = [(i, *(draw.random() for _ in range(3))) for i in range(2000)]
    df = spark.createDataFrame(rows, "i int, a double, b double, c double")
    fma = getattr(math, "fma", None) or pytest.skip("no fused multiply-add")
    assert {r.i: r.x for r in df.select("i", fused(F.col("a"), F.col("b"), F.col("c")).alias("x")).collect()} == {i: fma(a, b, c) for i, a, b, c in rows}


def test_small_groups(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 1.0), (2, 3.0), (3, 2.0), (3, 2.0), (3, 4.0)], "k int, v double")
    assert {r.k: r.b for r in interpolated(df, ["k"], "v", 0.5, "b").collect()} == {1: 5.0, 2: 2.0, 3: 2.0}


def test_entries_without_text(spark, tmp_path):
    rows = [(1, i, "user", t) for i, t in enumerate([None, "a b c", None, " d e f", "", " g " * 30, None])]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = compare.differences(q.QUERIES["distance_chunks_of_words"](spark, str(tmp_path)), compare.connect(str(tmp_path)), q.ORACLES["distance_chunks_of_words"])
    assert found == ""
