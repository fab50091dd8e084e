"""Tables of deltas against merges of whole tables; streams whose state outlives restarts."""

import os
import random

import pytest

from docloom.operators import evaluation
from docloom.operators.merge import merge
from docloom.sources.deltas import DeltaTable
from docloom.streaming import incremental, stateful

SHAPE = "k int, name string, n bigint"


def batch_of(rng, size=40):
    pick = lambda *v: rng.choice(v)
    return [(pick(None, *range(30)), pick(None, "a", "b", "c"), pick(None, 1, 2), i) for i in range(size)]


def rows(df):
    return sorted(map(tuple, df.select("k", "name", "n").collect()), key=str)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("update", [True, False])
def test_equals_merges_of_whole_tables(spark, tmp_path, update):
    rng, table = random.Random(6), DeltaTable(spark, str(tmp_path / "t"), SHAPE, ("k",), update, buckets=4, compact_after=3)
    whole = spark.createDataFrame([], SHAPE)
    for n in range(7):
        batch = spark.createDataFrame(batch_of(rng), SHAPE + ", seq int")
        table.write(batch, n, "seq")
        whole = spark.createDataFrame(merge(whole, batch, ["k"], "seq", update).drop("action").collect(), SHAPE)
        assert rows(table.read()) == rows(whole)
    assert os.path.exists(tmp_path / "t/bases")


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    rng, table = random.Random(8), DeltaTable(spark, str(tmp_path / "t"), SHAPE, ("k",), buckets=3, compact_after=2)
    batches = [spark.createDataFrame(batch_of(rng), SHAPE + ", seq int") for _ in range(4)]
    for n, batch in enumerate(batches):
        table.write(batch, n, "seq")
        before = rows(table.read())
        table.write(batch, n, "seq")
        assert rows(table.read()) == before


def test_a_batch_counts_once_it_is_logged(spark, tmp_path):
    """A write that stops before its log is not seen, and its repetition is."""
    table = DeltaTable(spark, str(tmp_path / "t"), SHAPE, ("k",), buckets=2, compact_after=2)
    table.write(spark.createDataFrame([(1, "a", 1, 0)], SHAPE + ", seq int"), 0, "seq")
    half = table.bucketed(spark.createDataFrame([(1, "b", 2), (2, "c", 3)], SHAPE))
    half.write.partitionBy("bucket").parquet(str(tmp_path / "t/deltas/batch=1"))
    half.write.partitionBy("bucket").parquet(str(tmp_path / "t/bases/upto=1"))
    assert rows(table.read()) == [(1, "a", 1)]
    table.write(spark.createDataFrame([(1, None, 5, 0)], SHAPE + ", seq int"), 1, "seq")
    assert rows(table.read()) == [(1, "a", 5)]


def test_only_touched_buckets_are_written(spark, tmp_path):
    table = DeltaTable(spark, str(tmp_path / "t"), SHAPE, ("k",), buckets=8, compact_after=3)
    for n in range(2):
        table.write(spark.createDataFrame([(k, "a", n, 0) for k in range(50)], SHAPE + ", seq int"), n, "seq")
    before = files(tmp_path)
    table.write(spark.createDataFrame([(7, "b", 9, 0)], SHAPE + ", seq int"), 2, "seq")
    after = files(tmp_path)
    assert all(after[f] == m for f, m in before.items())
    new = {f.split("/t/")[1] for f in after.keys() - before.keys()}
    buckets = {p.split("bucket=")[1].split("/")[0] for p in new if "bucket=" in p}
    assert len(buckets) == 1 and any(p.startswith("bases/upto=2") for p in new)
    assert (7, "b", 9) in rows(table.read()) and len(rows(table.read())) == 50


def test_no_rows(spark, tmp_path):
    table = DeltaTable(spark, str(tmp_path / "t"), SHAPE, ("k",))
    assert rows(table.read()) == []
    table.write(spark.createDataFrame([], SHAPE + ", seq int"), 0, "seq")
    assert rows(table.read()) == []


def test_late_matches_give_the_ratings_of_the_whole_fold(spark, tmp_path):
    """Matches come in any order, in batches with restarts; the delay covers them all."""
    rng = random.Random(3)
    matches = [(f"p{rng.randrange(3)}", f"2024-01-01 {i // 60:02}:{i % 60:02}:00", rng.randrange(5), rng.choice([0.0, 0.5, 1.0, None])) for i in range(90)]
    shape, folder = "pair string, ts timestamp, seq bigint, score double", tmp_path / "in"
    shuffled = sorted(range(90), key=lambda i: i // 30 * 25 + rng.randrange(40))
    for n in range(3):
        own = [matches[i] for i in shuffled[30 * n : 30 * n + 30]]
        spark.createDataFrame(own, "pair string, ts string, seq bigint, score double").coalesce(1).write.mode("append").json(str(folder))
        stream = stateful.rating_stream(incremental.queue(spark, str(folder), shape), "pair", "ts", "seq", "score", delay="60 minutes")
        incremental.drain(stream, lambda df, i: df.write.mode("overwrite").parquet(str(tmp_path / f"out/b={i}")), str(tmp_path / "cp"), "update")
        seen = {}
        for r in sorted(spark.read.parquet(str(tmp_path / "out")).collect(), key=lambda r: r.n_matches):
            seen[r.pair] = (round(r.rating_a, 9), round(r.rating_b, 9), r.n_matches)
        so_far = spark.createDataFrame([matches[i] for i in shuffled[: 30 * n + 30]], "pair string, ts string, seq bigint, score double").selectExpr("pair", "struct(ts, seq) AS at", "score")
        want = {r.pair: (round(r.rating_a, 9), round(r.rating_b, 9), r.n_matches) for r in evaluation.elo(so_far, ["pair"], "at", "score").collect()}
        assert seen == want


def test_downloads_are_tried_again_and_outlive_a_restart(spark, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()

    def fetch(url, folder=str(asked)):
        with open(f"{folder}/{url}", "a", encoding="utf-8") as log:
            log.write("x")
        tried = os.path.getsize(f"{folder}/{url}")
        if url.startswith("bad") or (url.startswith("slow") and tried < 3):
            raise OSError(f"no {url}")
        return f"page of {url}"

    folder, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    results = lambda: sorted(map(tuple, spark.read.parquet(out).select("url", "status", "tries", "body", "error").collect()))
    want = [("bad1", "rejected", 3, None, "OSError: no bad1"), ("good1", "done", 1, "page of good1", None), ("good2", "done", 1, "page of good2", None), ("slow1", "done", 3, "page of slow1", None)]
    spark.createDataFrame([("good1",), ("bad1",), ("slow1",), ("good1",), (None,)], "url string").coalesce(1).write.mode("append").json(folder)
    run = lambda: stateful.download(incremental.queue(spark, folder, "url string"), fetch, out, checkpoint, 5, pause=0.3, every="300 milliseconds")
    run()
    spark.createDataFrame([("good1",), ("good2",), ("bad1",)], "url string").coalesce(1).write.mode("append").json(folder)
    for _ in range(6):
        run()
        if results() == want:
            break
    assert results() == want
    assert {u: os.path.getsize(asked / u) for u in os.listdir(asked)} == {"good1": 1, "good2": 1, "bad1": 3, "slow1": 3}
