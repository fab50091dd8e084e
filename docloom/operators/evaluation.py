"""Chunking and retrieval evaluation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.sources.workspace import small_batches, written


def chunk_metrics(chunks: DataFrame, keys: list[str], text: str = "chunk_text") -> DataFrame:
    """Number, mean length and population deviation of the lengths."""
    n = F.char_length(text)
    return chunks.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_chunks"), F.avg(n).alias("mean_length"), F.stddev_pop(n).alias("std_length"))


def comparison_score(a: Column, b: Column) -> Column:
    """a's share of a + b; 0.5 if they are equal or nothing was counted."""
    return F.when((a == b) | (a + b == 0), F.lit(0.5)).otherwise(a / (a + b))


def page_ranges(chunks: DataFrame, keys: list[str], order: str) -> DataFrame:
    """(keys, lo, hi, chunks): the texts of each page range in order."""
    own = chunks.groupBy(*keys, "lo", "hi").agg(F.array_sort(F.collect_list(F.struct(order, "text"))).alias("_c"))
    return own.select(*keys, "lo", "hi", F.col("_c.text").alias("chunks"))


def compare_page_ranges(a: DataFrame, b: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Page ranges of two chunkings side by side, for documents that both have; one side may be null."""
    x, y = page_ranges(a, keys, order).alias("x"), page_ranges(b, keys, order).alias("y")
    common = a.select(*keys).intersect(b.select(*keys))
    on = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in [*keys, "lo", "hi"]]
    full = x.join(y, on, "full").select(*[F.coalesce(f"x.{c}", f"y.{c}").alias(c) for c in [*keys, "lo", "hi"]], F.col("x.chunks").alias("chunks_a"), F.col("y.chunks").alias("chunks_b"))
    return full.join(common, keys, "left_semi")


def total_distance(a: np.ndarray, b: np.ndarray | None = None, strip: int = 256) -> float:
    """Sum of the distances of all pairs of rows of a and b, or of a among themselves.

    Squares come from products of matrices, a strip at a time. Where a square is
    small beside the lengths of its rows, the product has lost its digits: such
    pairs are taken again from their differences.
    """
    own = b is None
    b = a if own else b
    square_b, total = (b * b).sum(axis=1), 0.0
    for at in range(0, len(a), strip):
        x = a[at : at + strip]
        other, lengths = (b[at:], square_b[at:]) if own else (b, square_b)
        both = (x * x).sum(axis=1)[:, None] + lengths[None, :]
        d = both - 2.0 * (x @ other.T)
        for i, j in batched(np.argwhere(~(d > 1e-4 * both)), 4096):
            d[i, j] = ((x[i] - other[j]) ** 2).sum(axis=1)
        np.sqrt(d, out=d)
        total += float(np.triu(d[:, : len(x)], 1).sum() + d[:, len(x) :].sum()) if own else float(d.sum())
    return total


def batched(places: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for at in range(0, len(places), most):
        yield places[at : at + most, 0], places[at : at + most, 1]


def mean_pairwise_distance(df: DataFrame, key: str, vector: str, block: int = 512, most: int = 8_192) -> DataFrame:
    """(key, n, mean_distance): mean Euclidean distance over the pairs of each group; 0 for fewer than two rows.

    Rows are dealt at random into blocks; each pair of blocks is one group of
    rows, of which only sums come back. A group's blocks number 16 at most until
    they have so many rows that a task's memory would not do (most), and have
    block rows at least: a row is sent once for each block of its group. The mean
    is over all pairs, so the work grows with the square of a group.
    """
    small_batches(df.sparkSession)
    size = F.greatest(F.lit(block), F.least(F.lit(max(block, most)), F.ceil(F.col("n") / 16)))
    sizes = df.where(F.col(vector).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).withColumn("parts", F.ceil(F.col("n") / size))
    dealt = df.where(F.col(vector).isNotNull()).select(key, vector).join(sizes.select(key, "parts"), key)
    # Rows are dealt by their place, not by their value: equal vectors go to different blocks. Written, so that a repeated task deals them alike.
    rows = written(dealt.withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("parts"))), "pairwise")
    cells = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(F.least("part", j).alias("i"), F.greatest("part", j).alias("j")))
    rows = rows.select(key, "part", vector, F.explode(cells).alias("c")).select(key, "part", F.col(vector).alias("v"), F.col("c.i").alias("i"), F.col("c.j").alias("j"))

    def sums(table: pa.Table) -> pa.Table:
        own = table.combine_chunks()
        part, (i, j) = np.asarray(own["part"]), (own[c][0].as_py() for c in ("i", "j"))
        vectors = np.asarray(own["v"].combine_chunks().flatten(), dtype=np.float64).reshape(len(own), -1)
        a, b = vectors[part == i], vectors[part == j]
        total = total_distance(a) if i == j else total_distance(a, b) if len(a) and len(b) else 0.0
        return pa.table([own[key].slice(0, 1), pa.array([total], pa.float64())], [key, "total"])

    kind = df.schema[key].dataType.simpleString()
    totals = rows.groupBy(key, "i", "j").applyInArrow(sums, f"`{key}` {kind}, total double").groupBy(key).agg(F.sum("total").alias("total"))
    pairs = F.col("n") * (F.col("n") - 1) / 2
    return sizes.join(totals, key, "left").select(key, "n", F.when(pairs > 0, F.col("total") / pairs).otherwise(F.lit(0.0)).alias("mean_distance"))


def hits_at_k(ranked: DataFrame, expected: DataFrame, ks: tuple[int, ...] = (1, 3, 5, 10)) -> DataFrame:
    """Per query of expected (query_id, id) whether that id is among the first k of ranked (query_id, id, rank)."""
    found = expected.alias("e").join(ranked.alias("r"), (F.col("e.query_id") == F.col("r.query_id")) & (F.col("e.id") == F.col("r.id")), "left")
    best = found.groupBy(F.col("e.query_id").alias("query_id")).agg(F.min("r.rank").alias("best"))
    return best.select("query_id", *[F.coalesce(F.col("best") <= k, F.lit(False)).alias(f"hit_{k}") for k in ks])


def precision_recall(hits: DataFrame, ks: tuple[int, ...] = (1, 3, 5, 10)) -> DataFrame:
    """One row: with one relevant id per query, recall at k is the share of queries with a hit, and precision that divided by k."""
    n = F.count(F.lit(1))
    share = lambda k: F.count_if(f"hit_{k}") / n
    return hits.agg(n.alias("n_queries"), *[share(k).alias(f"recall_{k}") for k in ks], *[(share(k) / k).alias(f"precision_{k}") for k in ks])


def score_stats(scored: DataFrame, keys: list[str], score: str = "score") -> DataFrame:
    return scored.groupBy(*keys).agg(F.avg(score).alias("mean_score"), F.stddev_pop(score).alias("std_score"), F.count(F.lit(1)).alias("n"))


def elo(matches: DataFrame, keys: list[str], seq: str, score: str, k: float = 32.0, start: float = 1500.0, history: bool = False) -> DataFrame:
    """(keys, rating_a, rating_b, n_matches) of a pair of rivals after its matches in order; score is a's result from 0 to 1 (null: a draw).

    With history, a row for each match, in which seq is kept and n_matches counts up. The
    fold is sequential: a pair's matches stream through one task in order, which
    holds two ratings, however many matches there are. Matches with the same seq
    are taken in the order of their scores.
    """
    names = [*keys, *([seq] if history else [])]
    shape = ", ".join(f"`{c}` {matches.schema[c].dataType.simpleString()}" for c in names) + ", rating_a double, rating_b double, n_matches int"
    rows = matches.select(*keys, seq, F.coalesce(F.col(score).cast("double"), F.lit(0.5)).alias("_score"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, a, b, n, last = None, start, start, 0, None
        for frame in frames:
            out = []
            for *own, at, s in frame.astype(object).where(frame.notna(), None).itertuples(index=False, name=None):
                if own != now:
                    if now is not None and not history:
                        out.append((*now, a, b, n))
                    now, a, b, n = own, start, start, 0
                change = k * (s - 1.0 / (1.0 + 10.0 ** ((b - a) / 400.0)))
                a, b, n = a + change, b - change, n + 1
                if history:
                    out.append((*own, at, a, b, n))
            last = frame
            yield pd.DataFrame(out, columns=[*names, "rating_a", "rating_b", "n_matches"])
        if last is not None and now is not None and not history:
            yield pd.DataFrame([(*now, a, b, n)], columns=[*names, "rating_a", "rating_b", "n_matches"])

    return rows.repartition(*keys).sortWithinPartitions(*keys, seq, "_score").mapInPandas(run, shape)


def elo_summary(matches: DataFrame, keys: list[str], score: str) -> DataFrame:
    """Wins of each side, the win rate to 3 digits, and the half width of the 95 % interval of the mean score (null below two matches)."""
    n = F.count(F.lit(1))
    return matches.groupBy(*keys).agg(
        n.alias("n_matches"), F.count_if(F.col(score) > 0.5).alias("wins_a"), F.count_if(F.col(score) < 0.5).alias("wins_b"),
        F.round(F.count_if(F.col(score) > 0.5) / n, 3).alias("win_rate_a"), (1.96 * F.stddev_samp(score) / F.sqrt(n)).alias("confidence"),
    )


def cost(usage: DataFrame, prices: DataFrame, keys: list[str], model: str = "model") -> DataFrame:
    """Tokens times the unit price of the row's model, summed; models without a price cost nothing."""
    both = usage.join(prices, model, "left")
    return both.groupBy(*keys).agg(F.sum("tokens").alias("tokens"), F.sum(F.col("tokens") * F.coalesce("unit_price", F.lit(0.0))).alias("cost"))


def merged_questions(old: Column, new: Column) -> Column:
    """old, followed by those of new that old has not (repeats inside new stay)."""
    have = F.coalesce(old, F.array().cast("array<string>"))
    return F.concat(have, F.filter(new, lambda q: ~F.array_contains(have, q)))


def ndcg(ranked: DataFrame, k: int = 10) -> DataFrame:
    """Per query the discounted gain of its first k (query_id, rank, relevance), over that of the best order of them."""
    own = ranked.where(F.col("rank") <= k)
    ideal = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("relevance").desc(), "rank"))
    gain = lambda r: F.sum(F.col("relevance") / F.log2(r + 1.0))
    both = own.withColumn("_i", ideal).groupBy("query_id").agg(gain(F.col("rank")).alias("dcg"), gain(F.col("_i")).alias("best"))
    return both.select("query_id", F.when(F.col("best") > 0, F.col("dcg") / F.col("best")).otherwise(F.lit(0.0)).alias("ndcg"))


def rating_history(history: DataFrame, time: str, rivals: tuple[str, str] = ("rival_a", "rival_b")) -> DataFrame:
    """(rival, time, rating): each rating after a match (rival_a, rival_b, rating_a, rating_b) under the name of its rival, in order of time."""
    side = lambda rival, rating: history.select(F.col(rival).alias("rival"), time, F.col(rating).alias("rating"))
    return side(rivals[0], "rating_a").unionByName(side(rivals[1], "rating_b")).orderBy("rival", time)


def needs_questions(questions: Column, force: bool = False) -> Column:
    """Whether an entry has no questions yet (all do with force)."""
    return F.lit(True) if force else questions.isNull() | (F.size(questions) == 0)


def shown_by_pages(chunks_a: Column, chunks_b: Column) -> Column:
    """Whether both sides of a comparison can be shown as page images: every chunk of both has locations."""
    placed = lambda chunks: F.coalesce(F.forall(chunks, lambda c: F.coalesce(F.size(c["chunk_locations"]) > 0, F.lit(False))), F.lit(False))
    return placed(chunks_a) & placed(chunks_b)
