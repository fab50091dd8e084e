"""Projection of vectors to few dimensions that keeps their neighbourhoods (uniform manifold approximation, McInnes and others 2018), as DataFrame rounds.

The neighbour graph comes from the inverted file of dense_index. Each row's
distances become membership weights, the graph is made symmetric, and positions,
begun with principal components, move in rounds: towards the neighbours, and
away from rows drawn at random. A round joins edges with positions and sums by
row; nothing is gathered, and positions are written after each round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators.dense_index import build_dense_index, search_dense_index
from docloom.operators.features import reduced
from docloom.operators.merge import with_new_ids
from docloom.sources.workspace import written

#: The curve 1 / (1 + a d^2b) for neighbours that lie at least 0.1 apart.
A, B = 1.577, 0.8951
#: No force moves a coordinate by more.
MOST = 4.0


def neighbours(rows: DataFrame, k: int) -> DataFrame:
    """(id, other, distance): about the k nearest rows of each row (id, v) by cosine distance, itself left out."""
    index = build_dense_index(rows, "id", "v")
    hits = search_dense_index(index, rows.select(F.col("id").alias("query_id"), F.col("v").alias("embedding")), k + 1)
    return hits.where("query_id <> id").select(F.col("query_id").alias("id"), F.col("id").alias("other"), F.greatest(1 - F.col("score"), F.lit(0.0)).alias("distance"))


def memberships(distances: np.ndarray, sizes: np.ndarray, rounds: int = 40) -> np.ndarray:
    """exp(-(d - nearest) / s) of each row's distances (rows of different sizes, one after the other), where s is such that a row's weights add up to log2 of their number."""
    starts = np.cumsum(sizes) - sizes
    over = distances - np.repeat(np.minimum.reduceat(distances, starts), sizes)
    goal, low, high = np.log2(np.maximum(sizes, 2)), np.full(len(sizes), 1e-6), np.full(len(sizes), 1e3)
    for _ in range(rounds):
        s = np.sqrt(low * high)
        total = np.add.reduceat(np.exp(-over / np.repeat(s, sizes)), starts)
        low, high = np.where(total > goal, low, s), np.where(total > goal, s, high)
    return np.exp(-over / np.repeat(np.sqrt(low * high), sizes))


def weighed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, others, distances) to (id, other, w)."""
    for part in parts:
        if part.num_rows:
            sizes = np.asarray(part["others"].value_lengths()).astype(np.int64)
            w = memberships(np.asarray(part["distances"].flatten(), dtype=np.float64), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.asarray(part["id"]), sizes)), part["others"].flatten(), pa.array(w)], ["id", "other", "w"])


def fuzzy_graph(near: DataFrame) -> DataFrame:
    """(id, other, w) in both directions: of the weights a and b of two rows for one another a + b - a b."""
    own = near.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("distance", "other"))).alias("n"))
    one_way = own.select("id", F.col("n.other").alias("others"), F.col("n.distance").alias("distances")).mapInArrow(weighed, "id bigint, other bigint, w double")
    pair = one_way.groupBy(F.least("id", "other").alias("id"), F.greatest("id", "other").alias("other")).agg(F.when(F.count(F.lit(1)) > 1, F.sum("w") - F.product("w")).otherwise(F.sum("w")).alias("w"))
    return pair.unionByName(pair.select(F.col("other").alias("id"), F.col("id").alias("other"), "w"))


def step(now: DataFrame, edges: DataFrame, n: int, dims: int, rate: float, away: int, seed: int) -> DataFrame:
    """Positions (id, y0, y1, ...) after one round."""
    ys = [f"y{i}" for i in range(dims)]
    other = now.select(F.col("id").alias("other"), *[F.col(y).alias(f"o{y}") for y in ys])

    def force(pairs: DataFrame, strength: Column) -> tuple[DataFrame, list[Column]]:
        apart = sum(((F.col(y) - F.col(f"o{y}")) ** 2 for y in ys), F.lit(0.0))
        both = pairs.join(other, "other").join(now, "id").withColumn("_d", apart).withColumn("_f", strength)
        return both, [F.greatest(F.least(F.col("_f") * (F.col(y) - F.col(f"o{y}")), F.lit(MOST)), F.lit(-MOST)) for y in ys]

    power = F.pow(F.col("_d"), F.lit(B))
    near, pull = force(edges, F.when(F.col("_d") > 0, -2 * A * B * power / F.col("_d") / (1 + A * power)).otherwise(0.0))
    pulled = near.groupBy("id").agg(*[(F.sum(F.col("w") * c) / F.sum("w")).alias(f"p{y}") for y, c in zip(ys, pull, strict=True)])
    drawn = now.select("id", F.explode(F.sequence(F.lit(0), F.lit(away - 1))).alias("_s")).select("id", F.pmod(F.xxhash64("id", "_s", F.lit(seed)), F.lit(n)).alias("other"))
    far, push = force(drawn.where("id <> other"), 2 * B / ((0.001 + F.col("_d")) * (1 + A * power)))
    pushed = far.groupBy("id").agg(*[F.avg(c).alias(f"q{y}") for y, c in zip(ys, push, strict=True)])
    both = now.join(pulled, "id", "left").join(pushed, "id", "left")
    return both.select("id", *[(F.col(y) + rate * (F.coalesce(f"p{y}", F.lit(0.0)) + F.coalesce(f"q{y}", F.lit(0.0)))).alias(y) for y in ys])


def manifold(df: DataFrame, key: str, vector: str, dimensions: int = 2, k: int = 15, rounds: int = 20, away: int = 5, least_rows: int = 21, seed: int = 7) -> DataFrame:
    """df with column reduced: positions in so many dimensions in which near vectors stay near.

    Tables of fewer than least_rows vectors, and vectors of no more dimensions,
    keep their vectors; rows without a vector get null. key has to tell rows
    apart.
    """
    have = df.where(F.col(vector).isNotNull())
    head = have.select(vector).limit(least_rows).collect()
    if len(head) < least_rows or len(head[0][0]) <= dimensions:
        return df.withColumn("reduced", F.col(vector).cast("array<double>"))
    ids = written(with_new_ids(have.select(F.col(key).alias("_key"), F.col(vector).cast("array<double>").alias("v")), ["_key"], -1), "manifold")
    n = ids.count()
    edges = written(fuzzy_graph(neighbours(ids.select("id", "v"), min(k, n - 1))), "manifold-edges")
    start = written(reduced(ids, "v", dimensions).select("id", "reduced"), "manifold-start")
    wide = start.agg(F.max(F.aggregate("reduced", F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x))))).first()[0] or 1.0
    now = written(start.select("id", *[(F.col("reduced")[i] * (10.0 / wide)).alias(f"y{i}") for i in range(dimensions)]), "manifold-0")
    for turn in range(rounds):
        now = written(step(now, edges, n, dimensions, 1.0 - turn / rounds, away, seed + turn), "manifold-y")
    found = ids.join(now, "id").select(F.col("_key").alias(key), F.array(*[f"y{i}" for i in range(dimensions)]).alias("reduced"))
    return df.join(found, key, "left")
