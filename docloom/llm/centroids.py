"""Centroid clustering by sort-means, in whole numbers.

A round of k-means compares a vector with the centroids in the order of their
distance from the one it was assigned to before (Phillips 2002: acceleration of
k-means). If that one is d away, a centroid more than 2d away from it can be
neither nearer nor as near, and so can none that comes later in the order: the
scan stops there. The order is made once per centroid and round; in a task all
vectors with the same previous centroid are scanned together.

Vectors are scaled to whole numbers, so that sums, means (rounded down) and
squared distances are exact and don't depend on how rows are dealt out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.shared import small_batches, written


def whole_numbers(vector: Column, size: int, scale: int) -> Column:
    """floor(scale * x) of each component; null unless the vector has exactly size components, none of them null or non-finite.

    A component whose scaled value is so large that a squared distance might not fit a long is an error.
    """
    most = math.isqrt((2**63 - 1) // (16 * size))
    good = (F.size(vector) == size) & F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    whole = lambda y: F.when(F.abs(y) <= most, F.floor(y)).otherwise(F.raise_error(F.lit("a component is too large for whole-number distances")).cast("bigint"))
    return F.when(good, F.transform(vector, lambda x: whole(x.cast("double") * scale)))


def sort_means(vectors: np.ndarray, before: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector (of equally near ones the smaller number) and its squared distance; before is the centroid each had so far."""
    between = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    order = np.argsort(between, axis=1, kind="stable")
    cluster, distance = before.copy(), ((vectors - centroids[before]) ** 2).sum(axis=1)
    for j in np.unique(before):
        rows = np.flatnonzero(before == j)
        own, reach = vectors[rows], 4 * distance[rows]
        best, nearest = distance[rows], np.full(len(rows), j)
        for t in order[j]:
            if t == j:
                continue
            open_ = np.flatnonzero(between[j, t] <= reach)
            if not len(open_):
                break
            d = ((own[open_] - centroids[t]) ** 2).sum(axis=1)
            better = (d < best[open_]) | ((d == best[open_]) & (t < nearest[open_]))
            best[open_[better]], nearest[open_[better]] = d[better], t
        cluster[rows], distance[rows] = nearest, best
    return cluster, distance


def packed(block: int):
    """A mapInArrow function: (id, v) to blocks of up to block vectors, all with cluster 0."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, block):
                own = part.slice(at, block)
                n = own.num_rows
                vectors = np.asarray(own["v"].flatten(), dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), own["id"]), pa.array([vectors.tobytes()]), pa.array([np.zeros(n, np.int32).tobytes()]), pa.array([[]], pa.list_(pa.int64()))],
                    ["ids", "vectors", "clusters", "sums"],
                )

    return run


def opened(part: pa.RecordBatch, centroids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Each block of a batch with its vectors and their nearest centroids and distances."""
    for i in range(part.num_rows):
        vectors = np.frombuffer(part["vectors"][i].as_py(), dtype=np.int32).reshape(-1, centroids.shape[1]).astype(np.int64)
        yield i, vectors, *sort_means(vectors, np.frombuffer(part["clusters"][i].as_py(), dtype=np.int32), centroids)


def assigned(centroids: np.ndarray):
    """A mapInArrow function: blocks with the clusters of this round, and per block and cluster the number of vectors and their sum."""
    k, size = centroids.shape

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            clusters, sums = [], []
            for _, vectors, cluster, _ in opened(part, centroids):
                total = np.zeros((k, size + 1), dtype=np.int64)
                for c in np.unique(cluster):
                    mine = vectors[cluster == c]
                    total[c, 0], total[c, 1:] = len(mine), mine.sum(axis=0)
                clusters.append(cluster.astype(np.int32).tobytes())
                sums.append(total.ravel())
            yield pa.RecordBatch.from_arrays([part["ids"], part["vectors"], pa.array(clusters, pa.binary()), pa.array(sums, pa.list_(pa.int64()))], part.schema.names)

    return run


def spread(centroids: np.ndarray):
    """A mapInArrow function: blocks to rows (id, cluster, distance)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i, _, cluster, distance in opened(part, centroids):
                yield pa.RecordBatch.from_arrays([part["ids"][i].values, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], ["id", "cluster", "distance"])

    return run


def moved(centroids: np.ndarray, totals: dict[int, int]) -> np.ndarray:
    """The means of what each centroid was assigned, rounded down; a centroid without vectors stays. totals: of each place in (count, sum ...) of each centroid."""
    k, size = centroids.shape
    after = centroids.copy()
    for c in range(k):
        own = [totals.get(c * (size + 1) + i, 0) for i in range(size + 1)]
        if own[0]:
            after[c] = [s // own[0] for s in own[1:]]
    return after


def cluster_vectors(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: str = "3", size: int = 64, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", block: int = 4096) -> DataFrame:
    """One row per vector that is kept: id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of exactly size components without nulls, NaN and
    infinities; each component x becomes floor(scale * x), x as double. The
    first centroids are the k kept vectors with the smallest SHA-256 of
    "seed:id", in that order; equal ids are ordered by their components, rows
    without id come last. Each round assigns every vector to the nearest
    centroid (squared Euclidean distance, ties to the smaller number) and moves
    each centroid to the mean of its vectors, rounded down; one without vectors
    stays. A last assignment gives the result. distance is squared; inertia is
    its sum. Repeated rows are vectors of their own. With fewer kept rows than
    k there are as many centroids as rows; an empty table gives an empty
    result. Other columns are not read. Components beyond about 2^26 after
    scaling are an error, as a squared distance might not fit a long.

    Vectors travel in blocks of some thousand, packed, with their clusters
    beside them: a round reads the blocks of the one before and sends k * (size
    + 1) sums per task. Blocks are persisted on disk for one round; if an
    executor takes its blocks with it, they are made again from the table by
    the same narrow steps. The driver holds k centroids. The rows of the result
    are written to the shared folder.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    kind = vectors.schema[id_col].dataType.simpleString()
    kept = vectors.select(vectors[id_col].alias("id"), whole_numbers(vectors[vector_col], size, scale).alias("v")).where("v is not null")
    first = kept.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).asc_nulls_last(), "v").limit(k)
    centroids = np.array([r["v"] for r in first.collect()], dtype=np.int64).reshape(-1, size)
    if not len(centroids):
        return spark.createDataFrame([], f"`{id_col}` {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")

    shape = f"ids array<{kind}>, vectors binary, clusters binary, sums array<bigint>"
    blocks, held = kept.mapInArrow(packed(block), shape), None
    for _ in range(rounds):
        blocks = blocks.mapInArrow(assigned(centroids), shape).persist(StorageLevel.DISK_ONLY)
        totals = blocks.select(F.posexplode("sums").alias("place", "n")).groupBy("place").agg(F.sum("n").alias("n"))
        centroids = moved(centroids, {r["place"]: r["n"] for r in totals.collect()})
        if held is not None:
            held.unpersist()
        held = blocks
    found = written(blocks.mapInArrow(spread(centroids), f"id {kind}, cluster int, distance bigint"), "clusters")
    if held is not None:
        held.unpersist()
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digest = lambda c: hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()
    about = spark.createDataFrame([(c, s, sum(sums.values()), digest(centroids[c])) for c, s in sums.items()], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.withColumnRenamed("id", id_col).join(F.broadcast(about), "cluster").select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
