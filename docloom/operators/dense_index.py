"""Nearest vectors by cosine: all against all in one job, and an inverted file of cells.

Vectors are scaled to length 1 and packed into blocks of some hundred, so that a
task multiplies matrices. Queries are a table as well: a block of vectors and a
block of queries meet in a cell of a grid, and a cell sends the k best of each
query only. Nothing of either side passes through the driver.

The inverted file deals vectors to the nearest of some centroids, fitted on a
bounded sample. A query looks into its nearest cells; what it found bounds what
other cells could add (no vector lies farther from its centroid than the cell's
radius), so the exact way goes on with the few cells that may hold better ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.sources.workspace import scratch, small_batches, written

PACKED = "ids array<bigint>, features array<string>, vectors binary, size int"
HITS = "query_id bigint, feature string, id bigint, score double"


def best_of(s: np.ndarray, i: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """In each row the k highest scores with their ids; ties go to the smaller id. Of wide rows only those that reach the k-th score are sorted."""
    wide = s.shape[1] - k
    if wide > k:
        row, col = np.nonzero(s >= np.partition(s, wide, axis=1)[:, wide, None])
        order = np.lexsort((i[row, col], -s[row, col], row))
        row, col = row[order], col[order]
        first = np.arange(len(row)) - np.searchsorted(row, np.arange(len(s)))[row] < k
        row, col = row[first], col[first]
        return s[row, col].reshape(-1, k), i[row, col].reshape(-1, k)
    order = np.lexsort((i, -s), axis=1)[:, :k]
    return np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-300)


def listed(values: list | np.ndarray, kind: pa.DataType) -> pa.Array:
    """The values as an array of one list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def packed(parts: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """(id, feature, v) to blocks of vectors of length 1."""
    for part in parts:
        for at in range(0, part.num_rows, block):
            own = part.slice(at, block)
            vectors = unit(np.asarray(own["v"].flatten(), dtype=np.float64).reshape(own.num_rows, -1))
            yield pa.RecordBatch.from_arrays([listed(own["id"].to_pylist(), pa.int64()), listed(own["feature"].to_pylist(), pa.string()), pa.array([vectors.tobytes()]), pa.array([vectors.shape[1]], pa.int32())], ["ids", "features", "vectors", "size"])


def blocks(rows: DataFrame, id_col: str, vector: str, feature: str | None, block: int) -> DataFrame:
    own = rows.select(F.col(id_col).cast("bigint").alias("id"), (F.col(feature).cast("string") if feature else F.lit("")).alias("feature"), F.col(vector).alias("v")).where("v is not null")
    return own.mapInArrow(lambda parts: packed(parts, block), PACKED)


def matrices(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for row in (r for batch in table.select(["ids", "features", "vectors", "size"]).to_batches(max_chunksize=1) for r in batch.to_pylist()):
        yield np.asarray(row["ids"], dtype=np.int64), np.asarray(row["features"], dtype=object), np.frombuffer(row["vectors"], dtype=np.float64).reshape(-1, row["size"])


def met(k: int, digits: int):
    """A cogrouped applyInArrow function: blocks of vectors and blocks of queries to the k best of each query and feature."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        best: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}
        asked = list(matrices(right)) if right.num_columns else []
        for ids, features, vectors in matrices(left) if asked else ():
            for f in dict.fromkeys(features):
                own = features == f
                for n, (_, _, q) in enumerate(asked):
                    s = np.round(q @ vectors[own].T, digits) + 0.0
                    i = np.broadcast_to(ids[own], s.shape)
                    if (f, n) in best:
                        s, i = np.hstack([best[f, n][0], s]), np.hstack([best[f, n][1], i])
                    best[f, n] = best_of(s, i, k)
        parts = [pa.table([pa.array(np.repeat(asked[n][0], s.shape[1])), pa.array([f] * s.size, pa.string()), pa.array(i.ravel()), pa.array(s.ravel())], ["query_id", "feature", "id", "score"]) for (f, n), (s, i) in best.items()]
        return pa.concat_tables(parts) if parts else pa.table({"query_id": pa.array([], pa.int64()), "feature": pa.array([], pa.string()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})

    return run


def ranked(hits: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id", "feature").orderBy(F.col("score").desc(), "id")
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def dense_top_k(corpus: DataFrame, queries: DataFrame, k: int = 10, ids: tuple[str, str] = ("vec_id", "query_id"), vector: str = "embedding", feature: str | None = None, condition: Column | None = None, block: int = 512, digits: int = 6, cells: tuple[int, int] | None = None) -> DataFrame:
    """(query_id, feature, id, score, rank): the k corpus rows nearest by cosine, per query and value of feature, exactly.

    The condition is applied before scoring; null vectors are left out. The
    cells of the grid (parts of corpus, parts of queries) follow from the counted
    rows: at most about 65,536 vectors and 4,096 queries for each part. A
    vector is sent once to each part of the queries. Scores are rounded; ties go to the
    smaller id.
    """
    spark = corpus.sparkSession
    rows = corpus.where(condition) if condition is not None else corpus
    small_batches(spark)
    if cells is None:
        asked = max(1, -(-queries.count() // 4_096))
        many = max(-(-int(spark.conf.get("spark.sql.shuffle.partitions")) // asked), -(-rows.count() // 65_536))
    else:
        many, asked = cells
    deal = lambda n: F.pmod(F.xxhash64(F.col("ids")[0], F.size("ids")), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = blocks(rows, ids[0], vector, feature, block).select("*", deal(many).alias("part"), every(asked).alias("group"))
    right = blocks(queries, ids[1], vector, None, block).select("*", every(many).alias("part"), deal(asked).alias("group"))
    hits = left.groupBy("part", "group").cogroup(right.groupBy("part", "group")).applyInArrow(met(k, digits), HITS)
    return ranked(hits, k)


@dataclass(frozen=True)
class DenseIndex:
    """A written inverted file. Rows of table: cell, sub (a part of a cell of bounded size), and blocks of vectors; centroids has a row for each cell, with its radius and number of parts."""

    spark: SparkSession
    path: str

    def table(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/vectors")

    def centroids(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/centroids")


def fitted(sample: np.ndarray, cells: int, rounds: int) -> np.ndarray:
    """Centroids of length 1 by spherical k-means, begun with vectors that lie far apart from those chosen so far."""
    chosen = [0]
    near = sample @ sample[0]
    while len(chosen) < min(cells, len(sample)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, sample @ sample[chosen[-1]])
    centroids = sample[chosen]
    for _ in range(rounds):
        own = (sample @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, sample)
        some = np.linalg.norm(sums, axis=1) > 0
        centroids = np.where(some[:, None], unit(sums), centroids)
    return centroids


def probes_for(sample: np.ndarray, centroids: np.ndarray, recall: float, k: int = 10, queries: int = 200) -> int:
    """How many cells a query has to look into, nearest first, to find the given part of its k nearest vectors; measured inside the sample."""
    asked = sample[:queries]
    near = np.argsort(-(asked @ sample.T), axis=1, kind="stable")[:, : k + 1]
    rank = np.argsort(np.argsort(-(asked @ centroids.T), axis=1, kind="stable"), axis=1)
    cell = (sample @ centroids.T).argmax(axis=1)
    need = np.sort(np.take_along_axis(rank, cell[near], axis=1).ravel())
    return int(need[min(len(need) - 1, int(np.ceil(recall * len(need))))]) + 1


def to_cells(centroids: np.ndarray):
    """A mapInArrow function: adds to (id, feature, v) the nearest cell, how far its centroid is (as an angle), and the vector at length 1."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                vectors = unit(np.asarray(part["v"].flatten(), dtype=np.float64).reshape(part.num_rows, -1))
                products = vectors @ centroids.T
                cell = products.argmax(axis=1)
                angle = np.arccos(np.clip(products[np.arange(len(cell)), cell], -1.0, 1.0))
                yield pa.RecordBatch.from_arrays([part["id"], part["feature"], part["v"], pa.array(cell, pa.int32()), pa.array(angle)], ["id", "feature", "v", "cell", "angle"])

    return run


def build_dense_index(corpus: DataFrame, id_col: str = "vec_id", vector: str = "embedding", feature: str | None = None, cells: int = 64, sample_rows: int = 20_000, rounds: int = 10, part_rows: int = 8_192, block: int = 512, recall: float = 0.95, path: str | None = None) -> DenseIndex:
    """Writes an index of all rows of corpus that have a vector, below path (a fresh folder in the shared one if None).

    Centroids are fitted on the driver on at most sample_rows rows, those with
    the smallest hashes of their ids (sample_rows and cells bound its memory);
    every row is then dealt to its nearest one. A cell's rows are dealt to as
    many parts as keep each at about part_rows, however full it is. How many cells
    a search looks into is measured in the same sample, so that it finds about
    the given part of the nearest vectors: few cells of clustered vectors, half
    of them or more if vectors lie in no clusters.
    """
    spark = corpus.sparkSession
    path = path or scratch(spark, "dense-index")
    rows = corpus.select(F.col(id_col).cast("bigint").alias("id"), (F.col(feature).cast("string") if feature else F.lit("")).alias("feature"), F.col(vector).cast("array<double>").alias("v")).where("v is not null")
    sample = np.array([r["v"] for r in rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).collect()], dtype=np.float64)
    if not len(sample):
        spark.createDataFrame([], f"cell int, sub int, {PACKED}").write.parquet(f"{path}/vectors")
        spark.createDataFrame([], "cell int, n bigint, radius double, subs int, probes int, centroid array<double>").write.parquet(f"{path}/centroids")
        return DenseIndex(spark, path)
    centroids = fitted(unit(sample), cells, rounds)
    dealt = written(rows.mapInArrow(to_cells(centroids), "id bigint, feature string, v array<double>, cell int, angle double"), "cells")
    about = dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius")).withColumn("subs", F.ceil(F.col("n") / part_rows).cast("int"))
    places = spark.createDataFrame([(c, v.tolist()) for c, v in enumerate(centroids)], "cell int, centroid array<double>")
    probes = F.lit(probes_for(unit(sample), centroids, recall)).alias("probes")
    about.join(places, "cell").select("cell", "n", "radius", "subs", probes, "centroid").coalesce(1).write.parquet(f"{path}/centroids")
    about = spark.read.parquet(f"{path}/centroids")
    parts = dealt.join(F.broadcast(about.select("cell", "subs")), "cell").withColumn("sub", F.pmod(F.xxhash64("id"), F.col("subs")).cast("int"))

    def block_up(table: pa.Table) -> pa.Table:
        keys = table["cell"][0].as_py(), table["sub"][0].as_py()
        made = pa.Table.from_batches(packed(table.select(["id", "feature", "v"]).combine_chunks().to_batches(), block))
        return made.add_column(0, "cell", pa.array([keys[0]] * len(made), pa.int32())).add_column(1, "sub", pa.array([keys[1]] * len(made), pa.int32()))

    parts.groupBy("cell", "sub").applyInArrow(block_up, f"cell int, sub int, {PACKED}").write.parquet(f"{path}/vectors")
    return DenseIndex(spark, path)


def to_probes(about: list, probes: int, more: bool):
    """A mapInArrow function: (query_id, v, least) to the cells that a query looks into: its nearest probes or, with more, those of the others that may hold a cosine of least."""
    centroids, radius = np.array([r["centroid"] for r in about]), np.array([r["radius"] for r in about])
    cell, subs = np.array([r["cell"] for r in about]), np.array([r["subs"] for r in about])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in (whole.slice(at, 1024) for at in range(0, whole.num_rows, 1024)):
                vectors = unit(np.asarray(part["v"].flatten(), dtype=np.float64).reshape(part.num_rows, -1))
                products = np.clip(vectors @ centroids.T, -1.0, 1.0)
                chosen = np.argsort(np.argsort(-products, axis=1, kind="stable"), axis=1) < probes
                if more:
                    bound = np.cos(np.maximum(np.arccos(products) - radius, 0.0)) + 1e-9
                    chosen = ~chosen & (bound >= np.asarray(part["least"])[:, None])
                row, at = np.nonzero(chosen)
                yield pa.RecordBatch.from_arrays([part["query_id"].take(pa.array(row)), pa.array(cell[at], pa.int32()), pa.array(subs[at], pa.int32())], ["query_id", "cell", "subs"])

    return run


def search_dense_index(index: DenseIndex, queries: DataFrame, k: int = 10, probes: int | None = None, exact: bool = False, query: tuple[str, str] = ("query_id", "embedding"), digits: int = 6, block: int = 512, query_rows: int = 32_768) -> DataFrame:
    """(query_id, feature, id, score, rank): the k nearest vectors of the index per query and feature in the query's nearest cells: probes of them, or as many as the index has measured.

    With exact, cells follow that may hold a vector as near as the k-th found
    (of each feature; all cells if a feature has fewer than k so far), and the
    result is that of dense_top_k. A query goes to a part of a cell only if it
    looks there; the cells' centroids (bounded by the index) are all that is sent
    to every task. Queries are dealt into groups of about query_rows, so that a
    task sees a part of a cell and a group at most, however many queries look
    there. Query ids are taken to be unique.
    """
    about = index.centroids().collect()
    asked = queries.select(F.col(query[0]).cast("bigint").alias("query_id"), F.col(query[1]).cast("array<double>").alias("v")).where("v is not null")
    if not about:
        return ranked(asked.sparkSession.createDataFrame([], HITS), k)

    small_batches(asked.sparkSession)
    groups = max(1, -(-asked.count() // query_rows))

    def found(rows: DataFrame, more: bool) -> DataFrame:
        looks = rows.mapInArrow(to_probes(about, probes or about[0]["probes"], more), "query_id bigint, cell int, subs int")
        own = looks.join(asked, "query_id").select("cell", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)).alias("sub"), F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int").alias("group"), "query_id", "v")

        def gathered(left: pa.Table, right: pa.Table) -> pa.Table:
            own = pa.table({"id": right["query_id"], "feature": pa.array([""] * len(right), pa.string()), "v": right["v"]}).combine_chunks()
            made = list(packed(own.to_batches(), block))
            return met(k, digits)(left, pa.Table.from_batches(made) if made else right.select([]))

        table = index.table().withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        return table.groupBy("cell", "sub", "group").cogroup(own.groupBy("cell", "sub", "group")).applyInArrow(gathered, HITS)

    first = ranked(found(asked.withColumn("least", F.lit(None).cast("double")), False), k)
    if not exact:
        return first
    first = written(first.drop("rank"), "first-hits")
    features = index.table().select(F.explode("features").alias("feature")).distinct().count()
    of_feature = first.groupBy("query_id", "feature").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    least = of_feature.groupBy("query_id").agg(F.min("least").alias("least"), F.count_if(F.col("n") >= k).alias("full"))
    bound = F.when(F.col("full") == features, F.col("least") - 10.0**-digits).otherwise(F.lit(-2.0))
    rest = asked.join(least, "query_id", "left").select("query_id", "v", bound.alias("least"))
    return ranked(first.unionByName(found(rest, True)), k)
