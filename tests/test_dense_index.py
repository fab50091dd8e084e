"""The inverted file against all pairs, the grid against itself."""

import random

import numpy as np
import pytest

from docloom import queries
from docloom.operators import dense_index
from docloom.operators.dense_index import build_dense_index, dense_top_k, search_dense_index


@pytest.fixture(scope="module")
def vectors(spark):
    """Clusters, one vector very many times, zero and missing vectors; two features."""
    rng = random.Random(4)
    middle = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in middle[i % 12]], "ab"[i % 7 == 0]) for i in range(1500)]
    rows += [(2000 + i, rows[0][1], "a") for i in range(400)] + [(3000, [0.0] * 8, "b"), (3001, None, "a"), (3002, rows[5][1], "c")]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string")


@pytest.fixture(scope="module")
def asked(vectors):
    return vectors.where("vec_id % 50 = 0").selectExpr("vec_id AS query_id", "embedding")


def got(df):
    return sorted(tuple(r[c] for c in ("query_id", "feature", "id", "score", "rank")) for r in df.collect())


def plain(vectors, asked, k, feature):
    rows = [(r.vec_id, np.array(r.embedding), r.label if feature else "") for r in vectors.collect() if r.embedding is not None]
    unit = lambda v: v / max(np.linalg.norm(v), 1e-300)
    out = []
    for q in asked.collect():
        for f in {r[2] for r in rows}:
            hits = sorted((-(round(float(unit(v) @ unit(np.array(q.embedding))), 6) + 0.0), i) for i, v, g in rows if g == f)[:k]
            out += [(q.query_id, f, i, -s + 0.0, n + 1) for n, (s, i) in enumerate(hits)]
    return sorted(out)


@pytest.mark.parametrize("cells", [None, (1, 1), (3, 2), (2, 7)])
def test_grid_equals_plain(vectors, asked, cells):
    assert got(dense_top_k(vectors, asked, 5, feature="label", block=64, cells=cells)) == plain(vectors, asked, 5, "label")


@pytest.mark.parametrize("feature", [None, "label"])
def test_exact_search_equals_all_pairs(vectors, asked, feature):
    index = build_dense_index(vectors, feature=feature, cells=20, part_rows=100, block=32)
    assert got(search_dense_index(index, asked, 5, probes=2, exact=True)) == plain(vectors, asked, 5, feature)
    # A cell that is too full is dealt to several parts.
    assert max(r.subs for r in index.centroids().collect()) > 3


def test_exact_search_leaves_cells_out(vectors, asked):
    """The bound spares cells: of well separated clusters a query looks into few."""
    index = build_dense_index(vectors.where("vec_id < 1500"), cells=12)
    about = index.centroids().collect()
    import pyarrow as pa

    part = pa.RecordBatch.from_pylist([{"query_id": r.query_id, "v": r.embedding, "least": 0.95} for r in asked.where("query_id < 1500").collect()])
    more = sum(b.num_rows for b in dense_index.to_probes(about, 1, True)(iter([part])))
    assert more < 0.5 * part.num_rows * (len(about) - 1)


def test_no_vectors_and_no_queries(vectors, asked):
    for exact in (False, True):
        assert search_dense_index(build_dense_index(vectors.limit(0)), asked, exact=exact).count() == 0
        assert search_dense_index(build_dense_index(vectors.limit(9)), asked.limit(0), exact=exact).count() == 0
    assert dense_top_k(vectors.limit(0), asked).count() == 0


def test_recall_of_near_cells(spark, sf):
    rows = queries.dense_index_recall(spark, sf).collect()
    assert rows and sum(r.n_found for r in rows) >= 0.9 * sum(r.n_exact for r in rows)


def test_groups_of_queries_give_the_same_hits(spark, sf):
    """A task sees a group of the queries that look into its cell; before, all of them."""
    from docloom.operators.dense_index import build_dense_index, search_dense_index

    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    queries = e.select(e.vec_id.alias("query_id"), "embedding")
    index = build_dense_index(e, cells=8)
    for exact in (False, True):
        whole, parts = (sorted(map(tuple, search_dense_index(index, queries, 5, exact=exact, query_rows=n).collect())) for n in (10**6, 37))
        assert whole and whole == parts
