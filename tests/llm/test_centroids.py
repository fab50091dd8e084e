"""Sort-means against plain k-means with Python's whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docloom.llm import centroids

SHAPE = "vec_id bigint, embedding array<float>, cluster string, distance int, id string, label int, v int"


def plain(rows, k, rounds, size=64):
    kept = []
    for vec_id, v in rows:
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [math.floor(1024 * float(np.float32(x))) for x in v]))
    rank = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    middle = [v for _, v in sorted(kept, key=rank)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(middle))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in range(len(middle)):
            mine = [v for (_, v), c in zip(kept, own) if c == j]
            if mine:
                middle[j] = [sum(x) // len(mine) for x in zip(*mine)]
    out = [(vec_id, near(v)[1], near(v)[0]) for vec_id, v in kept]
    total = sum(d for _, _, d in out)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted(((i, c, d, sum(e for _, b, e in out if b == c), total, digest[c]) for i, c, d in out), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(5)
    near = lambda c: [c + rng.gauss(0, 0.02) for _ in range(64)]
    rows = [(i, near(i % 11 / 5 - 1)) for i in range(300)]
    rows += [(7, near(0.3)), (7, rows[7][1]), (7, rows[7][1]), (None, near(0.1)), (None, near(-2.0))]
    rows += [(400 + i, [0.25] * 64) for i in range(150)]  # one vector, over and over
    rows += [(600, None), (601, []), (602, [1.0] * 63), (603, [1.0] * 65), (604, [None] + [1.0] * 63), (605, [math.nan] + [1.0] * 63), (606, [math.inf] * 64), (607, [-math.inf] + [0.0] * 63), (608, [-0.0005] * 64)]
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "c", 1, "x", None, 2) for i, v in rows], SHAPE).repartition(parts)


def test_equals_plain_rounds(spark, odd):
    assert got(centroids.cluster_vectors(frame(spark, odd), block=50)) == plain(odd, 8, 10)


def test_few_rows_and_none(spark, odd):
    few = odd[:5] + odd[-9:]
    assert got(centroids.cluster_vectors(frame(spark, few, 1))) == plain(few, 8, 10)
    empty = centroids.cluster_vectors(frame(spark, odd[-9:-1]))
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_dealing_changes_nothing(spark, odd):
    assert got(centroids.cluster_vectors(frame(spark, odd, 1))) == got(centroids.cluster_vectors(frame(spark, odd[::-1], 9), block=7))


def test_text_ids_and_other_sizes(spark):
    rows = [("a", [0.0, 0.0]), ("b", [1.0, 0.0]), ("c", [0.5, 0.0]), (None, [0.5, 1.0])]
    found = centroids.cluster_vectors(spark.createDataFrame(rows, "name string, at array<double>"), k=2, rounds=0, size=2, scale=10, id_col="name", vector_col="at")
    first = sorted("abc", key=lambda i: hashlib.sha256(f"3:{i}".encode()).hexdigest())[:2]
    by = {r["name"]: (r["cluster"], r["distance"]) for r in found.collect()}
    assert [by[i] for i in first] == [(0, 0), (1, 0)] and set(by) == {"a", "b", "c", None}


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        centroids.cluster_vectors(frame(spark, [(1, [1e20] * 64), (2, [0.0] * 64)])).collect()


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 6), st.integers(0, 2**32 - 1))
def test_no_nearer_centroid_is_passed_over(k, seed):
    """On a small grid nearly everything is a tie."""
    rng = np.random.default_rng(seed)
    vectors, middle = rng.integers(-2, 3, (40, 2)), rng.integers(-2, 3, (k, 2))
    cluster, distance = centroids.sort_means(vectors, rng.integers(0, k, 40), middle)
    every = ((vectors[:, None] - middle[None]) ** 2).sum(axis=2)
    assert (cluster == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def test_scan_stops_early():
    """With well separated clusters nearly every vector is compared with its own centroid alone."""
    rng = np.random.default_rng(1)
    middle = rng.integers(-1000, 1000, (50, 8)) * 100
    own = rng.integers(0, 50, 2000)
    vectors = middle[own] + rng.integers(-5, 6, (2000, 8))
    far = ((middle[:, None] - middle[None]) ** 2).sum(axis=2)
    assert np.median((far[own] <= 4 * ((vectors - middle[own]) ** 2).sum(axis=1)[:, None]).sum(axis=1)) == 1
    assert (centroids.sort_means(vectors, own, middle)[0] == own).all()
