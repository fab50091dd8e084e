"""Neighbourhoods after the projection, against those of principal components; the graph against plain sums."""

import math

import numpy as np
import pytest

from docloom.operators import manifold
from docloom.operators.features import reduced


def trustworthiness(high, low, k):
    """Of each point's k nearest in the projection, how far down they were before (Venna and Kaski 2001)."""
    unit = high / np.linalg.norm(high, axis=1, keepdims=True)
    before = np.argsort(np.argsort(-(unit @ unit.T) - 10 * np.eye(len(high)), axis=1), axis=1)
    after = np.argsort(((low[:, None] - low[None]) ** 2).sum(axis=2) - np.eye(len(low)), axis=1)[:, 1 : k + 1]
    n = len(high)
    worse = sum(max(0, before[i, j] - k) for i in range(n) for j in after[i])
    return 1 - 2 / (n * k * (2 * n - 3 * k - 1)) * worse


@pytest.fixture(scope="module")
def planted(spark):
    """Ten clusters in 30 dimensions, which two principal components can't keep apart."""
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(10, 30)) * 3
    vectors = middle[np.arange(400) % 10] + rng.normal(size=(400, 30))
    rows = [(f"r{i:03}", [float(x) for x in v], i % 10) for i, v in enumerate(vectors)]
    return vectors, spark.createDataFrame([*rows, ("none", None, -1)], "name string, e array<double>, label int")


def test_neighbourhoods_are_kept_better_than_by_components(planted):
    vectors, df = planted
    found = {r.name: r.reduced for r in manifold.manifold(df, "name", "e", 2, k=10, rounds=12).collect()}
    assert found.pop("none") is None and len(found) == 400
    low = np.array([found[f"r{i:03}"] for i in range(400)])
    flat = {r.name: r.reduced for r in reduced(df, "e", 2).collect() if r.reduced is not None}
    mine, theirs = trustworthiness(vectors, low, 10), trustworthiness(vectors, np.array([flat[f"r{i:03}"] for i in range(400)]), 10)
    assert mine > 0.95 and mine > theirs, (mine, theirs)
    near = np.argsort(((low[:, None] - low[None]) ** 2).sum(axis=2), axis=1)[:, 1:6]
    assert (near % 10 == (np.arange(400) % 10)[:, None]).mean() > 0.9


def test_graph_equals_plain_sums(spark):
    rows = [(0, 1, 0.1), (0, 2, 0.5), (0, 3, 0.9), (1, 0, 0.1), (1, 2, 0.4), (2, 0, 0.5), (2, 1, 0.4), (3, 0, 0.9)]
    w = {}
    for i in range(4):
        own = [(j, d) for a, j, d in rows if a == i]
        low, high, first = 1e-6, 1e3, min(d for _, d in own)
        for _ in range(200):
            s = math.sqrt(low * high)
            low, high = (low, s) if sum(math.exp(-(d - first) / s) for _, d in own) > math.log2(max(len(own), 2)) else (s, high)
        w |= {(i, j): math.exp(-(d - first) / s) for j, d in own}
    got = {(r.id, r.other): r.w for r in manifold.fuzzy_graph(spark.createDataFrame(rows, "id bigint, other bigint, distance double")).collect()}
    want = {(i, j): w.get((i, j), 0) + w.get((j, i), 0) - w.get((i, j), 0) * w.get((j, i), 0) for i, j in {*w, *((j, i) for i, j in w)}}
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-6 for p in want)


def test_few_rows_keep_their_vectors(planted):
    _, df = planted
    out = manifold.manifold(df.orderBy("name").limit(20), "name", "e").collect()
    assert len(out) == 20 and all((r.reduced is None) == (r.e is None) and (r.e is None or r.reduced == r.e) for r in out)
    assert manifold.manifold(df.limit(0), "name", "e").collect() == []
