"""Sums of distances by products of matrices."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.operators.evaluation import mean_pairwise_distance, total_distance


def plain(a, b):
    return np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2))


def test_totals():
    draw = np.random.default_rng(1)
    a, b = draw.normal(size=(70, 8)), draw.normal(size=(40, 8))
    a[10:20] = a[0] + 1e-9 * draw.normal(size=(10, 8))  # near copies far from the origin
    a[:20] += 1000.0
    b[:5] = a[:5]
    assert total_distance(a, b, 16) == pytest.approx(plain(a, b).sum(), rel=1e-11)
    assert total_distance(a, strip=16) == pytest.approx(plain(a, a).sum() / 2, rel=1e-11)
    assert total_distance(a[10:20]) == pytest.approx(plain(a[10:20], a[10:20]).sum() / 2, rel=1e-9) and total_distance(a[:1]) == 0.0


def test_mean_over_blocks(spark):
    df = spark.range(2000).select(F.lit(1).alias("k"), F.array(*[F.rand(i) for i in range(4)]).alias("v")).localCheckpoint()
    own = np.array([r.v for r in df.collect()])
    found = mean_pairwise_distance(df, "k", "v", 10)
    assert found.first().mean_distance == pytest.approx(plain(own, own).sum() / 2000 / 1999, rel=1e-9)
