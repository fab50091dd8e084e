"""Vectors as arrays; every product is taken in double precision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """0 if either has no length."""
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, dot(a, b) / size).otherwise(F.lit(0.0))


def fused(a: Column, b: Column, c: Column) -> Column:
    """a * b + c, rounded once: the product's own rounding error is found by splitting its factors in halves (Dekker 1971) and added back. For values below 1e290."""
    high = lambda x: x * 134217729.0 - (x * 134217729.0 - x)
    product, ah, bh = a * b, high(a), high(b)
    lost = ((ah * bh - product) + ah * (b - bh) + (a - ah) * bh) + (a - ah) * (b - bh)
    total = product + c
    off = (product - (total - (total - product))) + (c - (total - product))
    return total + (off + lost)


def mean_pool(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """The mean vector of each group, as rows (keys, pos, mean): sums are combined before the shuffle, no vector is gathered."""
    parts = df.select(*keys, F.posexplode(vector).alias("pos", "x"))
    return parts.groupBy(*keys, "pos").agg(F.avg(F.col("x").cast("double")).alias("mean"))
