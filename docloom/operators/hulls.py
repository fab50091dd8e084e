"""Volume of the convex hull of a group's vectors: hulls of parts first, then the hull of their corners."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_simplex(points: np.ndarray) -> list[int] | None:
    """Places of d + 1 points that lie in no hyperplane, each as far from those before as possible; None if there are none."""
    chosen, rest = [int(np.argmin(points[:, 0]))], points - points[np.argmin(points[:, 0])]
    scale = max(float(np.abs(rest).max()), 1e-300)
    for _ in range(points.shape[1]):
        far = int((rest**2).sum(axis=1).argmax())
        size = float(np.linalg.norm(rest[far]))
        if size <= 1e-9 * scale:
            return None
        chosen.append(far)
        rest = rest - np.outer(rest @ rest[far] / size**2, rest[far])
    return chosen


def plane(points: np.ndarray, corners: tuple[int, ...], inside: np.ndarray) -> tuple[np.ndarray, float]:
    """Normal and offset of the hyperplane through the corners, the inner point on its negative side."""
    base = points[corners[0]]
    normal = np.linalg.svd(points[list(corners[1:])] - base)[2][-1] if len(corners) > 1 else np.ones(1)
    normal = normal if normal @ (inside - base) < 0 else -normal
    return normal, float(normal @ base)


def hull(points: np.ndarray) -> list[tuple[int, ...]] | None:
    """The facets of the convex hull, each as places of d points, by adding the point farthest outside until none is; None for points in one hyperplane."""
    begun = first_simplex(points) if len(points) > points.shape[1] else None
    if begun is None:
        return None
    inside, slack = points[begun].mean(axis=0), 1e-10 * float(np.abs(points - points.mean(axis=0)).max())
    facets = list(combinations(begun, points.shape[1]))
    planes = [plane(points, f, inside) for f in facets]
    left = np.setdiff1d(np.arange(len(points)), begun)
    while len(left):
        normals, offsets = np.array([n for n, _ in planes]), np.array([o for _, o in planes])
        above = points[left] @ normals.T - offsets
        out = above.max(axis=1) > slack
        left, above = left[out], above[out]
        if not len(left):
            break
        at = int(above.max(axis=1).argmax())
        new, seen = int(left[at]), above[at] > slack
        ridges: dict[frozenset[int], int] = {}
        for f, s in zip(facets, seen, strict=True):
            if s:
                for r in combinations(f, len(f) - 1):
                    ridges[frozenset(r)] = ridges.get(frozenset(r), 0) + 1
        added = [(*sorted(r), new) for r, n in ridges.items() if n == 1]
        facets = [f for f, s in zip(facets, seen, strict=True) if not s] + added
        planes = [p for p, s in zip(planes, seen, strict=True) if not s] + [plane(points, f, inside) for f in added]
        left = np.delete(left, at)
    return facets


def volume(points: np.ndarray) -> float:
    """0 for points in one hyperplane."""
    points = np.unique(points, axis=0)
    facets = hull(points)
    if facets is None:
        return 0.0
    middle = points.mean(axis=0)
    return float(np.abs(np.linalg.det(points[np.array(facets)] - middle)).sum()) / math.factorial(points.shape[1])


def corners(points: np.ndarray) -> np.ndarray:
    """The points that the hull needs; all (each once) if they lie in one hyperplane."""
    points = np.unique(points, axis=0)
    facets = hull(points)
    return points if facets is None else points[sorted({c for f in facets for c in f})]


def hull_volumes(df: DataFrame, keys: list[str], vector: str, part_rows: int = 2_000) -> DataFrame:
    """(keys, n, volume): how many vectors a group has and the volume of their convex hull.

    Groups of at most d vectors, or whose vectors lie in one hyperplane, have
    volume 0; null vectors are left out. Rows are dealt to parts of about
    part_rows, counted before, so a large group is spread over tasks; of each
    part only the corners of its hull go on. The number of facets grows quickly
    with d: this is for a few dimensions, as after a projection. What has to fit
    a task are the corners of a group's parts.
    """
    rows = df.where(F.col(vector).isNotNull()).select(*keys, F.col(vector).cast("array<double>").alias("_v"))
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    counted = sizes.select(*[F.col(k).alias(f"_{k}") for k in keys], F.ceil(F.col("n") / part_rows).alias("_parts"))
    dealt = rows.join(counted, same).select(*keys, F.pmod(F.xxhash64("_v"), F.col("_parts")).alias("_part"), "_v")
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def of_part(own: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        found = corners(np.stack(frame["_v"].to_numpy()))
        return pd.DataFrame([(*own[: len(keys)], v) for v in found.tolist()], columns=[*keys, "_v"])

    def of_group(own: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(*own, volume(np.stack(frame["_v"].to_numpy())))], columns=[*keys, "volume"])

    few = dealt.groupBy(*keys, "_part").applyInPandas(of_part, f"{kinds}, _v array<double>")
    volumes = few.groupBy(*keys).applyInPandas(of_group, f"{kinds}, volume double").select(*[F.col(k).alias(f"_{k}") for k in keys], "volume")
    return sizes.join(volumes, same).select(*keys, "n", "volume")
