"""Boxes in page pixels, from the top left corner."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(left: Column, top: Column, width: Column, height: Column, page_width: Column, page_height: Column) -> Column:
    return F.struct(left.alias("left"), top.alias("top"), width.alias("width"), height.alias("height"), page_width.alias("page_width"), page_height.alias("page_height"))


def from_polygon(points: Column, page_width: Column, page_height: Column) -> Column:
    """The rectangle around an array of [x, y]."""
    xs, ys = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    return box(F.array_min(xs), F.array_min(ys), F.array_max(xs) - F.array_min(xs), F.array_max(ys) - F.array_min(ys), page_width, page_height)


def from_edges(edges: Column, page_width: Column, page_height: Column) -> Column:
    """From [left, top, right, bottom]."""
    return box(edges[0], edges[1], edges[2] - edges[0], edges[3] - edges[1], page_width, page_height)


def relative(b: Column) -> Column:
    """In parts of the page; null for a page without size."""
    w, h = F.nullif(b["page_width"], F.lit(0.0)), F.nullif(b["page_height"], F.lit(0.0))
    return F.struct((b["left"] / w).alias("left"), (b["top"] / h).alias("top"), (b["width"] / w).alias("width"), (b["height"] / h).alias("height"))


def clamped(edges: Column, page_width: Column, page_height: Column) -> Column:
    """[left, top, right, bottom] in pixels inside the page. Values of at most 1 are parts of the page. Null if nothing is left."""
    scale = F.exists(edges, lambda c: c > 1)
    size = lambda i: page_width if i % 2 == 0 else page_height
    at = [F.greatest(F.lit(0.0), F.least(size(i), F.when(scale, edges[i]).otherwise(edges[i] * size(i)))) for i in range(4)]
    return F.when((at[0] < at[2]) & (at[1] < at[3]), F.array(*at))


def union_of(column: str) -> Column:
    """Aggregate: the rectangle around all boxes, with the largest page size."""
    left, top = F.min(f"{column}.left"), F.min(f"{column}.top")
    right, bottom = F.max(F.col(f"{column}.left") + F.col(f"{column}.width")), F.max(F.col(f"{column}.top") + F.col(f"{column}.height"))
    return box(left, top, right - left, bottom - top, F.max(f"{column}.page_width"), F.max(f"{column}.page_height"))
