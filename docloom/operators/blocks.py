"""Parsed pages whose blocks nest to any depth, and parsers that give lines and words."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.arrays import rows_of
from docloom.operators.extraction import BLOCK_TYPES_OF_BODIES, common_type

NODE = "array<struct<page: int, pos: int, level: int, block_type: string, parent_type: string, text: string, html: string, bbox: array<double>, page_width: double, page_height: double>>"


def block_text(block: dict) -> str:
    """The spans of a block's lines, or its own spans, joined by spaces."""
    lines = block.get("lines") or [{"spans": block.get("spans") or []}]
    return " ".join(str(s.get("content") or "") for line in lines for s in line.get("spans") or []).strip()


def walk(pages: list[dict]) -> list[dict]:
    """All blocks of all pages in reading order; pos counts within a page. An explicit stack, so that depth is no matter."""
    out = []
    for n, page in enumerate(pages):
        width, height = (page.get("page_size") or [None, None])[:2]
        stack = [(b, 0, b.get("parent_type")) for b in reversed(page.get("para_blocks") or [])]
        pos = 0
        while stack:
            block, level, parent = stack.pop()
            kind = str(block.get("type") or "")
            box = [float(v) for v in block.get("bbox") or []] or None
            out.append(
                {"page": n + 1, "pos": pos, "level": level, "block_type": kind, "parent_type": parent, "text": block_text(block) or str(block.get("text") or ""), "html": block.get("html") or "", "bbox": box, "page_width": width, "page_height": height}
            )
            pos += 1
            stack += [(b, level + 1, b.get("parent_type") or kind) for b in reversed(block.get("blocks") or [])]
    return out


def nested_blocks(docs: DataFrame, key: str, json_col: str) -> DataFrame:
    """(key, page, pos, level, block_type, feature_type, parent_kind, text, html, bbox ...): a row per block, however deep.

    parent_kind is figure or table for captions, footnotes and bodies. Broken
    JSON gives no rows.
    """

    @F.pandas_udf(NODE)
    def flat(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            out = []
            for text in part:
                try:
                    out.append(walk((json.loads(text) or {}).get("pdf_info") or []))
                except (TypeError, ValueError, AttributeError):
                    out.append([])
            yield pd.Series(out, dtype=object)

    rows = rows_of(docs, [key], flat(F.col(json_col)), "b").select(key, "b.*")
    of = lambda kind: F.startswith("block_type", F.lit(f"{kind}_")) | F.coalesce(F.col("parent_type") == kind, F.lit(False))
    kind = F.when(of("image"), "figure").when(of("table"), "table")
    return rows.withColumns({"feature_type": common_type(F.col("block_type"), BLOCK_TYPES_OF_BODIES), "parent_kind": kind})


def entry_id(key: str, *parts) -> Column:
    """The same id for the same block in every run."""
    return F.sha2(F.concat_ws("|", F.col(key).cast("string"), *[F.col(p).cast("string") for p in parts]), 256)


def block_entries(blocks: DataFrame, key: str, by_title: bool = False) -> DataFrame:
    """Entries of nested blocks: (key, uuid, feature_type, string, page, secondary, figure_number, table_number, relationship, parent_uuid).

    Figures and tables are entries of their own, numbered from 1 through the
    document. Captions and footnotes are entries with an edge to the latest
    figure or table of their kind on the page; without one they are left out.
    Everything else that has text, and the html of tables, joins into one
    combined_text entry for each page, or with by_title for each title on it;
    a nested block's text counts once.
    """
    visual = F.col("feature_type").isin("figure", "table") & ~F.endswith("block_type", F.lit("_body"))
    attached = F.col("feature_type").isin("caption", "footnote") & F.col("parent_kind").isNotNull()
    rows = blocks.withColumns({"uuid": entry_id(key, "page", "pos"), "_visual": visual, "_attached": attached})
    page = Window.partitionBy(key, "page").orderBy("pos")
    count = lambda kind: F.sum((F.col("_visual") & (F.col("feature_type") == kind)).cast("int")).over(Window.partitionBy(key).orderBy("page", "pos"))
    latest = lambda kind: F.last(F.when(F.col("_visual") & (F.col("feature_type") == kind), F.col("uuid")), ignorenulls=True).over(page)
    rows = rows.withColumns(
        {
            "secondary": F.row_number().over(page),
            "figure_number": F.when(F.col("_visual") & (F.col("feature_type") == "figure"), count("figure")),
            "table_number": F.when(F.col("_visual") & (F.col("feature_type") == "table"), count("table")),
            "parent_uuid": F.when(F.col("_attached"), F.when(F.col("parent_kind") == "figure", latest("figure")).otherwise(latest("table"))),
            "_session": F.sum((F.col("feature_type") == "section_header").cast("int")).over(page) if by_title else F.lit(0),
        }
    )
    columns = [key, "uuid", "feature_type", "string", "page", "secondary", "figure_number", "table_number", "relationship", "parent_uuid"]
    edge = F.when(F.col("parent_uuid").isNotNull(), F.concat_ws("_", "parent_kind", "feature_type"))
    alone = rows.where(F.col("_visual") | F.col("parent_uuid").isNotNull())
    alone = alone.withColumns({"string": F.when(F.col("feature_type") == "table", F.col("html")).when(F.col("feature_type") == "figure", F.lit("")).otherwise(F.col("text")), "relationship": edge}).select(*columns)
    text = F.when(F.col("feature_type") == "table", F.col("html")).otherwise(F.col("text"))
    joined = rows.where(~F.col("_attached")).withColumn("_text", text).where(F.col("_text") != "").groupBy(key, "page", "_session").agg(F.array_sort(F.collect_list(F.struct("pos", "_text"))).alias("_t"))
    none = lambda kind: F.lit(None).cast(kind)
    combined = joined.withColumns(
        {
            "uuid": F.sha2(F.concat_ws("|", F.col(key).cast("string"), F.lit("text"), "page", "_session"), 256), "feature_type": F.lit("combined_text"), "string": F.array_join(F.col("_t._text"), " "),
            "secondary": none("int"), "figure_number": none("bigint"), "table_number": none("bigint"), "relationship": none("string"), "parent_uuid": none("string"),
        }
    ).select(*columns)
    return alone.unionByName(combined)


RECOGNIZED = "STRUCT<Blocks: ARRAY<STRUCT<BlockType: STRING, Text: STRING, Page: INT, Geometry: STRUCT<BoundingBox: STRUCT<Left: DOUBLE, Top: DOUBLE, Width: DOUBLE, Height: DOUBLE>>>>>"


def recognized_elements(docs: DataFrame, key: str, json_col: str) -> DataFrame:
    """(key, page, secondary, feature_type, string, left, top, width, height) from a text recognition answer.

    Lines, words and LAYOUT_ blocks are numbered from 1 on their page, layout
    blocks without text take their type as text; secondary 0 is the page's
    combined_text, its lines joined by spaces.
    """
    rows = rows_of(docs, [key], F.from_json(json_col, RECOGNIZED)["Blocks"], "_n", "b")
    kind = F.lower("b.BlockType")
    rows = rows.select(key, "_n", F.coalesce("b.Page", F.lit(1)).alias("page"), kind.alias("kind"), "b.Text", F.col("b.Geometry.BoundingBox").alias("box")).where(kind.isin("line", "word") | F.startswith(kind, F.lit("layout_")))
    layout = F.regexp_replace("kind", "^layout_", "")
    place = F.row_number().over(Window.partitionBy(key, "page").orderBy("_n"))
    elements = rows.select(key, "page", place.alias("secondary"), layout.alias("feature_type"), F.when(F.startswith("kind", F.lit("layout_")), F.coalesce("Text", F.upper(layout))).otherwise(F.coalesce("Text", F.lit(""))).alias("string"), F.col("box.Left").alias("left"), F.col("box.Top").alias("top"), F.col("box.Width").alias("width"), F.col("box.Height").alias("height"))
    lines = rows.groupBy(key, "page").agg(F.array_sort(F.collect_list(F.when(F.col("kind") == "line", F.struct("_n", F.coalesce("Text", F.lit("")).alias("t"))))).alias("_t"))
    zero = lambda name: F.lit(0.0).alias(name)
    return elements.unionByName(lines.select(key, "page", F.lit(0).alias("secondary"), F.lit("combined_text").alias("feature_type"), F.array_join(F.col("_t.t"), " ").alias("string"), zero("left"), zero("top"), zero("width"), zero("height")))
