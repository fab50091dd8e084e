"""Documents to entries: pages, blocks and passages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.arrays import folded, rows_of

# Block types of layout parsers in common terms (anything else: other), and the types that stand alone.
BLOCK_TYPES = {
    "text": "text", "word": "word", "line": "line", "image": "image", "table": "table", "tablegroup": "tablegroup", "figure": "figure", "figuregroup": "figuregroup",
    "code": "code", "equation": "equation", "form": "form", "pageheader": "header", "pagefooter": "footer", "sectionheader": "section_header", "listitem": "list",
    "listgroup": "listgroup", "pagenumber": "page_number", "span": "span", "picturegroup": "picturegroup", "picture": "picture", "page": "page", "caption": "caption",
    "footnote": "footnote", "handwriting": "handwriting", "textinlinemath": "textinlinemath", "tableofcontents": "tableofcontents", "document": "document", "complexregion": "complexregion",
}
BLOCK_TYPES_OF_BODIES = {
    "image": "figure", "image_body": "figure", "image_caption": "caption", "image_footnote": "footnote", "table": "table", "table_body": "table", "table_caption": "caption",
    "table_footnote": "footnote", "text": "text", "title": "section_header", "interline_equation": "equation", "footnote": "footnote", "discarded": "other", "list": "list", "index": "other",
}
VISUALS = ("figure", "figuregroup", "table", "tablegroup", "picture", "picturegroup", "image", "complexregion")

#: A page of a parsed document: blocks, and blocks of groups inside them.
BLOCK = "block_type STRING, html STRING, polygon ARRAY<ARRAY<DOUBLE>>"
PAGES = f"STRUCT<children: ARRAY<STRUCT<block_type: STRING, polygon: ARRAY<ARRAY<DOUBLE>>, children: ARRAY<STRUCT<{BLOCK}, children: ARRAY<STRUCT<{BLOCK}>>>>>>>"


def common_type(block_type: Column, table: dict[str, str] = BLOCK_TYPES) -> Column:
    known = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(known, F.lower(block_type)), F.lit("other"))


def plain(html: Column) -> Column:
    """Text of an HTML fragment: no tags, the five basic references decoded, single spaces."""
    text = F.regexp_replace(html, "<[^>]*>", " ")
    for code, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(code), F.lit(char))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def parsed_blocks(docs: DataFrame, key: str, json: str) -> DataFrame:
    """(key, page, pos, sub, block_type, feature_type, text, polygon): blocks of a layout parser's JSON, list groups flattened; broken JSON gives no rows."""
    pages = rows_of(docs, [key], F.from_json(json, PAGES)["children"], "_p", "page_block")
    blocks = pages.select(key, (F.col("_p") + 1).alias("page"), F.posexplode("page_block.children").alias("pos", "b"))
    nested = F.array(F.struct(F.col("b.block_type").alias("block_type"), F.col("b.html").alias("html"), F.col("b.polygon").alias("polygon")))
    inner = F.when(F.size("b.children") > 0, F.col("b.children")).otherwise(nested)
    rows = blocks.select(key, "page", "pos", F.posexplode(inner).alias("sub", "x"))
    return rows.select(key, "page", "pos", "sub", F.col("x.block_type").alias("block_type"), common_type(F.col("x.block_type")).alias("feature_type"), plain(F.coalesce("x.html", F.lit(""))).alias("text"), F.col("x.polygon").alias("polygon"))


def entries_by_page(blocks: DataFrame, key: str) -> DataFrame:
    """Visual blocks as entries of their own; the other texts of a page joined by spaces as one combined_text entry."""
    visual = F.col("feature_type").isin(*VISUALS)
    alone = blocks.where(visual).select(key, "page", F.col("pos").cast("int").alias("pos"), "feature_type", "text")
    texts = blocks.where(~visual & (F.col("text") != "")).groupBy(key, "page").agg(F.array_sort(F.collect_list(F.struct("pos", "sub", "text"))).alias("_t"))
    combined = texts.select(key, "page", F.lit(-1).alias("pos"), F.lit("combined_text").alias("feature_type"), F.array_join(F.col("_t.text"), " ").alias("text"))
    return combined.unionByName(alone)


def entries_by_title(blocks: DataFrame, key: str, across_pages: bool = True) -> DataFrame:
    """(key, session, title, min_page, max_page, text): a new entry at each section header, which is its title; sessions may cross pages."""
    part = [key] if across_pages else [key, "page"]
    w = Window.partitionBy(*part).orderBy("page", "pos", "sub")
    header = F.col("feature_type") == "section_header"
    rows = blocks.where(~F.col("feature_type").isin(*VISUALS)).withColumn("session", F.sum(header.cast("int")).over(w))
    own = rows.groupBy(*part, "session").agg(
        F.min("page").alias("min_page"), F.max("page").alias("max_page"), F.array_sort(F.collect_list(F.struct("page", "pos", "sub", "text"))).alias("_t"), F.max(F.when(header, F.col("text"))).alias("title")
    )
    return own.select(key, "session", "title", "min_page", "max_page", F.array_join(F.filter(F.col("_t.text"), lambda t: t != ""), " ").alias("text"))


def numbered(blocks: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Adds figure_number, table_number and secondary (place on the page), each from 1."""
    doc, page = Window.partitionBy(key).orderBy(*order), Window.partitionBy(key, "page").orderBy(*order)
    count = lambda kind: F.when(F.col("feature_type") == kind, F.sum((F.col("feature_type") == kind).cast("int")).over(doc))
    return blocks.withColumns({"figure_number": count("figure"), "table_number": count("table"), "secondary": F.row_number().over(page)})


def linked_to_parent(blocks: DataFrame, key: str, order: list[str], is_parent: Column, is_caption: Column, parent_id: str) -> DataFrame:
    """Adds parent: for captions the id of the latest parent before them; null without one."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return blocks.withColumn("parent", F.when(is_caption, F.last(F.when(is_parent, F.col(parent_id)), ignorenulls=True).over(w)))


def split_pages(docs: DataFrame, key: str, text: str, mark: str = r"\f|\n\s*\n") -> DataFrame:
    """(key, page from 1, text): plain text cut at form feeds or blank lines; blank pages keep their number but give no row."""
    rows = rows_of(docs, [key], F.split(text, mark), "_p", "page_text")
    return rows.where(F.trim("page_text") != "").select(key, (F.col("_p") + 1).alias("page"), F.trim("page_text").alias("text"))


def html_passages(pages: DataFrame, key: str, html: str, most_words: int = 220) -> DataFrame:
    """(key, passage from 1, n_words, text): blocks of a page packed greedily into passages of at most most_words words (a longer block stands alone)."""
    body = F.regexp_replace(F.col(html), r"(?is)<(script|style|noscript|head)\b.*?</\1>|<!--.*?-->", "")
    blocks = F.split(body, r"(?i)</?(?:p|div|li|ul|ol|h[1-6]|article|section|nav|footer|header|aside|table|tr|td|th|br)\b[^>]*>")
    clean = F.filter(F.transform(blocks, plain), lambda b: b != "")
    sized = F.transform(clean, lambda b: F.struct(b.alias("text"), F.size(F.split(b, " ")).alias("n")))
    end = F.array(F.struct(F.lit(None).cast("string").alias("text"), F.lit(0).alias("n")))

    def step(now, b):
        full = (now["text"] != "") & (b["text"].isNull() | (now["n"] + b["n"] > most_words))
        text = F.when(full | (now["text"] == ""), F.coalesce(b["text"], F.lit(""))).otherwise(F.concat_ws(" ", now["text"], b["text"]))
        return F.struct(F.when(full, b["n"]).otherwise(now["n"] + b["n"]).alias("n"), text.alias("text")), F.when(full, now["text"])

    packed = folded(F.concat(sized, end), F.struct(F.lit(0).alias("n"), F.lit("").alias("text")), step, "string")
    rows = rows_of(pages, [key], packed, "_n", "text")
    return rows.select(key, (F.col("_n") + 1).alias("passage"), F.size(F.split("text", " ")).alias("n_words"), "text")


def tei_header(docs: DataFrame, key: str, xml: str) -> DataFrame:
    """Title, authors, date and abstract of TEI documents."""
    part = lambda path: F.expr(f"xpath_string({xml}, '{path}')")
    local = lambda *names: "".join(f'//*[local-name()="{n}"]' if i == 0 else f'/*[local-name()="{n}"]' for i, n in enumerate(names))
    return docs.select(
        key, part(local("titleStmt", "title")).alias("title"), F.expr(f"""array_join(xpath({xml}, '//*[local-name()="author"]//*[local-name()="surname"]/text()'), ', ')""").alias("authors"),
        F.expr(f"""xpath_string({xml}, '//*[local-name()="publicationStmt"]/*[local-name()="date"]/@when')""").alias("date"), part(local("abstract")).alias("abstract"),
    )


def on_pages(entries: DataFrame, key: str, uuid: str, locations: str = "chunk_locations") -> DataFrame:
    """(key, page from 0, uuids): the entries that have a location on each page, in order; an entry counts once on a page."""
    rows = entries.select(key, uuid, F.explode(locations).alias("_l")).select(key, (F.col("_l.index.primary") - 1).alias("page"), uuid).distinct()
    return rows.groupBy(key, "page").agg(F.array_sort(F.collect_list(uuid)).alias("uuids"))


def group_elements(docs: DataFrame, key: str, json: str) -> DataFrame:
    """(key, page, pos, sub, kind, number, string, target_sub): what figure, picture and table groups of a layout parser's JSON hold.

    Figures (and pictures) and tables are numbered from 1 through the document
    and, where they have text, bring a caption of it. A caption has target_sub, the place in the
    group of the figure or table it belongs to: the latest before it, or the first one after it.
    """
    pages = rows_of(docs, [key], F.from_json(json, PAGES)["children"], "_p", "_page")
    groups = rows_of(pages, [key, (F.col("_p") + 1).alias("page")], F.col("_page.children"), "pos", "b")
    groups = groups.where(common_type(F.col("b.block_type")).isin("figuregroup", "picturegroup", "tablegroup"))
    rows = rows_of(groups, [key, "page", "pos"], F.col("b.children"), "sub", "x")
    kind = common_type(F.col("x.block_type"))
    kind = F.when(kind.isin("figure", "picture"), "figure").when(kind == "table", "table").when(kind == "caption", "caption")
    rows = rows.select(key, "page", "pos", "sub", kind.alias("kind"), plain(F.coalesce("x.html", F.lit(""))).alias("text")).where("kind is not null")
    doc = Window.partitionBy(key).orderBy("page", "pos", "sub")
    group = Window.partitionBy(key, "page", "pos").orderBy("sub")
    seat = F.when(F.col("kind") != "caption", F.col("sub"))
    before = F.last(seat, ignorenulls=True).over(group.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(seat, ignorenulls=True).over(group.rowsBetween(0, Window.unboundedFollowing))
    count = lambda k: F.when(F.col("kind") == k, F.sum((F.col("kind") == k).cast("int")).over(doc))
    rows = rows.withColumns({"number": F.coalesce(count("figure"), count("table")), "target_sub": F.when(F.col("kind") == "caption", F.coalesce(before, after))})
    own = rows.withColumn("string", F.when(F.col("kind") == "figure", F.lit("")).otherwise(F.col("text"))).drop("text")
    said = rows.where("kind = 'figure' and text <> ''").withColumns({"kind": F.lit("caption"), "number": F.lit(None).cast("bigint"), "string": F.col("text"), "target_sub": F.col("sub")}).drop("text")
    columns = [key, "page", "pos", "sub", "kind", "number", "string", "target_sub"]
    return own.select(*columns).unionByName(said.select(*columns))
