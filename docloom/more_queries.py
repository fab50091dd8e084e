"""Further registered queries of the library, as in queries.py."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.operators import blocks, chunking, crawl, evaluation, extraction, features, filters, hulls, lineage, manifold, merge, retrieval, sentences
from docloom.queries import BM25, COS, SPANS, WHOLE, query, r6, t, windows
from docloom.sources import files
from docloom.sources.deltas import DeltaTable
from docloom.sources.workspace import scratch

# ---- sources


@query("""SELECT page_id, (['pdf','txt','html','md','json','xml','csv','tsv','sql','yaml','toml','mp4','mp3','wav','jpeg','png','gif','svg','webm','docx','pptx','xlsx','odt','ods','odp','pdf','pdf'])[page_id % 27 + 1] AS file_type FROM pages""")
def mime_types(spark, d):
    """All 25 known types, one that is not, and none."""
    names = [
        "application/pdf", "text/plain", "text/html", "text/markdown", "application/json", "application/xml", "text/csv", "text/tab-separated-values", "application/sql", "application/x-yaml", "application/toml",
        "video/mp4", "audio/mpeg", "audio/wav", "image/jpeg", "image/png", "image/gif", "image/svg+xml", "video/webm", "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
        "application/vnd.openxmlformats-officedocument.presentationml.presentation", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", "application/vnd.oasis.opendocument.text",
        "application/vnd.oasis.opendocument.spreadsheet", "application/vnd.oasis.opendocument.presentation", "x/y", None,
    ]
    mime = F.get(F.array(*[F.lit(n).cast("string") for n in names]), (F.col("page_id") % 27).cast("int"))
    return t(spark, d, "pages").select("page_id", files.mime_file_type(mime).alias("file_type"))


@query("SELECT vec_id, label, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 6) AS total FROM embeddings WHERE vec_id IN (SELECT doc_id * 3 FROM labels)")
def vectors_by_id(spark, d):
    found = files.vectors_by_id(t(spark, d, "embeddings"), t(spark, d, "labels").select((F.col("doc_id") * 3).alias("vec_id")), "vec_id")
    return found.select("vec_id", "label", r6(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double"))).alias("total"))


@query("SELECT doc_id, k = 0 AS simple, k < 3 AS ocr, true AS layout FROM (SELECT doc_id, doc_id % 5 AS k FROM documents)")
def file_type_gate(spark, d):
    kind = F.get(F.array(*[F.lit(x) for x in ("pdf", "png", "jpg", "txt")]), (F.col("doc_id") % 5).cast("int"))
    return t(spark, d, "documents").select("doc_id", *[files.takes_file(x, kind).alias(x) for x in ("simple", "ocr", "layout")])


@query("SELECT o_orderkey, c.c_name, c.c_nationkey FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 5 <> 0) c ON c.c_custkey = o.o_custkey WHERE o_orderkey % 3 = 1")
def entries_eager_load(spark, d):
    entries = t(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("document_hash"), (F.col("o_orderkey") % 3).alias("pipeline_id"))
    documents = t(spark, d, "customer").where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("document_hash"), "c_name", "c_nationkey")
    return files.entries_with_documents(entries, documents, 1).select("o_orderkey", "document.c_name", "document.c_nationkey")


NAV = """SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<a href="([^"]*)"', 1) AS hrefs, regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<a href="[^"]*">(.*?)</a>', 1) AS texts,
 regexp_extract_all(html, '(?s)<p>', 0) AS ps FROM pages"""


@query(f"""SELECT page_id, len(hrefs)::BIGINT AS n_links, array_to_string(hrefs, '|') AS hrefs, array_to_string(list_transform(texts, lambda x: replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&')), '|') AS texts,
len(ps)::BIGINT AS n_paragraphs FROM ({NAV})""")
def selector_extracts(spark, d):
    """Menu links with text and target, and the paragraphs of the article inside its element."""
    configs = {"links": {"selector": "nav ul a[href]", "attributes": ["href"], "extract": "text"}, "bodies": {"selector": "article", "nested": {"ps": {"selector": "p", "multiple": True, "extract": "text"}}}}
    rows = crawl.with_extracts(t(spark, d, "pages").select("page_id", "html"), configs)
    shape = "extracted_data STRUCT<bodies: ARRAY<STRUCT<ps: ARRAY<STRUCT<text: STRING>>>>>, links_count BIGINT, links_href_list ARRAY<STRING>, links_text_list ARRAY<STRING>"
    rows = rows.select("page_id", F.from_json("extracted", shape).alias("x"))
    n = F.aggregate("x.extracted_data.bodies", F.lit(0).cast("bigint"), lambda s, b: s + F.size(b["ps"]))
    return rows.select("page_id", F.col("x.links_count").alias("n_links"), F.array_join("x.links_href_list", "|").alias("hrefs"), F.array_join("x.links_text_list", "|").alias("texts"), n.alias("n_paragraphs"))


@query("SELECT vec_id, (row_number() OVER (ORDER BY CASE WHEN vec_id % 3 > 0 THEN vec_id % 3 END NULLS FIRST, CASE WHEN vec_id % 5 > 0 THEN vec_id % 5 END NULLS FIRST, vec_id))::INT AS place FROM embeddings")
def index_order(spark, d):
    """Places by an index struct whose parts may be missing; all rows are one list here."""
    part = lambda k: F.when(F.col("vec_id") % k > 0, F.col("vec_id") % k)
    rows = t(spark, d, "embeddings").select("vec_id", F.struct(part(3).alias("primary"), part(5).alias("secondary"), F.col("vec_id").alias("tertiary")).alias("index"))
    return merge.with_new_ids(rows.select("vec_id", "index.*"), ["primary", "secondary", "tertiary"], 0, "place").select("vec_id", F.col("place").cast("int").alias("place"))


# ---- chunking


@query(f"""WITH whole AS (SELECT conv_id, string_agg(text, '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id),
spans AS (SELECT conv_id, turn, role, (sum(length(text)) OVER w - length(text))::BIGINT AS s, (sum(length(text)) OVER w)::BIGINT AS e FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)), {windows('conv_id', 'whole', 60, 10)},
j AS (SELECT c.conv_id, chunk_index, s.turn, s.role FROM chunks c JOIN spans s ON c.conv_id = s.conv_id AND c.chunk_start < s.e AND c.chunk_end > s.s),
f AS (SELECT conv_id, chunk_index, role, arg_max(turn, turn) AS last FROM j GROUP BY 1, 2, 3)
SELECT j.conv_id, j.chunk_index, string_agg(DISTINCT (turn // 2)::VARCHAR || '.' || (turn % 2)::VARCHAR, ',' ORDER BY (turn // 2)::VARCHAR || '.' || (turn % 2)::VARCHAR) AS locations, any_value(x.added) AS added
FROM j JOIN (SELECT conv_id, chunk_index, string_agg(role || '=' || last, ',' ORDER BY role) AS added FROM f GROUP BY 1, 2) x USING (conv_id, chunk_index) GROUP BY 1, 2""")
def chunk_locations(spark, d):
    """Locations of a chunk in order, each once, and its entries' maps merged, the last entry winning."""
    turns = t(spark, d, "conversations")
    whole, spans = chunking.joined_entries(turns, ["conv_id"], "turn", "text")
    none = F.array().cast("array<string>")
    place = F.array(F.struct(F.expr("turn div 2").alias("primary"), (F.col("turn") % 2).alias("secondary")))
    own = turns.select("conv_id", "turn", F.lit(1).alias("page"), none.alias("keywords"), none.alias("citations"), F.col("role").alias("entry_title"), F.concat(place, place).alias("chunk_locations"), F.create_map("role", F.col("turn").cast("string")).alias("added_featurization"))
    made = chunking.build_chunks(chunking.sliding_words(whole, ["conv_id"], "text", 60, 10), spans.join(own, ["conv_id", "turn"]), ["conv_id"], "turn", "sliding_window")
    added = F.array_join(F.transform(F.array_sort(F.map_entries("added_featurization")), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return made.select("conv_id", "chunk_index", F.array_join(F.transform("chunk_locations", lambda x: F.concat_ws(".", x["primary"], x["secondary"])), ",").alias("locations"), added.alias("added"))


def _told(df):
    """A stand-in for an embedder that SQL can follow: three numbers of a unit's length."""
    n = F.length("unit")
    return df.withColumn("embedding", F.array((n % 7).cast("double"), (n % 3).cast("double"), F.lit(1.0)))


UNITS = r"""u AS (SELECT conv_id, turn, unnest(l) AS unit, unnest(range(len(l))) AS i FROM (SELECT conv_id, turn, list_filter(string_split(regexp_replace(text, '([.!?])\s+', concat('\1', chr(1)), 'g'), chr(1)), lambda s: s <> '') AS l FROM conversations)),
v AS (SELECT *, [(length(unit) % 7)::DOUBLE, (length(unit) % 3)::DOUBLE, 1.0e0] AS a FROM u), n AS (SELECT *, lead(a) OVER w AS b FROM v WINDOW w AS (PARTITION BY conv_id ORDER BY turn, i)),
far AS (SELECT *, coalesce(1 - {cos}, 0) AS far FROM n), """.replace("{cos}", COS.format(a="a", b="b"))
DISTANCE = UNITS + """bd AS (SELECT conv_id, quantile_cont(far, 0.8) AS bound FROM far WHERE b IS NOT NULL GROUP BY 1),
c AS (SELECT far.*, coalesce((lag(far) OVER w > bound)::INT, 0) AS cut FROM far LEFT JOIN bd USING (conv_id) WINDOW w AS (PARTITION BY conv_id ORDER BY turn, i)),
g AS (SELECT *, sum(cut) OVER (PARTITION BY conv_id ORDER BY turn, i) + 1 AS chunk_index FROM c)"""


@query(f"WITH {DISTANCE} SELECT conv_id, chunk_index::BIGINT AS chunk_index, string_agg(unit, ' ' ORDER BY turn, i) AS chunk_text, min(turn) AS first_entry, max(turn) AS last_entry, count(*) AS n_units FROM g GROUP BY 1, 2")
def distance_chunks(spark, d):
    return chunking.distance_chunks(t(spark, d, "conversations"), ["conv_id"], "turn", "text", _told, percent=80.0)


@query(f"WITH {UNITS} c AS (SELECT *, coalesce((lag(far) OVER (PARTITION BY conv_id ORDER BY turn, i) > 0.1e0)::INT, 0) AS cut FROM far), g AS (SELECT *, sum(cut) OVER (PARTITION BY conv_id ORDER BY turn, i) + 1 AS chunk_index FROM c) SELECT conv_id, chunk_index::BIGINT AS chunk_index, sha256(string_agg(unit, chr(10) ORDER BY turn, i)) AS chunk_hash, (min(turn) + 1)::INT AS first_page, (max(turn) + 1)::INT AS last_page FROM g GROUP BY 1, 2")
def distance_chunks_of_pages(spark, d):
    pages = t(spark, d, "conversations").groupBy("conv_id").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct((F.col("turn") + 1).cast("string"), F.col("text"))))).alias("pages"))
    out = chunking.distance_chunks_of_pages(pages, ["conv_id"], "pages", _told, threshold=0.1)
    return out.select("conv_id", "chunk_index", F.sha2("chunk_text", 256).alias("chunk_hash"), F.col("first_entry").alias("first_page"), F.col("last_entry").alias("last_page"))


CROPS = r"""w AS (SELECT conv_id, turn, list_transform(regexp_extract_all(text, '\S+'), lambda x: length(x)) AS k FROM conversations), s AS (SELECT *, CASE WHEN len(k) <= 16 THEN [0] ELSE range(0, greatest(len(k) - 5, 0) + 1, 12) END AS st FROM w),
c AS (SELECT conv_id, turn, unnest(range(len(st))) AS i, k, unnest(st) AS at_ FROM s)"""


@query(f"WITH {CROPS} SELECT conv_id, turn, i::INT AS crop, array_to_string(CASE WHEN len(k) <= 16 THEN k ELSE k[at_ + 1:at_ + 16] || list_transform(range(16 - len(k[at_ + 1:at_ + 16])), lambda x: 0) END, ',') AS tokens FROM c")
def token_crops(spark, d):
    tokens = F.transform(tx.words(F.col("text")), lambda w: F.length(w))
    rows = t(spark, d, "conversations").select("conv_id", "turn", F.posexplode(chunking.token_crops(tokens, 16, 4)).alias("crop", "t"))
    return rows.select("conv_id", "turn", "crop", F.array_join(F.col("t").cast("array<string>"), ",").alias("tokens"))


@query(f"WITH {CROPS}, e AS (SELECT conv_id, turn, CASE WHEN len(k) <= 16 THEN k ELSE k[at_ + 1:at_ + 16] || list_transform(range(16 - len(k[at_ + 1:at_ + 16])), lambda x: 0) END AS q FROM c) SELECT conv_id * 100 + turn AS query_id, round(avg(coalesce(list_sum(q), 0)::DOUBLE), 6) AS total, round(avg(len(q)::DOUBLE), 6) AS size FROM e GROUP BY 1")
def query_vectors(spark, d):
    """Queries as crops of tokens, embedded (here by the crop's sum and size) and averaged."""
    embed = lambda df: df.withColumn("embedding", F.array(F.aggregate("tokens", F.lit(0.0), lambda s, x: s + x), F.size("tokens").cast("double")))
    tokenize = lambda c: F.transform(tx.words(c), lambda w: F.length(w))
    rows = t(spark, d, "conversations").select((F.col("conv_id") * 100 + F.col("turn")).alias("q"), "text")
    out = retrieval.query_vectors(rows, "q", "text", tokenize, embed, 16, 4)
    return out.select("query_id", r6(F.get("embedding", F.lit(0))).alias("total"), r6(F.get("embedding", F.lit(1))).alias("size"))


# ---- extraction


def _nested(spark, d):
    """Conversations as pages of nested blocks: user turns as titles, system turns as images with body and caption, assistant turns as lists that hold a text block."""
    span = lambda text: F.concat(F.lit('{"lines":[{"spans":[{"content":'), F.to_json(F.struct(text.alias("x"))).substr(F.lit(6), F.length(F.to_json(F.struct(text.alias("x")))) - 6), F.lit("}]}],"))
    text = span(F.col("text"))
    image = F.concat(F.lit('{"type":"image","bbox":[0,0,10,20],"blocks":[{"type":"image_body","bbox":[0,0,10,10]},'), text, F.lit('"type":"image_caption"}]}'))
    block = F.when(F.col("role") == "user", F.concat(text, F.lit('"type":"title"}'))).when(F.col("role") == "system", image).otherwise(F.concat(F.lit('{"type":"list","blocks":['), text, F.lit('"type":"text"}]}')))
    pages = t(spark, d, "conversations").withColumn("page", F.expr("turn div 2")).groupBy("conv_id", "page").agg(F.array_sort(F.collect_list(F.struct("turn", block.alias("b")))).alias("bs"))
    pages = pages.select("conv_id", "page", F.concat(F.lit('{"page_size":[612,792],"para_blocks":['), F.array_join(F.col("bs.b"), ","), F.lit("]}")).alias("p"))
    docs = pages.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("page", "p"))).alias("ps"))
    return blocks.nested_blocks(docs.select("conv_id", F.concat(F.lit('{"pdf_info":['), F.array_join(F.col("ps.p"), ","), F.lit("]}")).alias("json")), "conv_id", "json")


PAGED = "b AS (SELECT conv_id, dense_rank() OVER (PARTITION BY conv_id ORDER BY turn // 2) AS page, turn, role, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS text FROM conversations)"


@query(f"""WITH {PAGED} SELECT conv_id, page::INT AS page, 'combined_text' AS feature_type, string_agg(text, ' ' ORDER BY turn) AS string, NULL::BIGINT AS figure_number, NULL AS relationship, false AS linked FROM b WHERE role <> 'system' AND text <> '' GROUP BY 1, 2
UNION ALL SELECT conv_id, page::INT, 'figure', '', row_number() OVER (PARTITION BY conv_id ORDER BY turn), NULL, false FROM b WHERE role = 'system'
UNION ALL SELECT conv_id, page::INT, 'caption', text, NULL, 'figure_caption', true FROM b WHERE role = 'system'""")
def nested_block_entries(spark, d):
    out = blocks.block_entries(_nested(spark, d), "conv_id")
    known = out.where("feature_type = 'figure'").select(F.col("uuid").alias("parent_uuid"), F.lit(True).alias("_known"))
    return out.join(known, "parent_uuid", "left").select("conv_id", "page", "feature_type", "string", "figure_number", "relationship", F.coalesce("_known", F.lit(False)).alias("linked"))


@query(f"""WITH {PAGED}, s AS (SELECT *, sum((role = 'user')::INT) OVER (PARTITION BY conv_id, page ORDER BY turn) AS k FROM b WHERE role <> 'system')
SELECT conv_id, page::INT AS page, string_agg(text, ' ' ORDER BY turn) AS string FROM s WHERE text <> '' GROUP BY conv_id, page, k""")
def nested_blocks_by_title(spark, d):
    return blocks.block_entries(_nested(spark, d), "conv_id", by_title=True).where("feature_type = 'combined_text'").select("conv_id", "page", "string")


@query("""WITH b AS (SELECT conv_id, turn, turn // 2 + 1 AS page, CASE WHEN role = 'user' THEN 'line' WHEN role = 'system' THEN 'title' ELSE 'word' END AS kind, CASE WHEN role = 'system' THEN 'TITLE' ELSE text END AS string FROM conversations)
SELECT conv_id, page::INT AS page, (row_number() OVER (PARTITION BY conv_id, page ORDER BY turn))::INT AS secondary, kind AS feature_type, string, 0.25e0 AS width FROM b
UNION ALL SELECT conv_id, page::INT, 0, 'combined_text', coalesce(string_agg(string, ' ' ORDER BY turn) FILTER (kind = 'line'), ''), 0.0e0 FROM b GROUP BY 1, 2""")
def recognized_elements(spark, d):
    box = F.struct(F.struct(F.lit(0.5).alias("Left"), F.lit(0.5).alias("Top"), F.lit(0.25).alias("Width"), F.lit(0.1).alias("Height")).alias("BoundingBox"))
    kind = F.when(F.col("role") == "user", "LINE").when(F.col("role") == "system", "LAYOUT_TITLE").otherwise("WORD")
    block = F.struct("turn", kind.alias("BlockType"), F.when(F.col("role") != "system", F.col("text")).alias("Text"), F.expr("cast(turn div 2 + 1 as int)").alias("Page"), box.alias("Geometry"))
    docs = t(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(block)).alias("Blocks")).select("conv_id", F.to_json(F.struct("Blocks")).alias("json"))
    return blocks.recognized_elements(docs, "conv_id", "json").select("conv_id", "page", "secondary", "feature_type", "string", "width")


GROUPED = """b AS (SELECT conv_id, dense_rank() OVER (PARTITION BY conv_id ORDER BY turn // 4)::INT AS page, turn, role, (row_number() OVER (PARTITION BY conv_id, turn // 4 ORDER BY turn) - 1)::INT AS sub, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM conversations),
k AS (SELECT *, CASE role WHEN 'system' THEN 'table' WHEN 'user' THEN 'figure' ELSE 'caption' END AS kind FROM b),
p AS (SELECT *, coalesce(last_value(CASE WHEN kind <> 'caption' THEN sub END IGNORE NULLS) OVER w, first_value(CASE WHEN kind <> 'caption' THEN sub END IGNORE NULLS) OVER (PARTITION BY conv_id, page ORDER BY sub ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS seat,
 row_number() OVER (PARTITION BY conv_id, kind ORDER BY page, sub) AS nth FROM k WINDOW w AS (PARTITION BY conv_id, page ORDER BY sub))"""


@query(f"""WITH {GROUPED} SELECT conv_id, page, sub, kind, CASE WHEN kind <> 'caption' THEN nth END AS number, CASE WHEN kind = 'figure' THEN '' ELSE text END AS string, CASE WHEN kind = 'caption' THEN seat END AS target_sub FROM p
UNION ALL SELECT conv_id, page, sub, 'caption', NULL, text, sub FROM p WHERE kind = 'figure' AND text <> ''""")
def group_elements(spark, d):
    """Four turns of a conversation as a figure group: user turns are figures with text, system turns tables, assistant turns captions."""
    kind = F.when(F.col("role") == "system", "Table").when(F.col("role") == "user", "Figure").otherwise("Caption")
    block = F.struct("turn", kind.alias("block_type"), F.concat(F.lit("<p>"), F.replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("\n"), F.lit("<br>")), F.lit("</p>")).alias("html"))
    pages = t(spark, d, "conversations").withColumn("page", F.expr("turn div 4")).groupBy("conv_id", "page").agg(F.array_sort(F.collect_list(block)).alias("children"))
    pages = pages.select("conv_id", "page", F.array(F.struct(F.lit("FigureGroup").alias("block_type"), "children")).alias("children"))
    docs = pages.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("page", "children"))).alias("children"))
    return extraction.group_elements(docs.select("conv_id", F.to_json(F.struct("children")).alias("json")), "conv_id", "json").select("conv_id", "page", "sub", "kind", "number", "string", "target_sub")


@query("SELECT conv_id, (turn % 3)::INT AS page, string_agg(turn::VARCHAR, ',' ORDER BY turn) AS entries FROM conversations GROUP BY 1, 2")
def locations_by_page(spark, d):
    """Entries with two locations on one page count once there."""
    place = F.struct(F.struct((F.col("turn") % 3 + 1).cast("int").alias("primary")).alias("index"))
    rows = t(spark, d, "conversations").select("conv_id", "turn", F.array(place, place).alias("chunk_locations"))
    return extraction.on_pages(rows, "conv_id", "turn").select("conv_id", "page", F.array_join("uuids", ",").alias("entries"))


@query("""SELECT doc_id, 'a' || source AS title, '["' || lang || '",null]' AS keywords, CASE WHEN doc_id % 2 = 0 THEN '{"k":"' || lang || '"}' END AS features FROM documents""")
def stored_rows(spark, d):
    """Complex columns as JSON, strings without NUL characters."""
    lang = F.concat("lang", F.lit("\0"))
    rows = t(spark, d, "documents").select("doc_id", F.concat(F.lit("a\0"), "source").alias("title"), F.array(lang, F.lit(None).cast("string")).alias("keywords"), F.when(F.col("doc_id") % 2 == 0, F.struct(lang.alias("k"))).alias("features"))
    return filters.stored_rows(rows)


# ---- catalogue and merge


def _pipelines(spark, d):
    return t(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("pipeline_id"), F.concat(F.lit("v"), F.col("n_regionkey")).alias("version"), F.col("n_name").alias("description"))


PIPES = "p AS (SELECT n_nationkey::BIGINT AS pipeline_id, 'v' || n_regionkey AS version, n_name AS description FROM nation)"


@query(f"WITH {PIPES} SELECT * FROM p UNION ALL SELECT 99, '1.0', NULL")
def pipeline_ensure(spark, d):
    return lineage.ensure_pipeline(lineage.ensure_pipeline(_pipelines(spark, d), 7, version="other"), 99, version="1.0")


@query(f"""WITH {PIPES} SELECT pipeline_id, version, count(l.s_suppkey) AS n_documents FROM (SELECT pipeline_id, version FROM p UNION ALL SELECT 500, version || '-branch' FROM p WHERE pipeline_id = 7)
LEFT JOIN (SELECT s_nationkey AS k, s_suppkey FROM supplier UNION ALL SELECT 500, s_suppkey FROM supplier WHERE s_nationkey = 7) l ON l.k = pipeline_id GROUP BY 1, 2""")
def pipeline_fork(spark, d):
    links = t(spark, d, "supplier").select(F.col("s_nationkey").cast("bigint").alias("pipeline_id"), F.col("s_suppkey").alias("document_hash"))
    pipes, links = lineage.fork_pipeline(_pipelines(spark, d), links, 7, 500)
    return pipes.join(links, "pipeline_id", "left").groupBy("pipeline_id", "version").agg(F.count("document_hash").alias("n_documents"))


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey = 3 OR s_suppkey % 4 = 0")
def pipeline_documents(spark, d):
    s = t(spark, d, "supplier")
    links = s.select("s_suppkey", F.col("s_nationkey").alias("pipeline_id")).unionByName(s.where("s_suppkey % 4 = 0").select("s_suppkey", F.lit(3).alias("pipeline_id")))
    return lineage.documents_of(s.select("s_suppkey", "s_name"), links, 3, "s_suppkey")


@query("""SELECT s_suppkey AS pipeline_id, k AS position, CASE WHEN k = 1 AND s_suppkey % 2 = 0 THEN 'failed' WHEN k IN (1, 2) THEN 'new' ELSE 'old' END AS status, 1 AS n FROM supplier, (SELECT unnest([0, 1, 2])::INT AS k) WHERE k < 2 OR s_suppkey % 5 = 0""")
def pipeline_steps(spark, d):
    """Steps 0 and 1 are there; 1 is overwritten (with an error for even ones), 2 is new for some."""
    s = t(spark, d, "supplier").select(F.col("s_suppkey").alias("pipeline_id"))
    at = lambda df, k, status: df.withColumns({"position": F.lit(k), "status": F.lit(status)})
    steps = at(s, 0, "old").unionByName(at(s, 1, "old"))
    new = at(s, 1, "new").unionByName(at(s.where("pipeline_id % 5 = 0"), 2, "new")).withColumn("error", F.when((F.col("position") == 1) & (F.col("pipeline_id") % 2 == 0), "broken"))
    return lineage.put_steps(steps, new).groupBy("pipeline_id", "position", "status").agg(F.count(F.lit(1)).cast("int").alias("n"))


@query("SELECT doc_id, 42::BIGINT AS own, 42::BIGINT AS inside, lang FROM documents")
def pipeline_id_set(spark, d):
    rows = t(spark, d, "documents").select("doc_id", F.struct("lang", F.lit(None).cast("bigint").alias("pipeline_id")).alias("document"))
    return lineage.with_pipeline_id(lineage.with_pipeline_id(rows, 42), 42, "document").select("doc_id", F.col("pipeline_id").alias("own"), F.col("document.pipeline_id").alias("inside"), "document.lang")


@query("SELECT vec_id, label FROM embeddings WHERE label <> 2 AND vec_id NOT IN (SELECT doc_id FROM labels)")
def points_delete(spark, d):
    e = t(spark, d, "embeddings").select("vec_id", "label")
    return lineage.without_points(e, t(spark, d, "labels").select(F.col("doc_id").alias("vec_id")), F.col("label") == 2, "vec_id")


@query("""WITH e AS (SELECT l_orderkey AS s, l_partkey AS t, l_returnflag AS k FROM lineitem WHERE l_linenumber = 1)
SELECT uuid, direction, relationship_type, other FROM (SELECT s AS uuid, 'out' AS direction, k AS relationship_type, t AS other FROM e UNION ALL SELECT t, 'in', k, s FROM e) WHERE uuid IN (SELECT p_partkey FROM part WHERE p_partkey % 2 = 0)""")
def entry_relations(spark, d):
    edges = t(spark, d, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("source_uuid"), F.col("l_partkey").alias("target_uuid"), F.col("l_returnflag").alias("relationship_type"))
    return lineage.relations(t(spark, d, "part").where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("uuid")), edges)


@query("""WITH i AS (SELECT doc_id, sha256(length(text)::VARCHAR || ':' || text) AS h FROM documents WHERE doc_id % 7 <> 0), n AS (SELECT h, max(doc_id) AS last FROM i GROUP BY 1), o AS (SELECT h, max(doc_id) AS last FROM (SELECT doc_id, sha256(length(text)::VARCHAR || ':' || text) AS h FROM documents WHERE doc_id % 3 = 0) GROUP BY 1)
SELECT coalesce(n.h, o.h) AS content_hash, coalesce(n.last, o.last) AS uuid, CASE WHEN o.h IS NULL THEN 'insert' WHEN n.h IS NULL THEN 'keep' ELSE 'update' END AS action FROM n FULL JOIN o ON n.h = o.h
UNION ALL SELECT NULL, doc_id, 'reject' FROM documents WHERE doc_id % 7 = 0""")
def entry_upsert(spark, d):
    """Validation, hash and collision in one operator; a seventh of the rows lacks its text."""
    docs = t(spark, d, "documents").select(F.col("doc_id").alias("uuid"), F.col("text").alias("string"))
    old = docs.where("uuid % 3 = 0").withColumn("content_hash", merge.content_hash(F.col("string"))).groupBy("content_hash").agg(F.max("uuid").alias("uuid"))
    new = docs.withColumns({"string": F.when(F.col("uuid") % 7 != 0, F.col("string")), "seq": F.col("uuid")})
    out = merge.upsert_entries(old, new, ["content_hash"], update=True, required=("string",))
    rejected = out["rejected"].select(F.lit(None).cast("string").alias("content_hash"), "uuid", F.lit("reject").alias("action"))
    return out["merged"].select("content_hash", "uuid", "action").unionByName(rejected)


@query("""SELECT DISTINCT l_partkey + 1000000 AS target_uuid, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE o_orderkey + 5000000 END AS source_uuid, l_returnflag AS relationship_type FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_partkey % 3 = 0""")
def entry_edges(spark, d):
    """Edges by reference, whose ends are found in the batch or in the store."""
    even = t(spark, d, "orders").where("o_orderkey % 2 = 0").select(F.concat(F.lit("o"), "o_orderkey").alias("ref"), F.col("o_orderkey").alias("uuid"), F.lit("x").alias("string"), F.col("o_orderkey").alias("seq"))
    stored = t(spark, d, "orders").where("o_orderkey % 2 = 1").select(F.concat(F.lit("o"), "o_orderkey").alias("ref"), (F.col("o_orderkey") + 5_000_000).alias("uuid"), F.lit("x").alias("string"))
    parts = t(spark, d, "part").where("p_partkey % 3 = 0").select(F.concat(F.lit("p"), "p_partkey").alias("ref"), (F.col("p_partkey") + 1_000_000).alias("uuid"), F.lit("x").alias("string"))
    edges = t(spark, d, "lineitem").select(F.concat(F.lit("o"), "l_orderkey").alias("source_ref"), F.concat(F.lit("p"), "l_partkey").alias("target_ref"), F.col("l_returnflag").alias("relationship_type"))
    return merge.upsert_entries(stored.unionByName(parts), even, ["ref"], edges=edges)["edges"]


@query("""WITH i AS (SELECT sha256(text) AS h, max(doc_id) AS last FROM documents GROUP BY 1), o AS (SELECT sha256(text) AS h, min(doc_id) AS first FROM documents WHERE doc_id % 2 = 0 GROUP BY 1)
SELECT i.h AS document_hash, i.last AS id, CASE WHEN o.h IS NULL THEN 'insert' ELSE 'update' END AS action, (1 + (o.h IS NOT NULL AND o.first % 4 = 0)::INT)::BIGINT AS n_links FROM i LEFT JOIN o ON o.h = i.h""")
def document_upsert(spark, d):
    """Documents by hash, each linked once to the pipeline; some were linked to another one before."""
    docs = t(spark, d, "documents").select(F.sha2("text", 256).alias("document_hash"), F.col("doc_id").alias("id"))
    old = docs.where("id % 2 = 0").groupBy("document_hash").agg(F.min("id").alias("id"))
    links = old.where("id % 4 = 0").select(F.lit(1).cast("bigint").alias("pipeline_id"), "document_hash")
    merged, linked = merge.upsert_documents(old, links, docs.withColumn("seq", F.col("id")), 2, "seq")
    return merged.join(linked.groupBy("document_hash").agg(F.count(F.lit(1)).alias("n_links")), "document_hash").select("document_hash", "id", "action", "n_links")


# ---- features and retrieval


@query("SELECT doc_id, k < 3 AS image, CASE WHEN k = 5 THEN 'questions' WHEN k < 3 THEN 'image' ELSE 'text' END AS embedded_feature_type, 'm' AS embedding_model, 64 AS embedding_dimensions FROM (SELECT doc_id, doc_id % 6 AS k FROM documents)")
def embedding_stamp(spark, d):
    s = F.concat(F.get(F.array(*[F.lit(x) for x in ("data:image/png;base64,", "/9j/", "iVBORw0KGgo", "Data:image/", "", "x")]), (F.col("doc_id") % 6).cast("int")), F.col("text"))
    rows = t(spark, d, "documents").select("doc_id", s.alias("string"), F.when(F.col("doc_id") % 6 == 5, "questions").alias("embedded_feature_type"))
    return features.stamp_embedding(rows, "string", "m", "2024-01-01", 64).select("doc_id", features.is_image(F.col("string")).alias("image"), "embedded_feature_type", "embedding_model", "embedding_dimensions")


@query("SELECT conv_id, string_agg(text, '--- --- ' || chr(10) || ' --- --- ' ORDER BY turn) AS text FROM conversations GROUP BY 1")
def text_join(spark, d):
    return features.joined_texts(t(spark, d, "conversations"), ["conv_id"], "turn", "text")


@query("SELECT conv_id, turn, round(CASE role WHEN 'user' THEN n * 0.5e0 + turn * 1.5e0 WHEN 'system' THEN n * 0.25e0 + turn * 2.0e0 ELSE 0 END, 6) AS cost, role <> 'assistant' AND n + turn <= CASE role WHEN 'user' THEN 30 ELSE 10 END AS fits FROM (SELECT conv_id, turn, role, len(regexp_extract_all(text, '\\S+')) AS n FROM conversations)")
def model_costs(spark, d):
    models = features.model_catalogue(spark, [("user", "a", 1, 9.0, 9.0, 1, 1), ("user", "a", 30, 0.5, 1.5, 10, 1000), ("system", "b", 10, 0.25, 2.0, 10, 1000)])
    usage = t(spark, d, "conversations").select("conv_id", "turn", F.col("role").alias("model"), F.size(tx.words(F.col("text"))).alias("input_tokens"), F.col("turn").alias("output_tokens"))
    return features.priced(usage, models).select("conv_id", "turn", r6(F.col("cost")).alias("cost"), "fits")


ALLOWED_BM25 = BM25.replace("FROM documents)", "FROM documents SEMI JOIN (SELECT vec_id AS doc_id FROM embeddings WHERE label < 8) USING (doc_id))").replace("(SELECT count(*) FROM documents)", "(SELECT count(*) FROM dt)")
BOTH = f"""q AS (SELECT vec_id // 50 AS query_id, embedding AS qe FROM embeddings WHERE vec_id % 50 = 0), u AS (SELECT vec_id AS id, embedding AS e FROM embeddings WHERE label < 8),
ds AS (SELECT query_id, id, round({COS.format(a='qe', b='e')}, 6) + 0.0 AS score FROM q, u), dense AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id))::INT AS rank FROM ds QUALIFY rank <= 10), {ALLOWED_BM25},
hy AS (SELECT * FROM (SELECT query_id, id, score, rank, 'dense' AS channel FROM dense UNION ALL SELECT query_id, id, score, rank, 'sparse' FROM bm) QUALIFY row_number() OVER (PARTITION BY query_id, id ORDER BY channel, rank) = 1),
pts AS (SELECT hy.*, d.text, d.source, d.lang FROM hy JOIN documents d ON hy.id = d.doc_id WHERE score >= 0.2 AND length(d.text) > 0)"""


def _both(spark, d):
    e = t(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")
    docs = t(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    vectors = e.where("id % 50 = 0").select(F.expr("id div 50").alias("query_id"), "embedding")
    return retrieval.hybrid_retrieval(e, docs, vectors, t(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text"), condition=F.col("label") < 8, least=0.2)


@query(r"""SELECT doc_id, lang, trim(x) AS feature FROM (SELECT doc_id, lang, unnest(string_split(source || ';' || lang, ';')) AS x FROM documents WHERE lang IN ('en', 'fr') AND doc_id % 4 <> 0) UNION ALL SELECT doc_id, lang, NULL FROM documents WHERE lang NOT IN ('en', 'fr') OR doc_id % 4 = 0""")
def featurize_lists(spark, d):
    """A model that answers with a list, rows that the filter leaves out, and answers that can't be read."""
    model = lambda texts: [json.dumps({"items": t.split(";")}) if t != "-" else "no JSON" for t in texts]
    said = F.when(F.col("doc_id") % 4 == 0, F.lit("-")).otherwise(F.concat_ws(";", "source", "lang"))
    return features.featurized(t(spark, d, "documents").select("doc_id", "lang", "source"), said, model, "items", {"lang": ["en", "fr"]}).select("doc_id", "lang", "feature")


@query("SELECT doc_id, 2 AS n_messages, CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END AS n_images, sha256('Describe ' || text) AS content_hash FROM documents")
def image_prompts(spark, d):
    images = F.array(F.when(F.col("doc_id") % 2 == 0, F.lit("data:image/png;base64,x")), F.lit(""))
    rows = t(spark, d, "documents").select("doc_id", features.image_prompt("You describe images.", F.concat(F.lit("Describe "), "text"), images).alias("m"))
    return rows.select("doc_id", F.size("m").alias("n_messages"), F.size(F.get("m", F.lit(1))["images"]).alias("n_images"), F.sha2(F.get("m", F.lit(1))["content"], 256).alias("content_hash"))


@query(f"WITH {BOTH} SELECT query_id, id, score, rank, channel FROM pts")
def hybrid_search(spark, d):
    return _both(spark, d).select("query_id", "id", "score", "rank", "channel")


@query(f"WITH {BOTH}, ok AS (SELECT *, CASE WHEN id % 4 = 0 THEN lang ELSE source END AS title FROM pts WHERE id % 5 <> 0) SELECT id, title, max(score) AS score, sha256(any_value(text)) AS text_hash FROM ok GROUP BY id, title")
def points_flat(spark, d):
    """Payloads are read, titles fall back to the content type, and points count once over all queries."""
    hits = _both(spark, d).drop("text", "rerank_score")
    docs = t(spark, d, "documents")
    good = F.to_json(F.struct(F.when(F.col("doc_id") % 4 != 0, F.col("source")).alias("document_title"), F.col("lang").alias("content_type")))
    payloads = docs.select(F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 5 == 0, F.lit("{broken")).otherwise(good).alias("payload"))
    out = retrieval.parsed_points(hits, payloads, docs.select(F.col("doc_id").alias("id"), "text"), 0.2, flatten=True)
    return out.select("id", "title", "score", F.sha2("raw_text", 256).alias("text_hash"))


@query(r"""WITH s AS (SELECT doc_id, text, list_filter(string_split(regexp_replace(text, '([.!?])\s+', concat('\1', chr(1)), 'g'), chr(1)), lambda x: x <> '') AS l FROM documents)
SELECT doc_id, lo, array_to_string(l[lo - 1:lo + 2], ' ') AS citation_text, len(l[lo - 1:lo + 2])::INT AS n_marks, true AS placed FROM (SELECT *, 3 AS lo FROM s WHERE len(l) >= 4)""")
def citation_highlights(spark, d):
    """Sentences 3 and 4, with one on both sides; every mark is where its sentence stands."""
    docs = t(spark, d, "documents")
    groups = docs.where(F.size(tx.sentences(F.col("text"))) >= 4).select("doc_id", F.lit(3).alias("lo"), F.lit(4).alias("hi"))
    out = retrieval.highlights(groups, docs.select("doc_id", "text"), "doc_id", around=1).join(docs.select("doc_id", "text"), "doc_id")
    cut = F.array_join(F.transform("highlights", lambda h: F.col("text").substr(h["start"] + 1, h["end"] - h["start"])), " ")
    return out.select("doc_id", "lo", "citation_text", F.size("highlights").alias("n_marks"), (cut == F.col("citation_text")).alias("placed"))


# ---- evaluation


@query("""WITH RECURSIVE m AS (SELECT source, l.doc_id, CASE WHEN toxic = 1 THEN 0.5e0 ELSE quality::DOUBLE END AS score, row_number() OVER (PARTITION BY source ORDER BY l.doc_id) AS k FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
r AS (SELECT source, 0::BIGINT AS k, -1::BIGINT AS doc_id, 1500.0e0 AS a, 1500.0e0 AS b FROM (SELECT DISTINCT source FROM m)
UNION ALL SELECT r.source, m.k, m.doc_id, r.a + 32.0e0 * (m.score - 1 / (1 + pow(10.0e0, (r.b - r.a) / 400))), r.b - 32.0e0 * (m.score - 1 / (1 + pow(10.0e0, (r.b - r.a) / 400))) FROM r JOIN m ON m.source = r.source AND m.k = r.k + 1)
SELECT source || '/a' AS rival, doc_id, round(a, 6) AS rating FROM r WHERE k > 0 UNION ALL SELECT source || '/b', doc_id, round(b, 6) FROM r WHERE k > 0""")
def elo_history(spark, d):
    score = F.when(F.col("toxic") == 1, F.lit(0.5)).otherwise(F.col("quality").cast("double"))
    matches = t(spark, d, "labels").join(t(spark, d, "documents").select("doc_id", "source"), "doc_id").select("source", "doc_id", score.alias("score"))
    history = evaluation.elo(matches, ["source"], "doc_id", "score", history=True)
    history = history.withColumns({"rival_a": F.concat("source", F.lit("/a")), "rival_b": F.concat("source", F.lit("/b"))})
    return evaluation.rating_history(history, "doc_id").withColumn("rating", r6(F.col("rating")))


@query("SELECT doc_id, k <= 1 AS needed, true AS forced FROM (SELECT doc_id, doc_id % 3 AS k FROM documents)")
def questions_needed(spark, d):
    q = F.when(F.col("doc_id") % 3 == 1, F.array().cast("array<string>")).when(F.col("doc_id") % 3 == 2, F.array("lang"))
    rows = t(spark, d, "documents").select("doc_id", q.alias("q"))
    return rows.select("doc_id", evaluation.needs_questions(F.col("q")).alias("needed"), evaluation.needs_questions(F.col("q"), True).alias("forced"))


@query("SELECT conv_id, count(*) FILTER (turn % 3 = 2 AND turn < 4) = 0 AS shown FROM conversations GROUP BY 1")
def pages_shown(spark, d):
    """Conversations whose turns are chunks of one side (the first four) and of the other (the rest); every third turn of the first has no location."""
    place = F.when(F.col("turn") % 3 != 2, F.array(F.lit(1))).otherwise(F.when(F.col("turn") >= 4, F.array(F.lit(2))))
    chunk = F.struct(place.alias("chunk_locations"))
    sides = t(spark, d, "conversations").groupBy("conv_id").agg(F.collect_list(F.when(F.col("turn") < 4, chunk)).alias("a"), F.collect_list(F.when(F.col("turn") >= 4, chunk)).alias("b"))
    return sides.select("conv_id", evaluation.shown_by_pages(F.col("a"), F.col("b")).alias("shown"))



@query("""SELECT doc_id // 6 AS key, arg_max(n_chars, (doc_id % 4) * 1e12 + doc_id) AS n_chars, count(DISTINCT doc_id % 4)::BIGINT AS n_batches FROM documents GROUP BY 1""")
def delta_upsert(spark, d):
    """Documents arrive in four batches; each writes its own rows into a table of deltas, some buckets are compacted on the way, and readers merge: the last length of six documents each."""
    docs = t(spark, d, "documents").select(F.expr("doc_id div 6").alias("key"), "n_chars", "doc_id")
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.drop("doc_id").schema)
    table = DeltaTable(spark, scratch(spark, "deltas"), shape, ("key",), compact_after=3)
    for n in range(4):
        table.write(docs.where(F.col("doc_id") % 4 == n), n, "doc_id")
    batches = docs.groupBy("key").agg(F.count_distinct(F.col("doc_id") % 4).alias("n_batches"))
    return table.read().join(batches, "key").select("key", "n_chars", "n_batches")


@query()
def manifold_layout(spark, d):
    """Vectors in three dimensions that keep their neighbourhoods."""
    found = manifold.manifold(t(spark, d, "embeddings"), "vec_id", "embedding", 3)
    return found.select("vec_id", *[r6(F.get("reduced", F.lit(i))).alias(f"y{i}") for i in range(3)])


@query()
def hull_volumes(spark, d):
    """Of each label the volume of the hull of its vectors, taken three components at a time."""
    parts = t(spark, d, "embeddings").select("label", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(20)), lambda i: F.slice("embedding", i * 3 + 1, F.lit(3)))).alias("part", "v"))
    return hulls.hull_volumes(parts, ["label", "part"], "v").withColumn("volume", F.round("volume", 9))


@query(r"""WITH tk AS (SELECT unnest(regexp_extract_all(text, '\S+')) AS t FROM documents),
b AS (SELECT regexp_replace(lower(t), '^["''(\[]+|[,;:!?"'')\]]+$', '', 'g') AS b FROM tk),
c AS (SELECT rtrim(b, '.') AS word, count(*) AS n, count(*) FILTER (b LIKE '%.') AS dotted FROM b WHERE regexp_matches(rtrim(b, '.'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]') GROUP BY 1),
s AS (SELECT sum(dotted) / sum(n)::DOUBLE AS p FROM c),
l AS (SELECT word, dotted, n, length(word) - length(replace(word, '.', '')) AS inside, 2.0e0 * (dotted * ln(0.99e0 / p) + (n - dotted) * ln(0.01e0 / (1 - p))) AS ratio FROM c, s WHERE dotted > 0),
a AS (SELECT word FROM l WHERE ratio * exp(-(length(word) - inside)::DOUBLE) * (inside + 1) * pow((length(word) - inside)::DOUBLE, -(n - dotted)::DOUBLE) >= 0.3),
p AS (SELECT doc_id, unnest(range(len(l))) AS i, unnest(l) AS x FROM (SELECT doc_id, string_split(regexp_replace(text, '([.!?])(\s)', concat('\1', chr(1), '\2'), 'g'), chr(1)) AS l FROM documents)),
m AS (SELECT *, CASE WHEN x LIKE '%.' THEN rtrim(regexp_replace(lower(regexp_extract(x, '(\S+)$', 1)), '^["''(\[]+|[,;:!?"'')\]]+$', '', 'g'), '.') END IN (SELECT word FROM a) AS known FROM p),
g AS (SELECT doc_id, x, i, sum(cut) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM (SELECT *, coalesce(lag((NOT coalesce(known, false))::INT) OVER (PARTITION BY doc_id ORDER BY i), 0) AS cut FROM m)),
w AS (SELECT doc_id, k, regexp_replace(string_agg(x, '' ORDER BY i), '^\s+', '') AS sentence FROM g GROUP BY doc_id, k)
SELECT doc_id, count(*) AS n_sentences, sha256(string_agg(sentence, chr(1) ORDER BY k)) AS sentences FROM w WHERE sentence <> '' GROUP BY doc_id""")
def sentences_learnt(spark, d):
    found = sentences.learnt_sentences(t(spark, d, "documents"), ["doc_id"])
    own = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_sentences"), F.array_sort(F.collect_list(F.struct("sentence_no", "sentence"))).alias("s"))
    return own.select("doc_id", "n_sentences", F.sha2(F.array_join(F.col("s.sentence"), "\x01"), 256).alias("sentences"))


@query(f"""WITH {WHOLE}, {SPANS}, {windows('conv_id', 'whole', 12, 0)},
v AS (SELECT conv_id, chunk_index AS i, chunk_start, chunk_end, regexp_replace(chunk_text, '\\s+', ' ', 'g') AS unit FROM chunks),
x AS (SELECT *, [(length(unit) % 7)::DOUBLE, (length(unit) % 3)::DOUBLE, 1.0e0] AS a FROM v), n AS (SELECT *, lead(a) OVER w AS b FROM x WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
far AS (SELECT *, coalesce(1 - {COS.format(a="a", b="b")}, 0) AS far FROM n), bd AS (SELECT conv_id, quantile_cont(far, 0.8) AS bound FROM far WHERE b IS NOT NULL GROUP BY 1),
c AS (SELECT far.*, coalesce((lag(far) OVER w > bound)::INT, 0) AS cut FROM far LEFT JOIN bd USING (conv_id) WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
g AS (SELECT *, sum(cut) OVER (PARTITION BY conv_id ORDER BY i) + 1 AS chunk_index FROM c),
d AS (SELECT conv_id, chunk_index::BIGINT AS chunk_index, string_agg(unit, ' ' ORDER BY i) AS chunk_text, count(*) AS n_units, min(chunk_start) AS s, max(chunk_end) AS e FROM g GROUP BY 1, 2)
SELECT d.conv_id, chunk_index, chunk_text, n_units, min(turn) AS first_entry, max(turn) AS last_entry, string_agg(turn::VARCHAR, ',' ORDER BY turn) AS entries
FROM d JOIN spans p ON d.conv_id = p.conv_id AND d.s < p.e AND d.e > p.s GROUP BY ALL""")
def distance_chunks_of_words(spark, d):
    return chunking.distance_chunks_of_words(t(spark, d, "conversations"), ["conv_id"], "turn", "text", _told, 12, percent=80.0)
