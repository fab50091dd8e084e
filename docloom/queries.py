"""Registered queries: each applies library operators to whole tables, with DuckDB SQL that must give the same rows.

Doubles are rounded to 6 digits on both sides.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.functions import dates, geometry, vectors, web
from docloom.functions import text as tx
from docloom.operators import chunking, crawl, dense_index, evaluation, extraction, features, filters, lineage, merge, retrieval
from docloom.schemas import validate
from docloom.sources import files
from docloom.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c: Column) -> Column:
    return F.round(c, 6)


# ---- sources


@query("SELECT doc_id, sha256(text) AS document_hash, octet_length(encode(text))::BIGINT AS file_size, 'internal' AS scope, 'other' AS content_type, 'local_file' AS load_method FROM documents")
def load_documents(spark, d):
    rows = t(spark, d, "documents").select("doc_id", F.concat(F.lit("/d/"), "doc_id", F.lit(".txt")).alias("path"), F.col("text").cast("binary").alias("content"))
    rows = rows.withColumns({"length": F.length("content").cast("long"), "modificationTime": F.lit(None).cast("timestamp")})
    made = files.document_rows(rows, "local_file", "2024-01-01 00:00:00")
    ids = rows.select("doc_id", F.col("path").alias("file_path"))
    return made.join(ids, "file_path").select("doc_id", "document_hash", "file_size", "scope", "content_type", "load_method")


@query(r"""
SELECT page_id, CASE WHEN x IN ('doc') THEN 'docx' WHEN x IN ('htm') THEN 'html' WHEN x IN ('pdf','html','md','csv','json') THEN x ELSE 'txt' END AS file_type,
       CASE WHEN m = 'text/html' THEN 'html' ELSE 'pdf' END AS mime_type
FROM (SELECT page_id, (['pdf','doc','htm','md','','csv','json','zzz'])[page_id % 8 + 1] AS x, (['text/html','x/unknown'])[page_id % 2 + 1] AS m FROM pages)""")
def file_type_lookup(spark, d):
    x = F.element_at(F.array(*[F.lit(e) for e in (".pdf", ".DOC", ".htm", ".md", "", ".csv", ".json?q=1", ".zzz")]), (F.col("page_id") % 8 + 1).cast("int"))
    m = F.element_at(F.array(F.lit("text/html"), F.lit("x/unknown")), (F.col("page_id") % 2 + 1).cast("int"))
    return t(spark, d, "pages").select("page_id", files.file_type(F.concat(F.lit("/a.b/file"), x)).alias("file_type"), files.mime_file_type(m).alias("mime_type"))


@query("SELECT page_id, regexp_replace(url, '[;?#].*', '') AS norm_url FROM pages")
def url_normalize(spark, d):
    return t(spark, d, "pages").select("page_id", web.normalized(F.col("url")).alias("norm_url"))


@query(r"""SELECT page_id, nullif(trim(regexp_extract(html, '(?is)<title>(.*?)</title>', 1)), '') AS title,
 len(regexp_extract_all(html, '<a[^>]*href="([^"]*)"', 1)) AS n_links, array_to_string(regexp_extract_all(html, '<a[^>]*href="([^"]*)"', 1), '|') AS links FROM pages""")
def html_title_links(spark, d):
    h = F.col("html")
    return t(spark, d, "pages").select("page_id", web.title(h).alias("title"), F.size(web.links(h)).alias("n_links"), F.array_join(web.links(h), "|").alias("links"))


@query(r"""WITH l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a[^>]*href="([^"]*)"', 1)) AS link FROM pages),
m AS (SELECT page_id, url, link || (['', '.pdf', '.PDF#p2', '.pdf.html', '/pdf/x', '?download=pdf', '?type=application/pdf'])[page_id % 7 + 1] AS link FROM l),
c AS (SELECT *, regexp_replace(lower(trim(link)), '#.*', '') AS p FROM m)
SELECT page_id, link, CASE WHEN p = '' OR p LIKE 'javascript:%' OR p LIKE 'mailto:%' OR p LIKE 'tel:%' OR p LIKE 'data:%' THEN NULL ELSE p END AS cleaned,
 page_id % 7 IN (1, 2, 4, 5, 6) AS to_pdf, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || link AS absolute FROM c""")
def link_classify(spark, d):
    ends = F.get(F.array(*[F.lit(x) for x in ("", ".pdf", ".PDF#p2", ".pdf.html", "/pdf/x", "?download=pdf", "?type=application/pdf")]), (F.col("page_id") % 7).cast("int"))
    rows = t(spark, d, "pages").select("page_id", "url", F.explode(web.links(F.col("html"))).alias("link")).withColumn("link", F.concat("link", ends))
    link = F.col("link")
    return rows.select("page_id", "link", web.cleaned_link(link).alias("cleaned"), web.leads_to_pdf(web.cleaned_link(link)).alias("to_pdf"), web.resolved(link, F.col("url")).alias("absolute"))


@query("SELECT regexp_replace(url, '[;?#].*', '') AS norm_url, min(page_id) AS page_id, count(*) AS n FROM pages GROUP BY 1")
def visited_dedupe(spark, d):
    rows = t(spark, d, "pages").withColumn("norm_url", web.normalized(F.col("url")))
    return rows.groupBy("norm_url").agg(F.min("page_id").alias("page_id"), F.count(F.lit(1)).alias("n"))


@query(r"""WITH l AS (SELECT DISTINCT url, nullif(trim(regexp_extract(html, '(?is)<title>(.*?)</title>', 1)), '') AS title, unnest(regexp_extract_all(html, '<a[^>]*href="([^"]*)"', 1)) || '.pdf' AS link FROM pages)
SELECT DISTINCT url, title, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || trim(link) AS pdf_url FROM l""")
def page_pdf_links(spark, d):
    html = F.regexp_replace("html", '(<a[^>]*href="[^"]*)"', '$1.pdf"')
    return crawl.pdf_links(t(spark, d, "pages").select("url", html.alias("html")))


@query("""SELECT p.norm_url, coalesce(c.file_path, p.file_path) AS file_path FROM (SELECT norm_url, min(page_id)::VARCHAR AS file_path FROM (SELECT *, regexp_replace(url, '[;?#].*', '') AS norm_url FROM pages) WHERE page_id % 3 <> 0 GROUP BY 1) p
FULL JOIN (SELECT norm_url, 'c' || max(page_id)::VARCHAR AS file_path FROM (SELECT *, regexp_replace(url, '[;?#].*', '') AS norm_url FROM pages) WHERE page_id % 2 = 0 GROUP BY 1) c ON p.norm_url = c.norm_url WHERE p.norm_url IS NOT NULL
UNION ALL SELECT norm_url, 'c' || max(page_id)::VARCHAR FROM (SELECT *, regexp_replace(url, '[;?#].*', '') AS norm_url FROM pages) x WHERE page_id % 2 = 0 AND norm_url NOT IN (SELECT regexp_replace(url, '[;?#].*', '') FROM pages WHERE page_id % 3 <> 0) GROUP BY 1""")
def crawl_merge_back(spark, d):
    rows = t(spark, d, "pages").select(web.normalized(F.col("url")).alias("public_url"), "page_id")
    docs = rows.where("page_id % 3 <> 0").groupBy("public_url").agg(F.min("page_id").cast("string").alias("file_path")).withColumn("file_type", F.lit("html"))
    got = rows.where("page_id % 2 = 0").select("public_url", F.concat(F.lit("c"), "page_id").alias("file_path"), F.lit("html").alias("file_type"), F.col("page_id").alias("round"))
    return crawl.merge_back(docs, got).select(F.col("public_url").alias("norm_url"), "file_path")


# ---- projections and filters


@query("SELECT doc_id, 'blog' AS content_type, lang, CASE WHEN doc_id % 2 = 0 THEN 'own' ELSE 'added' END AS origin, 'x' AS batch FROM documents")
def metadata_overlay(spark, d):
    own = F.when(F.col("doc_id") % 2 == 0, F.create_map(F.lit("origin"), F.lit("own")))
    rows = t(spark, d, "documents").select("doc_id", "lang", F.lit("other").alias("content_type"), own.alias("document_metadata"))
    m = filters.overlay(rows, {"content_type": "blog", "lang": None}, {"origin": "added", "batch": "x"})
    return m.select("doc_id", "content_type", "lang", F.col("document_metadata")["origin"].alias("origin"), F.col("document_metadata")["batch"].alias("batch"))


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN d.source ELSE 'labelled' END AS source, d.lang, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)")
def payload_flatten(spark, d):
    inner = t(spark, d, "labels").select("doc_id", F.struct(F.lit("labelled").alias("source"), "quality").alias("label"))
    rows = t(spark, d, "documents").select("doc_id", "lang", "source").join(inner, "doc_id", "left")
    return filters.flattened(rows, "label").select("doc_id", "source", "lang", "quality")


@query("SELECT event_id, round((value % 100) / 612.0e0, 6) AS left_part, round((user_id % 50) / 792.0e0, 6) AS top_part, round((value % 7 + 1) / 612.0e0, 6) AS width_part FROM events")
def bbox_relative(spark, d):
    b = geometry.box(F.col("value") % 100, (F.col("user_id") % 50).cast("double"), F.col("value") % 7 + 1, F.lit(5.0), F.lit(612.0), F.lit(792.0))
    rel = geometry.relative(b)
    return t(spark, d, "events").select("event_id", r6(rel["left"]).alias("left_part"), r6(rel["top"]).alias("top_part"), r6(rel["width"]).alias("width_part"))


@query("""SELECT event_id, least(x1, x2, x3) AS l, least(y1, y2, y3) AS t, greatest(x1, x2, x3) - least(x1, x2, x3) AS w, greatest(y1, y2, y3) - least(y1, y2, y3) AS h
FROM (SELECT event_id, (event_id % 13)::DOUBLE x1, (event_id % 17)::DOUBLE x2, (event_id % 19)::DOUBLE x3, (event_id % 7)::DOUBLE y1, (event_id % 11)::DOUBLE y2, (event_id % 5)::DOUBLE y3 FROM events)""")
def polygon_to_bbox(spark, d):
    m = lambda n: (F.col("event_id") % n).cast("double")
    b = geometry.from_polygon(F.array(F.array(m(13), m(7)), F.array(m(17), m(11)), F.array(m(19), m(5))), F.lit(612.0), F.lit(792.0))
    return t(spark, d, "events").select("event_id", b["left"].alias("l"), b["top"].alias("t"), b["width"].alias("w"), b["height"].alias("h"))


@query("SELECT event_id, strftime(CASE WHEN event_id % 6 = 5 THEN NULL WHEN event_id % 6 = 2 THEN date_trunc('second', ts) + INTERVAL 5 HOUR WHEN event_id % 6 = 3 THEN date_trunc('day', ts) ELSE date_trunc('second', ts) END, '%Y-%m-%d %H:%M:%S') AS parsed FROM events")
def parse_dates(spark, d):
    ts = F.col("ts").cast("timestamp")
    form = lambda f: F.date_format(ts, f)
    k = F.col("event_id") % 6
    s = F.when(k == 0, form("yyyy-MM-dd HH:mm:ss")).when(k == 1, F.concat(F.lit("D:"), form("yyyyMMddHHmmss"), F.lit("Z"))).when(k == 2, F.concat(F.lit("D:"), form("yyyyMMddHHmmss"), F.lit("-05'00'")))
    s = s.when(k == 3, F.concat(F.lit("D:"), form("yyyyMMdd"))).when(k == 4, F.unix_timestamp(ts).cast("string")).otherwise("no date")
    return t(spark, d, "events").select("event_id", dates.iso(dates.flexible_date(s)).alias("parsed"))


@query("SELECT doc_id, lang IN ('en', 'fr') AND source = 'src0' AS matched FROM documents")
def filter_partition(spark, d):
    match, rest = filters.partition(t(spark, d, "documents").select("doc_id", "lang", "source"), {"lang": ["en", "fr"], "source": "src0"})
    return match.select("doc_id", F.lit(True).alias("matched")).unionByName(rest.select("doc_id", F.lit(False).alias("matched")))


@query("SELECT doc_id, CASE WHEN lang = 'de' THEN upper(source) ELSE source END AS source FROM documents")
def filter_pass_through(spark, d):
    rows = t(spark, d, "documents").select("doc_id", "lang", "source")
    return filters.pass_through(rows, {"lang": "de"}, lambda x: x.withColumn("source", F.upper("source"))).select("doc_id", "source")


@query("""SELECT doc_id, concat_ws('; ', CASE WHEN doc_id % 5 = 0 THEN 'missing title' END, CASE WHEN doc_id % 3 = 0 THEN 'bad scope: moon' END, CASE WHEN n_chars <= 100 THEN 'too short' END) AS reasons
FROM documents WHERE doc_id % 5 = 0 OR doc_id % 3 = 0 OR n_chars <= 100""")
def validate_rejects(spark, d):
    rows = t(spark, d, "documents").select("doc_id", "n_chars", F.when(F.col("doc_id") % 5 != 0, F.lit("x")).alias("title"), F.when(F.col("doc_id") % 3 == 0, F.lit("moon")).otherwise(F.lit("internal")).alias("scope"))
    _, bad = validate(rows, required=("title",), domains={"scope": ("external", "internal")}, checks={"too short": F.col("n_chars") > 100})
    return bad.select("doc_id", F.array_join("reject_reasons", "; ").alias("reasons"))


# ---- chunking

WINDOWS = r"""
w AS (SELECT {keys}, regexp_extract_all(text, '\s*\S+') AS p FROM {table}),
at AS (SELECT {keys}, p, unnest(range(0, len(p), {step})) AS i FROM w WHERE len(p) > 0),
win AS (SELECT {keys}, (i // {step} + 1)::INT AS chunk_index, array_to_string(p[i + 1:i + {size}], '') AS raw, least({size}, len(p) - i)::INT AS n_words,
        length(array_to_string(p[1:i], '')) AS before FROM at),
chunks AS (SELECT {keys}, chunk_index, n_words, regexp_replace(raw, '^\s+', '') AS chunk_text,
        (before + length(raw) - length(regexp_replace(raw, '^\s+', '')))::INT AS chunk_start, (before + length(raw))::INT AS chunk_end FROM win)
""".replace(" at AS", " at_ AS").replace("\nat AS", "\nat_ AS").replace("FROM at)", "FROM at_)").replace("FROM at,", "FROM at_,").replace("FROM at\n", "FROM at_\n")


def windows(keys: str, table: str, size: int, overlap: int) -> str:
    return WINDOWS.format(keys=keys, table=table, size=size, step=size - overlap)


@query(f"WITH {windows('doc_id', 'documents', 500, 50)} SELECT * FROM chunks")
def sliding_words(spark, d):
    return chunking.sliding_words(t(spark, d, "documents"), ["doc_id"], "text", 500, 50)


WHOLE = "whole AS (SELECT conv_id, string_agg(text, '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id)"
SPANS = "spans AS (SELECT conv_id, turn, (sum(length(text)) OVER w - length(text))::BIGINT AS s, (sum(length(text)) OVER w)::BIGINT AS e FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))"


@query(f"""WITH {WHOLE}, {SPANS}, {windows('conv_id', 'whole', 60, 10)}
SELECT c.conv_id, chunk_index, min(turn) AS first_entry, max(turn) AS last_entry, string_agg(turn::VARCHAR, ',' ORDER BY turn) AS entries
FROM chunks c JOIN spans s ON c.conv_id = s.conv_id AND c.chunk_start < s.e AND c.chunk_end > s.s GROUP BY 1, 2""")
def sliding_provenance(spark, d):
    whole, spans = chunking.joined_entries(t(spark, d, "conversations"), ["conv_id"], "turn", "text")
    return chunking.contributors(chunking.sliding_words(whole, ["conv_id"], "text", 60, 10), spans, ["conv_id"], "turn")


@query(f"""WITH {WHOLE}, {SPANS}, {windows('conv_id', 'whole', 60, 10)},
j AS (SELECT c.conv_id, chunk_index, s.turn, x.role FROM chunks c JOIN spans s ON c.conv_id = s.conv_id AND c.chunk_start < s.e AND c.chunk_end > s.s JOIN conversations x ON x.conv_id = s.conv_id AND x.turn = s.turn)
SELECT conv_id, chunk_index, (min(turn) + 1)::INT AS min_primary_index, (max(turn) + 1)::INT AS max_primary_index, string_agg(DISTINCT role, ',' ORDER BY role) AS keywords, arg_min(role, turn) AS entry_title, 'sliding_window' AS chunking_method FROM j GROUP BY 1, 2""")
def chunk_rows(spark, d):
    turns = t(spark, d, "conversations")
    whole, spans = chunking.joined_entries(turns, ["conv_id"], "turn", "text")
    none = F.array().cast("array<string>")
    entries = spans.join(turns.select("conv_id", "turn", (F.col("turn") + 1).cast("int").alias("page"), F.array("role").alias("keywords"), none.alias("citations"), F.col("role").alias("entry_title")), ["conv_id", "turn"])
    made = chunking.build_chunks(chunking.sliding_words(whole, ["conv_id"], "text", 60, 10), entries, ["conv_id"], "turn", "sliding_window")
    return made.select("conv_id", "chunk_index", "min_primary_index", "max_primary_index", F.array_join("keywords", ",").alias("keywords"), "entry_title", "chunking_method")


COS = "list_dot_product({a}::DOUBLE[], {b}::DOUBLE[]) / (sqrt(list_dot_product({a}::DOUBLE[], {a}::DOUBLE[])) * sqrt(list_dot_product({b}::DOUBLE[], {b}::DOUBLE[])))"


@query(f"""WITH e AS (SELECT *, lead(embedding) OVER (PARTITION BY label ORDER BY vec_id) AS nxt FROM embeddings),
s AS (SELECT label, vec_id, 1 - {COS.format(a='embedding', b='nxt')} AS dist FROM e),
c AS (SELECT *, coalesce((lag(dist) OVER (PARTITION BY label ORDER BY vec_id) > 1.0e0)::INT, 0) AS cut FROM s),
g AS (SELECT *, sum(cut) OVER (PARTITION BY label ORDER BY vec_id) AS group_id FROM c)
SELECT label, group_id::BIGINT AS group_id, min(vec_id) AS first_id, max(vec_id) AS last_id, count(*) AS n FROM g GROUP BY 1, 2""")
def distance_groups(spark, d):
    g = chunking.distance_groups(t(spark, d, "embeddings"), ["label"], "vec_id", "embedding", 1.0)
    return g.groupBy("label", "group_id").agg(F.min("vec_id").alias("first_id"), F.max("vec_id").alias("last_id"), F.count(F.lit(1)).alias("n"))


@query(f"""WITH e AS (SELECT *, lead(embedding) OVER (PARTITION BY label ORDER BY vec_id) AS nxt FROM embeddings)
SELECT label, round(quantile_cont(1 - {COS.format(a='embedding', b='nxt')}, 0.95), 6) AS threshold FROM e WHERE nxt IS NOT NULL GROUP BY label""")
def distance_percentile(spark, d):
    return chunking.percentile_thresholds(t(spark, d, "embeddings"), ["label"], "vec_id", "embedding").select("label", r6(F.col("threshold")).alias("threshold"))


@query("SELECT conv_id, turn, sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS session FROM conversations")
def header_sessions(spark, d):
    return chunking.header_sessions(t(spark, d, "conversations"), ["conv_id"], "turn", F.col("role") == "user").select("conv_id", "turn", "session")


GREEDY = r"""e AS (SELECT conv_id, turn, len(regexp_extract_all(text, '\S+'))::BIGINT AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
f AS (SELECT conv_id, turn, k, n AS size, 0 AS win FROM e WHERE k = 1
 UNION ALL SELECT e.conv_id, e.turn, e.k, CASE WHEN f.size + e.n > {most} THEN least(f.size, {overlap}) + e.n ELSE f.size + e.n END, f.win + (f.size + e.n > {most})::INT FROM f JOIN e ON e.conv_id = f.conv_id AND e.k = f.k + 1)"""


@query("WITH RECURSIVE " + GREEDY.format(most=120, overlap=20) + ' SELECT conv_id, turn, win AS "window" FROM f')
def greedy_windows(spark, d):
    return chunking.greedy_windows(t(spark, d, "conversations"), ["conv_id"], "turn", F.size(tx.words(F.col("text"))), 120, 20)


@query(rf"""WITH {WHOLE}, {windows('conv_id', 'whole', 60, 10)},
c AS (SELECT conv_id, chunk_index, list_distinct(regexp_extract_all(lower(chunk_text), '\S+')) AS a FROM chunks),
e AS (SELECT conv_id, turn, list_distinct(regexp_extract_all(lower(text), '\S+')) AS b FROM conversations)
SELECT conv_id, chunk_index, turn, round(len(list_intersect(a, b)) / len(b)::DOUBLE, 6) AS share FROM c JOIN e USING (conv_id) WHERE len(b) > 0 AND len(list_intersect(a, b)) / len(b)::DOUBLE > 0.5""")
def word_overlap_contributors(spark, d):
    turns = t(spark, d, "conversations")
    whole, _ = chunking.joined_entries(turns, ["conv_id"], "turn", "text")
    found = chunking.word_overlap_contributors(chunking.sliding_words(whole, ["conv_id"], "text", 60, 10), turns.select("conv_id", "turn", F.col("text").alias("entry_text")), ["conv_id"])
    return found.select("conv_id", "chunk_index", "turn", r6(F.col("share")).alias("share"))


@query(r"""SELECT doc_id, i AS chunk_index, trim(string_split(x, '</chunk>')[1]) AS chunk_text FROM (
SELECT doc_id, unnest(l) AS x, unnest(range(1, len(l) + 1)) AS i FROM (
 SELECT doc_id, list_filter(string_split('junk<chunk>' || replace(text, chr(10), ' </chunk> x <chunk>'), '<chunk>'), lambda p: contains(p, '</chunk>')) AS l FROM documents) WHERE len(l) > 0)""")
def chunk_tag_parse(spark, d):
    tagged = F.concat(F.lit("junk<chunk>"), F.replace("text", F.lit("\n"), F.lit(" </chunk> x <chunk>")))
    rows = t(spark, d, "documents").select("doc_id", F.posexplode(tx.tagged_chunks(tagged)).alias("i", "chunk_text"))
    return rows.select("doc_id", (F.col("i") + 1).alias("chunk_index"), "chunk_text")


@query(r"""SELECT doc_id, (len(l))::INT AS n_sentences, sha256(array_to_string(l, '|')) AS sentences FROM (
SELECT doc_id, list_filter(string_split(regexp_replace(text, '([.!?])\s+', concat('\1', chr(1)), 'g'), chr(1)), lambda s: s <> '') AS l FROM documents)""")
def sentence_split(spark, d):
    s = tx.sentences(F.col("text"))
    return t(spark, d, "documents").select("doc_id", F.size(s).alias("n_sentences"), F.sha2(F.array_join(s, "|"), 256).alias("sentences"))


@query()
def sliding_tokens(spark, d):
    """Files of public tokenizers lie where DOCLOOM_TOKENIZERS says."""
    return chunking.sliding_tokens(t(spark, d, "documents"), ["doc_id"], "text", f"{os.environ.get('DOCLOOM_TOKENIZERS', '/opt/tokenizers')}/byte_bpe_50k.json").drop("chunk_text")


@query(rf"""WITH RECURSIVE {GREEDY.format(most=120, overlap=0)}, w AS (SELECT c.conv_id, f.win, string_agg(text, ' ' ORDER BY c.turn) AS tx FROM conversations c JOIN f ON f.conv_id = c.conv_id AND f.turn = c.turn GROUP BY 1, 2),
k AS (SELECT conv_id, win, CASE WHEN win % 2 = 0 THEN string_split(tx, '. ') ELSE [tx] END AS l FROM w), ch AS (SELECT conv_id, win, unnest(l) AS chunk_text, unnest(range(1, len(l) + 1)) AS i FROM k),
s AS (SELECT ch.conv_id, ch.win, i, string_agg(c.turn::VARCHAR, ',' ORDER BY c.turn) AS entries FROM ch JOIN f ON f.conv_id = ch.conv_id AND f.win = ch.win JOIN conversations c ON c.conv_id = f.conv_id AND c.turn = f.turn
 WHERE len(list_intersect(list_distinct(regexp_extract_all(lower(chunk_text), '\S+')), list_distinct(regexp_extract_all(lower(c.text), '\S+')))) > 0.5 * len(list_distinct(regexp_extract_all(lower(c.text), '\S+'))) GROUP BY 1, 2, 3)
SELECT conv_id, win AS "window", i::INT AS chunk_index, sha256(chunk_text) AS chunk_hash, entries FROM ch LEFT JOIN s USING (conv_id, win, i)""")
def generative_chunks(spark, d):
    def answer(df, prompt):
        parts = F.to_json(F.struct(F.split(prompt, r"\. ", -1).alias("chunks")))
        return df.withColumn("answer", F.when(F.col("window") % 2 == 0, parts).otherwise("no JSON"))

    out = chunking.generative_chunks(t(spark, d, "conversations"), ["conv_id"], "turn", "text", answer, 120)
    return out.select("conv_id", "window", "chunk_index", F.sha2("chunk_text", 256).alias("chunk_hash"), "entries")


@query()
def topic_segments(spark, d):
    return chunking.topic_segments(t(spark, d, "documents"), ["doc_id"])


# ---- extraction


@query("SELECT conv_id, turn // 2 + 1 AS page, string_agg(text, ' ' ORDER BY turn) AS text, count(*) AS n FROM conversations GROUP BY 1, 2")
def page_grouping(spark, d):
    rows = t(spark, d, "conversations").select("conv_id", F.expr("turn div 2 + 1").alias("page"), "turn", "text")
    own = rows.groupBy("conv_id", "page").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("e"), F.count(F.lit(1)).alias("n"))
    return own.select("conv_id", "page", F.array_join(F.col("e.text"), " ").alias("text"), "n")


@query("SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) END AS parent FROM conversations")
def parent_caption_link(spark, d):
    return extraction.linked_to_parent(t(spark, d, "conversations"), "conv_id", ["turn"], F.col("role") == "user", F.col("role") == "assistant", "turn").select("conv_id", "turn", "parent")


def _blocks(spark, d):
    """Conversations as layout JSON: a page per two turns, user turns as section headers, system turns as pictures."""
    kind = F.when(F.col("role") == "user", "SectionHeader").when(F.col("role") == "system", "Picture").otherwise("Text")
    block = F.struct("turn", kind.alias("block_type"), F.concat(F.lit("<p>"), F.replace("text", F.lit("\n"), F.lit("<br>")), F.lit("</p>")).alias("html"))
    pages = t(spark, d, "conversations").withColumn("page", F.expr("turn div 2")).groupBy("conv_id", "page").agg(F.array_sort(F.collect_list(block)).alias("children"))
    docs = pages.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("page", "children"))).alias("children"))
    return extraction.parsed_blocks(docs.select("conv_id", F.to_json(F.struct("children")).alias("json")), "conv_id", "json")


FLAT = r"b AS (SELECT conv_id, dense_rank() OVER (PARTITION BY conv_id ORDER BY turn // 2) AS page, turn, role, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM conversations)"


@query(f"""WITH {FLAT} SELECT conv_id, page::INT AS page, -1 AS pos, 'combined_text' AS feature_type, string_agg(text, ' ' ORDER BY turn) AS text FROM b WHERE role <> 'system' AND text <> '' GROUP BY 1, 2
UNION ALL SELECT conv_id, page::INT, (rank() OVER (PARTITION BY conv_id, page ORDER BY turn) - 1)::INT, 'picture', text FROM b WHERE role = 'system'""")
def layout_by_page(spark, d):
    return extraction.entries_by_page(_blocks(spark, d), "conv_id")


@query(f"""WITH {FLAT}, s AS (SELECT *, sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS session FROM b WHERE role <> 'system')
SELECT conv_id, session::BIGINT AS session, max(CASE WHEN role = 'user' THEN text END) AS title, min(page)::INT AS min_page, max(page)::INT AS max_page, coalesce(string_agg(text, ' ' ORDER BY turn) FILTER (text <> ''), '') AS text FROM s GROUP BY 1, 2""")
def layout_by_title(spark, d):
    return extraction.entries_by_title(_blocks(spark, d), "conv_id")


@query(r"""SELECT doc_id, i::INT AS page, trim(p) AS text FROM (SELECT doc_id, unnest(l) AS p, unnest(range(1, len(l) + 1)) AS i FROM (
SELECT doc_id, regexp_split_to_array(replace(text, '.' || chr(10), chr(10) || ' ' || chr(10)), '\f|\n\s*\n') AS l FROM documents)) WHERE trim(p) <> ''""")
def simple_pages(spark, d):
    rows = t(spark, d, "documents").select("doc_id", F.replace("text", F.lit(".\n"), F.lit("\n \n")).alias("text"))
    return extraction.split_pages(rows, "doc_id", "text")


@query()
def html_passages(spark, d):
    return extraction.html_passages(t(spark, d, "pages"), "page_id", "html")


# ---- merge and lineage


@query("SELECT text_hash, n FROM (SELECT sha256(length(text)::VARCHAR || ':' || text || '|' || length(lang)::VARCHAR || ':' || lang || '|-') AS text_hash, count(*) AS n FROM documents GROUP BY 1)")
def content_hash(spark, d):
    h = merge.content_hash(F.col("text"), F.col("lang"), F.lit(None).cast("string"))
    return t(spark, d, "documents").groupBy(h.alias("text_hash")).agg(F.count(F.lit(1)).alias("n"))


INCOMING = """old AS (SELECT sha256(text) AS h, max(doc_id) AS id, 'old' AS tag FROM documents WHERE source <> 'src1' GROUP BY 1),
inc AS (SELECT h, arg_max(doc_id, doc_id) AS id, arg_max(CASE WHEN doc_id % 2 = 0 THEN 'new' END, doc_id) AS tag0, bool_or(false) AS z FROM (SELECT sha256(text) AS h, doc_id FROM documents WHERE source <> 'src0') GROUP BY 1),
new_ AS (SELECT h, max(doc_id) AS id FROM (SELECT sha256(text) AS h, doc_id FROM documents WHERE source <> 'src0') GROUP BY 1)"""
MERGED = f"""WITH {INCOMING}
SELECT coalesce(o.h, n.h) AS h, CASE WHEN {{update}} THEN coalesce(n.id, o.id) ELSE coalesce(o.id, n.id) END AS id,
 CASE WHEN n.h IS NOT NULL AND {{update}} THEN coalesce(CASE WHEN n.id % 2 = 0 THEN 'new' END, o.tag) WHEN o.h IS NOT NULL THEN o.tag ELSE CASE WHEN n.id % 2 = 0 THEN 'new' END END AS tag,
 CASE WHEN o.h IS NULL THEN 'insert' WHEN n.h IS NULL THEN 'keep' WHEN {{update}} THEN 'update' ELSE 'skip' END AS action
FROM old o FULL JOIN new_ n ON o.h = n.h"""


def _merged(spark, d, update: bool) -> DataFrame:
    docs = t(spark, d, "documents").select(F.sha2("text", 256).alias("h"), F.col("doc_id").alias("id"), "source")
    old = docs.where("source <> 'src1'").groupBy("h").agg(F.max("id").alias("id")).withColumn("tag", F.lit("old"))
    new = docs.where("source <> 'src0'").select("h", "id", F.when(F.col("id") % 2 == 0, F.lit("new")).alias("tag"), F.col("id").alias("seq"))
    return merge.merge(old, new, ["h"], "seq", update)


@query(MERGED.format(update="true"))
def merge_documents(spark, d):
    return _merged(spark, d, True)


@query(MERGED.format(update="false"))
def merge_skip(spark, d):
    return _merged(spark, d, False)


@query(f"SELECT mode, count(*) FILTER (action = 'insert') AS n_insert, count(*) FILTER (action = 'update') AS n_update, count(*) FILTER (action = 'skip') AS n_skip, count(*) FILTER (action = 'keep') AS n_keep FROM (SELECT 'update' AS mode, action FROM ({MERGED.format(update='true')}) UNION ALL SELECT 'skip', action FROM ({MERGED.format(update='false')})) GROUP BY mode")
def merge_counters(spark, d):
    both = [merge.counters(_merged(spark, d, u)).withColumn("mode", F.lit("update" if u else "skip")) for u in (True, False)]
    return both[0].unionByName(both[1])


EDGES = "e AS (SELECT DISTINCT l_orderkey AS source, l_partkey AS target FROM lineitem), old AS (SELECT * FROM e WHERE source % 3 = 0)"


@query(f"WITH {EDGES} SELECT source, target FROM e WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.source = e.source AND o.target = e.target)")
def edges_insert_ignore(spark, d):
    e = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("source"), F.col("l_partkey").alias("target"))
    return merge.insert_ignore(e.where("source % 3 = 0"), e, ["source", "target"])


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN o_orderpriority LIKE '1%' THEN o_custkey ELSE o_custkey + 1000000 END AS target_id, CASE WHEN o_orderpriority LIKE '1%' THEN 1 ELSE 2 END AS tier
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority < '4'""")
def citation_resolve(spark, d):
    o = t(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority")
    batch = o.where("o_orderpriority LIKE '1%'").select("l_orderkey", F.col("o_custkey").alias("target_id"))
    stored = o.where("o_orderpriority < '4'").select("l_orderkey", (F.col("o_custkey") + 1000000).alias("target_id"))
    return merge.resolve_citations(t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), batch, stored, "l_orderkey")


@query("SELECT lang, arg_max(source, doc_id) AS source, max(doc_id) AS last_id FROM documents GROUP BY lang")
def refresh_documents(spark, d):
    rows = t(spark, d, "documents").select("lang", "source", F.col("doc_id").alias("last_id"))
    base = rows.select("lang").distinct().withColumns({"source": F.lit("none"), "last_id": F.lit(-1).cast("long")})
    return merge.refresh(base, rows.withColumn("seq", F.col("last_id")), "lang", "seq")


@query("SELECT doc_id, lang, sha256(text) AS text_hash, 1000 + row_number() OVER (ORDER BY source, doc_id) AS id FROM documents")
def new_ids(spark, d):
    made = merge.with_new_ids(t(spark, d, "documents").select("source", "doc_id", "lang", "text"), ["source", "doc_id"], 1000)
    return made.select("doc_id", "lang", F.sha2("text", 256).alias("text_hash"), "id")


STEPS = """s AS (SELECT user_id AS pipeline_id, event_id AS step_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1)::INT AS position,
 lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS previous_id, CASE WHEN event_type = 'purchase' OR value < 300 THEN 'completed' ELSE 'failed' END AS status FROM events)"""


def _steps(spark, d) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("event_id")
    return t(spark, d, "events").select(
        F.col("user_id").alias("pipeline_id"), F.col("event_id").alias("step_id"), (F.row_number().over(w) - 1).alias("position"), F.lag("event_id").over(w).alias("previous_id"),
        F.when((F.col("event_type") == "purchase") | (F.col("value") < 300), "completed").otherwise("failed").alias("status"),
    )


@query(f"WITH {STEPS} SELECT * FROM s WHERE status = 'completed' QUALIFY row_number() OVER (PARTITION BY pipeline_id ORDER BY position DESC) = 1")
def latest_step(spark, d):
    return lineage.latest_steps(_steps(spark, d))


@query(f"""WITH {STEPS}, l AS (SELECT pipeline_id, max(position) AS done FROM s WHERE status = 'completed' GROUP BY 1)
SELECT s.* FROM s LEFT JOIN l USING (pipeline_id) WHERE position > coalesce(done, -1) QUALIFY row_number() OVER (PARTITION BY pipeline_id ORDER BY position) = 1""")
def next_step(spark, d):
    return lineage.next_steps(_steps(spark, d))


@query(f"""WITH {STEPS}, c AS (SELECT * FROM s WHERE pipeline_id = 7 AND position < 5)
SELECT 900 AS pipeline_id, 5000 + position AS step_id, position, CASE WHEN position > 0 THEN 5000 + position - 1 END AS previous_id, status FROM c""")
def fork_steps(spark, d):
    return lineage.fork(_steps(spark, d), 7, 900, 5, 5000)


@query("""SELECT 'entries' AS name, o_orderkey AS a, o_custkey AS b FROM orders WHERE o_custkey % 10 <> 0
UNION ALL SELECT 'edges', l_orderkey, -l_partkey - 1 FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey % 10 <> 0""")
def delete_pipeline(spark, d):
    o = t(spark, d, "orders").select(F.col("o_custkey").alias("pipeline_id"), F.col("o_orderkey").alias("uuid"))
    edges = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("source_uuid"), (-F.col("l_partkey") - 1).alias("target_uuid"))
    gone = o.where("pipeline_id % 10 = 0").select("pipeline_id").distinct()
    left = lineage.delete_pipeline(gone, {"entries": o}, edges)
    rows = lambda name, a, b: left[name].select(F.lit(name).alias("name"), F.col(a).alias("a"), F.col(b).alias("b"))
    return rows("entries", "uuid", "pipeline_id").unionByName(rows("edges", "source_uuid", "target_uuid"))


@query("SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'other' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def rename_content_type(spark, d):
    return lineage.rename_value(t(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", "BUILDING", "other")


# ---- retrieval

DENSE = """q AS (SELECT vec_id AS query_id, embedding AS qe FROM embeddings WHERE vec_id % 50 = 0),
u AS (SELECT vec_id AS id, label::VARCHAR AS feature, embedding AS e FROM embeddings),
ds AS (SELECT query_id, feature, id, round({cos}, 6) + 0.0 AS score FROM q, u),
dense AS (SELECT *, (row_number() OVER (PARTITION BY query_id, feature ORDER BY score DESC, id))::INT AS rank FROM ds QUALIFY rank <= 10)""".replace("{cos}", COS.format(a="qe", b="e"))


def _dense(spark, d) -> DataFrame:
    """Queries: every vector whose id is divisible by 50, against all vectors."""
    e = t(spark, d, "embeddings")
    return retrieval.dense_top_k(e, e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), 10, feature="label")


@query(f"WITH {DENSE} SELECT query_id, feature, id, score, rank FROM dense")
def dense_topk(spark, d):
    return _dense(spark, d)


def _indexed(spark, d, exact: bool) -> DataFrame:
    """Queries: every vector whose id is divisible by 50, against an index of all vectors."""
    e = t(spark, d, "embeddings")
    return dense_index.search_dense_index(dense_index.build_dense_index(e), e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), 10, exact=exact)


@query("WITH " + DENSE.replace("label::VARCHAR", "''") + " SELECT query_id, feature, id, score, rank FROM dense")
def dense_index_exact(spark, d):
    return _indexed(spark, d, True)


@query()
def dense_index_recall(spark, d):
    """How many of the exact hits the nearest cells alone give."""
    e = t(spark, d, "embeddings")
    queries = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    near, every = _indexed(spark, d, False), dense_index.dense_top_k(e, queries, 10)
    both = every.select("query_id", "id").join(near.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left")
    return both.groupBy("query_id").agg(F.count("hit").alias("n_found"), F.count(F.lit(1)).alias("n_exact"))


BM25 = r"""dt AS (SELECT doc_id, regexp_extract_all(lower(text), '([a-z0-9]+)', 1) AS w FROM documents),
p AS (SELECT doc_id, term, len_ AS length, count(*) AS tf FROM (SELECT doc_id, len(w) AS len_, unnest(w) AS term FROM dt) GROUP BY 1, 2, 3),
qt AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '([a-z0-9]+)', 1)) AS term FROM benchmark),
df AS (SELECT term, count(*) AS df FROM p SEMI JOIN qt USING (term) GROUP BY 1),
sc AS (SELECT item_id AS query_id, doc_id AS id, round(sum(tf * 2.2e0 / (tf + 1.2e0 * (1.0e0 - 0.75e0 + 0.75e0 * length / 256.0e0)) * ln(((SELECT count(*) FROM documents)::DOUBLE - df + 0.5e0) / (df + 0.5e0) + 1.0e0)), 6) AS score
       FROM qt JOIN p USING (term) JOIN df USING (term) GROUP BY 1, 2),
bm AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id))::INT AS rank FROM sc QUALIFY rank <= 10)"""


@query(f"WITH {BM25} SELECT query_id, id, score, rank FROM bm")
def bm25_topk(spark, d):
    return retrieval.bm25_top_k(t(spark, d, "documents"), t(spark, d, "benchmark"))


HYBRID = f"""{DENSE}, {BM25},
hy AS (SELECT * FROM (SELECT query_id // 50 AS query_id, id, score, rank, 'dense' AS channel FROM dense UNION ALL SELECT query_id, id, score, rank, 'sparse' FROM bm)
       QUALIFY row_number() OVER (PARTITION BY query_id, id ORDER BY channel, rank) = 1)"""


def _hybrid(spark, d) -> DataFrame:
    dense = _dense(spark, d).withColumn("query_id", F.expr("query_id div 50"))
    return retrieval.hybrid(dense, retrieval.bm25_top_k(t(spark, d, "documents"), t(spark, d, "benchmark")))


@query(f"WITH {HYBRID} SELECT query_id, id, score, rank, channel FROM hy")
def hybrid_union(spark, d):
    return _hybrid(spark, d)


def _points(spark, d) -> DataFrame:
    texts = t(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "source")
    return retrieval.format_points(_hybrid(spark, d), texts, 0.2)


POINTS = HYBRID + ", pts AS (SELECT hy.*, d.text, d.source FROM hy JOIN documents d ON hy.id = d.doc_id WHERE score >= 0.2 AND length(d.text) > 0)"


@query(f"WITH {POINTS} SELECT query_id, id, score, channel, sha256(text) AS text_hash, 0.0e0 AS rerank_score FROM pts")
def format_points(spark, d):
    return _points(spark, d).select("query_id", "id", "score", "channel", F.sha2("text", 256).alias("text_hash"), "rerank_score")


@query(f"""WITH {POINTS}, f AS (SELECT query_id, source, min((channel, rank, id)) AS m FROM pts GROUP BY 1, 2),
n AS (SELECT query_id, source, (row_number() OVER (PARTITION BY query_id ORDER BY m, source))::INT AS citation FROM f)
SELECT query_id, id, channel, source, citation FROM pts JOIN n USING (query_id, source)""")
def citation_numbers(spark, d):
    return retrieval.citation_numbers(_points(spark, d), "source", ["channel", "rank", "id"]).select("query_id", "id", "channel", "source", "citation")


@query(f"WITH {POINTS} SELECT query_id, id, channel, CASE WHEN l.quality >= 1 THEN l.quality::DOUBLE ELSE 0.0e0 END AS rerank_score FROM pts LEFT JOIN labels l ON pts.id = l.doc_id")
def rerank_apply(spark, d):
    scores = t(spark, d, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("new_score"))
    return retrieval.rerank(_points(spark, d), scores, 1.0).select("query_id", "id", "channel", "rerank_score")


@query(rf"""WITH {windows('doc_id', 'documents', 40, 8)},
c AS (SELECT doc_id, chunk_index, chunk_text AS t, (chunk_index * 7 % 5)::DOUBLE AS score FROM chunks),
n AS (SELECT *, lag(t) OVER w AS pt, lag(score) OVER w AS ps, lead(score) OVER w AS ns FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY chunk_index)),
e AS (SELECT *, coalesce(list_max(list_filter(range(11, least(length(pt), length(t)) + 1), lambda i: starts_with(t, right(pt, i)))), 0) AS edge FROM n),
x AS (SELECT *, CASE WHEN score <= ps THEN edge ELSE 0 END AS front, CASE WHEN score < ns THEN coalesce(lead(edge) OVER (PARTITION BY doc_id ORDER BY chunk_index), 0) ELSE 0 END AS back FROM e)
SELECT doc_id, chunk_index, edge::INT AS edge, trim(substring(t, front + 1, greatest(length(t) - front - back, 0))) AS merged FROM x""")
def merge_context(spark, d):
    c = chunking.sliding_words(t(spark, d, "documents"), ["doc_id"], "text", 40, 8)
    points = c.select("doc_id", F.col("chunk_index").alias("primary"), F.lit(None).cast("int").alias("secondary"), F.col("chunk_text").alias("text"), (F.col("chunk_index") * 7 % 5).cast("double").alias("score"))
    return retrieval.merge_context(points, ["doc_id"]).select("doc_id", F.col("primary").alias("chunk_index"), "edge", "merged")


@query("""WITH o AS (SELECT DISTINCT user_id, extract(day FROM ts) AS day FROM events), g AS (SELECT *, day - row_number() OVER (PARTITION BY user_id ORDER BY day) AS k FROM o)
SELECT user_id, min(day)::INT AS lo, max(day)::INT AS hi, count(*) AS n FROM g GROUP BY user_id, k""")
def citation_groups(spark, d):
    return retrieval.citation_groups(t(spark, d, "events").select("user_id", F.dayofmonth("ts").alias("day")), ["user_id"], "day")


@query(r"""SELECT doc_id, regexp_replace(text || '[12] a [3]', '\[\d+\]', '', 'g') AS text FROM documents""")
def bracket_strip(spark, d):
    return t(spark, d, "documents").select("doc_id", tx.strip_citations(F.concat("text", F.lit("[12] a [3]"))).alias("text"))


@query(r"""SELECT doc_id, i::INT AS sentence_no, s AS sentence FROM (SELECT doc_id, unnest(l) AS s, unnest(range(1, len(l) + 1)) AS i FROM (
SELECT doc_id, list_filter(string_split(regexp_replace(text, '([.!?])\s+', concat('\1', chr(1)), 'g'), chr(1)), lambda s: s <> '') AS l FROM documents))""")
def sentence_index(spark, d):
    return retrieval.indexed_sentences(t(spark, d, "documents"), "doc_id", "text")


@query(r"""WITH s AS (SELECT doc_id, i::INT AS sentence_no, x AS sentence FROM (SELECT doc_id, unnest(l) AS x, unnest(range(1, len(l) + 1)) AS i FROM (
SELECT doc_id, list_filter(string_split(regexp_replace(text, '([.!?])\s+', concat('\1', chr(1)), 'g'), chr(1)), lambda s: s <> '') AS l FROM documents)))
SELECT doc_id, sentence_no, concat_ws(' ', sentence, CASE WHEN sentence_no % 3 = 0 THEN '[1][' || (sentence_no % 5 + 2)::VARCHAR || ']' END) AS annotated FROM s""")
def citation_annotate(spark, d):
    s = retrieval.indexed_sentences(t(spark, d, "documents"), "doc_id", "text")
    cited = s.where("sentence_no % 3 = 0").select("doc_id", "sentence_no", F.explode(F.array((F.col("sentence_no") % 5 + 2), F.lit(1), F.lit(1))).alias("citation"))
    return retrieval.annotated(s, cited, "doc_id")


@query("""SELECT vec_id, coalesce(n.tag, o.tag) AS tag, CASE WHEN o.vec_id IS NULL THEN 'insert' WHEN n.vec_id IS NULL THEN 'keep' ELSE 'update' END AS action
FROM (SELECT vec_id, 'old' AS tag FROM embeddings WHERE label < 6) o FULL JOIN (SELECT vec_id, 'new' AS tag FROM embeddings WHERE label > 3 AND vec_id % 4 <> 0) n USING (vec_id)""")
def upsert_vectors(spark, d):
    e = t(spark, d, "embeddings")
    old = e.where("label < 6").select("vec_id", "embedding", F.lit("old").alias("tag"))
    new = e.where("label > 3").select("vec_id", F.when(F.col("vec_id") % 4 != 0, F.col("embedding")).alias("embedding"), F.lit("new").alias("tag"), F.col("vec_id").alias("seq"))
    return retrieval.upsert_vectors(old, new, "vec_id", "seq")[0].select("vec_id", "tag", "action")


# ---- evaluation


@query("WITH RECURSIVE " + GREEDY.format(most=120, overlap=0) + """,
a AS (SELECT conv_id, min(turn) AS lo, max(turn) AS hi, string_agg(text, ' ' ORDER BY turn) AS text, session FROM (SELECT *, sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS session FROM conversations) GROUP BY conv_id, session),
b AS (SELECT c.conv_id, min(c.turn) AS lo, max(c.turn) AS hi, string_agg(text, ' ' ORDER BY c.turn) AS text FROM conversations c JOIN f ON f.conv_id = c.conv_id AND f.turn = c.turn GROUP BY c.conv_id, f.win)
SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, coalesce(a.lo, b.lo) AS lo, coalesce(a.hi, b.hi) AS hi, sha256(a.text) AS hash_a, sha256(b.text) AS hash_b
FROM a FULL JOIN b ON a.conv_id = b.conv_id AND a.lo = b.lo AND a.hi = b.hi""")
def page_range_compare(spark, d):
    turns = t(spark, d, "conversations")

    def ranges(df: DataFrame, group: str) -> DataFrame:
        own = df.groupBy("conv_id", group).agg(F.min("turn").alias("lo"), F.max("turn").alias("hi"), F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("_t"))
        return own.select("conv_id", "lo", "hi", F.col(group).alias("n"), F.array_join(F.col("_t.text"), " ").alias("text"))

    a = ranges(chunking.header_sessions(turns, ["conv_id"], "turn", F.col("role") == "user"), "session")
    w = chunking.greedy_windows(turns, ["conv_id"], "turn", F.size(tx.words(F.col("text"))), 120)
    both = evaluation.compare_page_ranges(a, ranges(turns.join(w, ["conv_id", "turn"]), "window"), ["conv_id"], "n")
    digest = lambda c: F.when(F.col(c).isNotNull(), F.sha2(F.array_join(c, "|"), 256))
    return both.select("conv_id", "lo", "hi", digest("chunks_a").alias("hash_a"), digest("chunks_b").alias("hash_b"))


@query(f"WITH {windows('doc_id', 'documents', 500, 50)} SELECT lang, count(*) AS n_chunks, round(avg(length(chunk_text)), 6) AS mean_length, round(stddev_pop(length(chunk_text)), 6) AS std_length FROM chunks JOIN documents USING (doc_id) GROUP BY lang")
def chunk_metrics(spark, d):
    docs = t(spark, d, "documents")
    m = evaluation.chunk_metrics(chunking.sliding_words(docs, ["doc_id", "lang"], "text", 500, 50), ["lang"])
    return m.select("lang", "n_chunks", r6(F.col("mean_length")).alias("mean_length"), r6(F.col("std_length")).alias("std_length"))


@query("SELECT source, round(CASE WHEN sum(quality) = sum(toxic) OR sum(quality) + sum(toxic) = 0 THEN 0.5e0 ELSE sum(quality) / (sum(quality) + sum(toxic))::DOUBLE END, 6) AS score FROM labels JOIN documents USING (doc_id) GROUP BY source")
def comparison_score(spark, d):
    own = t(spark, d, "labels").join(t(spark, d, "documents").select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("quality").alias("a"), F.sum("toxic").alias("b"))
    return own.select("source", r6(evaluation.comparison_score(F.col("a"), F.col("b"))).alias("score"))


@query("SELECT source, round(avg(quality * 5.0e0), 6) AS clarity, round(avg(toxic * 5.0e0), 6) AS coherence, round(avg(quality * 5.0e0) + avg(toxic * 5.0e0), 6) AS total FROM labels JOIN documents USING (doc_id) GROUP BY source")
def rubric_averages(spark, d):
    own = t(spark, d, "labels").join(t(spark, d, "documents").select("doc_id", "source"), "doc_id").select("source", (F.col("quality") * 5.0).alias("x"), (F.col("toxic") * 5.0).alias("y"))
    s = evaluation.score_stats(own, ["source"], "x").join(evaluation.score_stats(own, ["source"], "y").select("source", F.col("mean_score").alias("my")), "source")
    return s.select("source", r6(F.col("mean_score")).alias("clarity"), r6(F.col("my")).alias("coherence"), r6(F.col("mean_score") + F.col("my")).alias("total"))


@query("""SELECT label, count(*) AS n, any_value(d) AS mean_distance FROM embeddings JOIN (
SELECT a.label, round(avg(sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) * (z[1]::DOUBLE - z[2]::DOUBLE))))), 6) AS d
FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id GROUP BY a.label) USING (label) GROUP BY label""")
def pairwise_distance(spark, d):
    return evaluation.mean_pairwise_distance(t(spark, d, "embeddings"), "label", "embedding", 128).select("label", "n", r6(F.col("mean_distance")).alias("mean_distance"))


RANKED = DENSE + ", rk AS (SELECT query_id, id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id))::INT AS rank, score FROM dense), ex AS (SELECT query_id, max(id) AS id FROM rk WHERE rank <= 8 GROUP BY 1)"


def _ranked(spark, d) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return _dense(spark, d).withColumn("rank", F.row_number().over(w))


def _hits(spark, d) -> DataFrame:
    ranked = _ranked(spark, d)
    return evaluation.hits_at_k(ranked, ranked.where("rank <= 8").groupBy("query_id").agg(F.max("id").alias("id")))


@query(f"WITH {RANKED} SELECT ex.query_id, rank <= 1 AS hit_1, rank <= 3 AS hit_3, rank <= 5 AS hit_5, rank <= 10 AS hit_10 FROM ex JOIN rk ON ex.query_id = rk.query_id AND ex.id = rk.id")
def hits_at_k(spark, d):
    return _hits(spark, d)


@query(f"""WITH {RANKED}, h AS (SELECT rank FROM ex JOIN rk ON ex.query_id = rk.query_id AND ex.id = rk.id)
SELECT count(*) AS n_queries, {', '.join(f'round(count(*) FILTER (rank <= {k}) / count(*)::DOUBLE, 6) AS recall_{k}, round(count(*) FILTER (rank <= {k}) / count(*)::DOUBLE / {k}, 6) AS precision_{k}' for k in (1, 3, 5, 10))} FROM h""")
def precision_recall_k(spark, d):
    pr = evaluation.precision_recall(_hits(spark, d))
    return pr.select("n_queries", *[r6(F.col(c)).alias(c) for c in pr.columns[1:]])


@query(f"WITH {RANKED} SELECT query_id, round(avg(score), 6) AS mean_score, round(stddev_pop(score), 6) AS std_score, count(*) AS n FROM rk WHERE rank <= 10 GROUP BY 1")
def score_stats(spark, d):
    s = evaluation.score_stats(_ranked(spark, d).where("rank <= 10"), ["query_id"])
    return s.select("query_id", r6(F.col("mean_score")).alias("mean_score"), r6(F.col("std_score")).alias("std_score"), "n")


@query(f"""WITH {RANKED}, x AS (SELECT rk.query_id, rank, (a.label = b.label)::INT AS rel FROM rk JOIN embeddings a ON a.vec_id = rk.query_id JOIN embeddings b ON b.vec_id = rk.id WHERE rank <= 10),
i AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rel DESC, rank) AS ir FROM x)
SELECT query_id, round(CASE WHEN sum(rel / log2(ir + 1.0e0)) > 0 THEN sum(rel / log2(rank + 1.0e0)) / sum(rel / log2(ir + 1.0e0)) ELSE 0 END, 6) AS ndcg FROM i GROUP BY 1""")
def ndcg_at_10(spark, d):
    e = t(spark, d, "embeddings")
    label = lambda k, name: e.select(F.col("vec_id").alias(k), F.col("label").alias(name))
    rel = _ranked(spark, d).join(label("query_id", "a"), "query_id").join(label("id", "b"), "id").withColumn("relevance", (F.col("a") == F.col("b")).cast("int"))
    return evaluation.ndcg(rel).select("query_id", r6(F.col("ndcg")).alias("ndcg"))


MATCHES = "m AS (SELECT source, l.doc_id, CASE WHEN toxic = 1 THEN 0.5e0 ELSE quality::DOUBLE END AS score, row_number() OVER (PARTITION BY source ORDER BY l.doc_id) AS k FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"


def _matches(spark, d) -> DataFrame:
    score = F.when(F.col("toxic") == 1, F.lit(0.5)).otherwise(F.col("quality").cast("double"))
    return t(spark, d, "labels").join(t(spark, d, "documents").select("doc_id", "source"), "doc_id").select("source", "doc_id", score.alias("score"))


@query(f"""WITH RECURSIVE {MATCHES}, r AS (SELECT source, 0::BIGINT AS k, 1500.0e0 AS a, 1500.0e0 AS b FROM (SELECT DISTINCT source FROM m)
UNION ALL SELECT r.source, m.k, r.a + 32.0e0 * (m.score - 1 / (1 + pow(10.0e0, (r.b - r.a) / 400))), r.b - 32.0e0 * (m.score - 1 / (1 + pow(10.0e0, (r.b - r.a) / 400))) FROM r JOIN m ON m.source = r.source AND m.k = r.k + 1)
SELECT source, round(arg_max(a, k), 6) AS rating_a, round(arg_max(b, k), 6) AS rating_b, max(k)::INT AS n_matches FROM r GROUP BY source""")
def elo_ratings(spark, d):
    return evaluation.elo(_matches(spark, d), ["source"], "doc_id", "score").select("source", r6(F.col("rating_a")).alias("rating_a"), r6(F.col("rating_b")).alias("rating_b"), "n_matches")


@query(f"""WITH {MATCHES} SELECT source, count(*) AS n_matches, count(*) FILTER (score > 0.5) AS wins_a, count(*) FILTER (score < 0.5) AS wins_b,
round(count(*) FILTER (score > 0.5) / count(*)::DOUBLE, 3) AS win_rate_a, round(1.96e0 * stddev_samp(score) / sqrt(count(*)), 6) AS confidence FROM m GROUP BY source""")
def elo_summary(spark, d):
    s = evaluation.elo_summary(_matches(spark, d), ["source"], "score")
    return s.withColumn("confidence", r6(F.col("confidence")))


@query(r"""WITH a AS (SELECT conv_id, list(role ORDER BY turn) FILTER (turn < 2) AS o, list(role || (turn % 3)::VARCHAR ORDER BY turn) || list(role ORDER BY turn) AS n FROM conversations GROUP BY 1)
SELECT conv_id, array_to_string(coalesce(o, []) || list_filter(n, lambda x: NOT list_contains(coalesce(o, []), x)), ',') AS questions FROM a""")
def question_merge(spark, d):
    ordered = lambda c, cond: F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("turn", c.alias("v"))))), lambda s: s["v"])
    own = t(spark, d, "conversations").groupBy("conv_id").agg(
        ordered(F.col("role"), F.col("turn") < 2).alias("o"), F.concat(ordered(F.concat("role", (F.col("turn") % 3).cast("string")), F.lit(True)), ordered(F.col("role"), F.lit(True))).alias("n")
    )
    return own.select("conv_id", F.array_join(evaluation.merged_questions(F.col("o"), F.col("n")), ",").alias("questions"))


@query("SELECT label, (i - 1)::INT AS pos, round(avg(x::DOUBLE), 6) AS mean FROM (SELECT label, unnest(embedding) AS x, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) GROUP BY 1, 2")
def vector_mean_pool(spark, d):
    return vectors.mean_pool(t(spark, d, "embeddings"), ["label"], "embedding").withColumn("mean", r6(F.col("mean")))


@query(r"""SELECT conv_id, sum(n)::BIGINT AS tokens, round(sum(n * CASE role WHEN 'user' THEN 0.5e0 WHEN 'assistant' THEN 1.5e0 ELSE 0 END), 6) AS cost FROM (SELECT conv_id, role, len(regexp_extract_all(text, '\S+')) AS n FROM conversations) GROUP BY 1""")
def cost_rollup(spark, d):
    usage = t(spark, d, "conversations").select("conv_id", F.col("role").alias("model"), F.size(tx.words(F.col("text"))).cast("long").alias("tokens"))
    prices = spark.createDataFrame([("user", 0.5), ("assistant", 1.5)], "model string, unit_price double")
    return evaluation.cost(usage, prices, ["conv_id"]).withColumn("cost", r6(F.col("cost")))


@query("SELECT doc_id, CASE WHEN k < 49 THEN 'academia' WHEN k < 89 THEN 'finance' WHEN k < 133 THEN 'government' WHEN k < 179 THEN 'laws' ELSE 'news' END AS kind FROM (SELECT doc_id, doc_id % 229 AS k FROM documents)")
def number_ranges(spark, d):
    kinds = spark.createDataFrame([(0, 49, "academia"), (49, 89, "finance"), (89, 133, "government"), (133, 179, "laws"), (179, 229, "news")], "lo int, hi int, kind string")
    rows = t(spark, d, "documents").select("doc_id", (F.col("doc_id") % 229).alias("k"))
    return rows.join(F.broadcast(kinds), (F.col("k") >= F.col("lo")) & (F.col("k") < F.col("hi"))).select("doc_id", "kind")


@query("SELECT label, n AS size, (row_number() OVER (ORDER BY n DESC, label))::INT AS place FROM (SELECT label, count(*) AS n FROM embeddings GROUP BY label)")
def cluster_organize(spark, d):
    return features.organized(t(spark, d, "embeddings"), "label")


@query()
def gmm_soft_assign(spark, d):
    rows = features.reduced(t(spark, d, "embeddings").select("vec_id", "embedding"), "embedding")
    return features.soft_clusters(rows.select("vec_id", "reduced"), "reduced").select("vec_id", "cluster", r6(F.col("probability")).alias("probability"))


@query()
def embed_documents(spark, d):
    return features.embed(t(spark, d, "documents").select("doc_id", "text"), "text").select("doc_id", "embedding")


@query("SELECT doc_id, trim(string_split(text, '. ')[1]) AS string, 'synthetic_summary' AS embedded_feature_type, doc_id::VARCHAR AS target_uuid FROM documents")
def summarize_entries(spark, d):
    rows = features.complete(t(spark, d, "documents").select("doc_id", "text"), F.col("text"), "summary")
    out = features.summary_entries(rows, "doc_id", "text", "summary")
    return out.select(F.col("citation.target_uuid").cast("long").alias("doc_id"), "string", "embedded_feature_type", F.col("citation.target_uuid").alias("target_uuid"))


@query("SELECT vec_id, label FROM embeddings WHERE label = 3 ORDER BY vec_id LIMIT 200")
def vector_scroll(spark, d):
    """A page of a collection's listing; the limit of 200 is what a page is."""
    return files.vector_rows(t(spark, d, "embeddings"), {"label": 3})


@query("""SELECT c.source, string_agg(DISTINCT n.n_name, ',' ORDER BY n.n_name) AS keywords, count(DISTINCT c.cluster) AS n_clusters
FROM (SELECT source, length(text) % 25 AS cluster FROM documents) c JOIN nation n ON n.n_nationkey = c.cluster GROUP BY c.source""")
def cluster_keywords(spark, d):
    members = t(spark, d, "documents").select("source", (F.length("text") % 25).alias("cluster"))
    labels = t(spark, d, "nation").select(F.col("n_nationkey").alias("cluster"), F.col("n_name").alias("label"))
    return features.keywords_of(members, labels, "source", "cluster").select("source", F.array_join("keywords", ",").alias("keywords"), "n_clusters")


@query("""SELECT doc_id, 2 AS n_messages, 'user' AS last_role, sha256('Summarize: ' || text) AS content_hash FROM documents""")
def chat_prompts(spark, d):
    m = features.chat_prompt("You sum up documents.", F.concat(F.lit("Summarize: "), "text"))
    rows = t(spark, d, "documents").select("doc_id", m.alias("m"))
    return rows.select("doc_id", F.size("m").alias("n_messages"), F.element_at("m", -1)["role"].alias("last_role"), F.sha2(F.element_at("m", -1)["content"], 256).alias("content_hash"))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'unreadable' WHEN doc_id % 3 = 1 THEN 'A' ELSE '' END AS winner, CASE WHEN doc_id % 3 = 1 THEN lang ELSE 'none' END AS reasoning FROM documents""")
def parse_answers(spark, d):
    k = F.col("doc_id") % 3
    answer = F.when(k == 0, F.lit("not JSON")).when(k == 1, F.to_json(F.struct(F.lit("A").alias("winner"), F.col("lang").alias("reasoning")))).otherwise(F.to_json(F.struct(F.lit("").alias("winner"))))
    parsed = features.parsed_answer(answer, "winner STRING, reasoning STRING", {"winner": "unreadable", "reasoning": "none"})
    return t(spark, d, "documents").select("doc_id", parsed["winner"].alias("winner"), parsed["reasoning"].alias("reasoning"))


@query("""SELECT dataset, id, page_id, document_id, sha256(query) AS query_hash, length(query)::BIGINT AS query_length FROM (
SELECT 'a' AS dataset, item_id AS id, text AS query, 0 AS page_id, string_split('file' || item_id || '.tar.gz', '.')[1] AS document_id FROM benchmark
UNION ALL SELECT 'b', doc_id, text, (doc_id % 9)::INT, source FROM documents)""")
def dataset_harmonize(spark, d):
    """Whole texts, shown by length and digest."""
    rows = harmonized_questions(spark, d)
    return rows.select("dataset", "id", "page_id", "document_id", F.sha2("query", 256).alias("query_hash"), F.char_length("query").cast("long").alias("query_length"))


def harmonized_questions(spark, d):
    a = files.question_rows(t(spark, d, "benchmark"), "a", F.col("item_id"), F.col("text"), F.lit(0), F.substring_index(F.concat(F.lit("file"), "item_id", F.lit(".tar.gz")), ".", 1))
    b = files.question_rows(t(spark, d, "documents"), "b", F.col("doc_id"), F.col("text"), F.col("doc_id") % 9, F.col("source"))
    return a.unionByName(b)


# ---- streams, run as tables here; tests run them as streams too


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def events_tumbling(spark, d):
    out = incremental.tumbling(incremental.event_time(t(spark, d, "events")), "1 hour", ["event_type"], "value")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("""WITH g AS (SELECT *, coalesce((ts - lag(ts) OVER w >= INTERVAL 2 HOUR)::INT, 0) AS cut FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(cut) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 2 HOUR AS session_end, count(*) AS n FROM s GROUP BY user_id, k""")
def events_session(spark, d):
    out = incremental.sessions(incremental.event_time(t(spark, d, "events")), "2 hours", ["user_id"])
    return out.select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), F.col("session_end").cast("timestamp_ntz").alias("session_end"), "n")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(spark, d):
    return incremental.first_seen(incremental.event_time(t(spark, d, "events")), ["user_id", "event_type"]).select("user_id", "event_type")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to chunks with provenance to metrics per language."""
    return chunk_metrics(spark, sf_dir)


from docloom import more_queries  # noqa: E402, F401  adds to QUERIES and ORACLES
