"""Dense, sparse and hybrid retrieval, and what is done with the hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.functions.arrays import folded, rows_of
from docloom.functions.vectors import mean_pool
from docloom.operators.chunking import token_crops
from docloom.operators.dense_index import dense_top_k
from docloom.operators.sparse_index import Weighing, build_index, search_index


def bm25_top_k(docs: DataFrame, queries: DataFrame, k: int = 10, doc: tuple[str, str] = ("doc_id", "text"), query: tuple[str, str] = ("item_id", "text"), k1: float = 1.2, b: float = 0.75, average: float = 256.0, digits: int = 6) -> DataFrame:
    """(query_id, id, score, rank): the k documents with the highest BM25 score for the distinct terms of each query, by an index that is built for this search.

    For more than one search of the same documents, build the index once
    (sparse_index.build_index) and use sparse_index.search_index.
    """
    return search_index(build_index(docs, *doc, weighing=Weighing(k1, b, average)), queries, k, query, digits)


def hybrid(dense: DataFrame, sparse: DataFrame) -> DataFrame:
    """Hits (query_id, id, score, rank, channel) of both channels; of a query's hits on one id the dense one counts, else the best rank."""
    both = dense.select("query_id", "id", "score", "rank", F.lit("dense").alias("channel")).unionByName(sparse.select("query_id", "id", "score", "rank", F.lit("sparse").alias("channel")))
    w = Window.partitionBy("query_id", "id").orderBy("channel", "rank")
    return both.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def format_points(hits: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Hits that reach the threshold (equal passes), with the text of their id; hits without text are left out."""
    return hits.where(F.col("score") >= least).join(texts.where(F.length("text") > 0), "id").withColumn("rerank_score", F.lit(0.0))


def parsed_points(hits: DataFrame, payloads: DataFrame, texts: DataFrame, least: float = 0.0, flatten: bool = False) -> DataFrame:
    """Hits as points: (query_id, id, score, title, date, raw_text, ...).

    payloads (id, payload) hold JSON of the hit's document; hits whose payload
    can't be read are left out. The title falls back to the content type. With
    flatten a point counts once however many queries found it: with the best score.
    """
    kind = "document_title STRING, content_type STRING, load_date TIMESTAMP, public_url STRING"
    read = payloads.select("id", F.from_json("payload", kind + ", _broken STRING", {"columnNameOfCorruptRecord": "_broken"}).alias("p")).where("p is not null and p._broken is null")
    own = read.select("id", F.coalesce("p.document_title", "p.content_type").alias("title"), F.col("p.load_date").alias("date"), F.col("p.public_url").alias("public_url"))
    points = format_points(hits, texts, least).join(own, "id").withColumnRenamed("text", "raw_text")
    if not flatten:
        return points
    rest = [c for c in points.columns if c not in ("id", "query_id")]
    return points.groupBy("id").agg(F.max_by(F.struct(*rest), F.struct("score", -F.col("query_id"))).alias("_p")).select("id", *[F.col(f"_p.{c}").alias(c) for c in rest])


def query_vectors(queries: DataFrame, query_id: str, text: str, tokenize, embed, size: int = 512, overlap: int = 0) -> DataFrame:
    """(query_id, embedding): queries cut into crops of size tokens, each embedded, and the vectors of a query averaged.

    tokenize(column) gives an array of token numbers, embed(df) adds column
    embedding from column tokens.
    """
    crops = queries.select(F.col(query_id).alias("query_id"), F.explode(token_crops(tokenize(F.col(text)), size, overlap)).alias("tokens"))
    mean = mean_pool(embed(crops).where("embedding is not null"), ["query_id"], "embedding")
    return mean.groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "mean"))), lambda s: s["mean"]).alias("embedding"))


def hybrid_retrieval(corpus: DataFrame, docs: DataFrame, vectors: DataFrame, queries: DataFrame, k: int = 10, condition: Column | None = None, least: float = 0.0) -> DataFrame:
    """Dense and sparse search of the same queries and collection as one operator: (query_id, id, score, rank, channel, text).

    corpus holds (id, embedding ...), docs (id, text), vectors (query_id,
    embedding), queries (query_id, text); condition is on corpus, and hits of
    the sparse channel have to be in what it leaves.
    """
    allowed = corpus.where(condition) if condition is not None else corpus
    dense = dense_top_k(allowed, vectors, k, ("id", "query_id"))
    texts = docs.join(allowed.select("id"), "id", "left_semi") if condition is not None else docs
    sparse = bm25_top_k(texts, queries, k, ("id", "text"), ("query_id", "text"))
    return format_points(hybrid(dense, sparse), docs.select("id", "text"), least)


def citation_numbers(points: DataFrame, document: str, order: list[str]) -> DataFrame:
    """Adds citation: 1 for the document that appears first in the query's order, 2 for the next, and so on."""
    first = points.groupBy("query_id", document).agg(F.min(F.struct(*order)).alias("_first"))
    number = F.row_number().over(Window.partitionBy("query_id").orderBy("_first", document))
    return points.join(first.select("query_id", document, number.alias("citation")), ["query_id", document])


def rerank(points: DataFrame, scores: DataFrame, least: float) -> DataFrame:
    """Sets rerank_score where a score of at least the threshold is known; nothing is dropped or sorted."""
    s = scores.select("id", F.col("new_score").cast("double").alias("_s"))
    return points.join(s, "id", "left").withColumn("rerank_score", F.when(F.col("_s") >= least, F.col("_s")).otherwise(F.col("rerank_score"))).drop("_s")


def adjacent(a: str, b: str) -> Column:
    """Whether b follows a: on one page by the next region (or if either has none); on the next page unless b's region is after a's."""
    same, nxt = F.col(f"{b}.primary") == F.col(f"{a}.primary"), F.abs(F.col(f"{b}.primary") - F.col(f"{a}.primary")) == 1
    both = F.col(f"{a}.secondary").isNotNull() & F.col(f"{b}.secondary").isNotNull()
    on_page = F.when(both, F.abs(F.col(f"{b}.secondary") - F.col(f"{a}.secondary")) == 1).otherwise(F.lit(True))
    over_page = F.when(both, ~(F.col(f"{a}.secondary") < F.col(f"{b}.secondary"))).otherwise(F.lit(True))
    return (same & on_page) | (nxt & over_page)


def merge_context(points: DataFrame, keys: list[str], order: str = "primary", least: int = 11) -> DataFrame:
    """Trims what neighbouring hits of a document share: the longest suffix of one that the next begins with, from the one with the lower score (tie: the second).

    Adds edge (characters shared with the hit before) and merged (the text left).
    """
    w = Window.partitionBy(*keys).orderBy(order)
    near = F.struct("primary", "secondary")
    out = points.withColumns({"_prev": F.lag(near).over(w), "_self": near, "_ptext": F.lag("text").over(w), "_pscore": F.lag("score").over(w), "_nscore": F.lead("score").over(w)})
    edge = F.when(F.col("_ptext").isNotNull() & adjacent("_prev", "_self"), tx.shared_edge(F.col("_ptext"), F.col("text"), least)).otherwise(F.lit(0))
    out = out.withColumn("edge", F.coalesce(edge, F.lit(0)))
    front = F.when(F.col("score") <= F.col("_pscore"), F.col("edge")).otherwise(F.lit(0))
    back = F.when(F.col("score") < F.col("_nscore"), F.lead("edge").over(w)).otherwise(F.lit(0))
    out = out.withColumns({"_front": F.coalesce(front, F.lit(0)), "_back": F.coalesce(back, F.lit(0))})
    left = F.greatest(F.length("text") - F.col("_front") - F.col("_back"), F.lit(0))
    merged = F.trim(F.col("text").substr(F.col("_front") + 1, left))
    return out.withColumn("merged", merged).drop("_prev", "_self", "_ptext", "_pscore", "_nscore", "_front", "_back")


def indexed_sentences(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, sentence_no from 1, sentence) without [n] marks."""
    rows = rows_of(docs, [key], tx.sentences(tx.strip_citations(F.col(text))), "_n", "sentence")
    return rows.select(key, (F.col("_n") + 1).alias("sentence_no"), "sentence")


def citation_groups(cited: DataFrame, keys: list[str], number: str) -> DataFrame:
    """(keys, lo, hi, n): runs of consecutive numbers, each number counted once."""
    once = cited.select(*keys, number).distinct()
    run = once.withColumn("_g", F.col(number) - F.row_number().over(Window.partitionBy(*keys).orderBy(number)))
    return run.groupBy(*keys, "_g").agg(F.min(number).alias("lo"), F.max(number).alias("hi"), F.count(F.lit(1)).alias("n")).drop("_g")


def highlights(groups: DataFrame, docs: DataFrame, key: str = "id", around: int = 0) -> DataFrame:
    """groups (key, lo, hi, ...) of sentence numbers, with citation_text and highlights (start, end): where its sentences stand in the text of docs (key, text).

    around widens a group by so many sentences on both sides. Positions are
    characters, end exclusive. Sentences stand in the text one after the other,
    so each one's place follows from where the last one ended.
    """
    def places(text: Column) -> Column:
        pieces = F.split(text, r"(?<=[.!?])\s+")
        gaps = F.regexp_extract_all(text, F.lit(r"(?<=[.!?])\s+"), F.lit(0))
        both = F.arrays_zip(pieces.alias("s"), gaps.alias("g"))
        step = lambda at, p: (at + F.length(p["s"]) + F.coalesce(F.length(p["g"]), F.lit(0)), F.when(p["s"] != "", F.struct(at.cast("int").alias("start"), (at + F.length(p["s"])).cast("int").alias("end"), p["s"].alias("s"))))
        return folded(both, F.lit(0).cast("bigint"), step, "struct<start: int, end: int, s: string>")

    both = groups.join(docs.select(key, places(F.col("text")).alias("_s")), key)
    low = F.greatest(F.col("lo") - around, F.lit(1))
    both = both.withColumn("_s", F.slice("_s", low.cast("int"), (F.col("hi") + around - low + 1).cast("int")))
    marks = F.transform("_s", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return both.withColumns({"citation_text": F.array_join(F.transform("_s", lambda s: s["s"]), " "), "highlights": marks}).drop("_s")


def annotated(sentences: DataFrame, cited: DataFrame, key: str, number: str = "sentence_no") -> DataFrame:
    """Sentences with their citation numbers behind them: sentence [1][2]. Each number once, in order."""
    marks = cited.groupBy(key, number).agg(F.array_join(F.transform(F.array_sort(F.collect_set("citation")), lambda c: F.concat(F.lit("["), c.cast("string"), F.lit("]"))), "").alias("_m"))
    both = sentences.join(marks, [key, number], "left")
    return both.select(key, number, F.concat_ws(" ", "sentence", "_m").alias("annotated"))


def rerank_remote(points: DataFrame, score, top_n: int = 10) -> DataFrame:
    """The top_n points of each query by a model's score. score(df) adds new_score from query_text and text; null counts as 0."""
    scored = score(points).withColumn("rerank_score", F.coalesce(F.col("new_score").cast("double"), F.lit(0.0))).drop("new_score")
    w = Window.partitionBy("query_id").orderBy(F.col("rerank_score").desc(), F.col("score").desc(), "id")
    return scored.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= top_n).drop("_n")


def upsert_vectors(stored: DataFrame, incoming: DataFrame, key: str, seq: str) -> tuple[DataFrame, DataFrame]:
    """(collection after the merge, rows left out for want of a vector)."""
    from docloom.operators.merge import merge

    has = F.coalesce(F.size("embedding") > 0, F.lit(False))
    return merge(stored, incoming.where(has), [key], seq), incoming.where(~has)
