"""The operators that pipelines can name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import web
from docloom.operators import blocks, chunking, crawl, extraction, features, filters, merge
from docloom.plans import prompts as prompts
from docloom.plans.registry import PROMPTS, operator
from docloom.schemas import validate
from docloom.sources import files


@operator("load", "local")
def local(spark: SparkSession, df: DataFrame | None, directory_path, ending_with: str = "", added_metadata: dict | None = None) -> DataFrame:
    return filters.overlay(files.scan_files(spark, directory_path, ending_with), added_metadata or {}, {})


@operator("load", "s3")
def s3(spark: SparkSession, df: DataFrame | None, bucket: str, prefixes: list[str], ending_with: str = "", added_metadata: dict | None = None) -> DataFrame:
    return filters.overlay(files.scan_files(spark, [f"s3a://{bucket}/{p}" for p in prefixes], ending_with, "s3"), added_metadata or {}, {})


@operator("load", "table")
def table(spark: SparkSession, df: DataFrame | None, path: str) -> DataFrame:
    return spark.read.parquet(path)


@operator("load", "pages")
def pages(spark: SparkSession, df: DataFrame | None, path: str) -> DataFrame:
    """Fetched pages (url, html): one document per normalized URL, hashed by content."""
    rows = spark.read.parquet(path).withColumn("public_url", web.normalized(F.col("url")))
    first = rows.groupBy("public_url").agg(F.min(F.struct("url", "html")).alias("p"))
    return first.select(F.sha2(F.coalesce("p.html", F.lit("")), 256).alias("document_hash"), "public_url", web.title(F.col("p.html")).alias("document_title"), F.col("p.html").alias("text"), F.lit("html").alias("file_type"), F.lit("url_scrape").alias("load_method"))


@operator("load", "manual_links")
def manual_links(spark: SparkSession, df: DataFrame | None, links: list[str], path: str) -> DataFrame:
    """Pages of the given URLs and the PDF files they link to, from a table of what was fetched (url, html): a fetcher fills it, this reads it."""
    wanted = spark.createDataFrame([(u,) for u in links], "url string").select(web.normalized(F.col("url")).alias("public_url")).distinct()
    rows = spark.read.parquet(path).withColumn("public_url", web.normalized(F.col("url"))).join(wanted, "public_url", "left_semi")
    own = rows.groupBy("public_url").agg(F.min("html").alias("text")).select("public_url", web.title(F.col("text")).alias("document_title"), "text", F.lit("html").alias("file_type"))
    files_ = crawl.pdf_links(rows.select("url", "html")).select(F.col("pdf_url").alias("public_url"), F.col("title").alias("document_title"), F.lit(None).cast("string").alias("text"), F.lit("pdf").alias("file_type")).dropDuplicates(["public_url"])
    hashed = F.sha2(F.coalesce("text", "public_url"), 256)
    return own.unionByName(files_).select(hashed.alias("document_hash"), "public_url", "document_title", "text", "file_type", F.lit("url_scrape").alias("load_method"))


@operator("extract", "simple")
def simple(spark: SparkSession, df: DataFrame, key: str = "document_hash", text: str = "text") -> DataFrame:
    return extraction.split_pages(df, key, text).withColumn("consolidated_feature_type", F.lit("text"))


@operator("extract", "layout")
def layout(spark: SparkSession, df: DataFrame, key: str = "document_hash", json: str = "text", mode: str = "by_page") -> DataFrame:
    blocks = extraction.parsed_blocks(df, key, json)
    return extraction.entries_by_page(blocks, key) if mode == "by_page" else extraction.entries_by_title(blocks, key)


@operator("extract", "html_passages")
def html_passages(spark: SparkSession, df: DataFrame, key: str = "document_hash", html: str = "text", most_words: int = 220) -> DataFrame:
    return extraction.html_passages(df, key, html, most_words)


@operator("chunk", "sliding_window")
def sliding_window(spark: SparkSession, df: DataFrame, chunk_size: int = 500, overlap: int = 50, key: str = "document_hash", order: str = "page") -> DataFrame:
    whole, spans = chunking.joined_entries(df, [key], order, "text")
    chunks = chunking.sliding_words(whole, [key], "text", chunk_size, overlap)
    return chunks.join(chunking.contributors(chunks, spans, [key], order), [key, "chunk_index"])


@operator("chunk", "topic_segmentation")
def topic_segmentation(spark: SparkSession, df: DataFrame, key: str = "document_hash") -> DataFrame:
    return chunking.topic_segments(df, [key])


@operator("featurize", "summarize")
def summarize(spark: SparkSession, df: DataFrame, text: str = "chunk_text", filter_params: dict | None = None) -> DataFrame:
    return filters.pass_through(df, filter_params or {}, lambda d: features.complete(d, F.col(text), "summary"))


@operator("embed", "embed")
def embed(spark: SparkSession, df: DataFrame, text: str = "chunk_text", filter_params: dict | None = None) -> DataFrame:
    return filters.pass_through(df, filter_params or {}, lambda d: features.embed(d, text))


@operator("extract", "nested_blocks")
def nested_blocks(spark: SparkSession, df: DataFrame, key: str = "document_hash", json: str = "text", mode: str = "by_page") -> DataFrame:
    return blocks.block_entries(blocks.nested_blocks(df, key, json), key, mode == "by_title")


@operator("extract", "recognized")
def recognized(spark: SparkSession, df: DataFrame, key: str = "document_hash", json: str = "text") -> DataFrame:
    return blocks.recognized_elements(df, key, json)


@operator("chunk", "distance_chunking")
def distance_chunking(spark: SparkSession, df: DataFrame, key: str = "document_hash", order: str = "page", text: str = "text", percentile_threshold: float = 95.0, threshold: float | None = None, chunk_size: int | None = None) -> DataFrame:
    """Units are sentences or, with chunk_size, runs of so many words; they are embedded by the default embedder."""
    if chunk_size:
        return chunking.distance_chunks_of_words(df, [key], order, text, lambda units: features.embed(units, "unit"), chunk_size, percentile_threshold, threshold)
    return chunking.distance_chunks(df, [key], order, text, lambda units: features.embed(units, "unit"), percentile_threshold, threshold)


@operator("chunk", "generative")
def generative(spark: SparkSession, df: DataFrame, key: str = "document_hash", order: str = "page", text: str = "text", most_words: int = 500) -> DataFrame:
    """Answers come from the default model."""
    return chunking.generative_chunks(df, [key], order, text, lambda d, prompt: features.complete(d, prompt, "answer"), most_words)


@operator("featurize", "featurize_model")
def featurize_model(spark: SparkSession, df: DataFrame, prompt_name: str, text: str = "chunk_text", items: str = "items", filter_params: dict | None = None) -> DataFrame:
    """Asks the default model with a registered prompt; a row for each item of its answer."""
    made = PROMPTS[prompt_name]
    return features.featurized(df, made.messages(F.col(text))[1]["content"], features.first_sentence, items, filter_params)


@operator("featurize", "get_clusters")
def get_clusters(spark: SparkSession, df: DataFrame, key: str = "uuid", vector: str = "embedding", dimensions: int = 20) -> DataFrame:
    """Adds clusters, the sorted numbers of the clusters inside clusters that a row is in; rows without a vector have none."""
    found = features.nested_clusters(df, key, vector, dimensions).groupBy(key).agg(F.array_sort(F.collect_set("cluster")).alias("clusters"))
    return df.join(found, key, "left").withColumn("clusters", F.coalesce("clusters", F.array().cast("array<int>")))


def next_version(spark: SparkSession, path: str) -> tuple[str | None, str]:
    """(folder of the newest version, folder of the next): versions are folders v=1, v=2, ... below path; one counts once it has been written whole."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    known = [0]
    if system.exists(folder):
        for status in system.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith("v=") and system.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                known.append(int(name[2:]))
    last = max(known)
    base = path.rstrip("/")
    return f"{base}/v={last}" if last else None, f"{base}/v={last + 1}"


def merged_into(spark: SparkSession, path: str, incoming: DataFrame, keys: list[str], seq: str, update: bool) -> DataFrame:
    """Merges into the table of versions at path and returns the new version with its actions. The version before stays whole, whatever happens on the way."""
    last, new = next_version(spark, path)
    existing = spark.read.parquet(last).drop("action") if last else incoming.drop(seq).limit(0)
    merge.merge(existing, incoming, keys, seq, update).write.mode("overwrite").parquet(new)
    return spark.read.parquet(new)


@operator("upsert", "upsert_entries")
def upsert_entries(spark: SparkSession, df: DataFrame, path: str, keys: list[str], update_on_collision: bool = False, order: str | None = None, text: str | None = None, required: list[str] | None = None, edges: str | None = None, ref: str = "ref") -> DataFrame:
    """Merges into the table of versions at path and returns the actions. Of rows with one key the last by order counts (by all values, if no order is given; rows with maps need one).

    With text, rows get the content_hash of that column, which keys may name.
    Rows without what is required go to a table below path/rejected instead. edges is a table
    (source_ref, target_ref, relationship_type); both ends are looked up by
    column ref among these rows, then in what is stored, and those found are
    added once to the table of versions at path/edges.
    """
    good, bad = validate(df, required=tuple(required or ()))
    good = good.withColumn("content_hash", merge.content_hash(F.col(text))) if text else good
    before, new = next_version(spark, path)
    if required:
        bad.write.mode("overwrite").parquet(f"{path.rstrip('/')}/rejected/{new.rpartition('/')[2]}")
    seq = good.withColumn("_seq", F.col(order) if order else F.xxhash64(*good.columns))
    merged = merged_into(spark, path, seq, keys, "_seq", update_on_collision)
    if edges:
        stored = spark.read.parquet(before) if before else merged.limit(0)
        found = merge.resolved_edges(spark.read.parquet(edges), merge.last_per_key(seq, keys, "_seq"), stored, ref)
        merged_into(spark, f"{path.rstrip('/')}/edges", found.withColumn("_seq", F.lit(0)), ["source_uuid", "target_uuid", "relationship_type"], "_seq", False)
    return merged


@operator("upsert", "upsert_embeddings")
def upsert_embeddings(spark: SparkSession, df: DataFrame, path: str, key: str = "uuid", collection_name: str = "") -> DataFrame:
    """Rows with a vector, merged into the collection's table of versions at path; the others are left out."""
    has = df.where(F.coalesce(F.size("embedding") > 0, F.lit(False))).withColumn("_seq", F.xxhash64(*df.columns))
    return merged_into(spark, path, has, [key], "_seq", True)
