"""Scans: directories of files, text corpora, JSON lines, CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# MIME types and file types by extension; unknown MIME types count as pdf.
MIME_TYPES = {
    "application/pdf": "pdf", "text/plain": "txt", "text/html": "html", "text/markdown": "md", "application/json": "json", "application/xml": "xml", "text/csv": "csv",
    "text/tab-separated-values": "tsv", "application/sql": "sql", "application/x-yaml": "yaml", "application/toml": "toml", "video/mp4": "mp4", "audio/mpeg": "mp3", "audio/wav": "wav",
    "image/jpeg": "jpeg", "image/png": "png", "image/gif": "gif", "image/svg+xml": "svg", "video/webm": "webm",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "docx", "application/vnd.openxmlformats-officedocument.presentationml.presentation": "pptx",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": "xlsx", "application/vnd.oasis.opendocument.text": "odt", "application/vnd.oasis.opendocument.spreadsheet": "ods",
    "application/vnd.oasis.opendocument.presentation": "odp",
}
EXTENSIONS = {"doc": "docx", "ppt": "pptx", "xls": "xlsx", "htm": "html", "yml": "yaml", "text": "txt", "markdown": "md"}
KNOWN = tuple("pdf docx pptx xlsx txt html md json xml csv tsv sql yaml toml mp4 mp3 wav jpg jpeg png gif svg webm odt ods odp".split())


def mapping(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def file_type(path: Column) -> Column:
    """By the last extension of the last path part; txt if it is none of the known ones."""
    extension = F.lower(F.regexp_extract(path, r"\.([^./?#]+)(?:[?#].*)?$", 1))
    known = F.coalesce(F.try_element_at(mapping(EXTENSIONS), extension), extension)
    return F.when(known.isin(*KNOWN), known).otherwise("txt")


def mime_file_type(mime: Column) -> Column:
    return F.coalesce(F.try_element_at(mapping(MIME_TYPES), F.lower(mime)), F.lit("pdf"))


def document_rows(files: DataFrame, method: str, run_ts: str) -> DataFrame:
    """Document rows from (path, modificationTime, length, content)."""
    return files.select(
        F.sha2("content", 256).alias("document_hash"), F.regexp_extract("path", r"([^/]+)$", 1).alias("document_title"), F.lit("internal").alias("scope"), F.lit("other").alias("content_type"),
        F.col("modificationTime").alias("creation_date"), file_type(F.col("path")).alias("file_type"), F.col("path").alias("file_path"), F.col("length").alias("file_size"),
        F.lit(method).alias("load_method"), F.lit(run_ts).cast("timestamp").alias("load_date"),
    )


def scan_files(spark: SparkSession, paths: str | list[str], ending_with: str = "", method: str = "local_file", run_ts: str = "2024-01-01 00:00:00") -> DataFrame:
    """One document row per file under the given absolute paths or URIs, recursively; hidden and empty files and other endings are left out."""
    paths = [paths] if isinstance(paths, str) else paths
    for p in paths:
        if not p.startswith("/") and "://" not in p:
            raise ValueError(f"not an absolute path: {p}")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return document_rows(files.where(~F.startswith(name, F.lit(".")) & (F.col("length") > 0) & F.endswith(F.lower("path"), F.lit(ending_with.lower()))), method, run_ts)


def scan_texts(spark: SparkSession, root: str) -> DataFrame:
    """(dataset, path, text): whole .txt files; dataset is the first folder below root."""
    rows = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.txt").withColumn("path", F.input_file_name())
    below = F.regexp_replace("path", f"^.*?{root.rstrip('/').rpartition('/')[2]}/", "")
    return rows.select(F.when(F.contains(below, F.lit("/")), F.substring_index(below, "/", 1)).alias("dataset"), "path", F.col("value").alias("text"))


def scan_ids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id STRING").json(path).where("id is not null")


def scan_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"')


def question_rows(df: DataFrame, dataset: str, id: Column, query: Column, page_id: Column, document: Column) -> DataFrame:
    """(dataset, id, query, page_id, document_id): a question set in common columns. All values are passed whole."""
    return df.select(F.lit(dataset).alias("dataset"), id.alias("id"), query.alias("query"), page_id.cast("int").alias("page_id"), document.alias("document_id"))


def vector_rows(vectors: DataFrame, must: dict[str, object], limit: int = 200) -> DataFrame:
    """Rows of a collection that meet all equalities, without vectors, up to limit by id (a page of a listing)."""
    from docloom.operators.filters import predicate

    kept = [c for c, t in vectors.dtypes if not t.startswith("array<float")]
    return vectors.where(predicate(must)).select(*kept).orderBy(kept[0]).limit(limit)


def vectors_by_id(vectors: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of a collection, vectors included, whose key is among ids (key); ids that are not there give nothing."""
    return vectors.join(ids.select(key).distinct(), key, "left_semi")


# The file types that extractors take.
EXTRACTED_TYPES = {"simple": ("pdf",), "ocr": ("pdf", "jpg", "jpeg", "png")}


def takes_file(extractor: str, file_type_col: Column) -> Column:
    """Whether an extractor takes files of a type; extractors without a list take all."""
    types = EXTRACTED_TYPES.get(extractor)
    return F.coalesce(file_type_col.isin(*types), F.lit(False)) if types else F.lit(True)


def entries_with_documents(entries: DataFrame, documents: DataFrame, pipeline_id: int | None = None, key: str = "document_hash") -> DataFrame:
    """Entries (of one pipeline, if given) with their document as a struct column; entries without one have null."""
    own = entries.where(F.col("pipeline_id") == pipeline_id) if pipeline_id is not None else entries
    inner = documents.select(F.col(key), F.struct(*[c for c in documents.columns if c != key]).alias("document"))
    return own.join(inner, key, "left")
