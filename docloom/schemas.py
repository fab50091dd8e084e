"""Table schemas, value domains and validation with a reject table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The domains of the enumerated columns.
SCOPES = ("external", "internal")
STEP_STATES = ("pending", "running", "completed", "failed")
STEP_TYPES = ("load", "extract", "chunk", "featurize", "embed", "upsert")
CHUNKING_METHODS = ("topic_segmentation", "sliding_window", "distance", "generative", "textract", "none")
CONTENT_TYPES = tuple(
    "zoning_map meeting_minutes local_ordinance state_law federal_law other_law gold_articles other_articles blog rss market_research text email linkedin tweet youtube podcast zoom_recording_video zoom_recording_audio zoom_recording_transcript other".split()
)
FILE_TYPES = tuple("pdf docx pptx txt html md json xml csv tsv sql yaml toml mp4 mp3 wav jpg jpeg png gif svg webm odt ods odp xlsx".split())
RELATIONSHIPS = tuple(
    "cites_general cites_background cites_method cites_result cited_by attachment section_reference ontological snippet synthetic figure_caption table_caption table_footnote figure_footnote".split()
)
EMBEDDED_FEATURES = ("text", "image", *(f"synthetic_{x}" for x in "feature_description summary context_summary trends components keywords answers questions facts".split()))

DOMAINS = {"scope": SCOPES, "content_type": CONTENT_TYPES, "file_type": FILE_TYPES, "chunking_method": CHUNKING_METHODS, "relationship_type": RELATIONSHIPS, "status": STEP_STATES, "step_type": STEP_TYPES}

INDEX = "STRUCT<primary: INT, secondary: INT, tertiary: INT>"
BOX = "STRUCT<left: DOUBLE, top: DOUBLE, width: DOUBLE, height: DOUBLE, page_width: DOUBLE, page_height: DOUBLE>"
LOCATION = f"STRUCT<index: {INDEX}, bounding_box: {BOX}, extracted_feature_type: STRING, page_file_path: STRING, extracted_file_path: STRING>"
CITATION = "STRUCT<relationship_type: STRING, target_uuid: STRING, source_uuid: STRING>"

DOCUMENT = """document_hash STRING, document_id BIGINT, pipeline_id BIGINT, document_title STRING, scope STRING, content_type STRING,
 creator_name STRING, creation_date TIMESTAMP, file_type STRING, file_path STRING, file_size BIGINT, public_url STRING,
 load_method STRING, load_date TIMESTAMP, document_summary STRING, document_keywords ARRAY<STRING>,
 document_metadata MAP<STRING, STRING>, extracted_document_file_path STRING, chunking_method STRING"""
ENTRY = f"""uuid STRING, document_hash STRING, string STRING, entry_title STRING, keywords ARRAY<STRING>,
 consolidated_feature_type STRING, chunk_locations ARRAY<{LOCATION}>, min_primary_index INT, max_primary_index INT,
 chunk_index INT, table_number INT, figure_number INT, embedded_feature_type STRING, citations ARRAY<{CITATION}>"""

#: Schema tag to DDL; a row's tag says which of them it follows.
SCHEMAS = {
    "Document": DOCUMENT,
    "Entry": ENTRY,
    "Record": ENTRY,
    "Embedding": f"{ENTRY}, embedding ARRAY<FLOAT>, tokens INT",
    "Upsert": f"{ENTRY}, dense_vector ARRAY<FLOAT>, sparse_vector STRUCT<indices: ARRAY<INT>, values: ARRAY<FLOAT>>",
    "chunk_comparison": "document_title STRING, page_lo INT, page_hi INT, chunks_a ARRAY<STRING>, chunks_b ARRAY<STRING>, winner STRING, reasoning STRING",
    "chunk_evaluation": f"{ENTRY}, text_clarity DOUBLE, coherence DOUBLE, organization DOUBLE, score DOUBLE, explanation STRING",
    "formatted_scored_points": "id STRING, raw_text STRING, score DOUBLE, title STRING, date TIMESTAMP, rerank_score DOUBLE",
}


def in_domain(column: str, domain: tuple[str, ...]) -> Column:
    """Null passes; anything else has to be one of the values."""
    return F.col(column).isNull() | F.col(column).isin(*domain)


def reject_reasons(required: tuple[str, ...] = (), domains: dict[str, tuple[str, ...]] | None = None, checks: dict[str, Column] | None = None) -> Column:
    """Array of what is wrong with a row; empty if nothing is.

    required: columns that may be neither null nor empty. domains: columns with
    their values. checks: name of a fault to the condition that has to hold
    (null counts as a fault).
    """
    faults = [F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), F.lit(f"missing {c}")) for c in required]
    faults += [F.when(~in_domain(c, d), F.concat(F.lit(f"bad {c}: "), F.col(c))) for c, d in (domains or {}).items()]
    faults += [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in (checks or {}).items()]
    return F.array_compact(F.array(*faults)) if faults else F.array().cast("array<string>")


def validate(df: DataFrame, **rules) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with reject_reasons); every row is in one of them."""
    marked = df.withColumn("reject_reasons", reject_reasons(**rules))
    return marked.where(F.size("reject_reasons") == 0).drop("reject_reasons"), marked.where(F.size("reject_reasons") > 0)


def by_index(column: str) -> list[Column]:
    """Order of an index struct: primary, secondary, tertiary, missing ones first."""
    return [F.col(f"{column}.{part}").asc_nulls_first() for part in ("primary", "secondary", "tertiary")]
