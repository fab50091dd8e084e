"""The merge family: keyed upserts, edges, and what follows from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.schemas import validate
from docloom.sources.workspace import written


def last_per_key(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The row with the largest seq of each key: combined before the shuffle, no window over hot keys."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def merge(existing: DataFrame, incoming: DataFrame, keys: list[str], seq: str, update: bool = True) -> DataFrame:
    """All rows after the upsert, with column action: insert, update, skip (update off) or keep.

    Of incoming rows with one key the last by seq counts. Null values of an
    incoming row leave the existing value. Keys may be null; null equals null.
    """
    old, new = existing.alias("o"), last_per_key(incoming, keys, seq).drop(seq).withColumn("_new", F.lit(True)).alias("n")
    same = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    both = old.withColumn("_old", F.lit(True)).alias("o").join(new, same, "full")
    was, now = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    action = F.when(~was, "insert").when(~now, "keep").when(F.lit(update), "update").otherwise("skip")
    pick = []
    for c in existing.columns:
        o, n = F.col(f"o.{c}"), F.col(f"n.{c}") if c in incoming.columns else F.lit(None)
        value = F.coalesce(n, o) if update else F.when(was, o).otherwise(n)
        pick.append(F.when(was, o).otherwise(n).alias(c) if c in keys else value.alias(c))
    return both.select(*pick, action.alias("action"))


def counters(merged: DataFrame) -> DataFrame:
    """How many rows each action took, as one row."""
    return merged.agg(*[F.count_if(F.col("action") == a).alias(f"n_{a}") for a in ("insert", "update", "skip", "keep")])


def content_hash(*columns: Column) -> Column:
    """SHA-256 over the values in turn; null differs from empty, and values can't run into each other."""
    parts = [F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat_ws("|", *parts), 256)


def insert_ignore(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of incoming whose key is new, each key once."""
    return incoming.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")


def resolve_citations(citations: DataFrame, batch: DataFrame, stored: DataFrame, ref: str) -> DataFrame:
    """(citation columns, target_id, tier): the target is looked up in the batch first, then in the store; those without one are left out."""
    tiers = batch.select(ref, F.struct(F.lit(1).alias("tier"), F.col("target_id")).alias("t")).unionByName(stored.select(ref, F.struct(F.lit(2).alias("tier"), F.col("target_id")).alias("t")))
    best = tiers.groupBy(ref).agg(F.min("t").alias("t"))
    return citations.join(best, ref).select(*citations.columns, F.col("t.target_id").alias("target_id"), F.col("t.tier").alias("tier"))


def refresh(documents: DataFrame, results: DataFrame, key: str, seq: str) -> DataFrame:
    """documents with the non-null values of the last result row of each key."""
    cols = [c for c in results.columns if c in documents.columns and c != key]
    last = last_per_key(results.select(key, seq, *cols), [key], seq).select(key, *[F.col(c).alias(f"_{c}") for c in cols])
    return documents.join(last, key, "left").select(*[F.coalesce(f"_{c}", c).alias(c) if c in cols else F.col(c) for c in documents.columns])


def with_new_ids(df: DataFrame, order: list[str], after: int, out: str = "id") -> DataFrame:
    """df with ids from after + 1 on, dense, in the given order (ties in any order).

    Rows are ranged by the order and written once, with their place inside their
    range: a range plan that ran twice could cut the rows at other bounds. The
    ranges' sizes (one row for each range) then give each its first id.
    """
    place = F.monotonically_increasing_id()
    ranged = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"_p": F.shiftright(place, 33), "_i": place.bitwiseAND(F.lit((1 << 33) - 1))}), "new-ids")
    sizes = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_p", F.coalesce(F.sum("_n").over(Window.partitionBy().orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    return ranged.join(before, "_p").withColumn(out, F.lit(after + 1) + F.col("_b") + F.col("_i")).select(*df.columns, out)


def resolved_edges(edges: DataFrame, batch: DataFrame, stored: DataFrame, ref: str) -> DataFrame:
    """(source_uuid, target_uuid, relationship_type) of edges (source_ref, target_ref, relationship_type): both ends are looked up by column ref in the batch, then in the store; each edge once."""
    own, before = (df.select(F.col(ref).alias("_ref"), F.col("uuid").alias("target_id")) for df in (batch, stored))
    found = resolve_citations(edges.withColumnRenamed("target_ref", "_ref"), own, before, "_ref").withColumnRenamed("target_id", "target_uuid").drop("_ref", "tier").withColumnRenamed("source_ref", "_ref")
    found = resolve_citations(found, own, before, "_ref").withColumnRenamed("target_id", "source_uuid")
    return found.select("source_uuid", "target_uuid", "relationship_type").distinct()


def upsert_entries(stored: DataFrame, incoming: DataFrame, keys: list[str], text: str = "string", seq: str = "seq", update: bool = False, required: tuple[str, ...] = (), edges: DataFrame | None = None, ref: str = "ref") -> dict[str, DataFrame]:
    """All that storing entries does: merged, counters, rejected, and edges.

    Rows without what is required are rejected. The others are hashed by their
    text (column content_hash, which keys may name) and merged. Edges
    (source_ref, target_ref, relationship_type) are resolved by column ref, in
    this batch before the store, and added once to those there are.
    """
    good, bad = validate(incoming, required=required)
    good = good.withColumn("content_hash", content_hash(F.col(text)))
    merged = merge(stored, good, keys, seq, update)
    out = {"merged": merged, "counters": counters(merged), "rejected": bad}
    if edges is not None:
        out["edges"] = resolved_edges(edges, last_per_key(good, keys, seq), stored, ref)
    return out


def upsert_documents(stored: DataFrame, links: DataFrame, incoming: DataFrame, pipeline_id: int, seq: str, key: str = "document_hash") -> tuple[DataFrame, DataFrame]:
    """(documents with their actions, links with those of the pipeline): documents are merged by hash, given values win, and each is linked once."""
    merged = merge(stored, incoming, [key], seq)
    new = incoming.select(F.lit(pipeline_id).cast(links.schema["pipeline_id"].dataType).alias("pipeline_id"), key).distinct()
    return merged, links.select("pipeline_id", key).unionByName(insert_ignore(links, new, ["pipeline_id", key]))
