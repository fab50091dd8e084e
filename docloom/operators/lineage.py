"""Steps and pipelines: latest, next, fork, delete, rename."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_steps(steps: DataFrame, status: str | None = "completed") -> DataFrame:
    """Per pipeline the step with the largest position (of that status)."""
    own = steps.where(F.col("status") == status) if status else steps
    rest = [c for c in steps.columns if c != "pipeline_id"]
    best = own.groupBy("pipeline_id").agg(F.max_by(F.struct(*rest), F.col("position")).alias("_s"))
    return best.select("pipeline_id", *[f"_s.{c}" for c in rest])


def next_steps(steps: DataFrame) -> DataFrame:
    """Per pipeline the first step after its last completed one."""
    done = latest_steps(steps).select("pipeline_id", F.col("position").alias("_done"))
    later = steps.join(done, "pipeline_id", "left").where(F.col("position") > F.coalesce("_done", F.lit(-1)))
    rest = [c for c in steps.columns if c != "pipeline_id"]
    best = later.groupBy("pipeline_id").agg(F.min_by(F.struct(*rest), F.col("position")).alias("_s"))
    return best.select("pipeline_id", *[f"_s.{c}" for c in rest])


def fork(steps: DataFrame, pipeline_id: int, new_id: int, before: int, first_step_id: int) -> DataFrame:
    """Copies of a pipeline's steps with a position below before: new step ids in order, previous_id mapped to the copies."""
    own = steps.where((F.col("pipeline_id") == pipeline_id) & (F.col("position") < before))
    ids = own.select(F.col("step_id").alias("_old"), (F.lit(first_step_id) + F.col("position")).alias("_new"))
    out = own.join(ids, F.col("step_id") == F.col("_old")).withColumn("step_id", F.col("_new")).drop("_old", "_new")
    out = out.join(ids, F.col("previous_id") == F.col("_old"), "left").withColumn("previous_id", F.col("_new")).drop("_old", "_new")
    return out.withColumn("pipeline_id", F.lit(new_id)).select(*steps.columns)


def fork_pipeline(pipelines: DataFrame, links: DataFrame, pipeline_id: int, new_id: int) -> tuple[DataFrame, DataFrame]:
    """(pipelines with a copy under new_id, links with the copy's documents): the copy's version ends in -branch and it is linked to the documents of the first."""
    copy = pipelines.where(F.col("pipeline_id") == pipeline_id).withColumns({"pipeline_id": F.lit(new_id).cast(pipelines.schema["pipeline_id"].dataType), "version": F.concat("version", F.lit("-branch"))})
    more = links.where(F.col("pipeline_id") == pipeline_id).withColumn("pipeline_id", F.lit(new_id).cast(links.schema["pipeline_id"].dataType))
    return pipelines.unionByName(copy.select(*pipelines.columns)), links.unionByName(more.select(*links.columns))


def ensure_pipeline(pipelines: DataFrame, pipeline_id: int, **values) -> DataFrame:
    """pipelines with a row of that id: the one there is, or a new one with the given values (other columns null)."""
    shape = {f.name: f.dataType for f in pipelines.schema.fields}
    row = {"pipeline_id": pipeline_id, **values}
    new = pipelines.sparkSession.range(1).select(*[F.lit(row.get(c)).cast(t).alias(c) for c, t in shape.items()])
    return pipelines.unionByName(new.join(pipelines.select("pipeline_id"), "pipeline_id", "left_anti").select(*pipelines.columns))


def put_steps(steps: DataFrame, new: DataFrame) -> DataFrame:
    """steps after new ones (pipeline_id, position, status, ...) have been written: one for each pipeline and position, the new one.

    A step with an error has status failed; its other values are kept.
    """
    new = new.withColumn("status", F.when(F.col("error").isNotNull(), "failed").otherwise(F.col("status"))) if "error" in new.columns else new
    kept = steps.join(new.select("pipeline_id", "position"), ["pipeline_id", "position"], "left_anti")
    return kept.unionByName(new.select(*[c for c in steps.columns if c in new.columns]), allowMissingColumns=True)


def documents_of(documents: DataFrame, links: DataFrame, pipeline_id: int, key: str = "document_hash") -> DataFrame:
    """The documents linked to a pipeline."""
    return documents.join(links.where(F.col("pipeline_id") == pipeline_id).select(key).distinct(), key, "left_semi")


def with_pipeline_id(df: DataFrame, pipeline_id: int, inner: str | None = None) -> DataFrame:
    """Sets pipeline_id, as a column or in a struct column."""
    value = F.lit(pipeline_id).cast("bigint")
    return df.withColumn(inner, F.col(inner).withField("pipeline_id", value)) if inner else df.withColumn("pipeline_id", value)


def without_points(points: DataFrame, ids: DataFrame | None = None, condition: Column | None = None, key: str = "id") -> DataFrame:
    """A collection without the points of ids (key), or without those that meet the condition (null does not)."""
    left = points.join(ids.select(key).distinct(), key, "left_anti") if ids is not None else points
    return left.where(~F.coalesce(condition, F.lit(False))) if condition is not None else left


def relations(entries: DataFrame, edges: DataFrame, key: str = "uuid") -> DataFrame:
    """(key, direction, relationship_type, other): the edges of each entry in both directions."""
    side = lambda mine, other, name: edges.select(F.col(f"{mine}_uuid").alias(key), F.lit(name).alias("direction"), "relationship_type", F.col(f"{other}_uuid").alias("other"))
    return side("source", "target", "out").unionByName(side("target", "source", "in")).join(entries.select(key), key, "left_semi")


def delete_pipeline(pipeline_ids: DataFrame, tables: dict[str, DataFrame], edges: DataFrame | None = None) -> dict[str, DataFrame]:
    """Tables without the rows of those pipelines; edges without those that touch a deleted entry."""
    out = {name: t.join(pipeline_ids, "pipeline_id", "left_anti") for name, t in tables.items()}
    if edges is not None:
        gone = tables["entries"].join(pipeline_ids, "pipeline_id", "left_semi").select("uuid")
        for end in ("source_uuid", "target_uuid"):
            edges = edges.join(gone.select(F.col("uuid").alias(end)), end, "left_anti")
        out["edges"] = edges
    return out


def rename_value(df: DataFrame, column: str, old: str, new: str) -> DataFrame:
    return df.withColumn(column, F.when(F.col(column) == old, F.lit(new)).otherwise(F.col(column)))
