"""Partition by a conjunction of parameters, and the pass-through rule built on it."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.schemas import DOMAINS


def predicate(params: dict[str, Any], domains: dict[str, tuple[str, ...]] = DOMAINS) -> Column:
    """AND over the fields: a list means IN, a scalar equality (null equals null).

    Values of enumerated fields are lower-cased and checked; unknown ones raise
    a ValueError that lists the valid values. Never null.
    """
    out = F.lit(True)
    for field, want in params.items():
        many = isinstance(want, (list, tuple, set))
        values = list(want) if many else [want]
        name = field.rpartition(".")[2]
        if name in domains:
            values = [v.lower() if isinstance(v, str) else v for v in values]
            wrong = [v for v in values if v is not None and v not in domains[name]]
            if wrong:
                raise ValueError(f"{field}: {wrong} not in {list(domains[name])}")
        test = F.lit(False)
        for v in values:
            test = test | F.col(field).eqNullSafe(F.lit(v))
        out = out & test
    return out


def partition(df: DataFrame, params: dict[str, Any]) -> tuple[DataFrame, DataFrame]:
    """(rows that match, the rest). A field that df has not counts as null."""
    missing = [f for f in params if f.split(".")[0] not in df.columns]
    wide = df.withColumns({f: F.lit(None).cast("string") for f in missing}) if missing else df
    p = predicate(params)
    return wide.where(p).drop(*missing), wide.where(~p).drop(*missing)


def pass_through(df: DataFrame, params: dict[str, Any], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """stage over the matching rows, together with the rest as it is."""
    match, rest = partition(df, params)
    return stage(match).unionByName(rest, allowMissingColumns=True)


def overlay(df: DataFrame, known: dict[str, Any], unknown: dict[str, str], metadata: str = "document_metadata") -> DataFrame:
    """Sets known columns and adds unknown keys to the metadata map, where its own values win. None changes nothing."""
    out = df.withColumns({k: F.lit(v) for k, v in known.items() if v is not None})
    extra = {k: v for k, v in unknown.items() if v is not None}
    if not extra:
        return out
    own = F.coalesce(F.col(metadata), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    fresh = F.create_map(*[F.lit(x) for kv in extra.items() for x in kv])
    return out.withColumn(metadata, F.map_concat(F.map_filter(fresh, lambda k, _: ~F.map_contains_key(own, k)), own))


def flattened(df: DataFrame, inner: str) -> DataFrame:
    """The fields of a struct column beside the others; where both have a name, the inner one wins unless it is null."""
    fields = df.schema[inner].dataType.names
    kept = [F.coalesce(F.col(f"{inner}.{c}"), F.col(c)).alias(c) if c in fields else F.col(c) for c in df.columns if c != inner]
    return df.select(*kept, *[F.col(f"{inner}.{c}").alias(c) for c in fields if c not in df.columns])


def stored_rows(df: DataFrame) -> DataFrame:
    """Rows as a relational table holds them: arrays, maps and structs as JSON, strings without NUL characters."""
    complex_ = {f.name: f.dataType.typeName() in ("array", "map", "struct") for f in df.schema.fields}
    text = lambda c: F.translate(c, "\0", "")
    # In JSON a NUL is written as an escape.
    made = [F.replace(F.to_json(F.col(f"`{n}`")), F.lit("\\u0000"), F.lit("")).alias(n) if complex_[n] else text(F.col(f"`{n}`")).alias(n) if t == "string" else F.col(f"`{n}`") for n, t in df.dtypes]
    return df.select(*made)
