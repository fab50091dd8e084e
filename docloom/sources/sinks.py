"""Sinks and the places they write to."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Storage:
    """A base URI; local paths and object stores are written the same way."""

    base: str

    @classmethod
    def of(cls, config: dict) -> Storage:
        if config.get("storage_type", "local") == "local":
            if not config.get("base_path"):
                raise ValueError("base_path is required: a folder that driver and executors share")
            return cls(config["base_path"])
        if not config.get("bucket_name"):
            raise ValueError("bucket_name is required")
        return cls(f"s3a://{config['bucket_name']}")

    def path(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    def write(self, df: DataFrame, name: str, form: str = "parquet", mode: str = "overwrite") -> str:
        df.write.mode(mode).format(form).save(self.path(name))
        return self.path(name)

    def read(self, spark: SparkSession, name: str, form: str = "parquet") -> DataFrame:
        return spark.read.format(form).load(self.path(name))


def payload(df: DataFrame, drop: tuple[str, ...] = ("schema__", "embedding", "tokens", "document")) -> Column:
    """A row as JSON without nulls and without those columns."""
    return F.to_json(F.struct(*[c for c in df.columns if c not in drop]))


def pages_json(entries: DataFrame, key: str, page: str, text: str) -> DataFrame:
    """(key, json): page number to text, as one object per document."""
    own = entries.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(page).cast("string").alias("p"), F.col(text).alias("t")))).alias("_e"))
    return own.select(key, F.to_json(F.map_from_entries("_e")).alias("json"))


def append_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def with_totals(detail: DataFrame, totals: DataFrame) -> DataFrame:
    """Detail rows and a row of totals in one table."""
    return detail.unionByName(totals, allowMissingColumns=True)
