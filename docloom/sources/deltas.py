"""Keyed tables in hash buckets: a batch writes its own rows only, readers merge, full buckets are compacted.

    deltas/batch=<n>/bucket=<b>   the rows of a batch, one for each key
    bases/upto=<n>/bucket=<b>     a bucket's state after batch n
    manifests/batch=<n>           of each bucket its base and the deltas after it

A batch counts once its manifest has been written, last of all; until then
nothing of it is seen. Repeating a batch writes the same again, whether or not
the first try came to its end. A manifest has a row for each bucket with at most
so many deltas as are compacted, so it stays small however many batches come,
and names the folders that a reader opens.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators.merge import last_per_key


@dataclass(frozen=True)
class DeltaTable:
    """Rows of schema, one for each value of keys (null equals null), below path.

    With update, non-null values of later batches replace earlier ones; without,
    the first batch that has a key decides. A bucket is compacted when so many
    batches have written to it since it was last.
    """

    spark: SparkSession
    path: str
    schema: str
    keys: tuple[str, ...]
    update: bool = True
    buckets: int = 64
    compact_after: int = 8

    def names(self, folder: str, whole: bool = False) -> list[int]:
        """The numbers n of folders named something=n below a folder; with whole only of those that were written to the end."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        system = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [s.getPath() for s in system.listStatus(path)] if system.exists(path) else []
        return [int(p.getName().split("=")[1]) for p in found if "=" in p.getName() and (not whole or system.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))]

    def manifest(self, before: int | None = None) -> dict[int, tuple[int | None, list[int]]]:
        """(base, deltas after it) of each bucket as of the last batch that counts, or the last before one."""
        known = [n for n in self.names("manifests", whole=True) if before is None or n < before]
        if not known:
            return {}
        rows = self.spark.read.schema("bucket int, base bigint, deltas array<bigint>").parquet(f"{self.path}/manifests/batch={max(known)}").collect()
        return {r.bucket: (r.base, list(r.deltas)) for r in rows}

    def versions(self, manifest: dict[int, tuple[int | None, list[int]]]) -> DataFrame:
        """All rows that readers have to merge, with the batch they are as of."""
        out = self.spark.createDataFrame([], f"{self.schema}, _batch bigint")
        for name, column in (("bases", "upto"), ("deltas", "batch")):
            own = [(b, n) for b, (base, deltas) in manifest.items() for n in ([base] if name == "bases" and base is not None else deltas if name == "deltas" else [])]
            if own:
                rows = self.spark.read.schema(f"{self.schema}, {column} bigint, bucket int").option("basePath", f"{self.path}/{name}").parquet(*[f"{self.path}/{name}/{column}={n}/bucket={b}" for b, n in own])
                out = out.unionByName(rows.withColumnRenamed(column, "_batch").drop("bucket"))
        return out

    def merged(self, versions: DataFrame) -> DataFrame:
        rest = [c for c in versions.columns if c not in (*self.keys, "_batch")]
        if self.update:
            own = versions.groupBy(*self.keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_batch"))).alias(c) for c in rest], F.count(F.lit(1)).alias("_n"))
        else:
            own = versions.groupBy(*self.keys).agg(F.min_by(F.struct(*rest, F.lit(1).alias("_")), F.col("_batch")).alias("_r")).select(*self.keys, *[F.col(f"_r.{c}").alias(c) for c in rest])
        return own.select(*[c for c in versions.columns if c != "_batch"])

    def read(self) -> DataFrame:
        return self.merged(self.versions(self.manifest()))

    def bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def write(self, rows: DataFrame, batch: int, seq: str) -> None:
        """Adds a batch; of its rows with one key the last by seq counts. Batches are numbered in order."""
        own = self.bucketed(last_per_key(rows, list(self.keys), seq).drop(seq))
        own.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/deltas/batch={batch}")
        now = self.manifest(batch)
        for b in self.names(f"deltas/batch={batch}"):
            base, deltas = now.get(b, (None, []))
            now[b] = (base, [*deltas, batch])
        full = {b: v for b, v in now.items() if v[1] and v[1][-1] == batch and len(v[1]) >= self.compact_after}
        if full:
            self.bucketed(self.merged(self.versions(full))).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/bases/upto={batch}")
            now |= {b: (batch, []) for b in full}
        rows = self.spark.createDataFrame([(b, base, deltas) for b, (base, deltas) in now.items()], "bucket int, base bigint, deltas array<bigint>")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifests/batch={batch}")
