"""Featurizing, embedding and clustering. Models are plug-ins: functions over batches of strings."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import mixtures
from docloom.operators.filters import partition
from docloom.sources.workspace import written

Model = Callable[[list[str]], list]


def hashed_embedding(texts: list[str], dimensions: int = 64) -> list[list[float]]:
    """Offline default embedder: signed feature hashing of words, to unit length."""
    out = []
    for text in texts:
        v = np.zeros(dimensions)
        for word in text.lower().split():
            h = zlib.crc32(word.encode())
            v[h % dimensions] += 1.0 if h & 0x80000000 else -1.0
        n = np.linalg.norm(v)
        out.append((v / n if n else v).tolist())
    return out


def first_sentence(texts: list[str]) -> list[str]:
    """Offline default of a summarizing model."""
    return [t.split(". ")[0].strip() for t in texts]


def embed(df: DataFrame, text: str, model: Model = hashed_embedding, out: str = "embedding") -> DataFrame:
    """Adds the model's vector; rows without text get null."""

    @F.pandas_udf("array<float>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            texts = part.fillna("").tolist()
            vectors = model(texts)
            yield pd.Series([v if t.strip() else None for v, t in zip(vectors, texts, strict=True)], dtype=object)

    return df.withColumn(out, run(F.col(text)))


def complete(df: DataFrame, prompt: Column, answer: str, model: Model = first_sentence) -> DataFrame:
    """Adds the model's answer to the prompt of each row."""

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(model(part.fillna("").tolist()), dtype=object)

    return df.withColumn(answer, run(prompt))


def chat_prompt(system: str, user: Column) -> Column:
    """Messages for a chat model."""
    message = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.array(message("system", F.lit(system)), message("user", user))


def image_prompt(system: str, user: Column, images: Column) -> Column:
    """Messages for a model that sees images: the user's text and an array of image URLs or data URIs, empty ones left out."""
    some = F.filter(F.coalesce(images, F.array().cast("array<string>")), lambda x: F.coalesce(x, F.lit("")) != "")
    message = lambda role, text, shown: F.struct(F.lit(role).alias("role"), text.alias("content"), shown.alias("images"))
    return F.array(message("system", F.lit(system), F.array().cast("array<string>")), message("user", user, some))


def featurized(df: DataFrame, text: Column, model: Model, items: str, filter_params: dict | None = None, out: str = "feature") -> DataFrame:
    """A row for each item that the model finds in a row's text, with the row's columns; rows that the filter leaves out are kept as they are.

    The answer is JSON with a list named items (or one value); a row whose
    answer can't be read has no item and one row with null.
    """
    match, rest = partition(df, filter_params or {})
    asked = complete(match, text, "_answer", model)
    found = F.coalesce(F.from_json("_answer", f"`{items}` ARRAY<STRING>")[items], F.when(F.get_json_object("_answer", f"$.{items}").isNotNull(), F.array(F.get_json_object("_answer", f"$.{items}"))))
    rows = asked.withColumn(out, F.explode_outer(found)).drop("_answer")
    return rows.unionByName(rest, allowMissingColumns=True) if filter_params else rows


def parsed_answer(answer: Column, schema: str, fallback: dict[str, str]) -> Column:
    """A JSON answer as a struct; what is missing or broken takes its fallback."""
    found = F.from_json(answer, schema)
    return F.struct(*[F.coalesce(found[c], F.lit(v)).alias(c) for c, v in fallback.items()])


def summary_entries(df: DataFrame, uuid: str, text: str, summary: str) -> DataFrame:
    """One new entry per row, with a synthetic edge to the row it sums up. Its id is a hash, so a retry gives the same."""
    new = F.sha2(F.concat_ws("|", F.lit("summary"), F.col(uuid).cast("string"), F.col(summary)), 256)
    return df.select(new.alias("uuid"), F.col(summary).alias("string"), F.lit("synthetic_summary").alias("embedded_feature_type"), F.struct(F.lit("synthetic").alias("relationship_type"), F.col(uuid).cast("string").alias("target_uuid"), new.alias("source_uuid")).alias("citation"))


def described_entries(df: DataFrame, uuid: str, description: str, caption: str) -> DataFrame:
    """Three rows per row: itself, its caption and its description."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), t.alias("string")) for k, t in (("original", F.lit(None).cast("string")), ("caption", F.col(caption)), ("description", F.col(description)))])
    rows = df.select(F.col(uuid).alias("source_uuid"), F.explode(kinds).alias("k"))
    return rows.select("source_uuid", F.col("k.kind").alias("kind"), F.col("k.string").alias("string"), F.sha2(F.concat_ws("|", "source_uuid", F.col("k.kind")), 256).alias("uuid"))


def stamp_feature(df: DataFrame, model: str, date: str, prompt: str) -> DataFrame:
    """Appends to the three parallel arrays of feature metadata."""
    add = lambda c, v: F.concat(F.coalesce(c, F.array().cast("array<string>")), F.array(F.lit(v)))
    return df.withColumns({c: add(c, v) for c, v in (("feature_models", model), ("feature_dates", date), ("feature_types", prompt))})


def reduced(df: DataFrame, vector: str, dimensions: int = 20) -> DataFrame:
    """Adds the projection on the first principal components (in place of a manifold projection).

    Fewer dimensions only where the vectors have fewer; tables of no more rows than dimensions keep their vectors.
    Rows without a vector get null.
    """
    have = df.where(F.col(vector).isNotNull())
    head = have.select(vector).limit(dimensions + 1).collect()
    if len(head) <= dimensions:
        return df.withColumn("reduced", F.col(vector).cast("array<double>"))
    as_vector = lambda rows: rows.withColumn("_v", array_to_vector(F.col(vector).cast("array<double>")))
    model = PCA(k=min(dimensions, len(head[0][0])), inputCol="_v", outputCol="_p").fit(as_vector(have))
    found = model.transform(as_vector(have)).withColumn("reduced", vector_to_array("_p")).drop("_v", "_p")
    return found.unionByName(df.where(F.col(vector).isNull()).withColumn("reduced", F.lit(None).cast("array<double>")))


def soft_clusters(df: DataFrame, vector: str, ks: range = range(5, 21), least: float = 0.1, seed: int = 7) -> DataFrame:
    """(columns, cluster, probability): memberships above least of the Gaussian mixture with the lowest BIC among ks.

    No more components than rows are tried. Rows without a vector belong to no cluster; an empty table gives no rows.
    """
    rows = written(df.where(F.col(vector).isNotNull()).withColumn("_v", F.col(vector).cast("array<double>")), "clusters")
    n = rows.count()
    best = mixtures.fitted(rows, "_v", n, [k for k in ks if k <= n] or [n], seed) if n else None

    @F.pandas_udf("array<double>")
    def memberships(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(list(mixtures.shares(np.stack(part.to_numpy()), best)[0]) if len(part) else [], dtype=object)

    found = rows.select(*df.columns, F.posexplode(memberships("_v")).alias("cluster", "probability"))
    return found.where(F.col("probability") > least)


def organized(members: DataFrame, cluster: str) -> DataFrame:
    """(cluster, size, place): clusters by size, largest first; ties by name."""
    from pyspark.sql import Window

    sizes = members.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"))
    return sizes.withColumn("place", F.row_number().over(Window.partitionBy().orderBy(F.col("size").desc(), cluster)))


def keywords_of(members: DataFrame, labels: DataFrame, key: str, cluster: str) -> DataFrame:
    """(key, keywords, n_clusters): the distinct labels, sorted, of the clusters that each key's rows belong to, by cluster id."""
    both = members.select(key, cluster).distinct().join(labels, cluster)
    return both.groupBy(key).agg(F.array_sort(F.collect_set("label")).alias("keywords"), F.count_distinct(cluster).alias("n_clusters"))


# How images in base64 begin.
IMAGE_STARTS = ("data:image/", "/9j/", "iVBORw0KGgo")


def is_image(text: Column) -> Column:
    """Whether a string is an image in base64, by its beginning; null is none. Decided row by row."""
    found = F.lit(False)
    for start in IMAGE_STARTS:
        found = found | F.startswith(text, F.lit(start))
    return F.coalesce(found, F.lit(False))


def stamp_embedding(df: DataFrame, text: str, model: str, date: str, dimensions: int) -> DataFrame:
    """Sets what an embedding is of (text or image, where not set), its date, model and dimensions."""
    kind = F.when(is_image(F.col(text)), "image").otherwise("text")
    known = F.col("embedded_feature_type") if "embedded_feature_type" in df.columns else F.lit(None).cast("string")
    return df.withColumns({"embedded_feature_type": F.coalesce(known, kind), "embedding_date": F.lit(date).cast("timestamp"), "embedding_model": F.lit(model), "embedding_dimensions": F.lit(dimensions)})


def joined_texts(df: DataFrame, keys: list[str], order: str, text: str, joint: str = "--- --- \n --- --- ") -> DataFrame:
    """(keys, text): the texts of each group in order, with a line of dashes between them."""
    own = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))).alias("_t"))
    return own.select(*keys, F.array_join(F.col("_t.t"), joint).alias("text"))


def likeliest(mixture: mixtures.Mixture):
    """A UDF: the component of a mixture that a vector most likely comes from."""

    @F.pandas_udf("int")
    def run(part: pd.Series) -> pd.Series:
        return pd.Series(mixtures.shares(np.stack(part.to_numpy()), mixture)[0].argmax(axis=1) if len(part) else [], dtype="int32")

    return run


def silhouettes(df: DataFrame, vector: str, ks: range = range(2, 11), seed: int = 7) -> DataFrame:
    """(k, silhouette): how well the hard clusters of a mixture of k components keep apart, for each k; tables of fewer than 3 rows give none."""
    rows = written(df.where(F.col(vector).isNotNull()).select(F.col(vector).cast("array<double>").alias("_v")), "silhouettes")
    n, out = rows.count(), []
    for k in (k for k in ks if k < n):
        labelled = rows.select(array_to_vector("_v").alias("features"), likeliest(mixtures.fitted(rows, "_v", n, [k], seed))("_v").alias("prediction"))
        if labelled.select("prediction").distinct().limit(2).count() > 1:
            out.append((k, float(ClusteringEvaluator().evaluate(labelled))))
    return df.sparkSession.createDataFrame(out, "k int, silhouette double")


def nested_clusters(df: DataFrame, key: str, vector: str, dimensions: int = 20, ks: range = range(2, 11), least: float = 0.1, seed: int = 7) -> DataFrame:
    """(key, cluster): clusters inside clusters, numbered from 0 through all outer ones.

    The vectors are reduced and clustered as a whole; the members of each outer
    cluster are reduced and clustered by themselves. A set of at most
    dimensions + 1 rows is one cluster. A row may be in several clusters.
    """
    rows = written(df.where(F.col(vector).isNotNull()).select(key, F.col(vector).alias("_w")), "nested")
    if rows.limit(dimensions + 2).count() <= dimensions + 1:
        return rows.select(key, F.lit(0).alias("cluster"))
    outer = written(soft_clusters(reduced(rows, "_w", dimensions), "reduced", ks, least, seed).select(key, "_w", "cluster"), "nested")
    out, first = None, 0
    # As many turns as there are outer clusters, which ks bounds.
    for (c,) in sorted(outer.select("cluster").distinct().collect()):
        own = outer.where(F.col("cluster") == c).select(key, "_w")
        if own.limit(dimensions + 2).count() <= dimensions + 1:
            inner = own.select(key, F.lit(0).alias("cluster"))
        else:
            inner = soft_clusters(reduced(own, "_w", dimensions), "reduced", ks, least, seed).select(key, "cluster")
        inner = written(inner, "nested")
        numbered = inner.withColumn("cluster", F.col("cluster") + first)
        out = numbered if out is None else out.unionByName(numbered)
        first += (inner.agg(F.max("cluster")).first()[0] or 0) + 1
    return out.select(key, F.col("cluster").cast("int").alias("cluster"))


#: (model, provider, context_length, input_price, output_price, requests_per_minute, tokens_per_minute); prices are in dollars for a token. Callers bring their own rows.
MODELS = "model STRING, provider STRING, context_length INT, input_price DOUBLE, output_price DOUBLE, requests_per_minute INT, tokens_per_minute INT"


def model_catalogue(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Models by name, each once (the last one given)."""
    return spark.createDataFrame(list({r[0]: r for r in rows}.values()), MODELS)


def priced(usage: DataFrame, models: DataFrame) -> DataFrame:
    """usage (model, input_tokens, output_tokens, ...) with its cost, and fits: whether the tokens fit the model's context. Unknown models cost nothing and fit nothing."""
    known = models.select("model", "input_price", "output_price", "context_length")
    both = usage.join(known, "model", "left")
    cost = F.coalesce(F.col("input_tokens") * F.col("input_price") + F.col("output_tokens") * F.col("output_price"), F.lit(0.0))
    return both.withColumns({"cost": cost, "fits": F.coalesce(F.col("input_tokens") + F.col("output_tokens") <= F.col("context_length"), F.lit(False))}).drop("input_price", "output_price", "context_length")
