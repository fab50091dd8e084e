"""An inverted index for BM25: segments of documents, posting lists by term, block maxima, pruned top-k.

A segment is what a task reads of the documents, up to a bound. Its postings
are written as one row per term: the segment's documents that have the term,
its weight in each, and for each block of neighbouring documents the largest of
these weights. Nothing is gathered to build it; rows are clustered by a hash
bucket of the term, so that a search opens the buckets of its terms only.

A search meets postings by term alone. For a query, the sum of its terms'
maxima in a block bounds the score of every document there: blocks are scored
in the order of this bound until it falls below the k-th best score, which
leaves the result exact (block-max pruning, Mallia and others 2024; the bound
is that of block-max WAND, Ding and Suel 2011).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.functions.arrays import rows_of
from docloom.sources.workspace import scratch, small_batches

#: Documents of a block, and blocks of a segment at most.
BLOCK, BLOCKS = 128, 256
#: Tokens after which a segment is closed: they bound what a task holds to build a segment (some 50 bytes a token), and to search one.
TOKENS = 2_000_000
ROWS = "segment bigint, term string, n int, docs binary, weights binary, blocks binary, maxima binary, ids array<bigint>"
NAMES = [c.split()[0] for c in ROWS.split(", ")]
#: Where the rows of segments' documents lie, beside the buckets of terms.
DOCUMENTS = -1


@dataclass(frozen=True)
class Weighing:
    """Settings of BM25; average stands for the mean length of documents, as in sparse encoders with a fixed setting."""

    k1: float = 1.2
    b: float = 0.75
    average: float = 256.0

    def weights(self, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return counts * (self.k1 + 1.0) / (counts + self.k1 * (1.0 - self.b + self.b * lengths / self.average))


@dataclass(frozen=True)
class SparseIndex:
    """A written index: postings, and for each segment its documents' ids in order (null last); postings name documents by their place there."""

    spark: SparkSession
    path: str
    buckets: int
    weighing: Weighing

    def table(self) -> DataFrame:
        return self.spark.read.schema(f"{ROWS}, bucket int").parquet(self.path)

    def postings(self) -> DataFrame:
        return self.table().where(F.col("bucket") != DOCUMENTS)

    def documents(self) -> DataFrame:
        return self.table().where(F.col("bucket") == DOCUMENTS).select("segment", "ids")


def bucket_of(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


class Segment:
    """Documents on their way into the index: ids, lengths, and (term, document, count) triples of each batch."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.lengths: list[np.ndarray] = []
        self.parts: list[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]] = []
        self.tokens = 0

    def add(self, part: pa.RecordBatch) -> None:
        size = np.asarray(pc.list_value_length(part["t"])).astype(np.int64)
        coded = part["t"].flatten().dictionary_encode()
        owner = np.repeat(np.arange(part.num_rows) + len(self.ids), size)
        cell, counts = np.unique(np.asarray(coded.indices).astype(np.int64) << 32 | owner, return_counts=True)
        self.parts.append((coded.dictionary, cell >> 32, cell & 0xFFFFFFFF, counts))
        self.ids += part["id"].to_pylist()
        self.lengths.append(size)
        self.tokens += int(size.sum())

    def rows(self, weighing: Weighing, number: int, most: int = 20_000) -> Iterator[pa.RecordBatch]:
        """The postings by term, and last a row of the documents (term null). Documents are numbered in the order of their ids."""
        by_id = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] or 0))
        place = np.empty(len(by_id), dtype=np.int64)
        place[by_id] = np.arange(len(by_id))
        if self.tokens:
            lengths = np.concatenate(self.lengths)
            every = pa.concat_arrays([d for d, *_ in self.parts]).dictionary_encode()
            names, code = every.dictionary, np.asarray(every.indices).astype(np.int64)
            firsts = np.cumsum([0, *[len(d) for d, *_ in self.parts]])
            term = np.concatenate([code[first + c] for first, (_, c, _, _) in zip(firsts, self.parts)])
            doc, count = (np.concatenate([p[i] for p in self.parts]) for i in (2, 3))
            weight = weighing.weights(count.astype(np.float64), lengths[doc])
            doc = place[doc]
            order = np.lexsort((doc, term))
            term, doc, weight = term[order], doc[order], weight[order]
            block = doc // BLOCK
            heads = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])])
            ends, block_ends = (np.r_[0, np.cumsum(np.bincount(t, minlength=len(names)))] for t in (term, term[heads]))
            lists = [(doc.astype("<u2"), ends), (weight.astype("<f8"), ends), (block[heads].astype("<u2"), block_ends), (np.maximum.reduceat(weight, heads).astype("<f8"), block_ends)]
            for a in range(0, len(names), most):
                b = min(a + most, len(names))
                yield rows_batch(number, names.slice(a, b - a), np.diff(ends[a : b + 1]), [binaries(values, at[a : b + 1]) for values, at in lists])
        yield rows_batch(number, pa.nulls(1, pa.string()), [len(by_id)], [pa.nulls(1, pa.binary())] * 4, [[self.ids[i] for i in by_id]])


def binaries(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """The bytes of the values between neighbouring edges."""
    width = values.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(((edges - edges[0]) * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values[edges[0] : edges[-1]]))])


def rows_batch(number: int, term: pa.Array, n, lists: list[pa.Array], ids=None) -> pa.RecordBatch:
    size = len(term)
    return pa.RecordBatch.from_arrays([pa.array([number] * size, pa.int64()), term, pa.array(n, pa.int32()), *lists, pa.array(ids or [None] * size, pa.list_(pa.int64()))], NAMES)


def segmented(weighing: Weighing):
    """A mapInArrow function: (partition, id, t) to posting rows. A task's segments are numbered within its partition."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, partition, made = Segment(), 0, 0
        for part in parts:
            for at in range(0, part.num_rows, BLOCK):
                own = part.slice(at, BLOCK)
                partition = own["partition"][0].as_py()
                segment.add(own)
                if len(segment.ids) >= BLOCK * BLOCKS or segment.tokens >= TOKENS:
                    yield from segment.rows(weighing, (partition << 32) + made)
                    segment, made = Segment(), made + 1
        if segment.ids:
            yield from segment.rows(weighing, (partition << 32) + made)

    return run


def build_index(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None, buckets: int = 64, weighing: Weighing = Weighing()) -> SparseIndex:
    """Writes an index of docs below path (a fresh folder in the shared one if None). Null ids and texts may be; repeated rows are documents of their own."""
    spark = docs.sparkSession
    small_batches(spark)
    path = path or scratch(spark, "sparse-index")
    rows = docs.select(F.spark_partition_id().alias("partition"), F.col(id_col).cast("bigint").alias("id"), tx.tokens(F.coalesce(F.col(text), F.lit(""))).alias("t"))
    made = rows.mapInArrow(segmented(weighing), ROWS).withColumn("bucket", F.when(F.col("term").isNotNull(), bucket_of(F.col("term"), buckets)).otherwise(DOCUMENTS))
    made.hint("rebalance", "bucket").sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(path)
    return SparseIndex(spark, path, buckets, weighing)


def search_index(index: SparseIndex, queries: DataFrame, k: int = 10, query: tuple[str, str] = ("item_id", "text"), digits: int = 6, query_block: int = 256) -> DataFrame:
    """(query_id, id, score, rank): the k documents with the highest BM25 score for the distinct terms of each query, exactly; documents with none of them are left out.

    Scores are rounded; ties go to the smaller id (a null id comes last).
    Queries are dealt into groups of about query_block. A posting row goes once
    to each group that has its term, whatever the number of queries, together
    with which of them ask for it; a task sees one segment and one group, and
    sends the k best of each query. Nothing of queries or documents passes
    through the driver but the buckets that have to be opened.
    """
    spark = index.spark
    terms = rows_of(queries, [F.col(query[0]).cast("bigint").alias("query_id")], F.array_distinct(tx.tokens(F.col(query[1]))), "term").distinct()
    groups = max(1, -(-queries.count() // query_block))
    terms = terms.withColumns({"group": F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int"), "bucket": bucket_of(F.col("term"), index.buckets)})
    asked = terms.groupBy("bucket", "term", "group").agg(F.collect_list("query_id").alias("queries"))
    open_ = [r[0] for r in asked.select("bucket").distinct().collect()]
    postings = index.postings().where(F.col("bucket").isin(open_)).join(asked.select("term").distinct(), "term", "left_semi")
    total = index.documents().agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0]
    df = postings.groupBy("term").agg(F.sum("n").cast("double").alias("df"))
    weighed = asked.join(df, "term").select("term", "group", "queries", F.log((F.lit(float(total)) - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1.0).alias("idf"))
    cells = postings.join(weighed, "term").select("segment", "group", "docs", "weights", "blocks", "maxima", "queries", "idf")
    hits = cells.groupBy("segment", "group").applyInArrow(pruned(k, digits), "query_id bigint, segment bigint, doc int, score double")
    names = index.documents().select("segment", F.posexplode("ids").alias("doc", "id"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    found = hits.join(names, ["segment", "doc"]).select("query_id", "id", "score")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


class Posting:
    """A term's row in a segment, weighted, with the places where its blocks begin."""

    def __init__(self, row: dict) -> None:
        self.docs = np.frombuffer(row["docs"], dtype="<u2").astype(np.int64)
        self.weights = np.frombuffer(row["weights"], dtype="<f8") * row["idf"]
        self.blocks = np.frombuffer(row["blocks"], dtype="<u2").astype(np.int64)
        self.maxima = np.frombuffer(row["maxima"], dtype="<f8") * row["idf"]
        self.edges = np.r_[np.searchsorted(self.docs, self.blocks * BLOCK), len(self.docs)]

    def add(self, scores: np.ndarray, chosen: np.ndarray) -> None:
        """Adds the weights of the documents in the chosen blocks (a flag for each block)."""
        own = np.flatnonzero(chosen[self.blocks])
        if len(own) == len(self.blocks):
            scores[self.docs] += self.weights
        elif len(own):
            size = self.edges[own + 1] - self.edges[own]
            at = np.repeat(self.edges[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            scores[self.docs[at]] += self.weights[at]


def best_in_segment(own: list[Posting], k: int, digits: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The k best documents (by score, then place) that have a term of own: places, rounded scores, and how many blocks were scored.

    Blocks are scored some at a time, those with the highest bound first.
    """
    bound = np.zeros(BLOCKS)
    for p in own:
        bound[p.blocks] += p.maxima
    order = np.argsort(-bound, kind="stable")[: int((bound > 0).sum())]
    docs, scores, at, step = np.zeros(0, dtype=np.int64), np.zeros(0), 0, 4
    while at < len(order) and not (len(docs) == k and np.round(bound[order[at]] + 1e-9, digits) < scores[-1]):
        chosen = np.zeros(BLOCKS, dtype=bool)
        chosen[order[at : at + step]] = True
        at, step = min(at + step, len(order)), 2 * step
        now = np.zeros(BLOCK * BLOCKS)
        for p in own:
            p.add(now, chosen)
        new = np.flatnonzero(now > 0)
        docs, scores = np.r_[docs, new], np.r_[scores, np.round(now[new], digits)]
        first = np.lexsort((docs, -scores))[:k]
        docs, scores = docs[first], scores[first]
    return docs, scores, at


def pruned(k: int, digits: int):
    """An applyInArrow function: the posting rows of a segment for a group of queries to the k best documents of each."""

    def run(table: pa.Table) -> pa.Table:
        of: dict[int, list[Posting]] = {}
        for row in (r for batch in table.to_batches(max_chunksize=256) for r in batch.to_pylist()):
            posting = Posting(row)
            for q in row["queries"]:
                of.setdefault(q, []).append(posting)
        segment = table["segment"][0].as_py() if table.num_rows else 0
        found = [(q, *best_in_segment(own, k, digits)[:2]) for q, own in of.items()]
        size = [len(d) for _, d, _ in found]
        return pa.table({
            "query_id": pa.array(np.repeat([q for q, _, _ in found], size), pa.int64()), "segment": pa.array([segment] * sum(size), pa.int64()),
            "doc": pa.array(np.concatenate([d for _, d, _ in found]), pa.int32()), "score": pa.array(np.concatenate([s for _, _, s in found]), pa.float64()),
        })

    return run
