"""Benchmark decontamination by winnowing.

A window of a test item is 13 words in a row, or all words of a shorter item.
Texts are cut into k-word grams; of the grams inside every window the least hash
is the window's fingerprint, so neighbouring windows mostly share theirs. Two
texts with a window in common have its fingerprint in common, wherever the
window lies: every shared span of 13 words is found. The fingerprints of both
sides are joined; each hit is then extended to the whole window, by a second
hash of all its words that is independent of the first. Items of n < 13 words
are matched on n words, each length by itself.

No text is compared with another and none is shuffled: a window that many items
share is one entry with one set of items.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm import wordhash
from docloom.llm.shared import small_batches, text_key, without, written

WINDOW = 13
#: Factor of the hash over whole windows; fingerprints have another one.
WHOLE = np.uint64(0xC2B2AE3D27D4EB4F)


def gram_size(span: int) -> int:
    """k, for windows of so many words; the window holds span - k + 1 grams."""
    return 6 if span == WINDOW else (span + 1) // 2


class Windows(NamedTuple):
    """Windows of a batch of texts, by text and place of the first word."""

    text: np.ndarray
    start: np.ndarray
    fingerprint: np.ndarray
    whole: np.ndarray


def windows(hashes: np.ndarray, counts: np.ndarray, span: int, wanted: np.ndarray | None = None) -> Windows:
    """All windows of span words; only those whose fingerprint is wanted (sorted), if given."""
    k = gram_size(span)
    h, owner, place = wordhash.grams(hashes, counts, k)
    n = len(h) - (span - k)
    if n <= 0:
        none = np.zeros(0, dtype=np.int64)
        return Windows(none, none, none.view(np.uint64), none.view(np.uint64))
    least = h[:n].copy()
    for s in range(1, span - k + 1):
        np.minimum(least, h[s : s + n], out=least)
    use = owner[:n] == owner[span - k : span - k + n]
    if wanted is not None:
        use &= among(least, wanted)
    at = np.flatnonzero(use)
    text, start = owner[at], place[at]
    first = (np.cumsum(counts) - counts)[text] + start
    whole = np.zeros(len(at), dtype=np.uint64)
    for i in range(span):
        whole = whole * WHOLE + hashes[first + i]
    return Windows(text, start, least[at], wordhash.mixed(whole + np.uint64(span)))


def among(values: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    return sorted_[np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)] == values if len(sorted_) else np.zeros(len(values), dtype=bool)


def item_windows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: (item, text) to (item, span, fp, whole), each distinct window of each item; span is its number of words."""
    for part in parts:
        texts = wordhash.byte_strings(part["text"])
        for a, b in wordhash.batches(texts, len(texts)):
            hashes, counts = wordhash.words(texts[a:b], wordhash.ALNUM)
            starts = np.cumsum(counts) - counts
            for span in range(1, WINDOW + 1):
                own = np.flatnonzero(counts >= WINDOW if span == WINDOW else counts == span)
                if not len(own):
                    continue
                w = windows(np.concatenate([hashes[starts[i] : starts[i] + counts[i]] for i in own]), counts[own], span)
                _, first = np.unique(np.stack([w.text.astype(np.uint64), w.whole]), axis=1, return_index=True)
                item = part["item"].slice(a, b - a).take(pa.array(own[w.text[first]]))
                yield pa.RecordBatch.from_arrays([item, pa.array(np.full(len(first), span), pa.int32()), pa.array(w.fingerprint[first].view(np.int64)), pa.array(w.whole[first].view(np.int64))], ["item", "span", "fp", "whole"])
    wordhash.release()


def covered(text: np.ndarray, start: np.ndarray, span: np.ndarray, texts: int) -> np.ndarray:
    """How many words of each text lie in one of its windows."""
    order = np.lexsort((start, text))
    text, begin, end = text[order], start[order], (start + span)[order]
    if not len(text):
        return np.zeros(texts, dtype=np.int64)
    # Texts are laid out one after the other, further apart than any window reaches, so that one running maximum serves all.
    base = np.arange(texts, dtype=np.int64) * (end.max() + 1)
    begin, end = begin + base[text], end + base[text]
    reach = np.r_[np.int64(-1), np.maximum.accumulate(end)[:-1]]
    return np.bincount(text, np.maximum(end - np.maximum(begin, reach), 0), minlength=texts).astype(np.int64)


RUNS = "array<struct<fp: bigint, span: int, start: array<bigint>, whole: array<bigint>>>"


def lists(owner: np.ndarray, values: pa.Array, texts: int) -> pa.ListArray:
    """values, ordered by owner, as one list for each text."""
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.bincount(owner, minlength=texts))], pa.int32()), values)


def judged(spans: list[int], known):
    """A mapInArrow function for few windows, all known to the task: (row, id, key, text) to (row, id, key, n_words, n_hit, sets).

    known holds (fingerprints, windows, sets): sorted arrays, and the set of items of each window.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, whole, set_of = known.value
        for part in parts:
            texts = wordhash.byte_strings(part["text"])
            for a, b in wordhash.batches(texts, len(texts)):
                hashes, counts = wordhash.words(texts[a:b], wordhash.ALNUM)
                found = [(windows(hashes, counts, span, wanted), span) for span in spans]
                text, start = np.concatenate([w.text for w, _ in found]), np.concatenate([w.start for w, _ in found])
                span, h = np.concatenate([np.full(len(w.text), s) for w, s in found]), np.concatenate([w.whole for w, _ in found])
                hit = among(h, whole)
                text, start, span, h = text[hit], start[hit], span[hit], h[hit]
                pairs = np.unique(np.stack([text, set_of[np.searchsorted(whole, h)]]), axis=1)
                own = lists(pairs[0], pa.array(pairs[1], pa.int64()), b - a)
                yield pa.RecordBatch.from_arrays(
                    [*[part[c].slice(a, b - a) for c in ("row", "id", "key")], pa.array(counts, pa.int64()), pa.array(covered(text, start, span, b - a)), own], ["row", "id", "key", "n_words", "n_hit", "sets"]
                )
        wordhash.release()

    return run


def described(spans: list[int]):
    """A mapInArrow function for any number of windows: (row, id, key, text) to (row, id, key, n_words, runs).

    A run is a fingerprint with the neighbouring windows that share it.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("fp", pa.int64()), ("span", pa.int32()), ("start", pa.list_(pa.int64())), ("whole", pa.list_(pa.int64()))])
        for part in parts:
            texts = wordhash.byte_strings(part["text"])
            for a, b in wordhash.batches(texts, len(texts)):
                hashes, counts = wordhash.words(texts[a:b], wordhash.ALNUM)
                owner, runs = [], []
                for span in spans:
                    w = windows(hashes, counts, span)
                    cut = np.flatnonzero(np.r_[len(w.text) > 0, (w.text[1:] != w.text[:-1]) | (w.fingerprint[1:] != w.fingerprint[:-1])])
                    ends = pa.array(np.r_[cut, len(w.text)], pa.int32())
                    fields = [pa.array(w.fingerprint[cut].view(np.int64)), pa.array(np.full(len(cut), span), pa.int32())]
                    fields += [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (w.start, w.whole.view(np.int64))]
                    runs.append(pa.StructArray.from_arrays(fields, fields=list(kind)))
                    owner.append(w.text[cut])
                owner = np.concatenate(owner)
                values = pa.concat_arrays(runs).take(pa.array(np.argsort(owner, kind="stable")))
                yield pa.RecordBatch.from_arrays([*[part[c].slice(a, b - a) for c in ("row", "id", "key")], pa.array(counts, pa.int64()), lists(owner, values, b - a)], ["row", "id", "key", "n_words", "runs"])
        wordhash.release()

    return run


def coverage(hits: DataFrame) -> DataFrame:
    """From windows (row, start, span): (row, n_hit), the words in at least one."""
    end = F.col("start") + F.col("span")
    reach = F.coalesce(F.max(end).over(Window.partitionBy("row").orderBy("start", "span").rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    fresh = F.greatest(end - F.greatest(F.col("start"), reach), F.lit(0))
    return hits.select("row", fresh.alias("fresh")).groupBy("row").agg(F.sum("fresh").cast("bigint").alias("n_hit"))


def item_sets(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (item, whole): windows (whole, items) and (items, item). Windows of the same items have one set, named by sums over its items: no list of items is gathered."""
    both = found.select("item", "whole").distinct()
    sums = [F.sum(F.pmod(F.xxhash64("item", F.lit(s)), F.lit(1 << 40))).alias(f"h{s}") for s in range(2)]
    named = both.groupBy("whole").agg(*sums, F.count(F.lit(1)).alias("n"))
    named = written(named.select("whole", F.xxhash64("h0", "h1", "n").alias("items")), "decon-sets")
    return named, written(both.join(named, "whole").select("items", "item").distinct(), "decon-items")


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", one_in: int = 20, known_most: int = 500_000) -> DataFrame:
    """One row per row of docs: id, key (a hash of the text), n_words, n_hit, item_ids (sorted as strings), contaminated.

    Words are runs of ASCII letters and digits and non-ASCII characters, A-Z as
    a-z. A word is hit if it lies in an occurrence of a window: 13 consecutive
    words of an item, or all words of an item of 1 to 12. contaminated: at
    least one word and at least one in one_in words are hit. Null or
    empty texts have no words and are never hit; items without words are never
    found; null item ids count as one id, "null". Ids of documents may be of any
    type and may be null; repeated rows and ids each get their result; other
    columns are not read. Empty tables on either side are allowed. A text may
    be of any length; its words take a few dozen bytes each in its task.

    Words count as equal when their 64-bit hashes are, windows when two
    independent 64-bit hashes over them are.

    While the benchmark has at most known_most distinct windows, they are
    broadcast (24 bytes each) and documents are judged where they are read.
    Beyond, fingerprints and then windows of both sides meet in shuffled joins.
    The result is the same.
    """
    spark = docs.sparkSession
    small_batches(spark)
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"), F.col(item_text).alias("text"))
    found = written(items.mapInArrow(item_windows, "item string, span int, fp bigint, whole bigint"), "decon-windows")
    sets, members = item_sets(found)
    spans = sorted(r.span for r in found.select("span").distinct().collect()) or [WINDOW]
    few = sets.limit(known_most + 1).count() <= known_most

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    if few:
        table = sets.toPandas().to_numpy(dtype=np.int64).reshape(-1, 2)
        table = table[np.argsort(table[:, 0].view(np.uint64))]
        prints = np.unique(found.select("fp").distinct().toPandas()["fp"].to_numpy(dtype=np.int64).view(np.uint64))
        known = spark.sparkContext.broadcast((prints, table[:, 0].copy().view(np.uint64), table[:, 1].copy()))
        rows = written(rows.mapInArrow(judged(spans, known), f"row bigint, id {kind}, key bigint, n_words bigint, n_hit bigint, sets array<bigint>"), "decon-docs")
        own = rows.where("n_hit > 0").select("row", F.explode("sets").alias("items"))
    else:
        rows = written(rows.mapInArrow(described(spans), f"row bigint, id {kind}, key bigint, n_words bigint, runs {RUNS}"), "decon-docs")
        runs = rows.select("row", F.explode("runs").alias("r")).select("row", "r.fp", "r.span", "r.start", "r.whole")
        near = runs.join(found.select("fp").distinct(), "fp", "left_semi")
        near = near.select("row", "span", F.explode(F.arrays_zip("start", "whole")).alias("w")).select("row", "span", "w.start", "w.whole")
        hits = written(near.join(sets, "whole").select("row", "start", "span", "items"), "decon-hits")
        own = hits.select("row", "items").distinct()
        rows = rows.drop("runs").join(coverage(hits), "row", "left").withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("bigint")))
    ids = own.join(members, "items").select("row", "item").distinct().groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("item_ids"))
    return rows.join(ids, "row", "left").select(
        F.col("id").alias(id_col), "key", "n_words", "n_hit", F.coalesce("item_ids", none_found()).alias("item_ids"), ((F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words"))).alias("contaminated")
    )


def none_found() -> Column:
    return F.array().cast("array<string>")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs (doc_id, text, ...) that are not contaminated, with all their columns."""
    return without(docs, written(find_contamination(docs, benchmark), "decon-found").where("contaminated"))
