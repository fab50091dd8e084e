"""Chunking with provenance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.functions.arrays import folded, let, rows_of, sums_before
from docloom.functions.vectors import cosine, fused
from docloom.operators.overlaps import containing, overlapping
from docloom.sources.workspace import small_batches


def sliding_words(df: DataFrame, keys: list[str], text: str = "text", size: int = 500, overlap: int = 50) -> DataFrame:
    """Windows of size words, each starting size - overlap words after the one before; windows at the tail are kept.

    Rows: keys, chunk_index (from 1), chunk_start and chunk_end (characters in
    the text, end exclusive), n_words, chunk_text: the exact slice of the text.
    Texts without words give no rows.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than size")
    step = size - overlap

    def cut(w: Column) -> Column:
        joined = lambda at, n: F.array_join(F.slice(w, at, F.lit(n)), "")
        own = lambda raw, at: F.length(raw) - (F.length(joined(at + step + 1, overlap)) if overlap else 0)
        window = lambda at: let(joined(at + 1, size), lambda raw: F.struct(own(raw, at).alias("own"), raw.alias("raw"), F.least(F.lit(size), F.size(w) - at).alias("n")))
        return F.transform(F.sequence(F.lit(0), F.size(w) - 1, F.lit(step)), window)

    # Each window joins its own words once; the words between two starts give the running offset.
    rows = df.where(F.rlike(F.col(text), F.lit(r"\S"))).select(*keys, let(tx.spaced_words(F.col(text)), cut).alias("_c"))
    rows = rows.select(*keys, F.arrays_zip("_c", sums_before(F.transform("_c", lambda c: c["own"])).alias("_b")).alias("_z"))
    at = rows_of(rows, keys, F.col("_z"), "_n", "_w").select(*keys, "_n", F.col("_w._c.raw").alias("_raw"), F.col("_w._c.n").alias("n_words"), F.col("_w._b").cast("int").alias("_before"))
    at = at.withColumn("chunk_text", F.regexp_replace("_raw", r"^\s+", ""))
    end = F.col("_before") + F.length("_raw")
    return at.select(*keys, (F.col("_n") + 1).alias("chunk_index"), (end - F.length("chunk_text")).alias("chunk_start"), end.alias("chunk_end"), "n_words", "chunk_text")


def by_size(texts: list[str], most: int = 1 << 18) -> Iterator[list[str]]:
    """texts in runs of at most so many characters (or one text): what a tokenizer keeps of a run takes a hundred times its size."""
    run, size = [], 0
    for text in texts:
        if run and size + len(text) > most:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


def sliding_tokens(df: DataFrame, keys: list[str], text: str, tokenizer_path: str, size: int = 500, overlap: int = 50) -> DataFrame:
    """Windows of size tokens of a public tokenizer file, as sliding_words: chunk_start and chunk_end come from the tokens' own offsets."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than size")

    @F.pandas_udf("array<struct<chunk_start: int, chunk_end: int, n_tokens: int>>")
    def spans(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        tokenizer.encode_special_tokens = True
        for part in parts:
            out = []
            for encoded in (e for run in by_size(part.fillna("").tolist()) for e in tokenizer.encode_batch(run, add_special_tokens=False)):
                at = encoded.offsets
                out.append([{"chunk_start": at[i][0], "chunk_end": at[min(i + size, len(at)) - 1][1], "n_tokens": min(size, len(at) - i)} for i in range(0, len(at), size - overlap)])
            yield pd.Series(out, dtype=object)

    small_batches(df.sparkSession)
    rows = rows_of(df, [*keys, text], spans(F.col(text)), "_n", "s")
    body = F.col(text).substr(F.col("s.chunk_start") + 1, F.col("s.chunk_end") - F.col("s.chunk_start"))
    return rows.select(*keys, (F.col("_n") + 1).alias("chunk_index"), "s.chunk_start", "s.chunk_end", "s.n_tokens", body.alias("chunk_text"))


def tokenized(df: DataFrame, text: str, tokenizer_path: str, out: str = "tokens") -> DataFrame:
    """Adds the token numbers of a public tokenizer file; null text has none."""

    @F.pandas_udf("array<int>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        tokenizer.encode_special_tokens = True
        for part in parts:
            yield pd.Series([e.ids for run in by_size(part.fillna("").tolist()) for e in tokenizer.encode_batch(run, add_special_tokens=False)], dtype=object)

    small_batches(df.sparkSession)
    return df.withColumn(out, run(F.col(text)))


def detokenized(df: DataFrame, tokens: str, tokenizer_path: str, out: str = "text") -> DataFrame:
    """Adds the text of token numbers, special ones included; null tokens give empty text."""

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        for part in parts:
            yield pd.Series(tokenizer.decode_batch([[] if t is None else list(map(int, t)) for t in part], skip_special_tokens=False), dtype=object)

    return df.withColumn(out, run(F.col(tokens)))


def generative_chunks(entries: DataFrame, keys: list[str], order: str, text: str, answer, most_words: int = 500) -> DataFrame:
    """(keys, window, chunk_index, chunk_text, entries): greedy windows, each cut by a model into the chunks of its JSON answer.

    answer(df, prompt column) adds column answer. A window whose answer can't be
    read is one chunk. A chunk's entries are those of its window of whose words
    it has more than half.
    """
    packed = greedy_windows(entries, keys, order, F.size(tx.words(F.col(text))), most_words)
    rows = entries.select(*keys, order, F.col(text).alias("entry_text")).join(packed, [*keys, order])
    whole = rows.groupBy(*keys, "window").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "entry_text"))), lambda e: e["entry_text"]), " ").alias("window_text"))
    said = F.from_json("answer", "chunks ARRAY<STRING>")["chunks"]
    cut = answer(whole, F.col("window_text")).withColumn("_c", F.when(F.size(said) > 0, said).otherwise(F.array("window_text")))
    chunks = cut.select(*keys, "window", F.posexplode("_c").alias("_n", "chunk_text")).withColumn("chunk_index", F.col("_n") + 1).drop("_n")
    from_ = word_overlap_contributors(chunks, rows, [*keys, "window"]).groupBy(*keys, "window", "chunk_index").agg(F.array_join(F.array_sort(F.collect_list(order)), ",").alias("entries"))
    return chunks.join(from_, [*keys, "window", "chunk_index"], "left")


def joined_entries(entries: DataFrame, keys: list[str], order: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(keys, text of all entries in order without separator) and (keys, order, entry_start, entry_end); an entry of null text stands nowhere and has no span."""
    w = Window.partitionBy(*keys).orderBy(order)
    size = F.length(F.coalesce(text, F.lit("")))
    start = F.coalesce(F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = entries.select(*keys, order, start.alias("entry_start"), (start + size).alias("entry_end"), F.col(text).isNotNull().alias("_has")).where("_has").drop("_has")
    whole = entries.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, F.coalesce(text, F.lit("")).alias("t")))).alias("_e"))
    return whole.select(*keys, F.array_join(F.col("_e.t"), "").alias("text")), spans


def contributors(chunks: DataFrame, spans: DataFrame, keys: list[str], order: str) -> DataFrame:
    """For each chunk the entries it overlaps, in order: first, last and all as text."""
    near = overlapping(chunks.select(*keys, "chunk_index", "chunk_start", "chunk_end"), spans, keys)
    return near.groupBy(*keys, "chunk_index").agg(F.min(order).alias("first_entry"), F.max(order).alias("last_entry"), F.array_join(F.array_sort(F.collect_list(order)), ",").alias("entries"))


def merged_maps(maps: Column, order: Column) -> Column:
    """One map of the maps of a group's rows; of a key the value of the last row by order counts. Null maps count as empty."""
    pairs = F.flatten(F.collect_list(F.transform(F.map_entries(maps), lambda e: F.struct(e["key"].alias("k"), order.alias("o"), e["value"].alias("v")))))
    last = lambda xs: F.filter(F.zip_with(xs, F.concat(F.slice(xs, F.lit(2), F.size(xs)), F.array(F.lit(None).cast("struct<k: string, o: bigint, v: string>"))), lambda x, y: F.struct(x["k"].alias("k"), x["v"].alias("v"), (y.isNull() | (y["k"] != x["k"])).alias("last"))), lambda z: z["last"] & z["k"].isNotNull())
    return F.map_from_entries(F.transform(let(F.array_sort(pairs.cast("array<struct<k: string, o: bigint, v: string>>")), last), lambda z: F.struct(z["k"], z["v"])))


def build_chunks(chunks: DataFrame, entries: DataFrame, keys: list[str], order: str, method: str) -> DataFrame:
    """Chunk rows with what their contributing entries bring, stamped with the method.

    Pages, keywords and citations (each once), the title of the first entry;
    where entries have them, chunk_locations (arrays of (primary, secondary), each
    once, in that order) and added_featurization (maps; the last entry wins).
    """
    own = overlapping(chunks, entries, keys)
    every = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    brought = {"keywords": every("keywords"), "citations": every("citations"), "entry_title": F.min_by("entry_title", order)}
    if "chunk_locations" in entries.columns:
        brought["chunk_locations"] = every("chunk_locations")
    if "added_featurization" in entries.columns:
        brought["added_featurization"] = merged_maps(F.col("added_featurization"), F.col(order))
    return own.groupBy(*keys, "chunk_index", "chunk_text").agg(F.min("page").alias("min_primary_index"), F.max("page").alias("max_primary_index"), *[c.alias(n) for n, c in brought.items()]).withColumn("chunking_method", F.lit(method))


def interpolated(df: DataFrame, keys: list[str], value: str, share: float, out: str) -> DataFrame:
    """(keys, out): of each group's values the one at the given share of their order, interpolated as low * (1 - part) + high * part.

    The sum is rounded once (Spark's percentile rounds both products), since
    values are then compared with it and neighbours may differ in their last bit.
    """
    w = Window.partitionBy(*keys)
    place = (F.count(F.lit(1)).over(w) - 1) * F.lit(share)
    placed = df.select(*keys, F.col(value).alias("_v"), place.alias("_p"), (F.row_number().over(w.orderBy(value)) - 1).alias("_r"))
    at = lambda p: F.max(F.when(F.col("_r") == p, F.col("_v")))
    ends = placed.groupBy(*keys).agg(at(F.floor("_p")).alias("_low"), at(F.ceil("_p")).alias("_high"), F.max(F.col("_p") - F.floor("_p")).alias("_part"))
    return ends.select(*keys, fused(F.col("_low"), 1 - F.col("_part"), F.col("_high") * F.col("_part")).alias(out))


def cut_where_far(units: DataFrame, keys: list[str], order: list[str], embed, percent: float, threshold: float | None) -> DataFrame:
    """units with chunk_index from 1: a chunk ends after a unit whose cosine distance to the next is above threshold, or above the given percentile of the document's distances.

    embed(df) adds column embedding from column unit. A distance to a vector of
    no length counts as 0.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    vectors = embed(units).withColumn("_far", F.coalesce(1 - cosine(F.col("embedding"), F.lead("embedding").over(w)), F.lit(0.0)))
    if threshold is None:
        has = vectors.withColumn("_next", F.lead(order[-1]).over(w)).where("_next is not null")
        bound = interpolated(has, keys, "_far", percent / 100, "_bound")
        vectors = vectors.join(bound, keys, "left")
    else:
        vectors = vectors.withColumn("_bound", F.lit(float(threshold)))
    cut = F.coalesce((F.lag("_far").over(w) > F.lag("_bound").over(w)).cast("int"), F.lit(0))
    return vectors.withColumn("_cut", cut).withColumn("chunk_index", F.sum("_cut").over(w) + 1)


def distance_chunks(entries: DataFrame, keys: list[str], order: str, text: str, embed, percent: float = 95.0, threshold: float | None = None, joint: str = " ") -> DataFrame:
    """(keys, chunk_index from 1, chunk_text, first_entry, last_entry, n_units): sentences of the entries, cut where neighbours lie far apart.

    Entries in order are cut into sentences, the units of cut_where_far.
    """
    units = rows_of(entries, [*keys, F.col(order).alias("_entry")], tx.sentences(F.col(text)), "_pos", "unit")
    grouped = cut_where_far(units, keys, ["_entry", "_pos"], embed, percent, threshold)
    own = grouped.groupBy(*keys, "chunk_index").agg(F.array_sort(F.collect_list(F.struct("_entry", "_pos", "unit"))).alias("_u"), F.min("_entry").alias("first_entry"), F.max("_entry").alias("last_entry"), F.count(F.lit(1)).alias("n_units"))
    return own.select(*keys, "chunk_index", F.array_join(F.col("_u.unit"), joint).alias("chunk_text"), "first_entry", "last_entry", "n_units")


def distance_chunks_of_words(entries: DataFrame, keys: list[str], order: str, text: str, embed, size: int, percent: float = 95.0, threshold: float | None = None) -> DataFrame:
    """(keys, chunk_index from 1, chunk_text, n_units, first_entry, last_entry, entries): as distance_chunks, over units of size words of the entries' joined text.

    Units may reach over entries; words of a unit are joined by one space. A
    chunk's entries are all that it overlaps, from its first unit to its last.
    """
    whole, spans = joined_entries(entries, keys, order, text)
    units = sliding_words(whole, keys, "text", size, 0).withColumnRenamed("chunk_index", "_pos").withColumn("unit", F.regexp_replace("chunk_text", r"\s+", " "))
    grouped = cut_where_far(units, keys, ["_pos"], embed, percent, threshold)
    own = grouped.groupBy(*keys, "chunk_index").agg(F.array_sort(F.collect_list(F.struct("_pos", "unit"))).alias("_u"), F.min("chunk_start").alias("chunk_start"), F.max("chunk_end").alias("chunk_end"), F.count(F.lit(1)).alias("n_units"))
    made = own.select(*keys, "chunk_index", F.array_join(F.col("_u.unit"), " ").alias("chunk_text"), "n_units", "chunk_start", "chunk_end")
    return made.join(contributors(made, spans, keys, order), [*keys, "chunk_index"]).drop("chunk_start", "chunk_end")


def distance_chunks_of_pages(pages: DataFrame, keys: list[str], pages_json: str, embed, **settings) -> DataFrame:
    """distance_chunks over documents given as JSON objects of page number to text; units are joined by line feeds."""
    rows = pages.select(*keys, F.explode(F.from_json(pages_json, "MAP<STRING, STRING>")).alias("_page", "_text"))
    return distance_chunks(rows.withColumn("page", F.col("_page").cast("int")), keys, "page", "_text", embed, joint="\n", **settings)


def token_crops(tokens: Column, size: int, overlap: int = 0, padding: int = 0) -> Column:
    """An array of tokens as arrays of size tokens, each size - overlap after the one before, the last one padded; a shorter array stays as it is."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than size")
    padded = lambda t: F.concat(t, F.array_repeat(F.lit(padding), F.lit(size) - F.size(t)))
    starts = F.sequence(F.lit(0), F.greatest(F.size(tokens) - overlap - 1, F.lit(0)), F.lit(size - overlap))
    return F.when(F.size(tokens) <= size, F.array(tokens)).otherwise(F.transform(starts, lambda at: padded(F.slice(tokens, at + 1, F.lit(size)))))


def word_overlap_contributors(chunks: DataFrame, entries: DataFrame, keys: list[str], least: float = 0.5) -> DataFrame:
    """Pairs of chunk and entry of one document, where the chunk has more than the given part of the entry's words."""
    return containing(chunks, entries, keys, "chunk_text", "entry_text", least)


def distance_groups(df: DataFrame, keys: list[str], order: str, vector: str, threshold: float) -> DataFrame:
    """Adds similarity to the next row and group_id (from 0): a new group begins after a row whose distance to the next exceeds the threshold."""
    w = Window.partitionBy(*keys).orderBy(order)
    out = df.withColumn("similarity", cosine(F.col(vector), F.lead(vector).over(w)))
    out = out.withColumn("_cut", F.coalesce((1 - F.lag("similarity").over(w) > threshold).cast("int"), F.lit(0)))
    return out.withColumn("group_id", F.sum("_cut").over(w)).drop("_cut")


def percentile_thresholds(df: DataFrame, keys: list[str], order: str, vector: str, percent: float = 95.0) -> DataFrame:
    """Per document the percentile of the distances between neighbours, interpolated."""
    w = Window.partitionBy(*keys).orderBy(order)
    near = df.select(*keys, (1 - cosine(F.col(vector), F.lead(vector).over(w))).alias("d"), F.lead(order).over(w).isNotNull().alias("_has")).where("_has")
    return near.groupBy(*keys).agg(F.percentile("d", percent / 100).alias("threshold"))


def header_sessions(df: DataFrame, keys: list[str], order: str, is_header: Column) -> DataFrame:
    """Adds session: it grows by 1 at each header, which belongs to its new session; 0 before the first."""
    return df.withColumn("session", F.sum(is_header.cast("int")).over(Window.partitionBy(*keys).orderBy(order)))


def greedy_windows(df: DataFrame, keys: list[str], order: str, size: Column, most: int, overlap: int = 0) -> DataFrame:
    """(keys, order, window): entries in order fill a window until the next would pass most; then a new one starts, with up to overlap carried over counted in.

    An entry larger than most has a window of its own.
    """
    packed = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), size.cast("bigint").alias("n")))).alias("_e"))
    start = F.struct(F.lit(0).cast("bigint").alias("size"), F.lit(0).alias("k"), F.lit(False).alias("any"))

    def step(acc, e):
        full = acc["any"] & (acc["size"] + e["n"] > most)
        k = acc["k"] + full.cast("int")
        total = F.when(full, F.least(acc["size"], F.lit(overlap)) + e["n"]).otherwise(acc["size"] + e["n"])
        return F.struct(total.alias("size"), k.alias("k"), F.lit(True).alias("any")), k

    packed = packed.withColumn("_w", folded(F.col("_e"), start, step, "int"))
    rows = rows_of(packed, keys, F.arrays_zip(F.col("_e.o").alias("o"), F.col("_w").alias("w")), "_r")
    return rows.select(*keys, F.col("_r.o").alias(order), F.col("_r.w").alias("window"))


def climbs(scores: np.ndarray) -> np.ndarray:
    """From each score how far the scores rise after it until they fall."""
    top = scores.copy()
    for g in range(len(top) - 2, -1, -1):
        if scores[g + 1] >= scores[g]:
            top[g] = top[g + 1]
    return top - scores


def block_similarities(codes: list[int], width: int, block: int) -> np.ndarray:
    """Cosine of the word counts of the block of lines before and after each gap between lines of width words.

    Both blocks move on by a line from gap to gap and their product and lengths
    with them, in whole numbers: time and memory are in proportion to the text.
    """
    n, kinds = len(codes) // width, max(codes) + 1
    counts, square, dot = ([0] * kinds, [0] * kinds), [0, 0], 0
    scores = np.zeros(n - 1)

    def move(side: int, line: int, by: int) -> None:
        nonlocal dot
        own, other = counts[side], counts[1 - side]
        for w in codes[line * width : (line + 1) * width]:
            square[side] += 1 + 2 * by * own[w]
            dot += by * other[w]
            own[w] += by

    for line in range(1, min(n, block + 1)):
        move(1, line, 1)
    move(0, 0, 1)
    for g in range(1, n):
        scores[g - 1] = dot / max(np.sqrt(square[0]) * np.sqrt(square[1]), 1e-12)
        move(1, g, -1)
        move(0, g, 1)
        if g >= block:
            move(0, g - block, -1)
        if g + block < n:
            move(1, g + block, 1)
    return scores


def text_tiles(texts: list[str], width: int = 20, block: int = 10) -> list[str]:
    """TextTiling of one text (Hearst 1997): tile boundaries at deep valleys of the similarity of neighbouring blocks."""
    out: list[str] = []
    for text in texts:
        words = text.split()
        n = len(words) // width
        if n < 3:
            out.append(text)
            continue
        ids = {w: i for i, w in enumerate(dict.fromkeys(w.lower() for w in words))}
        scores = block_similarities([ids[w.lower()] for w in words[: n * width]], width, block)
        depth = climbs(scores[::-1])[::-1] + climbs(scores)
        floor = depth.mean() + depth.std() / 2
        rim = np.r_[-1.0, depth, -1.0]
        cuts = [g + 1 for g in range(n - 1) if depth[g] > floor and rim[g] < depth[g] >= rim[g + 2]]
        tiles = [words[a * width : (b * width if b != n else None)] for a, b in zip([0, *cuts], [*cuts, n], strict=True)]
        out.append("\f".join(" ".join(t) for t in tiles if t))
    return out


def topic_segments(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, chunk_index, chunk_text): the tiles of each text; blank ones are dropped."""

    @F.pandas_udf("string")
    def tiled(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(text_tiles(part.fillna("").str.replace("\f", " ").tolist()), dtype=object)

    small_batches(df.sparkSession)
    tiles = F.filter(F.split(tiled(F.col(text)), "\f"), lambda t: F.trim(t) != "")
    rows = rows_of(df, keys, tiles, "_n", "chunk_text")
    return rows.select(*keys, (F.col("_n") + 1).alias("chunk_index"), "chunk_text")
