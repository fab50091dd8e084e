"""Sentences with abbreviations learnt from the corpus (Kiss and Strunk 2006: unsupervised multilingual sentence boundary detection).

An abbreviation is a word that nearly always has a period behind it, is short,
and may have periods inside. One aggregation counts every word with and without
a period; a log-likelihood ratio, weighted by length, periods inside and the
times it stood without one, says which are abbreviations. A period behind one
ends no sentence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.functions.arrays import let, rows_of
from docloom.sources.workspace import written

#: Share of an abbreviation's occurrences that have a period, and the least score.
USUAL, LEAST = 0.99, 0.3
#: Up to so many abbreviations stand in the plan itself, and each text is cut where it is read.
LISTED = 2000


def bare(token: Column) -> Column:
    """A token in lower case without quotes, brackets and commas around it; its periods stay."""
    return F.regexp_replace(F.lower(token), r"""^["'(\[]+|[,;:!?"')\]]+$""", "")


def word(token: Column) -> Column:
    return F.rtrim(bare(token), F.lit("."))


def abbreviations(df: DataFrame, text: str = "text", least: float = LEAST) -> DataFrame:
    """(word, n, n_dotted, score) of the words that are taken for abbreviations. Tokens without a letter don't count."""
    # Tokens are counted as they stand, so that patterns run once per distinct token.
    spelt = rows_of(df, [], F.split(F.col(text), r"\s+"), "t").groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    tokens = spelt.select(word(F.col("t")).alias("word"), "n", F.when(F.endswith(bare(F.col("t")), F.lit(".")), F.col("n")).otherwise(F.lit(0)).alias("dot"))
    counts = tokens.where(F.rlike("word", F.lit(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]"))).groupBy("word").agg(F.sum("n").alias("n"), F.sum("dot").alias("n_dotted"))
    counts = written(counts, "words")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_dotted"), F.lit(0)).alias("d")).first()
    share = min(max(total.d / max(total.n, 1), 1e-12), 1 - 1e-12)
    without = F.col("n") - F.col("n_dotted")
    ratio = 2.0 * (F.col("n_dotted") * F.log(F.lit(USUAL) / share) + without * F.log(F.lit(1.0 - USUAL) / (1.0 - share)))
    inner = F.length("word") - F.length(F.replace("word", F.lit(".")))
    letters = F.length("word") - inner
    scored = counts.where("n_dotted > 0").withColumn("score", ratio * F.exp(-letters) * (inner + 1) * F.pow(letters.cast("double"), -without))
    return scored.where(F.col("score") >= least)


def cut_in_place(df: DataFrame, keys: list[str], text: str, known: list[str]) -> DataFrame:
    """(keys, _s): the sentences of each text as an array, without a shuffle."""
    goes_on = lambda p: F.when(F.endswith(p, F.lit(".")), word(F.regexp_extract(p, r"(\S+)$", 1)).isin(known)).otherwise(F.lit(False))
    pieces = df.select(*keys, F.split(F.col(text), r"(?<=[.!?])(?=\s)").alias("_p"))
    ends = F.filter(F.transform("_p", lambda p, i: F.when(~goes_on(p) | (i == F.size("_p") - 1), i + 1)), lambda i: i.isNotNull())
    cut = pieces.withColumn("_e", ends)
    own = F.transform("_e", lambda e, k: let(F.coalesce(F.get("_e", k - 1), F.lit(0)), lambda b: F.array_join(F.slice("_p", b + 1, e - b), "")))
    return cut.select(*keys, F.filter(F.transform(own, lambda x: F.regexp_replace(x, r"^\s+", "")), lambda x: x != "").alias("_s"))


def learnt_sentences(df: DataFrame, keys: list[str], text: str = "text", known: DataFrame | None = None, most: int = 200_000) -> DataFrame:
    """(keys, sentence_no from 1, sentence): texts cut after . ! or ? before white space, but not after an abbreviation.

    Abbreviations are those of known (column word), else learnt from all texts of
    df. They are counted: up to LISTED (and most) are part of the plan, and no
    text is shuffled; up to most are sent to every task, more are joined by a
    shuffle. keys have to tell texts apart. What stands between two pieces of a
    sentence stays as it is. Null and blank texts have no sentences.
    """
    known = (abbreviations(df, text) if known is None else known).select(F.col("word").alias("_word")).distinct().withColumn("_known", F.lit(True))
    listed = [r["_word"] for r in known.limit(min(LISTED, most) + 1).collect()]
    if len(listed) <= min(LISTED, most):
        return rows_of(cut_in_place(df, keys, text, [w for w in listed if w is not None]), keys, F.col("_s"), "_n", "sentence").select(*keys, (F.col("_n") + 1).alias("sentence_no"), "sentence")
    few = known.limit(most + 1).count() <= most
    pieces = rows_of(df, keys, F.split(F.col(text), r"(?<=[.!?])(?=\s)"), "_pos", "_piece")
    last = F.regexp_extract("_piece", r"(\S+)$", 1)
    marked = pieces.withColumn("_last", F.when(F.endswith("_piece", F.lit(".")), word(last))).join(F.broadcast(known) if few else known, F.col("_last") == F.col("_word"), "left")
    w = Window.partitionBy(*keys).orderBy("_pos")
    ends = F.coalesce(F.lag(F.col("_known").isNull()).over(w).cast("int"), F.lit(0))
    own = marked.withColumn("_end", ends).withColumn("_s", F.sum("_end").over(w)).groupBy(*keys, "_s")
    whole = own.agg(F.regexp_replace(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_piece"))), lambda p: p["_piece"]), ""), r"^\s+", "").alias("sentence")).where("sentence <> ''")
    return whole.select(*keys, F.row_number().over(Window.partitionBy(*keys).orderBy("_s")).alias("sentence_no"), "sentence")
