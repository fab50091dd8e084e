"""Quality rules: a few counts per text, and a likelihood ratio between trusted and raw text.

The ratio compares two multinomials over hashed n-grams: one of trusted
documents, one of the whole raw corpus. A document's score is the mean, over
its n-grams, of log(share in trusted / share in raw); it is kept if that
reaches a fixed bound. Log ratios are rounded to whole multiples of 2^-20, so
sums don't depend on their order and every run gives the same verdicts.

Tokens for n-grams are runs of ASCII letters, digits and non-ASCII characters,
or runs of other ASCII characters, within a word, with A-Z as a-z. A token's
hash is the first 32 bits of its MD5; an n-gram's bucket is a polynomial of its
tokens' hashes.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.shared import LOWER, UPPER, small_batches

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = re.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+|[^0-9A-Za-z\x80-\U0010FFFF\x20\x09-\x0D]+")
FOLD = str.maketrans(UPPER, LOWER)
SYMBOLS = "#*$%&|<>"
SPACES = "\x20\t\n\x0b\x0c\r"
#: One natural logarithm in whole numbers.
UNIT = 1 << 20
#: Factor of the polynomial over tokens.
FACTOR = 1_000_003
#: Characters of a text that are cut into words at a time.
SLICE = 1 << 20


class Tokens(dict[str, int]):
    """Hash of each token that was met; emptied between texts when there are more than most."""

    def __init__(self, most: int = 500_000) -> None:
        super().__init__()
        self.most = most

    def __missing__(self, token: str) -> int:
        number = int.from_bytes(hashlib.md5(token.translate(FOLD).encode()).digest()[:4], "big")
        if len(token) <= 64 and len(self) < self.most:
            self[token] = number
        return number

    def hashes(self, text: str) -> np.ndarray:
        if len(self) >= self.most:
            self.clear()
        found = TOKEN.findall(text)
        return np.fromiter(map(self.__getitem__, found), dtype=np.int64, count=len(found))


def slices(text: str) -> Iterator[str]:
    """A text in runs of about SLICE characters that end before white space."""
    begin, space = 0, re.compile(r"[\x20\x09-\x0D]")
    while len(text) - begin > SLICE:
        at = space.search(text, begin + SLICE)
        if at is None:
            break
        yield text[begin : at.start()]
        begin = at.start()
    yield text[begin:]


def buckets(hashes: np.ndarray, sizes: tuple[int, ...], many: int) -> np.ndarray:
    """Bucket of every n-gram of each size: the polynomial of its tokens' hashes modulo many."""
    runs = []
    for size in sizes:
        n = max(len(hashes) - size + 1, 0)
        runs.append(reduce(lambda h, k: (h * FACTOR + hashes[k : k + n]) % many, range(1, size), hashes[:n] % many))
    return np.concatenate(runs)


def repeated(words: np.ndarray, size: int = 3) -> int:
    """How many words stand in runs of size words that are found twice or more. words: numbers from 0 on, equal for equal words."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    runs, many, base = words[:n].astype(np.int64), int(words.max()) + 1, int(words.max()) + 1
    for k in range(1, size):
        if many > 2**62 // base:  # ranks of the runs so far, which stay below their number
            runs = np.unique(runs, return_inverse=True)[1]
            many = n
        runs, many = runs * base + words[k : k + n], many * base
    order = np.argsort(runs, kind="stable")
    same = runs[order[1:]] == runs[order[:-1]]
    again = np.zeros(n + 1, dtype=bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    hit = np.zeros(len(words), dtype=bool)
    for k in range(size):
        hit[k : k + n] |= again[:n]
    return int(hit.sum())


def measured(text: str, tokens: Tokens) -> tuple[list[int], np.ndarray]:
    """(words, characters in words, symbols, repeated lines, words in repeated runs) and the hashes of the text's tokens."""
    numbers: dict[str, int] = defaultdict(count().__next__)
    hashes, ids = [], []
    for run in slices(text):
        words = WORD.findall(run)
        ids.append(np.fromiter(map(numbers.__getitem__, words), dtype=np.int32, count=len(words)))
        hashes.append(tokens.hashes(run))
    words = np.concatenate(ids)
    met, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in met
            met.add(line)
    chars = len(text) - sum(map(text.count, SPACES))
    return [len(words), chars, sum(map(text.count, SYMBOLS)), again, repeated(words)], np.concatenate(hashes)


def counted(sizes: tuple[int, ...], many: int):
    """A mapInArrow function: (text, trusted) to (bucket, raw, trusted), one row for each bucket that the task met."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, raw, good = Tokens(), np.zeros(many, dtype=np.int64), np.zeros(many, dtype=np.int64)
        for part in parts:
            none, trusted = np.zeros(0, dtype=np.int64), part["trusted"].to_pylist()
            own = [buckets(np.concatenate([tokens.hashes(s) for s in slices(text.as_py() or "")]), sizes, many) for text in part["text"]]
            raw += np.bincount(np.concatenate([none, *own]), minlength=many)
            good += np.bincount(np.concatenate([none, *[x for x, t in zip(own, trusted, strict=True) if t]]), minlength=many)
        met = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(raw[met]), pa.array(good[met])], ["bucket", "raw", "trusted"])

    return run


def log_ratios(raw: np.ndarray, trusted: np.ndarray) -> np.ndarray:
    """Of each bucket log(share in trusted / share in raw) with one added to every count, in UNITs; zeros if nothing is trusted."""
    if not trusted.sum():
        return np.zeros(len(raw), dtype=np.int64)
    ratio = np.log((trusted + 1.0) / (trusted.sum() + len(raw))) - np.log((raw + 1.0) / (raw.sum() + len(raw)))
    return np.floor(ratio * UNIT + 0.5).astype(np.int64)


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judged(weights: np.ndarray, sizes: tuple[int, ...], names: list[str]):
    """A mapInArrow function: (id, text) to (id, counts, n-grams of the text, sum of their log ratios)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens()
        for part in parts:
            rows = []
            for text in part["text"]:
                numbers, hashes = measured(text.as_py() or "", tokens)
                own = buckets(hashes, sizes, len(weights))
                rows.append([*numbers, len(own), int(weights[own].sum())])
            columns = np.array(rows, dtype=np.int64).reshape(-1, len(names) - 1).T
            yield pa.RecordBatch.from_arrays([part["id"], *[pa.array(c) for c in columns]], names)

    return run


def trusted_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Ids with a label of good quality and none of bad quality or toxic text."""
    return labels.groupBy(id_col).agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t")).where("q = 1 and t = 0").select(id_col)


def rate_documents(
    docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", many: int = 10_000, sizes: tuple[int, ...] = (1, 2), least: float = -0.2,
    least_words: int = 50, most_repeated: float = 0.5, most_broadcast: int = 500_000,
) -> DataFrame:
    """One row per row of docs: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_grams, score, kept.

    trusted holds the ids (column id_col) of documents that text should be like.
    All rows of docs are counted for the raw corpus, those whose id is trusted
    also for the target; n-grams of the given sizes fall into many buckets.
    base_failed: fewer than least_words words, or more than most_repeated of
    them in 3-word runs found twice or more in the text. score is the mean log
    ratio of the text's n-grams (0 without any); kept is not base_failed and
    score >= least, compared in whole numbers. At -0.2 a text goes whose n-grams
    are on average 18 % rarer in trusted text than in the corpus; ordinary text
    lies above 0, since the corpus contains what is not trusted.

    Null and empty texts have no words. Repeated rows are counted and returned
    each; rows without id are never trusted; other columns are not read. With no
    trusted document every score is 0. An empty table gives an empty result. A
    task holds one text with its words' numbers; long texts are cut into words
    piece by piece.

    A first pass over all texts sends at most many rows per task, a second one
    scores them; the driver holds many numbers. Up to most_broadcast trusted ids
    (counted first) are broadcast, more are joined by a shuffle.
    """
    spark = docs.sparkSession
    small_batches(spark)
    ids = trusted.select(F.col(id_col).alias("id")).where("id is not null").distinct().withColumn("trusted", F.lit(True))
    few = ids.limit(most_broadcast + 1).count() <= most_broadcast
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    marked = rows.join(F.broadcast(ids) if few else ids, "id", "left").select("text", "trusted")
    sums = marked.mapInArrow(counted(sizes, many), "bucket int, raw bigint, trusted bigint").groupBy("bucket").agg(F.sum("raw"), F.sum("trusted")).collect()
    raw, good = np.zeros(many, dtype=np.int64), np.zeros(many, dtype=np.int64)
    for bucket, n, m in sums:
        raw[bucket], good[bucket] = n, m
    names = ["id", *COLUMNS, "n_grams", "total"]
    kind = docs.schema[id_col].dataType.simpleString()
    found = rows.mapInArrow(judged(log_ratios(raw, good), sizes, names), f"id {kind}, " + ", ".join(f"{n} bigint" for n in names[1:]))
    failed = (F.col("n_words") < least_words) | (F.col("n_repeat_words") > F.col("n_words") * most_repeated)
    enough = F.col("total") >= F.col("n_grams") * F.floor(F.lit(least * UNIT))
    score = F.when(F.col("n_grams") > 0, F.round(F.col("total") / F.col("n_grams") / UNIT, 6)).otherwise(F.lit(0.0))
    return found.select(F.col("id").alias(id_col), *COLUMNS, failed.alias("base_failed"), "n_grams", score.alias("score"), (~failed & enough).alias("kept"))
