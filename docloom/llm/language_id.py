"""Language identification with a sparse multinomial logistic regression.

Features are hashed character n-grams (1 to 3) of the lower-cased letters, with
TF-IDF weights: the share of the n-gram in the text, times the logarithm of how
rare it is among all texts to learn from. The weights are trained with
follow-the-regularised-leader and an elastic-net penalty on a bounded sample,
equally from each language, and a temperature is then fitted on held-back rows
of the sample, so that scores are calibrated.

Document frequencies are counted over every row to learn from; every text is
scored whole. A text's logits are the mean of its n-grams' weights, so scoring
gathers rows of a table and adds them up, without building a vector per text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm.shared import small_batches, written
from docloom.llm.wordhash import release

#: Feature space, unless there are very many languages.
BITS = 15
FEATURES = 1 << BITS
SIZES = (1, 2, 3)
#: Weights of a model at most: with L languages there are as many features as a power of two that keeps features times L below this.
MOST_WEIGHTS = 1 << 24
#: Characters from which on a text is counted in slices.
LONG = 500_000
#: Characters of a run of texts: a worker holds about a hundred bytes for each.
RUN = 1 << 17
UNKNOWN = "und"
#: Names of the columns that are added, not to clash with the table's own.
PREDICTED, SCORE = "_lang_pred", "_lang_score"

_MIX = [np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)]
_LETTER = np.array([chr(i).isalpha() for i in range(0x10000)], dtype=bool)


def letters(codes: np.ndarray) -> np.ndarray:
    out = _LETTER[np.minimum(codes, 0xFFFF)] & (codes <= 0xFFFF)
    for i in np.flatnonzero(codes > 0xFFFF):
        out[i] = chr(codes[i]).isalpha()
    return out


def hashed(h: np.ndarray, bits: int) -> np.ndarray:
    mixed = h ^ (h >> np.uint32(15))
    return ((mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - bits)).astype(np.int32)


def features(texts: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, text of each, letters per text). Runs of anything but letters are one space; texts begin and end with one."""
    joined = "\0".join(texts).lower() if all("\0" not in t for t in texts) else "\0".join(t.replace("\0", " ") for t in texts).lower()
    codes = np.frombuffer(("\0 " + joined.replace("\0", " \0 ") + " \0").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    end = codes == 0
    letter = letters(codes)
    keep = letter | end
    keep[1:] |= letter[:-1] | end[:-1]
    codes, letter, end = np.where(letter | end, codes, np.uint32(32))[keep], letter[keep], end[keep]
    text = np.cumsum(end) - 1
    counts = np.bincount(text[letter], minlength=len(texts))[: len(texts)]
    found, owner = [], []
    h = np.zeros(len(codes), dtype=np.uint32)
    for n in range(max(SIZES)):
        m = len(codes) - n
        h = (h[:m] * np.uint32(0x01000193)) ^ (codes[n:] * _MIX[n])
        if n + 1 in SIZES:
            whole = ~end[:m]
            for k in range(1, n + 1):
                whole &= ~end[k : k + m]
            if n == 0:
                whole &= letter
            found.append(hashed(h[whole], bits))
            owner.append(text[:m][whole].astype(np.int32))
    return np.concatenate(found), np.concatenate(owner), counts


def counts_of_long(text: str, bits: int = BITS, size: int = LONG) -> tuple[np.ndarray, int]:
    """(how often each feature occurs, letters) of one text, as features() has it, with memory for a slice only: the last characters of a slice go with the next."""
    text, reach = text.lower(), max(SIZES) - 1
    counts, many = np.zeros(1 << bits, dtype=np.int64), 0
    before = np.array([32], dtype=np.uint32)
    for at in range(0, len(text) + size, size):
        codes = np.frombuffer(text[at : at + size].encode("utf-32-le", "surrogatepass"), dtype=np.uint32) if at < len(text) else np.array([32], dtype=np.uint32)
        letter = letters(codes)
        many += int(letter.sum())
        codes = np.where(letter, codes, np.uint32(32))
        keep = codes != 32
        keep |= np.r_[before[-1:], codes[:-1]] != 32
        codes = np.r_[before, codes[keep]]
        h = np.zeros(len(codes), dtype=np.uint32)
        for n in range(max(SIZES)):
            m = max(len(codes) - n, 0)
            h = (h[:m] * np.uint32(0x01000193)) ^ (codes[n:] * _MIX[n])
            if n + 1 in SIZES:
                new = np.arange(m) + n >= len(before)
                counts += np.bincount(hashed(h[new & (codes[:m] != 32) if n == 0 else new], bits), minlength=1 << bits)
        before = codes[-reach:]
    return counts, many


def cut(texts: list[str], most: int = RUN, rows: int = 200):
    """Runs of at most so many characters (a longer text stands alone; beyond LONG it is counted in slices) and rows."""
    start = total = 0
    for i, t in enumerate(texts):
        if i - start == rows or (total and total + len(t) > most):
            yield start, i
            start, total = i, 0
        total += len(t)
    if len(texts) > start:
        yield start, len(texts)


def strings(column: pa.Array) -> list[str]:
    return ["" if t is None else t for t in column.to_pylist()]


def is_long(run: list[str]) -> bool:
    return len(run) == 1 and len(run[0]) > LONG


def frequencies(bits: int):
    """A mapInArrow function: in how many texts of the task each feature occurs; feature -1 counts the texts."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(1 << bits, dtype=np.int64), 0
        for part in parts:
            texts = strings(part["text"])
            for a, b in cut(texts):
                if is_long(texts[a:b]):
                    df += counts_of_long(texts[a], bits)[0] > 0
                else:
                    f, owner, _ = features(texts[a:b], bits)
                    seen = np.zeros((b - a, 1 << bits), dtype=bool)
                    seen[owner, f] = True
                    df += seen.sum(axis=0)
                n += b - a
        at = np.flatnonzero(df)
        release()
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, at], pa.int32()), pa.array(np.r_[n, df[at]], pa.int64())], ["feature", "df"])

    return run


def counted(bits: int):
    """A mapInArrow function: texts as sparse counts, for training."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keys, values = [], []
            for t in strings(part["text"]):
                if is_long([t]):
                    every = counts_of_long(t, bits)[0]
                    k, v = np.flatnonzero(every), every[every > 0]
                else:
                    k, v = np.unique(features([t], bits)[0], return_counts=True)
                keys.append(k.astype(np.int32))
                values.append(v.astype(np.int32))
            yield pa.RecordBatch.from_arrays([part["order"], part["lang"], pa.array(keys, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.int32()))], ["order", "lang", "features", "counts"])

    return run


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray  # features x languages; idf and scale are multiplied in
    bias: np.ndarray
    temperature: float
    bits: int = BITS


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], n_languages: int, idf: np.ndarray, epochs: int, alpha: float, beta: float, l1: float, l2: float, scale: float):
    """FTRL-proximal, one pass over the rows per epoch; rows are (features, counts, language). Returns weights, bias."""
    many = len(idf)
    z = np.zeros((many + 1, n_languages))
    g2 = np.zeros((many + 1, n_languages))

    def weights(at: np.ndarray) -> np.ndarray:
        zz = z[at]
        shrunk = np.sign(zz) * np.maximum(np.abs(zz) - l1, 0.0)
        return -shrunk / ((beta + np.sqrt(g2[at])) / alpha + l2)

    for _ in range(epochs):
        for f, c, y in rows:
            at = np.r_[f, many]
            x = np.r_[c / c.sum() * idf[f] * scale, 1.0]
            w = weights(at)
            p = softmax(x @ w)
            p[y] -= 1.0
            g = x[:, None] * p[None, :]
            s = (np.sqrt(g2[at] + g * g) - np.sqrt(g2[at])) / alpha
            z[at] += g - s * w
            g2[at] += g * g
    w = weights(np.arange(many + 1))
    return w[:many], w[many]


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least negative log likelihood, from 0.5 (a small sample without errors would drive it to 0) to 20.

    Golden-section search on its logarithm.
    """
    loss = lambda t: -np.log(softmax(logits / np.exp(t))[np.arange(len(y)), y] + 1e-12).mean()
    a, b, r = np.log(0.5), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def fit(learn: DataFrame, sample_rows: int = 2000, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01, scale: float = 20.0, seed: int = 7) -> Model | None:
    """Learns from rows (doc_id, text, lang) with a letter and a language; None if there are none.

    sample_rows bounds the rows that weights and temperature are fitted on:
    about sample_rows / languages of each language, those with the least hash
    of doc_id, and never more than twice sample_rows in all. Every fifth is
    held back for the temperature. Document frequencies cover all rows.

    The driver and every task hold the model, features times languages numbers:
    32,768 features up to 512 languages, fewer beyond (MOST_WEIGHTS), so that
    its size stays the same however many languages there are. More languages
    than sample_rows leave some without a row to be fitted on: raise it then.
    """
    small_batches(learn.sparkSession)
    has_letter = F.rlike("text", F.lit(r"\p{L}"))
    learn = learn.where(F.col("lang").isNotNull() & has_letter).select("doc_id", "text", "lang")
    sizes = written(learn.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "lang-sizes")
    per = {r["lang"]: r["n"] for r in sizes.collect()}
    if not per:
        return None
    languages = tuple(sorted(per))
    bits = min(BITS, (MOST_WEIGHTS // len(languages)).bit_length() - 1)
    rows = {r["feature"]: r["df"] for r in learn.select("text").mapInArrow(frequencies(bits), "feature int, df bigint").groupBy("feature").agg(F.sum("df").alias("df")).collect()}
    n = rows.pop(-1)
    df = np.zeros(1 << bits)
    df[list(rows)] = list(rows.values())
    idf = np.log((1 + n) / (1 + df)) + 1.0

    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    # Not by createDataFrame: it would start Python workers of another kind on every executor, which stay.
    shares = sizes.select("lang", F.least(F.lit(1.0), F.lit(sample_rows / len(languages)) / F.col("n")).alias("share"))
    picked = learn.withColumn("order", order).join(F.broadcast(shares), "lang").where(F.pmod("order", F.lit(1 << 30)) < F.col("share") * (1 << 30))
    sample = picked.select("order", "lang", "text").mapInArrow(counted(bits), "order bigint, lang string, features array<int>, counts array<int>")
    sample = written(sample, "lang-sample").orderBy("order", "lang", F.hash("features")).limit(2 * sample_rows).toPandas()
    place = {lang: i for i, lang in enumerate(languages)}
    data = [(np.asarray(f), np.asarray(c, dtype=float), place[lang]) for f, c, lang in zip(sample["features"], sample["counts"], sample["lang"], strict=True) if len(f)]
    held, used = data[::5], [d for i, d in enumerate(data) if i % 5] or data
    w, bias = train(used, len(languages), idf, epochs, alpha, beta, l1, l2, scale)
    w = w * (idf * scale)[:, None]
    logits = np.array([(c / c.sum()) @ w[f] + bias for f, c, _ in held])
    t = temperature(logits, np.array([y for _, _, y in held])) if held else 1.0
    return Model(languages, w.astype(np.float32), bias, t, bits)


def scored(shared, keep_text: bool):
    """A mapInArrow function: adds the language of column text and its probability to the columns there are."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model | None = shared.value
        few = model is not None and len(model.languages) <= 64
        columns = list(np.ascontiguousarray(model.weights.T, dtype=np.float64)) if few else []
        for part in parts:
            texts = strings(part["text"])
            names, scores = [], np.zeros(len(texts))
            for a, b in cut(texts):
                if model is None:
                    names += [UNKNOWN] * (b - a)
                    continue
                if is_long(texts[a:b]):
                    counts, many = counts_of_long(texts[a], model.bits)
                    logits, letters_in = (counts / max(counts.sum(), 1) @ model.weights)[None] + model.bias, np.array([many])
                else:
                    f, owner, letters_in = features(texts[a:b], model.bits)
                    total = np.maximum(np.bincount(owner, minlength=b - a), 1)
                    if few:
                        runs = np.flatnonzero(np.r_[len(owner) > 0, owner[1:] != owner[:-1]])
                        sums = [np.bincount(owner[runs], np.add.reduceat(w[f], runs), minlength=b - a) if len(runs) else np.zeros(b - a) for w in columns]
                        logits = np.stack(sums, axis=1) / total[:, None] + model.bias
                    else:
                        counts = np.bincount(owner.astype(np.int64) << model.bits | f, minlength=(b - a) << model.bits).reshape(b - a, -1)
                        logits = counts.astype(np.float32) @ model.weights / total[:, None] + model.bias
                p = softmax(logits / model.temperature)
                best = p.argmax(axis=1)
                some = letters_in > 0
                names += [model.languages[k] if s else UNKNOWN for k, s in zip(best, some, strict=True)]
                scores[a:b] = np.where(some, p[np.arange(b - a), best], 0.0)
            kept = [i for i, name in enumerate(part.schema.names) if name != "text" or keep_text]
            yield pa.RecordBatch.from_arrays([*[part.column(i) for i in kept], pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*[part.schema.names[i] for i in kept], PREDICTED, SCORE])
        release()

    return run


def held_out() -> object:
    """Rows that are never learnt from: crc32 of doc_id as text divides by 5. A null doc_id is not learnt from either, but not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, model: Model | None, keep_text: bool = False) -> DataFrame:
    """docs with the columns PREDICTED and SCORE, a row per row; text stays only if asked for.

    Texts that are null or without a letter are und with score 0.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name != "text" or keep_text]
    shape = T.StructType([*[T.StructField(f.name, f.dataType) for f in kept], T.StructField(PREDICTED, T.StringType()), T.StructField(SCORE, T.DoubleType())])
    return docs.mapInArrow(scored(shared, keep_text), shape)


def learn_from(docs: DataFrame) -> DataFrame:
    """The rows that are not held out."""
    return docs.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0).select("doc_id", "text", "lang")


def accepted(docs: DataFrame, sample_rows: int = 2000, least_score: float = 0.0) -> DataFrame:
    """The rows of docs, with all their columns, whose language is recognised: not und, and with at least the given score (0: any).

    A higher bound also drops clean documents: short ones, and those in two languages.
    """
    found = identify(docs, fit(learn_from(docs), sample_rows), keep_text=True)
    return found.where((F.col(PREDICTED) != UNKNOWN) & (F.col(SCORE) >= least_score)).select(*docs.columns)


def identify_documents(docs: DataFrame, sample_rows: int = 2000) -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score.

    Learns from the text and lang of the rows that are not held out, then
    predicts every row from its text alone. Without any row to learn from all
    are und. Repeated rows each get their result; other columns are not read;
    an empty table gives an empty result. A text may be of any length: beside the
    text itself a task holds what half a million characters need.
    """
    found = identify(docs.select("doc_id", held_out().alias("held_out"), "text"), fit(learn_from(docs), sample_rows))
    return found.select("doc_id", "held_out", F.col(PREDICTED).alias("lang_pred"), F.col(SCORE).alias("score"))
