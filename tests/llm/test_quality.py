"""Quality rules against a plain count of everything."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docloom.llm import quality
from docloom.llm.queries import op12_quality_rules

SPACE = " \t\n\x0b\x0c\r"


def split(text):
    return [w for w in re.split(f"[{SPACE}]+", text) if w]


def plain_counts(text):
    text = text or ""
    words = split(text)
    runs = Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i in range(len(words) - 2) if runs[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if split(x)]
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:i] for i, x in enumerate(lines)), len(hit)]


def tokens(text):
    out = []
    for word in split(text or ""):
        kind = None
        for c in word:
            now = c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789" or ord(c) > 127
            c = c.lower() if ord(c) < 128 else c
            if now == kind:
                out[-1] += c
            else:
                out.append(c)
            kind = now
    return [int(hashlib.md5(t.encode()).hexdigest()[:8], 16) for t in out]


def plain(rows, good, many=10_000, least=-0.2):
    grams = []
    for _, text in rows:
        t = tokens(text)
        grams.append([h % many for h in t] + [((a % many) * 1_000_003 + b) % many for a, b in zip(t, t[1:])])
    raw, trusted = Counter(), Counter()
    for (i, _), g in zip(rows, grams):
        raw.update(g)
        trusted.update(g if i in good else [])
    r, t = sum(raw.values()) + many, sum(trusted.values()) + many
    weight = lambda b: math.floor((math.log((trusted[b] + 1) / t) - math.log((raw[b] + 1) / r)) * 2**20 + 0.5) if trusted else 0
    out = []
    for (i, text), g in zip(rows, grams):
        c, total = plain_counts(text), sum(map(weight, g))
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        out.append((i, *c, failed, len(g), round(total / len(g) / 2**20, 6) if g else 0.0, not failed and total >= len(g) * math.floor(least * 2**20)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def close(mine, theirs):
    assert len(mine) == len(theirs)
    for a, b in zip(mine, theirs, strict=True):
        assert a[:8] == b[:8] and a[9] == b[9] and abs(a[8] - b[8]) < 2e-6, (a, b)


def test_odd_texts(spark, odd_docs, no_docs):
    more = [(50, "a b c a b c " * 30), (51, "x\ny\nx\n\n\nx\r\ny "), (52, "one two three"), (53, "one one one"), (54, "é|é #<>&%*$ É"), (55, "\x00 \x1c a\x1cb \x85 \xa0c"), (56, "w " * 120_000), (57, "y" * 300_000), (50, "again another row of the same id")]
    docs = odd_docs.unionByName(spark.createDataFrame(more, "doc_id bigint, text string"), allowMissingColumns=True).repartition(3)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    trusted = spark.createDataFrame([(1,), (6,), (None,), (50,), (50,), (99,)], "doc_id bigint")
    close(got(quality.rate_documents(docs, trusted)), plain(rows, {1, 6, 50}))
    close(got(quality.rate_documents(docs, trusted, most_broadcast=0)), plain(rows, {1, 6, 50}))
    close(got(quality.rate_documents(docs, trusted.limit(0))), plain(rows, set()))
    assert got(quality.rate_documents(no_docs, trusted)) == []


def test_labels(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, 0, 0), (4, 1, None), (5, None, 0), (6, 1, 0), (6, 0, 0), (7, 1, 0), (7, 1, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert sorted(r[0] or 0 for r in quality.trusted_ids(labels).collect()) == [0, 1, 4, 7]


def test_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    good = {r[0] for r in quality.trusted_ids(spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    mine = {r[0]: (*r[:-1], r[-1]) for r in got(op12_quality_rules(spark, sf))}
    assert mine == {r[0]: (*r[:7], r[9]) for r in plain(rows, good)}


def test_junk_goes_and_clean_stays(spark):
    """Planted: clean text in two languages, labelled in part; shouting, tables of symbols; clean text without a label stays."""
    rng = random.Random(3)
    words = [["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 7))) for _ in range(400)] for _ in range(2)]
    clean = lambda i: " ".join(rng.choice(words[i % 2]) for _ in range(rng.randint(60, 200))) + "."
    junk = lambda i: " ".join(w.upper() + "!!" if i % 2 else f"{w}{rng.choice(['$$$', '###'])}" for w in clean(i).split())
    rows = [(i, clean(i)) for i in range(300)] + [(1000 + i, junk(i)) for i in range(60)]
    trusted = spark.createDataFrame([(i,) for i in range(0, 300, 3)], "doc_id bigint")
    kept = {r["doc_id"] for r in quality.rate_documents(spark.createDataFrame(rows, "doc_id bigint, text string"), trusted).where("kept").collect()}
    assert kept == set(range(300))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab \n\t#é"), max_size=60))
def test_counts(text):
    numbers, hashes = quality.measured(text, quality.Tokens())
    assert numbers == plain_counts(text) and hashes.tolist() == tokens(text)


def test_slices_change_nothing(monkeypatch):
    text = " ".join(f"w{i % 17}#x {i % 5}\n" for i in range(500))
    whole = quality.measured(text, quality.Tokens())
    monkeypatch.setattr(quality, "SLICE", 7)
    pieces = quality.measured(text, quality.Tokens(most=3))
    assert pieces[0] == whole[0] and np.array_equal(pieces[1], whole[1])


@pytest.mark.parametrize("size", [1, 2, 3, 4])
def test_repeated_runs(size):
    rng = np.random.default_rng(size)
    for _ in range(50):
        words = rng.integers(0, 6, rng.integers(1, 40))
        runs = Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
        hit = {i + k for i in range(len(words) - size + 1) if runs[tuple(words[i : i + size])] > 1 for k in range(size)}
        assert quality.repeated(words, size) == len(hit)
