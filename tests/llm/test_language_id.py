import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import language_id as li
from docloom.llm.queries import op6_language_id


def test_held_out_accuracy(spark, sf):
    want = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op6_language_id(spark, sf).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(want) and {r.doc_id for r in held} == {i for i in want if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.lang_pred == want[r.doc_id] for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def brute_features(text):
    """n-grams as strings, without hashing."""
    clean = "".join(c if c.isalpha() else " " for c in text.lower())
    clean = " " + " ".join(clean.split()) + " "
    return [clean[i : i + n] for n in (1, 2, 3) for i in range(len(clean) - n + 1) if n > 1 or clean[i] != " "]


def test_features_do_not_depend_on_the_batch():
    texts = ["Ab cé, 12 xyz!", "", "日本 \U0001F600 \U00010400", "   ", "a", "x\0y", "ſß"]
    f, owner, letters = li.features(texts)
    for i, t in enumerate(texts):
        alone, _, n = li.features([t])
        assert sorted(alone) == sorted(f[owner == i]) and n[0] == letters[i]
    assert [len(f[owner == i]) for i in (0, 4)] == [len(brute_features(texts[i])) for i in (0, 4)]
    grams = brute_features("Ab cé, 12 xyz!")
    assert len(set(f[owner == 0])) == len(set(grams))


def test_scores_equal_brute_force(spark, odd_docs):
    """Logits from a vector per text, as the definition has it."""
    rng = np.random.default_rng(3)
    model = li.Model(("a", "b", "c"), rng.normal(size=(li.FEATURES, 3)).astype(np.float32), np.array([0.1, 0.0, -0.1]), 1.7)
    rows = li.identify(odd_docs.select("doc_id", "text"), model, keep_text=True).collect()
    for r in rows:
        f, _, letters = li.features([r.text or ""])
        if not letters[0]:
            assert (r[li.PREDICTED], r[li.SCORE]) == ("und", 0.0)
            continue
        counts = np.bincount(f, minlength=li.FEATURES)
        p = li.softmax((counts / counts.sum() @ model.weights.astype(float) + model.bias) / model.temperature)
        assert r[li.PREDICTED] == model.languages[p.argmax()] and abs(r[li.SCORE] - p.max()) < 1e-5


def hashed(gram):
    """The feature of one n-gram, character by character."""
    h = 0
    for i, c in enumerate(gram):
        h = (h * 0x01000193 & 0xFFFFFFFF) ^ (ord(c) * (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)[i] & 0xFFFFFFFF)
    h ^= h >> 15
    return (h * 0x2C1B3C6D & 0xFFFFFFFF) >> 17


def plain_fit(rows, sample_rows, epochs=3, alpha=0.5, beta=1.0, l1=0.02, l2=0.01, scale=20.0):
    """rows: (order, text, lang). Everything in dictionaries, a coordinate at a time."""
    langs = sorted({lang for _, _, lang in rows})
    texts = [(order, Counter(map(hashed, brute_features(t))), lang) for order, t, lang in rows]
    df = Counter(f for _, c, _ in texts for f in c)
    idf = lambda f: math.log((1 + len(texts)) / (1 + df[f])) + 1.0
    size = Counter(lang for _, _, lang in texts)
    sample = sorted((x for x in texts if x[0] % (1 << 30) < min(1.0, sample_rows / len(langs) / size[x[2]]) * (1 << 30)), key=lambda x: x[0])[: 2 * sample_rows]
    z, g2 = defaultdict(float), defaultdict(float)

    def weight(f, k):
        v = z[f, k]
        return 0.0 if abs(v) <= l1 else -(v - math.copysign(l1, v)) / ((beta + math.sqrt(g2[f, k])) / alpha + l2)

    def share(logits):
        e = [math.exp(v - max(logits)) for v in logits]
        return [v / sum(e) for v in e]

    def vector(c):
        return {**{f: n / sum(c.values()) * idf(f) * scale for f, n in c.items()}, "bias": 1.0}

    for _ in range(epochs):
        for i, (_, c, lang) in enumerate(sample):
            if i % 5 == 0:
                continue
            x = vector(c)
            p = share([sum(v * weight(f, k) for f, v in x.items()) for k in range(len(langs))])
            for k in range(len(langs)):
                for f, v in x.items():
                    g = v * (p[k] - (langs[k] == lang))
                    w = weight(f, k)
                    z[f, k] += g - (math.sqrt(g2[f, k] + g * g) - math.sqrt(g2[f, k])) / alpha * w
                    g2[f, k] += g * g
    logits = lambda c: [sum(v * weight(f, k) for f, v in vector(c).items()) for k in range(len(langs))]
    held = [(logits(c), langs.index(lang)) for i, (_, c, lang) in enumerate(sample) if i % 5 == 0]
    grid = [0.5 * 40 ** (i / 4000) for i in range(4001)]
    loss = lambda t: -sum(math.log(share([v / t for v in ls])[y] + 1e-12) for ls, y in held)
    best = min(grid[::40], key=loss)
    t = min((x for x in grid if best / 1.1 < x < best * 1.1), key=loss)
    return langs, lambda text: share([v / t for v in logits(Counter(map(hashed, brute_features(text))))]), t


@pytest.mark.parametrize("sample_rows", [10_000, 60])
def test_fit_equals_a_plain_version(spark, sf, sample_rows):
    """Frequencies, sample, weights, temperature and predictions against dictionaries and loops, from texts alone."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("text", F.left("text", F.lit(300)))
    rows = [(r.o, r.text, r.lang) for r in li.learn_from(docs).withColumn("o", F.xxhash64(F.lit(7), F.col("doc_id"))).collect() if any(c.isalpha() for c in r.text)]
    langs, predict, t = plain_fit(rows, sample_rows)
    model = li.fit(li.learn_from(docs), sample_rows)
    assert list(model.languages) == langs and abs(math.log(model.temperature / t)) < 0.02
    for r in li.identify(docs, model, keep_text=True).select("text", li.PREDICTED, li.SCORE).collect():
        if any(c.isalpha() for c in r.text):
            p = predict(r.text)
            assert r[li.PREDICTED] == langs[p.index(max(p))] and abs(r[li.SCORE] - max(p)) < 0.01


def test_only_undetermined_documents_are_rejected(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, "the", None), (-2, "der the la de", None), (-3, "123 !!", None), (-4, None, "en"), (-5, "", "en")], "doc_id bigint, text string, lang string")
    kept = {r.doc_id for r in li.accepted(docs.unionByName(odd)).collect()}
    assert {-1, -2} <= kept and not {-3, -4, -5} & kept
    assert {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text)} <= kept


def test_elastic_net_makes_weights_sparse():
    rng = np.random.default_rng(0)
    rows = [(np.unique(np.r_[y * 10 + rng.integers(0, 10, 5), 100 + rng.integers(0, 500, 5)]), None, y) for y in rng.integers(0, 3, 300)]
    rows = [(f, np.ones(len(f)), y) for f, _, y in rows]
    dense = li.train(rows, 3, np.ones(li.FEATURES), 2, 0.5, 1.0, 0.0, 0.01, 20.0)[0]
    sparse = li.train(rows, 3, np.ones(li.FEATURES), 2, 0.5, 1.0, 2.0, 0.01, 20.0)[0]
    assert (sparse != 0).sum() < (dense != 0).sum() and np.abs(sparse[:30]).sum() > 0


def test_temperature_is_calibrated():
    rng = np.random.default_rng(1)
    logits = rng.normal(size=(4000, 3))
    y = np.array([rng.choice(3, p=p) for p in li.softmax(logits)])
    assert abs(li.temperature(logits * 4, y) - 4) < 0.5


def test_odd_rows(odd_docs, no_docs):
    rows = li.identify_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count() and {r.lang_pred for r in rows if r.doc_id in (3, 4, 5)} == {"und"}
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert li.identify_documents(no_docs).collect() == []


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "text", None), (2, "123", "en")], "doc_id int, text string, lang string")
    assert {r.lang_pred for r in li.identify_documents(docs).collect()} == {"und"}


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_long_texts_are_counted_in_slices(size):
    for text in ("", "a", "1", "Ab cé, 12 xyz!", " .. Ab\0cd  ΑΣ ΑΣΑ İi ", "日本語 \U00020000\U00020001 x", "no end " * 40):
        f, _, n = li.features([text])
        counts, many = li.counts_of_long(text, size=size)
        assert counts.tolist() == np.bincount(f, minlength=li.FEATURES).tolist() and many == n[0]


def test_a_very_long_text(spark):
    """20 million characters at a bounded peak; the same answer as for a shorter copy."""
    import tracemalloc

    text = "the quick brown fox jumps " * 800_000
    tracemalloc.start()
    counts, many = li.counts_of_long(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert many == 800_000 * 21 and peak < 3 * len(text)
    docs = [(i, t, lang) for i in range(40) for t, lang in ((f"the quick fox {i} jumps", "en"), (f"der schnelle fuchs {i} springt", "de"))]
    long = [(900, text[:2_600_000], None), (901, text[:260], None), (902, "der schnelle fuchs springt " * 40_000, None)]
    found = {r.doc_id: r for r in li.identify_documents(spark.createDataFrame(docs + long, "doc_id int, text string, lang string")).collect() if r.doc_id >= 900}
    assert [found[i].lang_pred for i in (900, 901, 902)] == ["en", "en", "de"] and abs(found[900].score - found[901].score) < 0.02


def test_very_many_languages(spark):
    """2,000 languages: the model keeps its size."""
    docs = spark.range(8000).selectExpr("CAST(id AS int) AS doc_id", "concat('word', repeat(substr('abcdefghijklmnopqrstuvwxyz', id % 20 + 1, 3), 5)) AS text", "concat('lang', id % 2000) AS lang")
    model = li.fit(li.learn_from(docs), sample_rows=400, epochs=1)
    many = len(model.languages)
    assert 1990 < many <= 2000 and model.weights.shape == (1 << 13, many) and model.weights.size <= li.MOST_WEIGHTS
    found = li.identify(docs.limit(20), model).collect()
    assert all(r[li.PREDICTED] in model.languages and 0 < r[li.SCORE] <= 1 for r in found)
