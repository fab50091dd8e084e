import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import decontaminate as dc
from docloom.llm import wordhash

UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute(docs, items):
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            n = min(13, len(v))
            windows = {tuple(v[p : p + n]) for p in range(len(v) - n + 1)} if v else set()
            for p in range(len(w) - n + 1 if v else 0):
                if tuple(w[p : p + n]) in windows:
                    hit.update(range(p, p + n))
                    found.add(str(item))
        out.append((str(i), len(w), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def found(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id int, text string")
    b = spark.createDataFrame(items, "item_id int, text string")
    return sorted((str(r.doc_id), r.n_words, r.n_hit, tuple(r.item_ids), r.contaminated) for r in dc.find_contamination(d, b, **kw).collect())


@pytest.mark.parametrize("known_most", [500_000, 0])
@pytest.mark.parametrize("lengths", [(13, 40), (1, 12), (5, 60)])
def test_equals_brute_force(spark, known_most, lengths):
    rng = random.Random(len(lengths) + lengths[0])
    word = lambda: rng.choice(["The", "of", "ÀB", "x1", *[f"w{i}" for i in range(60)]])
    items = [(i, " ".join(word() for _ in range(rng.randint(*lengths)))) for i in range(30)] + [(98, None), (99, "!!"), (97, "")]
    docs = [(-1, None), (-2, "...")]
    for i in range(80):
        text = [word() for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 3)):
            part = (rng.choice(items[:30])[1]).split()
            a = rng.randint(0, max(0, len(part) - 13))
            at = rng.randint(0, len(text))
            text[at:at] = part[a : a + rng.randint(1, 25)]
        docs.append((i, rng.choice([" ", ", ", "\n- "]).join(text)))
    assert found(spark, docs, items, known_most=known_most) == brute(docs, items)


def test_repetition_on_both_sides(spark):
    items = [(1, "a b " * 20), (2, "c " * 13), (2, "c " * 13), (None, "d " * 15)]
    docs = [(1, "a b " * 30), (2, "b a " * 7), (3, "c " * 12), (4, "x " + "c " * 50 + "y"), (4, "x " + "c " * 50 + "y"), (5, "D. " * 14)]
    want = brute(docs, [(i if i is not None else "null", t) for i, t in items])
    assert found(spark, docs, items) == want


def test_every_position_is_guaranteed(spark):
    """A shared span of exactly 13 words is found wherever it lies."""
    item = [f"i{k}" for k in range(50)]
    docs = [(k, " ".join([f"d{j}" for j in range(k % 17)] + item[k : k + 13] + ["end"] * (k % 5))) for k in range(38)]
    rows = found(spark, docs, [(7, " ".join(item))])
    assert all(n_hit == 13 and ids == ("7",) for _, _, n_hit, ids, _ in rows)


def test_threshold_is_exact(spark):
    item = " ".join(f"i{k}" for k in range(13))
    docs = [(n, item + " o" * (n - 13)) for n in (259, 260, 261)]
    assert [r[4] for r in found(spark, docs, [(1, item)])] == [True, True, False]


@pytest.mark.parametrize("known_most", [500_000, 0])
def test_a_template_in_very_many_items(spark, known_most):
    """One window that 100,000 items share: one set, no pair of texts."""
    template = " ".join(f"t{k}" for k in range(13))
    items = spark.range(100_000).select(F.col("id").alias("item_id"), F.concat(F.lit(template + " own"), F.col("id").cast("string")).alias("text"))
    docs = spark.createDataFrame([(1, "x " + template + " y"), (2, template.replace("t5", "u5")), (3, template[3:] + " own77")], "doc_id int, text string")
    rows = {r.doc_id: r for r in dc.find_contamination(docs, items, known_most=known_most).collect()}
    assert (len(rows[1].item_ids), rows[1].n_hit) == (100_000, 13) and rows[1].item_ids == sorted(rows[1].item_ids)
    assert not rows[2].item_ids and (rows[3].item_ids, rows[3].n_hit) == (["77"], 13)


def test_a_short_item_costs_the_others_nothing(spark, sf):
    """Items of 12 words match on 12 words, whatever other lengths there are: no document but the real ones becomes a candidate."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = [words(r.text) for r in docs.collect()]
    items = [(i, " ".join(w[5:17])) for i, w in enumerate(texts) if len(w) > 20][:100] + [(1000, "occursnowhere"), (1001, texts[0][0])]
    table = spark.createDataFrame(items, "item_id int, text string")
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, tuple(r.item_ids), r.contaminated) for r in dc.find_contamination(docs, table).collect())
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], items)
    once = np.array([w for t in texts for w in wordhash.words([" ".join(t).encode()], wordhash.ALNUM)[0]])
    prints = np.unique(dc.windows(wordhash.words([items[0][1].encode()], wordhash.ALNUM)[0], np.array([12]), 12).fingerprint)
    assert len(dc.windows(once, np.array([len(once)]), 12, prints).text) < 100


def test_ids_of_any_type_and_long_texts(spark):
    item = " ".join(f"i{k}" for k in range(13))
    long = "word " * 600_000 + item + " x" * 100
    docs = spark.createDataFrame([("a", item), ("https://x/b", long), (None, "i0 i1"), ("w", "x" * 3_000_000)], "doc_id string, text string")
    rows = {r.doc_id: (r.n_words, r.n_hit, r.contaminated) for r in dc.find_contamination(docs, spark.createDataFrame([(1, item)], "item_id int, text string")).collect()}
    assert rows == {"a": (13, 13, True), "https://x/b": (600_113, 13, False), None: (2, 0, False), "w": (1, 0, False)}


def test_block_size_does_not_matter(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice(["a", "bc", " ", "\n", "xyz", "  ", "é"]) for _ in range(rng.randint(0, 50))).encode() for _ in range(200)]
    want = wordhash.words(texts, wordhash.SPACED)
    assert want[1].tolist() == [len(t.split()) for t in texts]
    for size in (1, 7, 64):
        monkeypatch.setattr(wordhash, "BLOCK", size)
        got = wordhash.words(texts, wordhash.SPACED)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "Same text here five words at least")], "item_id int, text string")
    none = spark.createDataFrame([], "item_id int, text string")
    rows = dc.find_contamination(odd_docs, items).collect()
    assert len(rows) == odd_docs.count() and sorted(r.doc_id for r in rows if r.contaminated) == [1, 2, 2]
    assert not any(r.contaminated for r in dc.find_contamination(odd_docs, none).collect())
    assert dc.find_contamination(no_docs, items).collect() == []
    kept = dc.clean_documents(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 3
