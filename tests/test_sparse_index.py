"""The inverted index: whole results, pruning, and that only postings of asked terms meet queries."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from docloom.operators import sparse_index
from docloom.operators.retrieval import bm25_top_k
from docloom.operators.sparse_index import BLOCK, Posting, best_in_segment, build_index, search_index


def plain(docs, queries, k, digits=6):
    split = lambda t: re.findall("[a-z0-9]+", (t or "").lower())
    texts = [(i, split(t)) for i, t in docs]
    df = {}
    for _, t in texts:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    out = []
    for q, t in queries:
        hits = []
        for i, words in texts:
            s = sum(words.count(w) * 2.2 / (words.count(w) + 1.2 * (0.25 + 0.75 * len(words) / 256)) * math.log((len(texts) - df[w] + 0.5) / (df[w] + 0.5) + 1) for w in set(split(t)) if w in words)
            if s:
                hits.append((-round(s, digits), i is None, i))
        out += [(q, i, -s, n + 1) for n, (s, _, i) in enumerate(sorted(hits)[:k])]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(5000)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(1, 30)))) for i in range(900)]
    docs += [(5, None), (6, ""), (None, "w1 w2 w3"), (None, None), (7, docs[7][1]), (8, "W1!W1-w1"), (9, "É ß"), (-4, "w1 w2 w3"), (2**62, "w3 w2 w1")]
    queries = [(i, " ".join(rng.choices(words, k=5))) for i in range(40)] + [(50, None), (51, "absent words"), (52, "w1 w1 w2 w2"), (53, "w1 w2 w3"), (54, "W1, W2")]
    return docs, queries


def got(df):
    return sorted(((r.query_id, r.id, r.score, r["rank"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("parts,group", [(1, 256), (7, 4)])
def test_equals_plain_scores(spark, corpus, parts, group):
    docs, queries = corpus
    index = build_index(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(parts), buckets=5)
    found = search_index(index, spark.createDataFrame(queries, "item_id bigint, text string"), 10, query_block=group)
    want = plain(docs, queries, 10)
    assert got(found) == want


def test_nothing_to_search(spark):
    docs, queries = spark.createDataFrame([], "doc_id bigint, text string"), spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert bm25_top_k(docs, queries).count() == 0
    assert bm25_top_k(spark.createDataFrame([(1, "a")], docs.schema), queries.limit(0)).count() == 0
    assert bm25_top_k(spark.createDataFrame([(1, "a"), (2, "c")], docs.schema), queries).select("id").collect() == [(1,)]


def test_an_index_is_searched_again(spark, corpus):
    docs, queries = corpus
    index = build_index(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(2))
    for some in (queries[:7], queries[7:]):
        assert got(search_index(index, spark.createDataFrame(some, "item_id bigint, text string"), 3)) == plain(docs, some, 3)


def test_only_buckets_of_asked_terms_are_opened(spark, corpus, capsys):
    docs, _ = corpus
    index = build_index(spark.createDataFrame(docs, "doc_id bigint, text string"), buckets=40)
    assert len({r.bucket for r in index.postings().select("bucket").distinct().collect()}) > 20
    search_index(index, spark.createDataFrame([(1, "w1")], "item_id bigint, text string")).explain("formatted")
    filters = [line for line in capsys.readouterr().out.splitlines() if "PartitionFilters" in line]
    assert any("bucket" in line and ("IN (" in line or "= " in line) for line in filters)


def test_a_segment_holds_every_posting(corpus):
    docs, queries = corpus
    segment, made = sparse_index.Segment(), []
    for at in range(0, 600, 100):
        own = docs[at : at + 100]
        segment.add(pa.RecordBatch.from_arrays([pa.array([i for i, _ in own], pa.int64()), pa.array([t.split() for _, t in own], pa.list_(pa.string()))], ["id", "t"]))
    rows = [r for batch in segment.rows(sparse_index.Weighing(), 3, most=11) for r in batch.to_pylist()]
    assert rows[-1]["term"] is None and rows[-1]["ids"] == sorted(i for i, _ in docs[:600])
    for r in rows[:-1]:
        p = Posting({**r, "idf": 1.0})
        have = sorted(i for i, t in docs[:600] if r["term"] in t.split())
        assert p.docs.tolist() == have and r["n"] == len(have)
        assert p.blocks.tolist() == sorted({d // BLOCK for d in have})
        assert [p.weights[p.docs // BLOCK == b].max() for b in p.blocks] == p.maxima.tolist()
        made.append(r["term"])
    assert len(made) == len(set(made))


def test_blocks_below_the_bound_are_not_scored():
    rng = np.random.default_rng(2)
    own = []
    for _ in range(4):
        docs = np.sort(rng.choice(BLOCK * 256, 9000, replace=False))
        block = docs // BLOCK
        weights = rng.random(9000) * np.where(block % 9 == 0, 1.0, 0.3)
        blocks = np.unique(block)
        maxima = np.array([weights[block == b].max() for b in blocks])
        own.append(Posting({"docs": docs.astype("<u2").tobytes(), "weights": weights.astype("<f8").tobytes(), "blocks": blocks.astype("<u2").tobytes(), "maxima": maxima.astype("<f8").tobytes(), "idf": 2.0}))
    whole = np.zeros(BLOCK * 256)
    for p in own:
        whole[p.docs] += p.weights
    for k in (1, 5, 50):
        docs, scores, scored = best_in_segment(own, k, 6)
        order = np.lexsort((np.arange(len(whole)), -np.round(whole, 6)))[:k]
        assert docs.tolist() == order.tolist() and np.allclose(scores, np.round(whole[order], 6))
    assert best_in_segment(own, 1, 6)[2] < 256 / 2
