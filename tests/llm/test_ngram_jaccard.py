import random
import re
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from docloom.llm import ngram_jaccard as nj
from docloom.llm.components import connected_components
from docloom.llm.queries import op4_ngram_jaccard

UPPER = {c: c + 32 for c in range(65, 91)}


def sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows, percent=80):
    """Sizes and components by comparing every pair of sets that share anything."""
    classes, inverted = defaultdict(list), defaultdict(list)
    for i, text in rows:
        classes[sets(text)].append(i)
    known = [s for s in classes if s]
    parent = list(range(len(known)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, s in enumerate(known):
        common = Counter(j for g in s for j in inverted[g])
        for g in s:
            inverted[g].append(k)
        for j, o in common.items():
            if 100 * o >= percent * (len(s) + len(known[j]) - o):
                parent[find(j)] = find(k)
    members = defaultdict(list)
    for k, s in enumerate(known):
        members[find(k)] += classes[s]
    least = {i: min(m) for m in members.values() for i in m}
    return {i: (len(sets(t)), least.get(i, i)) for i, t in rows}


def found(df, **kw):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in nj.similar_documents(df, **kw).collect()}


def test_query_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in op4_ngram_jaccard(spark, sf).collect()} == brute(rows)


@pytest.mark.parametrize("seed,long_list,percent", [(1, 1, 80), (2, 4, 80), (3, 1000, 80), (4, 2, 60)])
def test_near_copies(spark, seed, long_list, percent):
    """Families of edited copies of all lengths, with shared passages, against brute force."""
    rng = random.Random(seed)
    word = lambda: f"w{int(rng.paretovariate(0.4)) % 900}"
    passage = [word() for _ in range(12)]
    rows = []
    for _ in range(12):
        base = [word() for _ in range(rng.choice((3, 6, 30, 80, 300)))]
        for _ in range(rng.randint(1, 25)):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.3:
                copy = passage + copy
            rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    assert found(spark.createDataFrame(rows, "doc_id int, text string"), long_list=long_list, percent=percent) == brute(rows, percent)


def test_hot_group_of_one_word_edits(spark):
    """Many copies that all link to each other: the links stay few."""
    base = [f"b{i}" for i in range(100)]
    rows = [(i, " ".join([*base[: i % 90], f"x{i}", *base[i % 90 + 1 :]])) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    assert found(df) == brute(rows)


@pytest.mark.parametrize("hot_share", [0.0, 0.001, 1.0])
def test_a_passage_in_most_documents(spark, hot_share):
    """Grams that most documents have, in texts that consist of little else; counted or dealt as hot, the result is the same."""
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join([*passage[: rng.randint(12, 40)], *(f"u{rng.randrange(60)}" for _ in range(rng.randint(0, 6)))])) for i in range(400)]
    assert found(spark.createDataFrame(rows, "doc_id int, text string").repartition(2), hot_share=hot_share) == brute(rows)


def test_long_lists_are_paired_by_label_and_size(spark):
    """30,000 near copies of one label and a few others in one gram's list: only pairs with one of the others are made."""
    lists = spark.range(30_020).select(
        F.lit(7).cast("bigint").alias("gram"), F.col("id").alias("g"), F.when(F.col("id") % 3 == 0, 1000).otherwise(100).cast("bigint").alias("n"),
        F.when(F.col("id") % 3 == 0, 1000).otherwise(100).cast("bigint").alias("shared"), F.lit(0).alias("pos"), F.greatest(F.col("id") - 30_000, F.lit(-1)).alias("lo"), F.greatest(F.col("id") - 30_000, F.lit(-1)).alias("hi"), F.lit(-1).cast("bigint").alias("hub"),
    )
    began = time.time()
    pairs = {(min(r), max(r)) for r in nj.met(lists, 80).collect()}
    assert time.time() - began < 60
    others = range(30_000, 30_020)
    assert pairs == {(min(x, o), max(x, o)) for o in others for x in range(30_020) if x != o and (x % 3 == 0) == (o % 3 == 0)}


@pytest.mark.parametrize("part_bytes", [1, 2000, 1 << 25])
def test_ids_of_any_type_and_small_parts(spark, part_bytes):
    base = [f"b{i}" for i in range(60)]
    rows = [(f"u/{i}", " ".join([*base[:30], f"x{i}", *base[31:]])) for i in range(20)] + [("z", "alone"), (None, None)]
    got = {r.doc_id: r.component_id for r in nj.similar_documents(spark.createDataFrame(rows, "doc_id string, text string"), part_bytes=max(part_bytes, 100)).collect()}
    assert got == {**{f"u/{i}": "u/0" for i in range(20)}, "z": "z", None: None}


def test_odd_rows(odd_docs, no_docs):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in nj.similar_documents(odd_docs).collect()}
    assert nj.similar_documents(odd_docs).count() == odd_docs.count() and nj.similar_documents(no_docs).collect() == []
    assert {(1, 3, 1), (2, 3, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 19996, 6), (7, 19997, 6), (None, 4, None), (9, 1, 9), (10, 1, 9)} <= got


def test_representatives(odd_docs):
    kept = [r.doc_id for r in nj.representatives(odd_docs).collect()]
    assert sorted(kept, key=str) == sorted([1, 3, 4, 5, 6, None, 8, 9], key=str)


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(500, i) for i in range(501, 560)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    want = {x: find(x) for x in parent}
    assert {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()} == want
