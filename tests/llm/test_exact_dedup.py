from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from docloom.llm import exact_dedup as xd

UPPER = {c: c + 32 for c in range(65, 91)}


def brute(docs):
    groups = defaultdict(list)
    rows = [(r.doc_id, (r.text or "").translate(UPPER)) for r in docs.collect()]
    for i, t in rows:
        groups[t].append(-1 if i is None else i)
    return sorted((str(i), str(max(groups[t])).replace("-1", "None"), len(groups[t])) for i, t in rows)


def weak(text):
    """A digest that collides."""
    return F.substring(F.sha2(text, 256), 1, 1)


@pytest.mark.parametrize("digest", [xd.sha256, weak])
@pytest.mark.parametrize("files", [None, 1])
def test_odd_rows(odd_docs, digest, files):
    rows = xd.deduplicate(odd_docs.repartition(3), digest=digest, files_per_batch=files).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in rows) == brute(odd_docs)
    assert sum(r.kept for r in rows) == 8 and all(r.kept <= (r.doc_id == r.keep_id) for r in rows)


def test_collisions_over_all_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = xd.deduplicate(docs, digest=weak).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in rows) == brute(docs)


@pytest.mark.parametrize("most", [200_000, 0])
def test_state_lasts_and_locators_fetch(spark, tmp_path, odd_docs, most):
    """Calls on one folder see each other's rows; the same rows in one call give the same groups."""
    first = spark.createDataFrame([(1, "A b"), (5, "new"), (9, None)], "doc_id int, text string")
    second = spark.createDataFrame([(7, "a B"), (3, "a b"), (2, ""), (8, "other")], "doc_id int, text string")
    folder = str(tmp_path / "state")
    rows = lambda df, **kw: sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in xd.deduplicate(df, folder=folder, most=most, **kw).collect())
    assert rows(first) == [(1, 1, 1, True), (5, 5, 1, True), (9, 9, 1, True)]
    assert rows(second) == [(2, 9, 2, False), (3, 7, 3, False), (7, 7, 3, True), (8, 8, 1, True)]
    assert rows(first.limit(0)) == []
    assert [r[:3] for r in rows(spark.createDataFrame([(4, "A B")], "doc_id int, text string"))] == [(4, 7, 4)]
    assert len(list((tmp_path / "state" / "checkpoint" / "commits").glob("[0-9]"))) >= 3


@pytest.mark.parametrize("digest", [xd.sha256, weak])
def test_ids_of_any_type_and_clashing_names(spark, digest):
    docs = spark.createDataFrame([("a", "X y", 1, "k"), ("b", "x Y", 2, "l"), (None, "x y", 3, None), (None, None, 4, "m")], "doc_id string, text string, digest int, locator string")
    rows = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in xd.deduplicate(docs, digest=digest).collect())
    assert rows == [("None", "None", 1, True), ("None", "b", 3, False), ("a", "b", 3, False), ("b", "b", 3, True)]
    kept = xd.survivors(docs)
    assert kept.columns == docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, docs.where("digest in (2, 4)").collect()))


def test_empty(no_docs):
    assert xd.deduplicate(no_docs).collect() == []
    assert xd.survivors(no_docs).collect() == []


def test_survivors(odd_docs):
    kept = xd.survivors(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([r.keep_id for r in xd.deduplicate(odd_docs).where("kept").collect()], key=str)
