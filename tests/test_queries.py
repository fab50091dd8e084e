"""Every library query against its SQL, or against a plain reading of its definition."""

import compare
import pytest

from docloom import queries as q


@pytest.mark.parametrize("name", sorted(q.ORACLES))
def test_query_equals_sql(spark, sf, duck, name):
    assert not compare.differences(q.QUERIES[name](spark, sf), duck, q.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(q.QUERIES) - set(q.ORACLES)))
def test_query_without_sql_has_rows(spark, sf, name):
    assert q.QUERIES[name](spark, sf).count() > 0


def test_topic_segments_keep_every_word(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = {}
    for r in sorted(q.topic_segments(spark, sf).collect(), key=lambda r: (r.doc_id, r.chunk_index)):
        found.setdefault(r.doc_id, []).extend(r.chunk_text.split())
    assert all(found.get(i, []) == t.split() for i, t in texts.items())


def test_passages_are_packed_greedily(spark, sf):
    rows = sorted(q.html_passages(spark, sf).collect(), key=lambda r: (r.page_id, r.passage))
    for a, b in zip(rows, rows[1:]):
        if a.page_id == b.page_id:
            assert a.n_words + b.n_words > 220  # else both would have been one
    assert {r.passage for r in rows} >= {1, 2}


def test_memberships_add_up(spark, sf):
    rows = q.gmm_soft_assign(spark, sf).collect()
    assert all(0.1 < r.probability <= 1 + 1e-6 for r in rows)


def test_harmonized_questions_are_whole(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = {r.id: r.query for r in q.harmonized_questions(spark, sf).where("dataset = 'b'").collect()}
    assert found == texts and max(map(len, found.values())) > 50
