"""Each stage of the pipeline against brute force on its own input."""

import corpus_pipeline as cp
from test_decontaminate import brute as contaminated
from test_mixing import check
from test_ngram_jaccard import brute as near

from docloom.llm.queries import queries

UPPER = {c: c + 32 for c in range(65, 91)}


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in cp.STAGES[:4]:
        out = stage(spark, docs, sf)
        assert out.columns == columns
        before, after = docs.collect(), {r.doc_id for r in out.collect()}
        assert out.count() == len(after)
        if name == "language ID":
            want = {r.doc_id for r in before if any(c.isalpha() for c in r.text)}
        elif name == "exact dedup":
            last = {r.text.translate(UPPER): r.doc_id for r in sorted(before, key=lambda r: r.doc_id)}
            want = set(last.values())
        elif name == "n-gram Jaccard join":
            want = {i for i, (_, c) in near([(r.doc_id, r.text) for r in before]).items() if i == c}
        else:
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            want = {int(i) for i, *_, bad in contaminated([(r.doc_id, r.text) for r in before], items) if not bad}
        assert after == want, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
    rows = cp.STAGES[4][1](spark, docs, sf).collect()
    assert len(rows) == docs.count()
    check(rows)
    assert sorted((r.doc_id, r.taken) for r in cp.run(spark, sf).collect()) == sorted((r.doc_id, r.taken) for r in rows)


def test_odd_documents_pass_through(spark, odd_docs, no_docs, sf):
    """Only documents with a letter pass the first stage; of copies one stays; null ids, sources and languages are kept."""
    docs, left = odd_docs, []
    for _, stage in cp.STAGES[:4]:
        docs = stage(spark, docs, sf)
        assert docs.columns == odd_docs.columns
        left.append(sorted((str(r.doc_id) for r in docs.collect()), key=str))
    assert left[0] == sorted(map(str, [1, 2, 2, 6, 7, None, 8, 9, 10]))
    assert left[1] == sorted(map(str, [2, 6, 7, None, 8, 10]))
    assert left[2] == left[3] == sorted(map(str, [2, 6, None, 8, 10]))
    rows = {str(r.doc_id): r for r in cp.STAGES[4][1](spark, docs, sf).collect()}
    assert sorted(rows) == left[3] and rows["6"].size == 20000 and sum(r.taken for r in rows.values()) > 0
    for _, stage in cp.STAGES:
        none = stage(spark, no_docs, sf)
        assert none.collect() == [] and {"doc_id"} <= set(none.columns)


def test_a_query_for_each_operator():
    assert sorted(n.split("_")[0] for n in queries()) == sorted(f"op{k}" for k in range(1, 14))
