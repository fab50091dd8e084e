"""What Python workers hold: runs of texts are bounded, and no step of the pipeline starts workers of a second kind."""

import tracemalloc

import pytest

from docloom.llm import exact_dedup, language_id, wordhash


def peak(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_words_of_a_megabyte(monkeypatch):
    monkeypatch.setattr(wordhash, "_powers", wordhash._powers[:])
    texts = [(b"some words here " * 625)] * 100
    assert peak(lambda: wordhash.words(texts, wordhash.SPACED)) < 25


def test_runs_of_texts():
    texts = ["Some letters, and more " * 80] * 1000
    assert max(peak(lambda a=a, b=b: language_id.features(texts[a:b])) for a, b in list(language_id.cut(texts))[:2]) < 20


def test_blocks_do_not_change_hashes(monkeypatch):
    texts = [b"one two  three", b"", b"x" * 300 + b" y", b"a b " * 90]
    want = [x.tolist() for x in wordhash.words(texts, wordhash.SPACED)]
    monkeypatch.setattr(wordhash, "BLOCK", 16)
    assert [x.tolist() for x in wordhash.words(texts, wordhash.SPACED)] == want


def test_no_workers_for_small_tables(spark, odd_docs, monkeypatch):
    def refused(*_, **__):
        raise AssertionError("createDataFrame starts Python workers of its own")

    rows = odd_docs.count()
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spark), "createDataFrame", refused)
        assert exact_dedup.deduplicate(odd_docs).count() == rows
        assert language_id.identify_documents(odd_docs).count() == rows
