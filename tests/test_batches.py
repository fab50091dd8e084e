"""Operators with Python workers ask for batches of bounded size, and hold one text's worth of work at a time."""

import pytest

from docloom import more_queries as m
from docloom import queries as q

BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def unset(spark):
    spark.conf.unset(BYTES)
    yield
    spark.conf.unset(BYTES)


def test_pages_go_to_workers_in_small_batches(spark, sf, unset):
    m.selector_extracts(spark, sf)
    assert int(spark.conf.get(BYTES)) <= 4 << 20


def test_tokenizers_get_texts_in_runs_of_bounded_size(spark, sf, unset):
    from docloom.operators.chunking import by_size

    texts = ["a" * 10, "", "b" * 25, "c" * 9, "d"]
    runs = list(by_size(texts, 20))
    assert [t for r in runs for t in r] == texts and all(sum(map(len, r)) <= 20 or len(r) == 1 for r in runs)
    assert list(by_size([])) == []
    q.sliding_tokens(spark, sf)
    assert int(spark.conf.get(BYTES)) <= 4 << 20


def test_tiles_of_a_text_of_distinct_words_take_memory_in_proportion_to_it(spark, sf, unset):
    import tracemalloc

    from docloom.operators.chunking import text_tiles

    text = " ".join(f"w{i}" for i in range(20_000))
    tracemalloc.start()
    text_tiles([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6
    q.topic_segments(spark, sf)
    assert int(spark.conf.get(BYTES)) <= 4 << 20


def test_similarities_of_blocks_are_those_of_whole_counts():
    import random

    import numpy as np

    from docloom.operators.chunking import block_similarities, climbs

    draw, width, block = random.Random(5), 4, 3
    codes = [draw.randrange(9) for _ in range(80)]
    lines = np.array([np.bincount(codes[a : a + width], minlength=9) for a in range(0, 80, width)])
    cos = lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    plain = [cos(lines[max(0, g - block) : g].sum(axis=0), lines[g : g + block].sum(axis=0)) for g in range(1, 20)]
    assert np.allclose(block_similarities(codes, width, block), plain)
    assert climbs(np.array([1.0, 2.0, 2.0, 1.0, 3.0])).tolist() == [1.0, 0.0, 0.0, 2.0, 0.0]


def test_segments_and_parts_of_the_grid_are_bounded(spark, sf, unset):
    from docloom.operators import sparse_index

    docs = spark.createDataFrame([(i, "a b c d e") for i in range(3)], "doc_id bigint, text string")
    sparse_index.build_index(docs)
    assert int(spark.conf.get(BYTES)) <= 4 << 20
    assert sparse_index.TOKENS <= 2_000_000
