import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n bigint, id string, key int, row int, label string"
LONG = " ".join(f"w{i}" for i in range(20000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    rows = [
        (1, "Same text here, five words at least", "en", "a", 3, 1, "x", 1, 1, "l"),
        (2, "same TEXT here, five words at least", "en", None, 3, 1, "x", 1, 1, "l"),
        (2, "same TEXT here, five words at least", "en", None, 3, 1, "x", 1, 1, "l"),
        (3, None, None, None, None, None, None, None, None, None),
        (4, "", "en", "b", 0, 1, "x", 1, 1, "l"),
        (5, " \n\t ", None, "b", 0, 1, "x", 1, 1, "l"),
        (6, LONG, "en", "a", None, 1, "x", 1, 1, "l"),
        (7, LONG + " tail", "en", "a", 1, None, "x", 1, 1, "l"),
        (None, "an orphan text without any id at all", None, "c", 1, 1, None, None, 1, "l"),
        (8, "ÀÉÎ ß ﬁ 日本語 \U0001F600 İ", "fr", "c", 1, 1, "x", 1, 1, "l"),
        (9, "word", "fr", "c", 1, 1, "x", 1, 1, "l"),
        (10, "Word", "de", "c", 1, 1, "x", 1, 1, "l"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
