import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docloom.functions import dates, geometry, vectors, web
from docloom.functions import text as tx

LOOSE = settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def one(spark, column, **values):
    shape = ", ".join(f"{k} {kind}" for k, (kind, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], shape).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text,want",
    [
        ("1704067200", "2024-01-01 00:00:00"), ("D:20240102030405-05'00'", "2024-01-02 08:04:05"), ("D:20240102030405+02'30'", "2024-01-02 00:34:05"), ("D:20240102", "2024-01-02 00:00:00"),
        ("Tue, 02 Jan 2024 03:04:05 +0100", "2024-01-02 02:04:05"), ("2024-01-02T03:04:05Z", "2024-01-02 03:04:05"), ("2024-01-02T03:04:05", "2024-01-02 03:04:05"), ("2024-01-02 03:04:05", "2024-01-02 03:04:05"),
        ("2024-01-02", "2024-01-02 00:00:00"), ("01/02/2024", "2024-01-02 00:00:00"), ("garbage", None), ("", None), (None, None), ("D:2024", None),
    ],
)
def test_dates(spark, text, want):
    assert one(spark, dates.iso(dates.flexible_date(F.col("t"))), t=("string", text)) == want


def test_boxes(spark):
    b = geometry.from_edges(F.col("e"), F.lit(100.0), F.lit(0.0))
    assert one(spark, b, e=("array<double>", [1.0, 2.0, 11.0, 5.0])).asDict() == {"left": 1, "top": 2, "width": 10, "height": 3, "page_width": 100, "page_height": 0}
    assert one(spark, geometry.relative(b), e=("array<double>", [1.0, 2.0, 11.0, 5.0])).asDict() == {"left": 0.01, "top": None, "width": 0.1, "height": None}
    clamp = geometry.clamped(F.col("e"), F.lit(200.0), F.lit(100.0))
    assert one(spark, clamp, e=("array<double>", [0.1, 0.1, 0.5, 2.0])) == [0.1, 0.1, 0.5, 2.0]
    assert one(spark, clamp, e=("array<double>", [0.1, -0.1, 0.5, 1.0])) == [20.0, 0.0, 100.0, 100.0]
    assert one(spark, clamp, e=("array<double>", [300.0, 0.0, 400.0, 50.0])) is None


def test_union_of_boxes(spark):
    rows = [(1, (0.0, 0.0, 2.0, 2.0, 9.0, 9.0)), (1, (5.0, 1.0, 1.0, 4.0, 9.0, 9.0))]
    df = spark.createDataFrame(rows, "k int, b struct<left: double, top: double, width: double, height: double, page_width: double, page_height: double>")
    assert list(df.groupBy("k").agg(geometry.union_of("b").alias("u")).first().u) == [0, 0, 6, 5, 9, 9]


@pytest.mark.parametrize("link,want", [("/x", "http://h.de/x"), ("x.pdf", "http://h.de/a/x.pdf"), ("//o/x", "http://o/x"), ("https://o/x", "https://o/x")])
def test_resolved(spark, link, want):
    assert one(spark, web.resolved(F.col("l"), F.lit("http://h.de/a/b?q=1#f")), l=("string", link)) == want


def test_links(spark):
    assert [one(spark, web.cleaned_link(F.col("l")), l=("string", x)) for x in (" A.PDF#p ", "", "mailto:x", None, "JavaScript:f()")] == ["a.pdf", None, None, None, None]
    assert one(spark, web.title(F.col("h")), h=("string", "<TITLE> a\nb </TITLE>")) == "a\nb" and one(spark, web.title(F.col("h")), h=("string", "x")) is None


def test_vectors(spark):
    cos = vectors.cosine(F.col("a"), F.col("b"))
    assert one(spark, cos, a=("array<float>", [1.0, 0.0]), b=("array<float>", [1.0, 0.0])) == 1.0
    assert one(spark, cos, a=("array<float>", [0.0, 0.0]), b=("array<float>", [1.0, 0.0])) == 0.0


@LOOSE
@given(st.text(alphabet="ab ", max_size=30), st.text(alphabet="ab ", max_size=30))
def test_shared_edge(spark, a, b):
    want = max((i for i in range(3, min(len(a), len(b)) + 1) if b.startswith(a[len(a) - i :])), default=0)
    assert one(spark, tx.shared_edge(F.col("a"), F.col("b"), 3), a=("string", a), b=("string", b)) == want


def test_edge_of_10_and_11_characters(spark):
    for n, want in ((10, 0), (11, 11)):
        assert one(spark, tx.shared_edge(F.col("a"), F.col("b")), a=("string", "x" + "abcdefghijk"[:n]), b=("string", "abcdefghijk"[:n] + "y")) == want


def test_text(spark):
    assert one(spark, tx.header_level(F.col("h")), h=("string", "<H3>x</H3><h2>y</h2>")) == 2
    assert one(spark, tx.tagged_chunks(F.col("h")), h=("string", "a<chunk> x </chunk> y <chunk>open <chunk></chunk>")) == ["x", ""]
    assert one(spark, tx.share_of_words(F.col("a"), F.col("b")), a=("string", "A b"), b=("string", "")) == 0.0
    assert one(spark, tx.sentences(F.col("a")), a=("string", "One. Two!  Three? 4.5 x")) == ["One.", "Two!", "Three?", "4.5 x"]
    assert one(spark, tx.without_nul(F.col("a")), a=("string", "a\0b")) == "ab"
