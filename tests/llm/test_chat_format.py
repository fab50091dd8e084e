import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from docloom.llm import chat_format as cf

SCHEMA = "conv_id int, turn int, role string, text string, turns string, formatted int"
HARD = ["\\", "\\s", "\\t", "\\h", "</turn>", "### ", "### user: x</turn>\n", "\\### Assistant: </turn> ok", ":", "\n", "#### ", "<</turn>", "a: b", "", "C:\\temp\\new", "\\\\h"]


def test_hard_texts_round_trip(spark):
    rows = [(i, t, role, text, "x", 1) for i in range(4) for t, (text, role) in enumerate(zip(HARD, ["user", "assistant", "a: b", "r\\:</turn>### "] * 4, strict=True))]
    out = cf.format_chats(spark.createDataFrame(rows, SCHEMA)).withColumn("learnt", cf.loss_text()).collect()
    for r in out:
        assert [(t.role, t.text) for t in r.parsed] == [(x[2], x[3]) for x in rows if x[0] == r.conv_id]
        assert r.learnt == "".join(x[3] for x in rows if x[0] == r.conv_id and x[2] == "assistant")
        assert all(r.formatted[s.end :].startswith("</turn>\n") for s in r.loss_spans)


def test_escapes_only_where_needed(spark):
    rows = [(1, 0, "user", "plain \\d", "", 0), (2, 0, "user", "plain \\d", "", 0), (2, 1, "assistant", "x</turn>", "", 0)]
    out = {r.conv_id: r for r in cf.format_chats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out[1].escaped == 0 and "plain \\d" in out[1].formatted
    assert out[2].escaped == 1 and "plain \\d" in out[2].formatted and "x\\t</turn>" in out[2].formatted


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "x:y"]), st.lists(st.sampled_from([*HARD, "é", "\U0001F600", " ", "s", "t", "h", "<", "/turn>", "#"]), max_size=6).map("".join)), min_size=1, max_size=5))
def test_any_texts_round_trip(spark, turns):
    df = spark.createDataFrame([(1, i, r, t, "", 0) for i, (r, t) in enumerate(turns)], SCHEMA)
    row = cf.format_chats(df).withColumn("learnt", cf.loss_text()).first()
    assert [(t.role, t.text) for t in row.parsed] == turns and row.learnt == "".join(t for r, t in turns if r == "assistant")


def test_a_conversation_of_very_many_turns(spark):
    """100,000 turns, a third of them with reserved strings; spans cover what is learnt."""
    from pyspark.sql import functions as F

    turns = spark.range(100_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.when(F.col("id") % 3 == 0, "### </turn>").otherwise("text "), F.col("id")).alias("text"))
    began = time.time()
    row = cf.format_chats(turns).withColumn("learnt", cf.loss_text()).first()
    assert time.time() - began < 60
    want = [("### </turn>" if i % 3 == 0 else "text ") + str(i) for i in range(1, 100_000, 2)]
    assert row.learnt == "".join(want) and len(row.parsed) == 100_000 and len(row.loss_spans) == 50_000
    for i in (0, 1, 777, 49_999):
        s = row.loss_spans[i]
        assert row.formatted[s.start : s.end].replace("\\h", "### ").replace("\\t", "</turn>") == want[i]


def test_odd_rows(spark):
    rows = [(1, None, None, None, "", 0), (1, 2, "assistant", "x" * 200000, "", 0), (1, 2, "assistant", "x" * 200000, "", 0), (None, 1, "user", "lost", "", 0), (None, 1, "user", "also", "", 0)]
    found = cf.format_chats(spark.createDataFrame(rows, SCHEMA)).collect()
    out = {r.conv_id: r for r in found}
    assert [len(t.text) for t in out[1].parsed] == [0, 200000, 200000]
    assert sorted([t.text for t in r.parsed] for r in found if r.conv_id is None) == [["also"], ["lost"]]
    assert cf.format_chats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_grammar_errors_are_seen(spark):
    from pyspark.sql import functions as F

    broken = spark.createDataFrame([("### user: a### b</turn>\n",), ("user: a</turn>\n",), ("### user a</turn>\n",)], "formatted string")
    assert all(t.role is None for r in broken.select(cf.parse(F.col("formatted")).alias("p")).collect() for t in r.p)


@pytest.mark.parametrize("text", HARD)
def test_escape_is_undone(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    r = df.select(cf.unescape(cf.escape(df.t)).alias("a"), cf.unescape_role(cf.escape_role(df.t)).alias("b"), cf.escape_role(df.t).alias("c")).first()
    assert r.a == r.b == text and ":" not in r.c
