import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from docloom.operators import chunking, evaluation, extraction, features, filters, lineage, merge, retrieval
from docloom.schemas import validate

LOOSE = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


# ---- filters


def test_partition_is_a_disjoint_cover(spark):
    df = spark.createDataFrame([(1, "en", "blog"), (2, None, "blog"), (3, "fr", None)], "id int, lang string, content_type string")
    for params in ({"lang": "en"}, {"lang": None}, {"lang": ["en", None]}, {"content_type": "BLOG", "lang": "en"}, {"nowhere": None}, {"nowhere": "x"}, {}):
        match, rest = filters.partition(df, params)
        assert sorted([r.id for r in match.collect()] + [r.id for r in rest.collect()]) == [1, 2, 3] and match.columns == rest.columns == df.columns
    assert [r.id for r in filters.partition(df, {"lang": [None, "fr"]})[0].collect()] == [2, 3]
    with pytest.raises(ValueError, match="meeting_minutes"):
        filters.predicate({"content_type": "novel"})


def test_validate(spark):
    df = spark.createDataFrame([(1, "a", "internal"), (2, "", "moon"), (3, None, None)], "id int, title string, scope string")
    good, bad = validate(df, required=("title",), domains={"scope": ("internal", "external")}, checks={"odd": F.col("id") != 3})
    assert [r.id for r in good.collect()] == [1] and {r.id: r.reject_reasons for r in bad.collect()} == {2: ["missing title", "bad scope: moon"], 3: ["missing title", "odd"]}


# ---- chunking


@LOOSE
@given(st.text(alphabet="ab \n\té", max_size=80), st.integers(1, 6), st.integers(0, 5))
def test_windows_cover_every_word(spark, text, size, overlap):
    df = spark.createDataFrame([(1, text)], "id int, text string")
    if overlap >= size:
        with pytest.raises(ValueError):
            chunking.sliding_words(df, ["id"], "text", size, overlap)
        return
    rows = sorted(chunking.sliding_words(df, ["id"], "text", size, overlap).collect(), key=lambda r: r.chunk_index)
    words = text.split()
    assert len(rows) == len(range(0, len(words), size - overlap))
    for n, r in enumerate(rows):
        assert r.chunk_text.split() == words[n * (size - overlap) : n * (size - overlap) + size] and text[r.chunk_start : r.chunk_end] == r.chunk_text and r.n_words == len(r.chunk_text.split())


def test_tail_window_shorter_than_the_overlap(spark):
    df = spark.createDataFrame([(1, " ".join("abcdefg"))], "id int, text string")
    assert [r.chunk_text for r in chunking.sliding_words(df, ["id"], "text", 4, 3).collect()] == ["a b c d", "b c d e", "c d e f", "d e f g", "e f g", "f g", "g"]


def test_greedy_packing(spark):
    rows = [(1, i, n) for i, n in enumerate([5, 5, 1, 30, 2, 0, 9])]
    df = spark.createDataFrame(rows, "d int, i int, n int")
    assert [r.window for r in chunking.greedy_windows(df, ["d"], "i", F.col("n"), 10).orderBy("i").collect()] == [0, 0, 1, 2, 3, 3, 4]
    assert [r.window for r in chunking.greedy_windows(df, ["d"], "i", F.col("n"), 10, 4).orderBy("i").collect()] == [0, 0, 1, 2, 3, 3, 4]


def test_text_tiles_find_a_change_of_topic():
    text = " ".join(["cats purr softly and sleep"] * 60 + ["stocks rise while markets trade"] * 60)
    tiles = chunking.text_tiles([text])[0].split("\f")
    assert " ".join(tiles) == text and len(tiles) >= 2 and abs(len(tiles[0].split()) - 300) <= 40


# ---- merge


def test_merge_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, None), (None, 3, "n")], "k string, v int, w string")
    new = spark.createDataFrame([("b", 5, None, 1), ("b", 6, "late", 2), ("c", 7, "z", 1), (None, None, "m", 1)], "k string, v int, w string, seq int")
    once = merge.merge(old, new, ["k"], "seq")
    assert sorted(map(tuple, once.collect()), key=str) == sorted([("a", 1, "x", "keep"), ("b", 6, "late", "update"), ("c", 7, "z", "insert"), (None, 3, "m", "update")], key=str)
    twice = merge.merge(once.drop("action"), new, ["k"], "seq")
    assert sorted(map(str, twice.drop("action").collect())) == sorted(map(str, once.drop("action").collect()))
    assert merge.counters(merge.merge(old, new, ["k"], "seq", update=False)).first().asDict() == {"n_insert": 1, "n_update": 0, "n_skip": 2, "n_keep": 1}


def test_content_hash_tells_values_apart(spark):
    rows = [("a", "b"), ("ab", ""), ("ab", None), (None, "ab"), ("a|1:b", "")]
    df = spark.createDataFrame(rows, "x string, y string").select(merge.content_hash(F.col("x"), F.col("y")).alias("h"))
    assert len({r.h for r in df.collect()}) == len(rows)


def test_new_ids_are_dense(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("o"))
    rows = merge.with_new_ids(df, ["o"], 10).orderBy("o").collect()
    assert [r.id for r in rows] == list(range(11, 1011))


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_new_ids_neither_lose_nor_repeat_rows(spark, adaptive):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        rows = spark.range(400_000).select(F.col("id").alias("n"), F.pmod(F.xxhash64("id"), F.lit(100_000)).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
        made = merge.with_new_ids(rows, ["k"], 1000)
        got = made.agg(F.count(F.lit(1)), F.count_distinct("id"), F.min("id"), F.max("id"), F.count_distinct("n"), F.count_if(F.col("payload") != F.sha2(F.col("n").cast("string"), 256))).first()
        assert tuple(got) == (400_000, 400_000, 1001, 401_000, 400_000, 0)
        falls = made.withColumn("_after", F.lead("k").over(Window.partitionBy(F.expr("id div 50000")).orderBy("id"))).where("_after < k")
        assert falls.count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_citations_prefer_the_batch(spark):
    c = spark.createDataFrame([("r1",), ("r2",), ("r3",)], "ref string")
    side = lambda rows: spark.createDataFrame(rows, "ref string, target_id int")
    out = merge.resolve_citations(c, side([("r1", 1)]), side([("r1", 9), ("r2", 2)]), "ref").collect()
    assert sorted(map(tuple, out)) == [("r1", 1, 1), ("r2", 2, 2)]


# ---- lineage


def test_fork_and_delete(spark):
    steps = spark.createDataFrame([(1, 10, 0, None, "completed"), (1, 11, 1, 10, "completed"), (1, 12, 2, 11, "failed"), (2, 20, 0, None, "pending")], "pipeline_id int, step_id int, position int, previous_id int, status string")
    assert sorted(map(tuple, lineage.fork(steps, 1, 5, 2, 100).collect())) == [(5, 100, 0, None, "completed"), (5, 101, 1, 100, "completed")]
    assert [(r.pipeline_id, r.step_id) for r in lineage.next_steps(steps).orderBy("pipeline_id").collect()] == [(1, 12), (2, 20)]
    entries = spark.createDataFrame([(1, "u1"), (2, "u2"), (2, "u3")], "pipeline_id int, uuid string")
    edges = spark.createDataFrame([("u1", "u2"), ("u2", "u3"), ("u3", "u1")], "source_uuid string, target_uuid string")
    left = lineage.delete_pipeline(spark.createDataFrame([(1,)], "pipeline_id int"), {"entries": entries}, edges)
    assert left["entries"].count() == 2 and [tuple(r) for r in left["edges"].select("source_uuid", "target_uuid").collect()] == [("u2", "u3")]


# ---- retrieval and evaluation


def test_dense_blocks_do_not_matter(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    q = e.where("vec_id < 20").select(F.col("vec_id").alias("query_id"), "embedding")
    a, b = (sorted(map(tuple, retrieval.dense_top_k(e.repartition(3), q, 5, block=n).collect())) for n in (3, 512))
    assert a == b and len(a) == 100
    assert retrieval.dense_top_k(e, q.limit(0), 5).count() == 0


@pytest.mark.parametrize("a,b,want", [((1, 1), (1, 2), True), ((1, 1), (1, 3), False), ((1, None), (1, 5), True), ((1, None), (2, None), True), ((1, 1), (2, 2), False), ((1, 2), (2, 1), True), ((1, 1), (3, 1), False), ((1, 1), (2, None), True)])
def test_neighbour_rule(spark, a, b, want):
    side = "struct<primary: int, secondary: int>"
    df = spark.createDataFrame([(a, b)], f"a {side}, b {side}")
    assert df.select(retrieval.adjacent("a", "b").alias("x")).first().x is want


def test_overlap_goes_from_the_lower_score(spark):
    shared = "common words here"
    rows = [("d", 1, None, "start " + shared, s) for s in (1.0,)] + [("d", 2, None, shared + " end", 2.0)]
    df = spark.createDataFrame(rows, "d string, primary int, secondary int, text string, score double")
    assert [r.merged for r in retrieval.merge_context(df, ["d"]).orderBy("primary").collect()] == ["start", shared + " end"]
    tie = df.withColumn("score", F.lit(1.0))
    assert [r.merged for r in retrieval.merge_context(tie, ["d"]).orderBy("primary").collect()] == ["start " + shared, "end"]


@LOOSE
@given(st.lists(st.sampled_from([0.0, 0.5, 1.0]), min_size=1, max_size=20))
def test_elo_is_zero_sum(spark, scores):
    df = spark.createDataFrame([("p", i, s) for i, s in enumerate(scores)], "p string, i int, s double")
    r = evaluation.elo(df, ["p"], "i", "s").first()
    assert abs(r.rating_a + r.rating_b - 3000) < 1e-6 and r.n_matches == len(scores)


def test_pairwise_distance_blocks(spark):
    df = spark.createDataFrame([("a", [float(i), 0.0]) for i in range(7)] + [("b", [1.0, 1.0])], "g string, v array<double>")
    want = sum(j - i for i in range(7) for j in range(i)) and sum(abs(i - j) for i in range(7) for j in range(i)) / 21
    for block in (1, 2, 100):
        rows = {r.g: r for r in evaluation.mean_pairwise_distance(df, "g", "v", block).collect()}
        assert abs(rows["a"].mean_distance - want) < 1e-9 and rows["b"].mean_distance == 0.0


# ---- extraction and features

TREE = '{"children":[{"block_type":"Page","children":[{"block_type":"SectionHeader","html":"<h1>A &amp; B</h1>"},{"block_type":"Text","html":"<p>one</p>"},{"block_type":"Figure","html":"<img>"},{"block_type":"ListGroup","html":"x","children":[{"block_type":"ListItem","html":"i1"},{"block_type":"ListItem","html":"i2"}]}]},{"block_type":"Page","children":[{"block_type":"Figure","html":"only"}]},{"block_type":"Page","children":[{"block_type":"Text","html":"two"},{"block_type":"Mystery","html":"m"}]}]}'


def test_layout_trees(spark):
    blocks = extraction.parsed_blocks(spark.createDataFrame([("d", TREE), ("bad", "{"), ("none", None)], "k string, j string"), "k", "j")
    pages = sorted((r.page, r.pos, r.feature_type, r.text) for r in extraction.entries_by_page(blocks, "k").collect())
    assert pages == [(1, -1, "combined_text", "A & B one i1 i2"), (1, 2, "figure", ""), (2, 0, "figure", "only"), (3, -1, "combined_text", "two m")]
    assert [(r.session, r.title, r.min_page, r.max_page, r.text) for r in extraction.entries_by_title(blocks, "k").collect()] == [(1, "A & B", 1, 3, "A & B one i1 i2 two m")]
    assert {r.title for r in extraction.entries_by_title(blocks, "k", across_pages=False).collect()} == {"A & B", None}
    assert [r.figure_number for r in extraction.numbered(blocks.where("k = 'd'"), "k", ["page", "pos", "sub"]).where("feature_type = 'figure'").orderBy("page").collect()] == [1, 2]


def test_tei(spark):
    xml = '<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title>T</title></titleStmt><publicationStmt><date when="2024-01-02">x</date></publicationStmt><sourceDesc><author><persName><surname>Li</surname></persName></author><author><persName><surname>Ng</surname></persName></author></sourceDesc></fileDesc><profileDesc><abstract><p>Abs.</p></abstract></profileDesc></teiHeader></TEI>'
    assert tuple(extraction.tei_header(spark.createDataFrame([(1, xml)], "k int, x string"), "k", "x").first()) == (1, "T", "Li, Ng", "2024-01-02", "Abs.")


def test_plug_ins(spark):
    df = spark.createDataFrame([(1, "a b. c"), (2, ""), (3, None)], "id int, text string")
    rows = {r.id: r for r in features.embed(features.complete(df, F.col("text"), "s"), "text").collect()}
    assert rows[1].s == "a b" and abs(sum(x * x for x in rows[1].embedding) - 1) < 1e-6 and rows[2].embedding is None and rows[3].embedding is None
    made = features.described_entries(df.where("id = 1").withColumns({"d": F.lit("desc"), "c": F.lit("cap")}), "id", "d", "c").collect()
    assert [(r.kind, r.string) for r in made] == [("original", None), ("caption", "cap"), ("description", "desc")]
    parsed = spark.createDataFrame([('{"a": "x"}',), ("oops",)], "j string").select(features.parsed_answer(F.col("j"), "a string, b string", {"a": "?", "b": "!"}).alias("p")).collect()
    assert [tuple(r.p) for r in parsed] == [("x", "!"), ("?", "!")]
    stamped = features.stamp_feature(spark.createDataFrame([(None, ["d"], [])], "feature_models array<string>, feature_dates array<string>, feature_types array<string>"), "m", "t", "p").first()
    assert (stamped.feature_models, stamped.feature_dates, stamped.feature_types) == (["m"], ["d", "t"], ["p"])


# ---- crawling, tokens, plug-in compositions


def test_crawl_rounds(spark, tmp_path):
    from docloom.operators import crawl

    site = {"http://h/a": '<a href="/b?x=1">b</a><a href="c.pdf">p</a><a href="mailto:x">m</a>', "http://h/b": '<a href="/a#t">a</a><a href="/d">d</a>', "http://h/d": None}
    web_rows = spark.createDataFrame(list(site.items()), "norm_url string, html string")

    def fetch(urls):
        return urls.join(web_rows, "norm_url", "left").withColumn("error", F.when(F.col("html").isNull(), "404"))

    def keep(df, n):
        df.write.parquet(str(tmp_path / str(n)))
        return spark.read.parquet(str(tmp_path / str(n)))

    out = crawl.crawl(spark.createDataFrame([("http://h/a?q=2",), ("http://h/a",)], "url string"), fetch, 5, keep)
    assert sorted((r.norm_url, r.round, r.error) for r in out.collect()) == [("http://h/a", 0, None), ("http://h/b", 1, None), ("http://h/d", 2, "404")]


def test_token_windows(spark):
    import os

    path = f"{os.environ.get('DOCLOOM_TOKENIZERS', '/opt/tokenizers')}/byte_bpe_50k.json"
    if not os.path.exists(path):
        pytest.skip("no vocabulary file")
    text = "The same words, the same words, the same words again: naïve déjà vu."
    rows = chunking.sliding_tokens(spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, text string"), ["id"], "text", path, 6, 2).orderBy("chunk_index").collect()
    assert {r.id for r in rows} == {1} and rows[0].chunk_start == 0 and max(r.chunk_end for r in rows) == len(text)
    assert all(text[r.chunk_start : r.chunk_end] == r.chunk_text for r in rows) and all(a.chunk_end > b.chunk_start for a, b in zip(rows, rows[1:]))


def test_rerank_remote_keeps_scores_with_their_points(spark):
    points = spark.createDataFrame([(1, i, 1.0 - i / 100, str(i)) for i in range(30)], "query_id int, id int, score double, text string")
    out = retrieval.rerank_remote(points, lambda d: d.withColumn("new_score", F.when(F.col("id") % 2 == 0, F.col("id") / 30.0)), 5).orderBy("id").collect()
    assert [r.id for r in out] == [20, 22, 24, 26, 28] and all(abs(r.rerank_score - r.id / 30) < 1e-9 for r in out)


def test_mixtures_of_more_than_five_components_are_told_apart(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = np.repeat(rng.normal(size=(8, 24)) * 6, 400, axis=0) + rng.normal(size=(3200, 24))  # with few rows BIC rightly takes fewer
    rows = [(i, i // 400, v.tolist()) for i, v in enumerate(x)] + [(3200, -1, None)]
    small = features.reduced(spark.createDataFrame(rows, "id int, planted int, v array<double>"), "v")
    assert {len(r.reduced) for r in small.where("id < 3200").collect()} == {20}
    found = features.soft_clusters(small.select("id", "planted", "reduced"), "reduced").collect()
    kinds = {}
    for r in found:
        kinds.setdefault(r.cluster, set()).add(r.planted)
    assert {r.id for r in found} == set(range(3200))
    assert all(len(k) == 1 for k in kinds.values()) and set().union(*kinds.values()) == set(range(8))


def test_mixtures_of_few_rows(spark):
    few = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(3)], "id int, v array<double>")
    for n in (0, 3):
        rows = features.reduced(few.limit(n), "v")
        assert {r.id for r in features.soft_clusters(rows, "reduced").collect()} == set(range(n))
