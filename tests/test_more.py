import json
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom import queries as q
from docloom.functions import text as tx
from docloom.functions.arrays import folded, sums_before
from docloom.operators import blocks, chunking, crawl, evaluation, features, lineage, merge, retrieval, sparse_index
from docloom.plans import registry
from docloom.plans.pipeline import errors
from docloom.schemas import by_index
from docloom.sources import workspace
from docloom.streaming import incremental


def test_folds_equal_loops(spark):
    rows = [([],), ([5],), (list(range(200)),), ([3] * 64,), ([1] * 65,), (None,)]
    df = spark.createDataFrame(rows, "xs array<bigint>")
    odd = folded(F.col("xs"), F.lit(0).cast("bigint"), lambda s, x: (s + x, F.when(x % 2 == 1, s)), "bigint")
    for (xs,), r in zip(rows, df.select(sums_before(F.col("xs")).alias("a"), odd.alias("b")).collect(), strict=True):
        sums = [sum((xs or [])[:i]) for i in range(len(xs or []))]
        assert r.a == sums and r.b == [s for s, x in zip(sums, xs or [], strict=True) if x % 2]


def test_long_texts_are_cut_in_linear_time(spark):
    text = " ".join(f"w{i}" for i in range(300_000))
    rows = chunking.sliding_words(spark.createDataFrame([(1, text)], "k int, text string"), ["k"], "text", 500, 50).collect()
    assert len(rows) == 667 and all(text[r.chunk_start : r.chunk_end] == r.chunk_text for r in rows)
    entries = spark.range(50_000).select(F.lit(1).alias("k"), F.col("id").alias("o"))
    assert chunking.greedy_windows(entries, ["k"], "o", F.lit(7), 70).agg(F.max("window")).first()[0] == 4999


def test_shared_folders_are_asked_for():
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Conf:
        get = staticmethod(lambda name, default: default)

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.scratch(Session(), "x")


def test_bm25_equals_postings(spark, sf):
    """Against a plain count over dictionaries; waves of one query and tasks of few cells change nothing."""
    docs, queries = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet").limit(12)
    tokens = {r.doc_id: r.t for r in docs.select("doc_id", tx.tokens(F.col("text")).alias("t")).collect()}
    df = {}
    for t in tokens.values():
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    want = {}
    for item, terms in ((r.item_id, set(r.t)) for r in queries.select("item_id", tx.tokens(F.col("text")).alias("t")).collect()):
        scores = []
        for i, t in tokens.items():
            s = sum(t.count(w) * 2.2 / (t.count(w) + 1.2 * (0.25 + 0.75 * len(t) / 256)) * math.log((len(tokens) - df[w] + 0.5) / (df[w] + 0.5) + 1) for w in terms if w in t)
            if s:
                scores.append((-round(s, 6), i))
        want[item] = [i for _, i in sorted(scores)[:10]]
    for parts, group in ((1, 256), (5, 1)):
        got = {}
        index = sparse_index.build_index(docs.repartition(parts))
        for r in sorted(sparse_index.search_index(index, queries, query_block=group).collect(), key=lambda r: r.rank):
            got.setdefault(r.query_id, []).append(r.id)
        assert got == want


def test_dense_cells_do_not_matter(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    queries = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    runs = [sorted(map(tuple, retrieval.dense_top_k(e, queries, feature="label", block=b, cells=c).collect())) for b, c in ((512, None), (3, (5, 2)))]
    assert runs[0] == runs[1]


def test_pairwise_distance_of_equal_vectors(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0])] * 300 + [(1, [3.0, 4.0])] * 100 + [(2, [1.0])], "k int, v array<double>")
    got = {r.k: (r.n, round(r.mean_distance, 9)) for r in evaluation.mean_pairwise_distance(df, "k", "v", 32).collect()}
    assert got == {1: (400, round(5 * 300 * 100 / (400 * 399 / 2), 9)), 2: (1, 0.0)}


def test_embedder_equals_a_plain_version(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r.embedding for r in q.embed_documents(spark, sf).collect()}
    for r in rows:
        v = [0.0] * 64
        for word in r.text.lower().split():
            h = zlib.crc32(word.encode())
            v[h % 64] += 1 if h >> 31 else -1
        n = math.sqrt(sum(x * x for x in v))
        assert np.allclose(got[r.doc_id], [x / n if n else x for x in v], atol=1e-6) if r.text.strip() else got[r.doc_id] is None


def test_token_windows_equal_a_plain_version(spark, sf):
    import os

    from tokenizers import Tokenizer

    path = f"{os.environ.get('DOCLOOM_TOKENIZERS', '/opt/tokenizers')}/byte_bpe_50k.json"
    if not os.path.exists(path):
        pytest.skip("no vocabulary file")
    tokenizer = Tokenizer.from_file(path)
    got = {}
    for r in sorted(q.sliding_tokens(spark, sf).collect(), key=lambda r: (r.doc_id, r.chunk_index)):
        got.setdefault(r.doc_id, []).append((r.chunk_start, r.chunk_end, r.n_tokens))
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        at = tokenizer.encode(r.text, add_special_tokens=False).offsets
        want = [(w[0][0], w[-1][1], len(w)) for w in (at[i : i + 500] for i in range(0, len(at), 450))]
        assert got.get(r.doc_id, []) == want


def test_nested_blocks_of_any_depth(spark):
    deep = {"type": "text", "spans": [{"content": "end"}]}
    for _ in range(3000):
        deep = {"type": "list", "blocks": [deep]}
    page = {"para_blocks": [{"type": "table_caption", "text": "lost"}, {"type": "table", "html": "<td>1", "bbox": [1, 2, 3, 4]}, {"type": "table_footnote", "text": "note"}, {"type": "image"}, {"type": "image_caption", "text": "cap"}, {"type": "table"}]}
    docs = spark.createDataFrame([(1, json.dumps({"pdf_info": [page, page]})), (2, "{broken"), (3, None), (4, "{}"), (5, "[1]")], "k int, j string")
    rows = blocks.block_entries(blocks.nested_blocks(docs, "k", "j"), "k").collect()
    by = {r.uuid: r for r in rows}
    assert {r.k for r in rows} == {1} and [r.table_number for r in sorted(rows, key=lambda r: (r.page, r.secondary or 0)) if r.feature_type == "table"] == [1, 2, 3, 4]
    edges = sorted((r.string, r.relationship, by[r.parent_uuid].feature_type, by[r.parent_uuid].page == r.page) for r in rows if r.parent_uuid)
    assert edges == [("cap", "figure_caption", "figure", True)] * 2 + [("note", "table_footnote", "table", True)] * 2
    assert blocks.walk([{"para_blocks": [deep]}])[-1]["level"] == 3000


def test_selectors():
    tree = crawl.Tree()
    tree.feed("<div id=a class='x y'><p data-k=1>one<b>two</b></p><ul><li>1<li>2</ul></div><div class=x><p>three</p></div>")
    nodes = tree.finish().nodes
    text = lambda s: ["".join(nodes[i]["text"]) for i in crawl.selected(nodes, s)]
    assert text("#a p") == ["onetwo"] and text(".x p") == ["onetwo", "three"] and text("div.x.y b") == ["two"] and text("p[data-k]") == ["onetwo"] == text("p[data-k='1']") and text("p[data-k=2]") == []
    assert text("b, ul") == ["two", "12"]
    assert crawl.extracted(nodes, 0, {"attributes": ["id", "no"], "nested": {"p": {"selector": "p", "extract": "text"}, "none": {"selector": "i"}}}) == {"id": "a", "no": None, "p": {"text": "onetwo"}}
    assert crawl.rolled_up({"a": [{"x": 1}, {"x": ""}, {"y": 2}], "b": None, "c": []}) == {"a_count": 3, "a_x_list": [1], "c_count": 0}
    with pytest.raises(ValueError):
        crawl.selected(nodes, "p:first-child")


def test_clusters_inside_clusters(spark):
    """Two far groups of two near ones each: four clusters, numbered through; the silhouette is highest at the true number."""
    rng = np.random.default_rng(4)
    centres = [(0, 0), (0, 4), (60, 0), (60, 4)]
    rows = [(i, [float(v) for v in rng.normal(centres[i % 4], 0.15)]) for i in range(240)]
    df = spark.createDataFrame([*rows, (999, None)], "id int, v array<double>")
    found = {}
    for r in features.nested_clusters(df, "id", "v", 2, range(2, 3)).collect():
        found.setdefault(r.id, set()).add(r.cluster)
    assert set(found) == set(range(240)) and len({frozenset(found[i]) for i in range(240)}) == 4
    assert all(found[i] == found[i % 4] for i in range(240)) and set().union(*found.values()) == {0, 1, 2, 3}
    sweep = {r.k: r.silhouette for r in features.silhouettes(df, "v", range(2, 6)).collect()}
    assert set(sweep) == {2, 3, 4, 5} and sweep[2] > sweep[3]
    assert features.nested_clusters(df.limit(0), "id", "v").collect() == [] and features.silhouettes(df.limit(0), "v").collect() == []
    assert {r.cluster for r in features.nested_clusters(df.where("id < 3"), "id", "v", 2).collect()} == {0}


def test_prompts_and_discovery(spark):
    made = registry.Prompt("You judge.", lambda a: F.concat(F.lit("Which? "), a), "winner STRING", {"winner": "none"})
    try:
        registry.prompt("judge", made)
        with pytest.raises(KeyError):
            registry.prompt("judge", made)
        df = spark.createDataFrame([("x", '{"winner": "A"}'), ("y", "no")], "t string, answer string")
        rows = df.select(made.messages(F.col("t")).alias("m"), made.parsed(F.col("answer")).alias("p")).collect()
        assert [(r.m[1].content, r.p.winner) for r in rows] == [("Which? x", "A"), ("Which? y", "none")]
    finally:
        registry.PROMPTS.pop("judge", None)
    assert {"docloom.operators.blocks", "docloom.operators.merge"} <= set(registry.discover("docloom.operators"))


def test_collection_names_have_to_agree():
    registry.OPERATORS["upsert", "probe"] = lambda spark, df, collection_name="": df
    try:
        config = {"stages": [{"name": "upsert", "functions": [{"name": "probe", "params": {"collection_name": "a"}}]}], "pipeline": {"collection_name": "b"}}
        assert any("collection_name" in e for e in errors(config))
        assert errors({**config, "pipeline": {"collection_name": "a"}}) == []
    finally:
        del registry.OPERATORS["upsert", "probe"]


def test_index_order(spark):
    df = spark.createDataFrame([(1, (1, 2, None)), (2, (1, None, 3)), (3, (None, 9, 9)), (4, (1, 2, 1))], "id int, index struct<primary: int, secondary: int, tertiary: int>")
    assert [r.id for r in df.orderBy(*by_index("index")).collect()] == [3, 2, 1, 4]


def test_ratings_of_null_keys_and_history(spark):
    rows = [(None, 1, 1.0), (None, 2, 1.0), (4, 1, None), (4, 2, 0.0)]
    df = spark.createDataFrame(rows, "k bigint, s int, score double")
    got = {r.k: (round(r.rating_a, 3), r.n_matches) for r in evaluation.elo(df, ["k"], "s", "score").collect()}
    assert got == {None: (1530.53, 2), 4: (1484.0, 2)}
    assert evaluation.elo(df, ["k"], "s", "score", history=True).count() == 4 and evaluation.elo(df.limit(0), ["k"], "s", "score").collect() == []


def test_maps_merge_with_the_last_winning(spark):
    rows = [(1, 1, {"a": "x", "b": "1"}), (1, 2, {"b": "2"}), (1, 3, None), (2, 1, None), (3, 5, {"a": "late"}), (3, 2, {"a": "early"})]
    df = spark.createDataFrame(rows, "k int, o int, m map<string,string>").groupBy("k").agg(chunking.merged_maps(F.col("m"), F.col("o")).alias("m"))
    assert {r.k: r.m for r in df.collect()} == {1: {"a": "x", "b": "2"}, 2: {}, 3: {"a": "late"}}


def test_an_upsert_of_everything(spark):
    stored = spark.createDataFrame([("r1", "u1", "old")], "ref string, uuid string, string string").withColumn("content_hash", merge.content_hash(F.col("string")))
    new = spark.createDataFrame([("r2", "u2", "new", 1), ("r3", "u3", "new", 2), ("r4", "u4", None, 3), ("r1", "u9", "old", 4)], "ref string, uuid string, string string, seq int")
    edges = spark.createDataFrame([("r3", "r1", "cites"), ("r3", "r1", "cites"), ("r3", "gone", "cites"), ("r1", "r3", "cites")], "source_ref string, target_ref string, relationship_type string")
    out = merge.upsert_entries(stored, new, ["content_hash"], required=("string",), edges=edges)
    assert {(r.uuid, r.action) for r in out["merged"].collect()} == {("u1", "skip"), ("u3", "insert")} and out["counters"].first().n_insert == 1
    assert [r.uuid for r in out["rejected"].collect()] == ["u4"]
    assert {tuple(r) for r in out["edges"].collect()} == {("u3", "u9", "cites"), ("u9", "u3", "cites")}


def test_steps_and_points(spark):
    steps = spark.createDataFrame([(1, 0, "completed")], "pipeline_id int, position int, status string")
    out = lineage.put_steps(steps, spark.createDataFrame([(1, 0, "completed", "boom")], "pipeline_id int, position int, status string, error string"))
    assert [tuple(r) for r in out.collect()] == [(1, 0, "failed")]
    points = spark.createDataFrame([(1, None), (2, "a"), (3, "b")], "id int, tag string")
    assert sorted(r.id for r in lineage.without_points(points, condition=F.col("tag") == "a").collect()) == [1, 3]


def test_operators_of_pipelines(spark, tmp_path):
    ops = registry.OPERATORS
    rows = spark.createDataFrame([("d", 1, "One here. Two here. Three zzz."), ("d", 2, "Four here."), ("e", 1, None)], "document_hash string, page int, text string")
    chunks = ops["chunk", "distance_chunking"](spark, rows, threshold=0.9).collect()
    assert " ".join(r.chunk_text for r in sorted(chunks, key=lambda r: r.chunk_index)) == "One here. Two here. Three zzz. Four here."
    assert ops["chunk", "generative"](spark, rows.where("text is not null")).count() >= 1
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", None), ("c", [0.0, 1.0])], "uuid string, embedding array<float>")
    assert {r.uuid: r.clusters for r in ops["featurize", "get_clusters"](spark, vectors).collect()} == {"a": [0], "b": [], "c": [0]}
    path = str(tmp_path / "points")
    for n in (1, 2):
        out = ops["upsert", "upsert_embeddings"](spark, vectors.withColumn("n", F.lit(n)), path)
        assert {(r.uuid, r.n, r.action) for r in out.collect()} == {(u, n, "insert" if n == 1 else "update") for u in "ac"}


def test_a_broken_version_is_not_read(spark, tmp_path):
    path = str(tmp_path / "entries")
    put = lambda x: registry.OPERATORS["upsert", "upsert_entries"](spark, spark.createDataFrame([(1, x)], "k int, v string"), path, ["k"], update_on_collision=True)
    assert put("a").count() == 1
    (tmp_path / "entries" / "v=2").mkdir()
    (tmp_path / "entries" / "v=2" / "part-0.parquet").write_text("broken")
    assert [(r.v, r.action) for r in put("b").collect()] == [("b", "update")]


def test_tokens_and_back(spark):
    import os

    path = f"{os.environ.get('DOCLOOM_TOKENIZERS', '/opt/tokenizers')}/byte_bpe_50k.json"
    if not os.path.exists(path):
        pytest.skip("no vocabulary file")
    rows = [("Some text, with é and 日本.",), ("",), (None,), ("  two  spaces\n",)]
    df = chunking.tokenized(spark.createDataFrame(rows, "text string"), "text", path)
    assert [r.back for r in chunking.detokenized(df, "tokens", path, "back").collect()] == [t or "" for (t,) in rows]


def test_manual_links_and_prompts(spark, tmp_path):
    pages = [("http://a/x?q=1", "<title>A</title><a href=\"/f.pdf\">f</a>"), ("http://a/y", "<a href='z'>z</a>")]
    spark.createDataFrame(pages, "url string, html string").write.parquet(str(tmp_path / "p"))
    out = registry.OPERATORS["load", "manual_links"](spark, None, ["http://a/x", "http://nowhere/"], str(tmp_path / "p")).collect()
    assert sorted((r.public_url, r.file_type, r.document_title) for r in out) == [("http://a/f.pdf", "pdf", "A"), ("http://a/x", "html", "A")]
    registry.PROMPTS["probe"] = registry.Prompt("s", lambda c: c, "items ARRAY<STRING>", {})
    try:
        df = spark.createDataFrame([('{"items": ["a", "b"]}', 1), ("none", 2)], "chunk_text string, n int")
        rows = registry.OPERATORS["featurize", "featurize_model"](spark, df, "probe").collect()
        assert sorted((r.n, str(r.feature)) for r in rows) == [(1, "a"), (1, "b"), (2, "None")]
    finally:
        del registry.PROMPTS["probe"]


def test_registered_upsert_validates_hashes_and_links(spark, tmp_path):
    upsert = registry.OPERATORS["upsert", "upsert_entries"]
    path, links = str(tmp_path / "entries"), str(tmp_path / "links")
    spark.createDataFrame([("a", "b", "next"), ("a", "b", "next"), ("b", "z", "next"), ("c", "a", "next")], "source_ref string, target_ref string, relationship_type string").write.parquet(links)
    shape = "uuid string, string string, ref string, at int"
    first = spark.createDataFrame([("u1", "one", "a", 1), ("u2", "two", "b", 1), ("u9", None, "x", 1), ("u8", "one", "a", 0)], shape)
    out = upsert(spark, first, path, ["content_hash"], order="at", text="string", required=["string"], edges=links)
    assert sorted((r.uuid, r.action) for r in out.collect()) == [("u1", "insert"), ("u2", "insert")] and out.where("content_hash is null").count() == 0
    again = upsert(spark, spark.createDataFrame([("u3", "three", "c", 1), ("u4", "two", "b", 1)], shape), path, ["content_hash"], order="at", text="string", required=["string"], edges=links)
    assert sorted((r.uuid, r.action) for r in again.collect()) == [("u1", "keep"), ("u2", "skip"), ("u3", "insert")]
    assert [(r.uuid, r.reject_reasons) for r in spark.read.parquet(f"{path}/rejected/v=1").collect()] == [("u9", ["missing string"])]
    known = spark.read.parquet(f"{path}/edges/v=2").select("source_uuid", "target_uuid").collect()
    assert {tuple(r) for r in known} >= {("u1", "u2"), ("u3", "u1")}


def test_selecting_from_a_deep_page_takes_time_by_its_size():
    import time

    began = time.time()
    tree = crawl.Tree()
    tree.feed("<div>x" * 30_000 + "</b>" * 30_000)
    nodes = tree.finish().nodes
    assert time.time() - began < 10 and len(nodes) == 30_000
    assert crawl.extracted(nodes, 29_990, {"extract": "text"}) == {"text": "x" * 10} and nodes[0]["end"] == 29_999


def test_registered_prompts(spark):
    """A pipeline file can name them; every one asks with its parts and falls back where it has a fallback."""
    assert {"summarize_entry", "describe_image", "chunk_text", "LLM_chunk_rubric", "LLM_relative_evaluation", "extract_claims"} <= set(registry.PROMPTS)
    assert errors({"stages": [{"name": "featurize", "functions": [{"name": "featurize_model", "params": {"prompt_name": "extract_claims"}}]}]}) == []
    df = spark.createDataFrame([("one", "two", '{"summary": "s"}'), ("one", None, "no json")], "a string, b string, answer string")
    made = registry.PROMPTS["summarize_entry"]
    rows = df.select(made.messages(F.col("a"), F.col("b")).alias("m"), made.parsed(F.col("answer")).alias("p")).collect()
    assert [r.m[1].content for r in rows] == ["Entry:\none\n\nDocument:\ntwo", "Entry:\none"] and [r.p.summary for r in rows] == ["s", ""] and rows[0].m[0].role == "system"
    both = registry.PROMPTS["LLM_relative_evaluation"]
    assert df.select(both.messages(F.col("a"), F.col("b")).alias("m"), both.parsed(F.col("answer")).alias("p")).first().p.winner == "tie"
    out = registry.OPERATORS["featurize", "featurize_model"](spark, df, "extract_claims", text="a")
    assert out.count() == 2 and "feature" in out.columns
