import os
import shutil
import subprocess
import sys
import time

import pytest
import yaml
from pyspark.sql import functions as F

from docloom.plans import registry
from docloom.plans.pipeline import Pipeline, errors
from docloom.sources import files
from docloom.sources.deltas import DeltaTable
from docloom.sources.sinks import Storage, pages_json, payload
from docloom.streaming import incremental

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def config(sf, base, **pipeline):
    return {
        "stages": [
            {"name": "load", "functions": [{"name": "pages", "params": {"path": f"{sf}/pages.parquet"}}]},
            {"name": "extract", "functions": [{"name": "html_passages"}]},
            {"name": "chunk_2", "functions": [{"name": "sliding_window", "params": {"chunk_size": 50, "overlap": 5, "order": "passage"}}, {"name": "topic_segmentation"}]},
            {"name": "embed", "functions": [{"name": "embed"}]},
            {"name": "upsert", "functions": [{"name": "upsert_entries", "params": {"path": f"{base}/entries", "keys": ["document_hash", "chunk_index", "chunk_text"]}}]},
        ],
        "pipeline": {"pipeline_id": 3, **pipeline},
        "storage": {"storage_type": "local", "base_path": str(base)},
    }


def test_run_resume_and_rerun(spark, sf, tmp_path):
    path = tmp_path / "p.yaml"
    path.write_text(yaml.safe_dump(config(sf, tmp_path / "o")))
    first = Pipeline.load(str(path)).run(spark)
    n = first.count()
    assert n > 0 and {r.action for r in first.select("action").distinct().collect()} == {"insert"} and first.where("embedding is null").count() == 0
    again = Pipeline(config(sf, tmp_path / "o", resume_from_step=3)).run(spark)
    assert again.count() == n and {r.action for r in again.select("action").distinct().collect()} == {"skip"}
    assert Pipeline(config(sf, tmp_path / "o", resume_from_step=0)).run(spark).count() == n


def test_all_errors_are_collected():
    bad = {"stages": [{"name": "chunk_1", "functions": [{"name": "sliding_window", "params": {"size": 1}}, {"name": "nothing"}]}, {"name": "dream"}, {"name": "load", "functions": [{"name": "local", "params": {"added_metadata": {"content_type": "novel"}}}]}]}
    found = errors(bad)
    assert len(found) == 5 and any("missing parameter directory_path" in e for e in found)
    with pytest.raises(ValueError, match="unknown stage dream"):
        Pipeline(bad).run(None)


def test_registry(spark):
    assert registry.listing(spark).where("stage = 'chunk'").count() >= 2
    with pytest.raises(KeyError):
        registry.operator("chunk", "sliding_window")(lambda spark, df: df)


def test_scans(spark, tmp_path):
    for name, text in (("a/x.TXT", "one"), ("a/.hidden.txt", "no"), ("b/y.md", "two"), ("b/empty.txt", ""), ("a/z.txt", "three")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    rows = files.scan_files(spark, str(tmp_path), ".txt").collect()
    assert sorted((r.document_title, r.file_size, r.file_type) for r in rows) == [("x.TXT", 3, "txt"), ("z.txt", 5, "txt")]
    with pytest.raises(ValueError):
        files.scan_files(spark, "relative/path")
    assert {(r.dataset, r.text) for r in files.scan_texts(spark, str(tmp_path)).collect()} >= {("a", "three")}
    (tmp_path / "i.jsonl").write_text('{"id": "1"}\n{"x": 2}\n')
    assert [r.id for r in files.scan_ids(spark, str(tmp_path / "i.jsonl")).collect()] == ["1"]
    (tmp_path / "c.csv").write_text('q,p\n"a ""b"", c",1\n')
    assert tuple(files.scan_csv(spark, str(tmp_path / "c.csv"), "q string, p int").first()) == ('a "b", c', 1)


def test_sinks(spark, tmp_path):
    with pytest.raises(ValueError):
        Storage.of({"storage_type": "s3"})
    assert Storage.of({"storage_type": "s3", "bucket_name": "b"}).path("x") == "s3a://b/x"
    df = spark.createDataFrame([(1, "a", None, [0.5])], "id int, s string, n string, embedding array<float>")
    assert df.select(payload(df).alias("j")).first().j == '{"id":1,"s":"a"}'
    pages = spark.createDataFrame([("d", 2, "b"), ("d", 1, "a")], "d string, p int, t string")
    assert pages_json(pages, "d", "p", "t").first().json == '{"1":"a","2":"b"}'


# ---- streams


def streamed(spark, sf, tmp_path, parts=3):
    events = incremental.event_time(spark.read.parquet(f"{sf}/events.parquet"))
    n = events.count()
    for k in range(parts):  # files arrive in order of time
        events.where((F.col("event_id") >= k * n // parts) & (F.col("event_id") < (k + 1) * n // parts)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.1)
    return events, spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def test_merged_stream_equals_table(spark, sf, tmp_path):
    events, stream = streamed(spark, sf, tmp_path)
    cols = ["user_id", "event_type", "event_id", "value"]
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in events.select("user_id", "event_type", "value").schema)
    table = DeltaTable(spark, str(tmp_path / "out"), shape, ("user_id", "event_type"), compact_after=2)
    incremental.drain(stream.select(*cols), incremental.merging(table, "event_id"), str(tmp_path / "cp"))
    want = events.groupBy("user_id", "event_type").agg(F.max_by("value", "event_id").alias("value"))
    assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, want.select("user_id", "event_type", "value").collect()))


def test_streamed_windows_and_dedupe(spark, sf, tmp_path):
    events, stream = streamed(spark, sf, tmp_path)
    for n, make in enumerate((lambda d: incremental.tumbling(d, "1 day", ["event_type"], "value"), lambda d: incremental.first_seen(d, ["event_id"]).select("event_id"))):
        out = str(tmp_path / f"o{n}")
        incremental.drain(make(stream), lambda rows, i, out=out: rows.write.mode("overwrite").parquet(f"{out}/b={i}"), str(tmp_path / f"cp{n}"))
        rows = spark.read.parquet(out).drop("b")
        whole = make(events)
        if n:
            assert rows.count() == events.count()
        else:
            assert rows.exceptAll(whole).where("n > 100000").count() == 0 and rows.count() <= whole.count() and rows.count() >= whole.count() - 10


# ---- the library without the training-data operators


def test_stands_alone(tmp_path):
    for name in ("docloom", "__spark_entry__.py"):
        src = os.path.join(ROOT, name)
        (shutil.copytree if os.path.isdir(src) else shutil.copy)(src, tmp_path / name, **({"ignore": shutil.ignore_patterns("llm", "__pycache__")} if os.path.isdir(src) else {}))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 60 and not any(n.startswith('op') or n == 'pipeline' for n in q) and set(e.oracle_sql()) <= set(q); import docloom.plans.pipeline, docloom.streaming.incremental"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_the_training_data_operators():
    for folder, _, names in os.walk(os.path.join(ROOT, "docloom")):
        if os.path.basename(folder) == "llm":
            continue
        for name in names:
            if name.endswith(".py"):
                with open(os.path.join(folder, name), encoding="utf-8") as file:
                    assert "docloom.llm" not in file.read(), name
