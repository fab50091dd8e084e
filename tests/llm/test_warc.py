import gzip
import io
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docloom.llm import warc

PAGES = "page_id bigint, url string, html string, payload string, d int"


def pages(spark):
    rows = [
        (1, "http://a/", "<p>x</p>", "p", 1), (2, "http://b/", "<p>x</p>", "p", 1), (3, None, None, None, None), (4, "http://d/\r\nX: y", "", "p", 1),
        (5, "http://e/", "é\r\n\r\nWARC/1.1\r\n" + "z" * 300000, "p", 1), (6, "http://f/", "<p>y</p>", "p", 1), (7, "http://g/", "<p>x</p>", "p", 1),
    ]
    return spark.createDataFrame(rows, PAGES)


def test_round_trip(spark):
    rows = {r.page_id: r for r in warc.round_trip(pages(spark)).collect()}
    assert len(rows) == 7
    assert {k: (r.record_type, r.refers_to, r.payload_bytes) for k, r in rows.items()} == {
        1: ("revisit", 7, 8), 2: ("revisit", 7, 8), 3: ("revisit", 4, 0), 4: ("response", None, 0), 5: ("response", None, 300016), 6: ("response", None, 8), 7: ("response", None, 8),
    }
    assert rows[1].payload_digest == warc.sha1_base32(b"<p>x</p>") and all(r.digest_ok for r in rows.values() if r.record_type == "response")


def test_least_bytes(spark):
    kinds = {r.page_id: r.record_type for r in warc.round_trip(pages(spark), least_bytes=5).collect()}
    assert kinds[3] == kinds[4] == "response" and kinds[1] == "revisit"


def test_empty_and_repeated(spark):
    assert warc.round_trip(spark.createDataFrame([], PAGES)).collect() == []
    twice = spark.createDataFrame([(1, "u", "h", "", 0), (1, "u", "h", "", 0), (None, "u", "h", "", 0)], PAGES)
    assert sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in warc.round_trip(twice).collect()) == [("1", "response", "None")] * 2 + [("None", "revisit", "1")]


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    path = f"file:{tmp_path_factory.mktemp('warc')}/a"
    warc.archive_pages(pages(spark), path)
    return path


def test_filters_are_pushed(spark, archive):
    read = warc.read_records(spark, archive).where((F.col("record_type") == "revisit") & F.col("target_uri").startswith("http://"))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert read.count() == 2 and "Filter (" not in plan
    assert warc.read_records(spark, archive).where("http_length > 100").count() == 1
    assert warc.read_records(spark, archive).where("refers_to is not null and record_id in ('<urn:page:1>', '<urn:page:9>')").count() == 1
    assert warc.read_records(spark, archive).where("target_uri = 'http://d/%0D%0AX: y'").count() == 1


def test_unwanted_payloads_are_not_inflated():
    """With a length field, only a member's first bytes are inflated before the next one is reached."""
    big = os.urandom(1 << 20)
    data = warc.member(warc.record({"record_type": "response", "record_id": "<a>", "payload": big}), 6) + warc.member(warc.record({"record_type": "response", "record_id": "<b>", "payload": b"x"}), 6)
    first = warc.Member(io.BufferedReader(io.BytesIO(data)), 0)
    first.head()
    second = first.end()
    assert len(first.data) <= warc.Member.HEAD and data[second : second + 2] == b"\x1f\x8b"


@pytest.mark.parametrize("name", ["x.warc", "x.warc.gz"])
def test_foreign_files(spark, tmp_path, name):
    """Plain files and gzip members without lengths."""
    records = [warc.record({"record_type": "response", "record_id": f"<{i}>", "payload_digest": "sha1:" + warc.sha1_base32(b"p" * i), "payload": b"p" * i}) for i in (0, 5, 70000)]
    (tmp_path / name).write_bytes(b"".join(records) if name.endswith("warc") else b"".join(gzip.compress(r) for r in records))
    rows = warc.read_records(spark, str(tmp_path)).collect()
    assert sorted((r.record_id, len(r.payload), r.digest_ok) for r in rows) == [("<0>", 0, True), ("<5>", 5, True), ("<70000>", 70000, True)]
    assert warc.read_records(spark, str(tmp_path), "record_id string").count() == 3


def test_stores_of_spark_are_known():
    assert warc.store_uri("s3a://bucket/x") == "s3://bucket/x" and warc.store_uri("/tmp/x") == "/tmp/x" and warc.store_uri("file:/tmp/x") == "file:/tmp/x"
    assert warc.store_uri("wasbs://c@a.blob.core.windows.net/x").startswith("abfss://")
    assert warc.filesystem("file:///tmp/x")[1] == "/tmp/x"
    fs, path = warc.filesystem("s3a://bucket/x?region=us-east-1")
    assert fs.type_name == "s3" and path == "bucket/x"


def test_files_of_unfinished_jobs_are_not_read(spark, tmp_path):
    path = str(tmp_path / "a")
    warc.archive_pages(pages(spark), path)
    writer = warc.WarcWriter({"path": path}, False)
    batch = pa.RecordBatch.from_pylist([{"record_type": "response", "record_id": "<urn:page:99>", "payload": b"x"}])
    failed = writer.write(iter([batch]))
    assert warc.read_records(spark, path, "record_id string").count() == 7
    writer.commit([failed, None])
    assert warc.read_records(spark, path, "record_id string").count() == 8
    other = writer.write(iter([batch]))
    writer.abort([other])
    assert len(list((tmp_path / "a").glob("part-*"))) == len({f for f in os.listdir(path) if f.startswith("part-")}) and warc.read_records(spark, path, "record_id string").count() == 8
    warc.page_records(pages(spark).limit(2)).write.format("warc").mode("overwrite").save(path)
    assert warc.read_records(spark, path, "record_id string").count() == 2


def test_a_very_long_payload(spark, tmp_path):
    rows = spark.createDataFrame([(1, "u", "x" * 20_000_000, "", 0), (2, "u", "x" * 20_000_000, "", 0)], PAGES)
    assert sorted((r.page_id, r.payload_bytes, r.record_type) for r in warc.round_trip(rows).collect()) == [(1, 20_000_000, "revisit"), (2, 20_000_000, "response")]
