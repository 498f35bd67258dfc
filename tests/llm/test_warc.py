import base64
import gzip
import hashlib
import io
import time

import numpy as np

from millrace.llm import warc as W
from millrace.llm.common import shared_dir

SCHEMA = "page_id long, url string, html string"
PAGES = [(1, "http://a", "x"), (2, "http://b", "x"), (3, None, None), (4, "u\r\nX: y", ""), (5, "http://é", "née " * 40_000), (6, "http://c", "x"), (None, "http://n", "x"), (7, "h", "\r\n\r\nWARC/1.1\r\n"), (6, "http://c", "x"), (None, "m", "alone")]


def test_round_trip(spark):
    folder = shared_dir(spark, "warc-test")
    W.archive(spark.createDataFrame(PAGES, SCHEMA).withColumn("sha", W.F.lit("clash")), folder)
    out = W.read_back(spark, folder).collect()
    assert len(out) == len(PAGES)
    by = {r["page_id"]: r for r in out if r["page_id"] is not None}
    for page_id, _, html in PAGES:
        if page_id is None:
            continue
        data, r = (html or "").encode(), by[page_id]
        assert r["payload_bytes"] == len(data) and r["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
    assert [(by[i]["record_type"], by[i]["refers_to"]) for i in (1, 2, 6, 3, 4)] == [("revisit", 6), ("revisit", 6), ("response", None), ("revisit", 4), ("response", None)]
    assert sorted(r["record_type"] for r in out if r["page_id"] is None) == ["response", "revisit"]


def test_predicates_are_pushed(spark):
    folder = shared_dir(spark, "warc-push")
    W.archive(spark.createDataFrame(PAGES, SCHEMA), folder)
    scan = spark.read.format("warc").load(folder)
    assert scan.where("record_type = 'revisit' AND page_id IN (1, 3)").count() == 2
    assert scan.where("target_uri LIKE 'http://%' AND page_id > 4").count() == 3
    reader = W.WarcReader(scan.schema, folder, False)
    left = list(reader.pushFilters([W.EqualTo(("record_type",), "response"), W.EqualTo(("payload_bytes",), 1)]))
    assert len(left) == 1 and reader.tests == [("record_type", "EqualTo", "response")]


def test_foreign_archives_without_manifest(spark, tmp_path):
    plain = b"".join(W.record("response", i, f"http://x/{i}", b"p" * i) for i in range(5))
    (tmp_path / "a.warc").write_bytes(plain)
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(W.record("response", 10 + i, None, b"q" * i)) for i in range(5)))
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(b"".join(W.record("response", 20 + i, None, b"r" * i) for i in range(5))))
    W.register(spark)
    scan = spark.read.format("warc")
    got = scan.schema("page_id long, payload_bytes long").load(f"file://{tmp_path}").collect()
    assert sorted((r["page_id"], r["payload_bytes"]) for r in got) == [(a + i, i) for a in (0, 10, 20) for i in range(5)]
    assert scan.schema("page_id long").load(f"file://{tmp_path}").where("page_id >= 12").count() == 8


def test_empty(spark):
    folder = shared_dir(spark, "warc-none")
    W.archive(spark.createDataFrame([], SCHEMA), folder)
    assert W.read_back(spark, folder).count() == 0


def test_append_keeps_and_overwrite_clears(spark):
    folder = shared_dir(spark, "warc-append")
    W.archive(spark.createDataFrame([(1, "u", "one")], SCHEMA), folder)
    W.archive(spark.createDataFrame([(2, "u", "two")], SCHEMA), folder)
    assert sorted(r["page_id"] for r in W.read_back(spark, folder).collect()) == [1, 2]
    rows = spark.createDataFrame([(3, "u", "three", "response", None)], "page_id long, url string, html string, record_type string, refers_to long")
    rows.write.format("warc").mode("overwrite").save(folder)
    assert [r["page_id"] for r in W.read_back(spark, folder).collect()] == [3]


def every(data, payload=True, **more):
    return list(W.records(io.BytesIO(data), 0, len(data), lambda row: True, payload, **more))


def test_long_payloads_take_linear_time():
    for pack in (W.member, gzip.compress, lambda x: x):
        body = b"<p>" * 10_000_000
        began = time.perf_counter()
        rows = every(pack(W.record("response", 1, "u", body)) + pack(W.record("response", 2, "u", b"z")))
        assert [r["payload_bytes"] for r in rows] == [len(body), 1]
        assert time.perf_counter() - began < 10
        assert [r["header_length"] for r in every(pack(W.record("response", 1, "u", body)), payload=False)] == [len(body)]


def test_malformed_records_and_broken_members():
    good = [W.record("response", i, None, b"x" * i) for i in range(1, 4)]
    bad = good[0].replace(b"\r\nContent-Length: ", b"\r\nContent-Length: x", 1)
    for pack in (W.member, gzip.compress, lambda x: x):
        rows = every(b"".join(map(pack, [good[1], bad, good[2]])))
        assert [r["page_id"] for r in rows if r["content_length"] is not None] == [2, 3]
        assert [r["content_length"] for r in rows if r["page_id"] == 1] == [None]
    broken = bytearray(gzip.compress(good[0]))
    broken[20:30] = b"\xff" * 10
    rows = every(gzip.compress(good[1]) + bytes(broken) + gzip.compress(good[2]))
    assert [r["page_id"] for r in rows if r.get("payload_bytes")][-1] == 3
    assert every(gzip.compress(good[1])[:60])[:0] == []  # a cut file does not fail


def test_members_of_others_are_split(spark, tmp_path):
    rng = np.random.default_rng(3)
    data = b"".join(gzip.compress(W.record("response", i, None, rng.bytes(int(rng.integers(1, 3000))))) for i in range(200))
    for step in (700, 5000):
        got = [r["page_id"] for at in range(0, len(data), step) for r in W.records(io.BytesIO(data), at, min(len(data), at + step), lambda row: True, False, True)]
        assert got == list(range(200))
    (tmp_path / "d.warc.gz").write_bytes(data)
    W.register(spark)
    assert spark.read.format("warc").option("splitMembers", "true").load(f"file://{tmp_path}").count() == 200
