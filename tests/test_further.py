"""Operators whose queries SQL can't say, and cases that the tables don't hold."""

from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import filters, metrics, ranking, text
from millrace.plans import further, registry
from millrace.sources import arrow_files, scratch, store
from millrace.streaming import events as E

SF = "/root/testdata/sf0.001"


def test_a_query_without_results_counts_as_zero(spark):
    run = spark.createDataFrame([(1, "a", 0), (1, "b", 1)], "qid long, doc_id string, rank int")
    truth = spark.createDataFrame([(1, "b"), (2, "c"), (2, "d")], "qid long, doc_id string")
    out = {r["qid"]: r for r in metrics.by_query(metrics.ranked_hits(run, truth)).collect()}
    assert out[1]["mrr"] == 0.5
    assert [out[2][c] for c in ("mrr", "map", "recall_single", "recall_multi", "ndcg", "precision")] == [0.0] * 6
    assert {r["qid"] for r in metrics.by_query(metrics.ranked_hits(run, truth), k=1).collect()} == {1, 2}


def test_a_late_older_row_does_not_replace_a_newer_one(spark, tmp_path):
    source, sink = tmp_path / "in", f"{tmp_path}/out"
    for n, rows in enumerate([[(1, 10, "new"), (2, 5, "x")], [(1, 3, "late"), (2, 6, "y"), (3, 1, "z")]]):
        spark.createDataFrame(rows, "k long, t long, v string").coalesce(1).write.parquet(f"{source}/{n}")
    stream = spark.readStream.schema("k long, t long, v string").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(str(source))
    E.upsert_batches(stream, sink, "k", "t").awaitTermination()
    last = sorted(p.name for p in (tmp_path / "out").iterdir() if p.name.startswith("v"))[-1]
    assert {r["k"]: r["v"] for r in spark.read.parquet(f"{sink}/{last}").collect()} == {1: "new", 2: "y", 3: "z"}


def test_upsert_keeps_the_greatest_of_repeated_keys(spark):
    old = spark.createDataFrame([(1, "a"), (None, "n")], "k long, v string")
    new = spark.createDataFrame([(1, "b"), (1, "c"), (2, "d"), (None, "m")], "k long, v string")
    key = lambda df: sorted((r["k"] or 0, r["v"]) for r in df.collect())
    assert key(store.upsert(old, new, "k", "overwrite")) == [(0, "m"), (1, "c"), (2, "d")]
    assert key(store.upsert(old, new, "k", "skip")) == [(0, "n"), (1, "a"), (2, "d")]


def test_moments_with_and_without_zone(spark):
    rows = spark.createDataFrame([(i, datetime(2024, 1, 1, i)) for i in range(6)], "i int, t timestamp_ntz")
    kept = lambda value, operator=">=": [r["i"] for r in rows.where(filters.compile_filter({"field": "t", "operator": operator, "value": value})).orderBy("i").collect()]
    assert kept("2024-01-01T03:00:00") == [3, 4, 5]
    assert kept("2024-01-01T03:00:00+02:00") == [1, 2, 3, 4, 5]
    assert kept(datetime(2024, 1, 1, 6, tzinfo=timezone(timedelta(hours=2)))) == [4, 5]
    assert kept(datetime(2024, 1, 1, 2), "<") == [0, 1]


def test_arrow_layouts_append_overwrite_and_project(spark):
    arrow_files.register(spark)
    rows = spark.createDataFrame([(1, "a", [1.0, None]), (2, None, None)], "i long, s string, v array<double>")
    path = scratch.folder(spark, "arrow-test")
    for layout in ("file", "stream"):
        rows.write.format("arrow_ipc").option("layout", layout).mode("append").save(path)
    back = spark.read.format("arrow_ipc").schema(rows.schema).load(path)
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.union(rows).collect()))
    rows.limit(1).write.format("arrow_ipc").mode("overwrite").save(path)
    assert [tuple(r) for r in spark.read.format("arrow_ipc").schema("s string").load(path).collect()] == [("a",)]


def test_diverse_order_against_plain_loops(spark):
    rng = np.random.default_rng(1)
    rows = [(q, i, float(rng.random()), rng.normal(size=6).tolist()) for q in range(3) for i in range(7)]
    out = ranking.diverse_order(spark.createDataFrame(rows, "q long, i long, s double, v array<double>"), "q", "i", "s", "v").collect()
    for q in range(3):
        items = {i: (s, np.array(v) / np.linalg.norm(v)) for qq, i, s, v in rows if qq == q}
        chosen = [max(items, key=lambda i: items[i][0])]
        while len(chosen) < len(items):
            chosen.append(min((i for i in items if i not in chosen), key=lambda i: np.mean([items[i][1] @ items[c][1] for c in chosen])))
        assert [r["i"] for r in sorted((r for r in out if r["q"] == q), key=lambda r: r["position"])] == chosen
    got = registry.queries()["diversity_ranker"](spark, SF).collect()
    assert {r["position"] for r in got} == set(range(1, 9))


def test_content_chunks_cover_the_text_and_meet_again(spark):
    gear = np.random.default_rng(64).integers(0, 2**64, 256, dtype=np.uint64)
    body = " ".join(f"word{n}" for n in np.random.default_rng(6).integers(0, 10**6, 5000))
    a, b, empty = further._cut([body, "some text put in front " + body, None], 512, gear)
    for chunks, whole in ((a, body), (b, "some text put in front " + body)):
        assert b"".join(x for _, _, x in chunks) == whole.encode()
        assert all(64 <= n <= 1024 for _, n, _ in chunks[:-1])
    assert len({x for _, _, x in a} & {x for _, _, x in b}) > 0.8 * len(a) and empty == []
    h, mask = 0, (512 - 1) << (64 - 512 .bit_length() + 1)
    for i, c in enumerate(body.encode()):  # the same boundaries byte by byte
        h = (h << 1) + int(gear[c]) & (2**64 - 1)
        if i + 1 >= 64 and h & mask == 0:
            assert a[0][1] == i + 1
            break
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    total = registry.queries()["content_chunks"](spark, SF).groupBy("doc_id").agg(F.sum("length").alias("n"))
    assert total.join(docs, "doc_id").where("n <> octet_length(text)").count() == 0


def test_recursive_chunks_fit_and_rejoin(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    out = registry.queries()["recursive_split"](spark, SF).collect()
    assert all(0 < r["n"] <= 500 for r in out)
    sums = {}
    for r in out:
        sums[r["doc_id"]] = sums.get(r["doc_id"], 0) + r["n"]
    assert sums == {r["doc_id"]: len(r["text"]) for r in docs if r["text"]}


def test_schema_rules(spark):
    schema = {"required": ["a"], "properties": {"a": {"type": "integer", "minimum": 1}, "b": {"type": "string", "enum": ["x", "y"]}}, "additionalProperties": False}
    cases = {'{"a": 1}': True, '{"a": 0}': False, '{"a": "1"}': False, '{"a": 2, "b": "x"}': True, '{"a": 2, "b": "z"}': False, '{"a": 2, "c": 1}': False, "[1]": False, "not json": False, '{"b": "x"}': False}
    rows = spark.createDataFrame(list(cases.items()), "j string, want boolean").withColumn("got", text.matches_schema(F.col("j"), schema)).collect()
    assert all(r["got"] == r["want"] for r in rows), [tuple(r) for r in rows if r["got"] != r["want"]]


@pytest.mark.parametrize("similarity", ["cosine", "dot", "euclidean", "manhattan"])
def test_top_k_in_blocks_against_plain_loops(spark, similarity):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(90, 5))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(200, None), (201, [1.0, None, 1.0, 1.0, 1.0]), (202, [1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ranking.vector_top_k(vectors, vectors.where("vec_id < 20"), 4, similarity, block=16, share=6).collect()
    score = {"cosine": lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b), "dot": lambda a, b: a @ b, "euclidean": lambda a, b: -np.linalg.norm(a - b), "manhattan": lambda a, b: -np.abs(a - b).sum()}[similarity]
    for q in range(20):
        want = sorted(((-score(x[q], x[i]), i) for i in range(90) if i != q))[:4]
        assert [r["vec_id"] for r in sorted((r for r in got if r["qid"] == q), key=lambda r: r["rank"])] == [i for _, i in want]
