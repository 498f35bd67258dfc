"""Queries against their SQL on rows that the tables don't hold, and steps that must not grow faster than their input."""

import time

import duckdb
import numpy as np
from pyspark.sql import functions as F

from millrace.functions import vectors as V
from millrace.operators import joining, text
from millrace.plans import registry

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


def against_sql(spark, folder, name, **tables):
    """Rows of a query and of its SQL over (rows, schema) of each table."""
    con = duckdb.connect()
    for table, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    got = QUERIES[name](spark, str(folder))
    want = con.execute(ORACLES[name])
    assert sorted(got.columns) == sorted(c[0] for c in want.description)
    rows = got.select(*[c[0] for c in want.description]).collect()
    return sorted(map(str, map(tuple, rows))), sorted(map(str, want.fetchall()))


BLANK = (
    [(1, None), (2, ""), (3, " "), (4, "a "), (5, "a\n"), (6, None), (7, "é 漢 😀 ")]
    + [(10 + n, "w " * n) for n in (49, 50, 51, 99, 100, 101, 180, 199, 200, 201, 400)]
    + [(500 + n, "w " * n + "x") for n in (49, 50, 99, 100, 199, 200, 260)],
    "doc_id long, text string",
)


def test_word_chunks_of_empty_and_null_texts(spark, tmp_path):
    got, want = against_sql(spark, tmp_path, "split_by_words", documents=BLANK)
    assert got == want and "(1, 0, None)" in got


def test_word_blocks_of_empty_and_null_texts(spark, tmp_path):
    got, want = against_sql(spark, tmp_path, "hierarchical_split", documents=BLANK)
    assert got == want and "(1, 2, 0, 0)" in got


def test_merged_blocks_of_empty_null_and_repeated_texts(spark, tmp_path):
    rows, schema = BLANK
    documents = rows + [(7, "one"), (8, "w " * 120), (8, "w " * 120), (9, "w " * 60), (9, "w " * 330), (None, "w"), (-2, None)]
    got, want = against_sql(spark, tmp_path, "auto_merging", documents=(documents, schema))
    assert got == want and "(1, 1, 0)" in got


def test_crowded_cells_of_a_range_join_are_dealt_to_tasks(spark):
    points = spark.range(3000).select(F.col("id").alias("p"), (F.col("id") % 7).cast("double").alias("x")).union(spark.createDataFrame([(None, 2.0), (-1, None)], "p long, x double"))
    ranges = spark.range(400).select(F.col("id").alias("s"), (F.col("id") % 5).cast("double").alias("low"), (F.col("id") % 5 + 2).cast("double").alias("high"))
    out = joining.range_join(points, ranges, "x", "low", "high", 50.0, block=100)
    want = points.crossJoin(ranges).where("x >= low AND x < high")
    assert out.columns == want.columns and sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
    ids = spark.range(4500)
    a, b = ids.select("id", (F.col("id") % 3 + 0.5).alias("x")), ids.select(F.col("id").alias("s"), (F.col("id") % 2).cast("double").alias("low"), F.lit(9.0).alias("high"))
    tasks = joining.range_join(a, b, "x", "low", "high", 50.0).groupBy(F.spark_partition_id()).count().collect()
    tasks = [r["count"] for r in tasks]
    assert sum(tasks) == a.crossJoin(b).where("x >= low AND x < high").count() and max(tasks) < 0.8 * sum(tasks)


SUPPLIERS = "s_suppkey long, s_nationkey int, s_acctbal double"


def test_communities_of_a_crowded_nation_make_no_pairs(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, int(i % 3), float(np.round(rng.normal(0, 6000), 2))) for i in range(300)] + [(300 + i, 4, 3000.0 * (i // 3)) for i in range(30)]
    rows += [(400, 5, 1e6), (401, None, 1.0), (402, None, 1.0), (403, 1, None), (404, 6, 0.1), (405, 6, 3000.1), (406, 7, 0.3), (407, 7, 3000.3), (408, 7, 3000.3000000000006), (None, 1, 5.0), (409, 8, 1.0), (409, 8, 1.0)]
    got, want = against_sql(spark, tmp_path, "communities", supplier=(rows, SUPPLIERS))
    assert got == want
    plan = QUERIES["communities"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    got, want = against_sql(spark, tmp_path, "communities", supplier=(rows + [(5, 0, 100.0), (5, 2, -7000.0)], SUPPLIERS))
    assert got == want  # a key with several rows


def test_vector_functions_do_not_fold_the_vector_for_every_element(spark):
    x = np.random.default_rng(2).normal(size=3000)
    rows = spark.createDataFrame([(x.tolist(),), ([],), (None,), ([1.0, None],), ([0.0, 0.0],)], "x array<double>").coalesce(1)
    began = time.time()
    got = rows.select(V.softmax(F.col("x")), V.l2_normalize(F.col("x")), V.layer_norm(F.col("x")), V.keep_largest(F.col("x"), 2)).collect()
    assert time.time() - began < 60  # a fold of folds took the cube of the length
    e = np.exp(x - x.max())
    for found, want in zip(got[0], (e / e.sum(), x / np.linalg.norm(x), (x - x.mean()) / np.sqrt(x.var() + 1e-8), np.where(np.abs(x) >= np.sort(np.abs(x))[-2], x, 0)), strict=True):
        assert np.allclose(found, want, atol=1e-12)
    assert list(got[2]) == [None] * 4 and [list(c) for c in got[4]] == [[0.5, 0.5], [0.0, 0.0], [0.0, 0.0], [0.0, 0.0]]
    assert list(got[1])[:3] == [[], [], []]


def test_recursive_chunks_of_a_long_text_take_time_by_its_length(spark):
    body = "one two\n" * 60_000
    texts = [None, "", " ", "x" * 11, "a" * 9 + "\n\n" + "b", "ab cd ef gh ij kl", "\n\n" * 9, "é漢😀 " * 5, "a" * 25 + " b", body]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string").coalesce(1)
    began = time.time()
    got = [r["c"] for r in rows.select("i", text.recursive_chunks(F.col("x"), 10).alias("c")).orderBy("i").collect()]
    assert time.time() - began < 60  # a list copied for every piece took the square of the length
    assert got[:3] == [None, [], [" "]] and got[3] == ["x" * 10, "x"] and got[4] == ["a" * 9 + "\n", "\n", "b"]
    assert got[5] == ["ab cd ef ", "gh ij kl"] and got[6] == ["\n" * 10, "\n" * 8] and got[7] == ["é漢😀 é漢😀 "] * 2 + ["é漢😀 "] and got[8] == ["a" * 10, "a" * 10, "a" * 5 + " ", "b"]
    assert got[9] == ["one two\n"] * 60_000


def test_bm25_shuffles_no_counts_of_terms(spark, tmp_path):
    words = "alpha beta gamma delta Epsilon zeta eta theta".split()
    rng = np.random.default_rng(4)
    rows = [(i, ", ".join(rng.choice(words, rng.integers(1, 30)))) for i in range(-20, 200)] + [(300, None), (301, ""), (302, "none of them"), (303, "eta\n" * 500)]
    asked = [(1, "alpha zeta"), (2, "Theta theta THETA eta"), (3, "unknown"), (4, ""), (5, None), (6, "beta"), (6, "beta gamma")], "item_id long, text string"
    schema = "doc_id long, text string"
    got, want = against_sql(spark, tmp_path, "bm25_top_k", documents=(rows, schema), benchmark=asked)
    assert got == want and len(got) == 15
    plan = QUERIES["bm25_top_k"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(term" not in plan
    got, want = against_sql(spark, tmp_path, "bm25_top_k", documents=(rows + [(None, "alpha eta"), (7, rows[27][1])], schema), benchmark=asked)
    assert got == want  # a null key and a key with two documents
