import math
import tracemalloc

import numpy as np
import xxhash
from pyspark.sql import functions as F

from millrace.llm import quality
from millrace.llm.common import mix


def test_held_out_accuracy(spark, sf):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score(docs.select("doc_id", "text"), labels).join(labels, "doc_id").where("crc32(cast(doc_id as string)) % 3 = 1").toPandas()
    assert ((scored["quality_score"] >= 0.5).astype(int) == scored["quality"]).mean() > 0.95
    assert scored["quality_score"].between(0, 1).all()


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (5, None, None), (None, 1, 1), (3, 0, 0)], "doc_id long, quality int, toxic int")
    out = quality.score(odd_docs, labels).collect()
    assert len(out) == odd_docs.count() and all(0 <= r["quality_score"] <= 1 for r in out)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["quality_score"] for r in quality.score(odd_docs, none).collect()} == {0.5}
    assert quality.score(no_docs, none).count() == 0
    assert quality.keep(odd_docs, none).columns == odd_docs.columns


def test_scores_ignore_ids_and_labels(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judge = quality.scorer(docs.select("doc_id", "text"), labels)
    a = docs.select("doc_id", judge("text").alias("s")).toPandas().set_index("doc_id")["s"]
    b = docs.select((F.col("doc_id") + 7).alias("doc_id"), judge("text").alias("s")).toPandas().set_index("doc_id")["s"]
    assert np.allclose(a.sort_index().to_numpy(), b.sort_index().to_numpy())


def test_calibration_softens_an_overconfident_network():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = (rng.random(400) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    net = quality.Network(3)
    net.fit(x[:200], y[:200])
    net.w[2] = net.w[2] * 6
    net.calibrate(x[200:], y[200:])
    assert net.temperature > 1


ROWS = 2 * quality.BLOCK  # few rows, so that words share some


def own(name):
    h, out = xxhash.xxh64_intdigest(name, 5), np.zeros(quality.DIM)
    for k in range(quality.NONZERO):
        m = int(mix(np.array([(h + (k + 1) * 0x9E3779B97F4A7C15) % 2**64], np.uint64))[0])
        out[m % quality.DIM] += 1 if m >> 63 else -1
    return out


def row(word):
    return xxhash.xxh64_intdigest(word.encode(), 3) % ROWS


def plain_contexts(texts):
    """Random indexing word by word."""
    near, seen = np.zeros((ROWS, quality.DIM)), np.zeros(ROWS)
    for t in texts:
        words = (t or "").split()
        for i, w in enumerate(words):
            for j in range(max(0, i - quality.WINDOW), min(len(words), i + quality.WINDOW + 1)):
                if j != i:
                    near[row(w)] += own(f"row {row(words[j])}")
                    seen[row(w)] += 1
    return near, seen


TEXTS = ["The cat sat on the mat. The cat\nsat", "a 12 dogs, 12 dogs barked!", "", None, "cat cat cat cat", "x" * 60 + " y", "alone", " ".join(f"w{i % 700}" for i in range(3000))]


def test_contexts_over_all_documents_against_plain_code(spark):
    want = plain_contexts(TEXTS + TEXTS[:2])
    for parts in (1, 5):
        docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS + TEXTS[:2])], "text_id long, text string").repartition(parts)
        near, seen = quality.contexts(docs, rows=ROWS)
        assert (near == want[0]).all() and (seen == want[1]).all()
    near, seen = quality.contexts(docs.where("text_id < 0"), rows=ROWS)
    assert not near.any() and not seen.any()


def test_sums_in_several_goes_equal_sums_at_once():
    base, rng = quality.row_vectors(quality.BLOCK), np.random.default_rng(3)
    texts = [rng.integers(0, quality.BLOCK, n).astype(np.int32) for n in (1, 5, 200_000, 3)]
    gap = np.full(quality.WINDOW, quality.BLOCK, np.int32)
    results = []
    for goes in ([texts], [texts[:2], texts[2:]]):
        near, seen = np.zeros((quality.BLOCK, quality.DIM), np.int64), np.zeros(quality.BLOCK, np.int64)
        for go in goes:
            quality.add_contexts(near, seen, base, np.concatenate([x for t in go for x in (t, gap)]))
        results.append((near, seen))
    assert (results[0][0] == results[1][0]).all() and (results[0][1] == results[1][1]).all()
    assert results[0][1].sum() == sum(4 * len(t) - 6 for t in texts if len(t) > 2)


def test_pooling_against_plain_code():
    near, seen = plain_contexts(TEXTS)
    vectors = quality.vectors_of(near, seen)
    vector = lambda w: own(f"row {row(w)}") + near[row(w)] / max(seen[row(w)], 1) + own(quality.shape(w))
    text = "The cat sat sat\ndog The cat sat sat\nThe cat sat sat"
    words = text.split()
    for _ in range(2):
        got = quality.features(text, vectors)
        assert np.allclose(got[: quality.DIM], np.mean([vector(w) for w in words], 0), atol=1e-5)
        assert np.allclose(got[quality.DIM : 2 * quality.DIM], np.mean([vector(w) for w in set(words)], 0), atol=1e-5)
        assert np.allclose(got[2 * quality.DIM :], [np.log1p(13) / 8, 4 / 13, 4 / 13 * np.log1p(13) / 8, 3 / 13, 2 / 3, 0])
        vectors.most = 2  # remembered words give way between texts
        quality.features(TEXTS[-1], vectors)


def test_network_against_plain_loops():
    rng = np.random.default_rng(2)
    net = quality.Network(5)
    net.mean, net.scale, net.temperature = rng.normal(size=5), rng.uniform(0.5, 2, 5), 1.7
    x = rng.normal(size=5)
    a, b, c, d = net.w
    hidden = [math.tanh(sum((x[i] - net.mean[i]) / net.scale[i] * a[i, j] for i in range(5)) + b[j]) for j in range(quality.HIDDEN)]
    logit = sum(h * w for h, w in zip(hidden, c, strict=True)) + d[0]
    assert math.isclose(net(x[None, :])[0], 1 / (1 + math.exp(-logit / 1.7)), rel_tol=1e-9)


def test_the_fit_does_not_depend_on_the_plan(spark):
    rows = [(i % 40, f"word{i} text number {i % 7}") for i in range(400)] + [(None, "nobody")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, 0)], "doc_id long, quality int")
    samples = [quality.sample(spark.createDataFrame(rows[::k], "doc_id long, text string").repartition(n), labels) for k, n in ((1, 3), (-1, 7))]
    assert samples[0].equals(samples[1]) and samples[0]["doc_id"].is_unique


def test_the_stored_table_equals_that_of_the_sums(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "text_id long, text string").repartition(3)
    for some in (docs, docs.where("text = 'alone'"), docs.where("text = 'x' OR text_id = 0"), docs.where("text_id < 0")):  # all blocks, some and none
        got = quality.stored_vectors(some, rows=ROWS).vectors().table
        assert (got == quality.vectors_of(*quality.contexts(some, rows=ROWS)).table).all()


def test_the_driver_holds_neither_the_word_table_nor_the_fitting_texts(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet")
    quality.scorer(docs, labels)  # imports
    tracemalloc.start()
    try:
        judge = quality.scorer(docs, labels)
        assert tracemalloc.get_traced_memory()[1] < 4 * quality.ROWS * quality.DIM / 2  # half the table in floats
    finally:
        tracemalloc.stop()
    # the network is that of the texts and the table on the driver
    rows, vectors = quality.sample(docs, labels), quality.vectors_of(*quality.contexts(docs))
    net = quality.train(rows["text"].tolist(), rows["quality"].to_numpy(), vectors)
    got = docs.select("text", judge("text").alias("s")).toPandas()
    assert np.allclose(got["s"], [net(quality.features(t, vectors)[None, :].astype(float))[0] for t in got["text"]], atol=1e-6)


def test_remembered_words_hold_no_vectors():
    vectors, n = quality.vectors_of(np.zeros((ROWS, quality.DIM)), np.zeros(ROWS)), 50_000
    tracemalloc.start()
    try:
        for at in range(0, n, 1000):
            quality.features(" ".join(f"word{i}" for i in range(at, at + 1000)), vectors)
        assert len(vectors) == n and tracemalloc.get_traced_memory()[0] < n * 4 * quality.DIM  # less than the floats of a vector each
    finally:
        tracemalloc.stop()
