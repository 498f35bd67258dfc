import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import quality
from millrace.llm.common import TO_LOWER


def test_stages_against_plain_functions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near duplicates", "decontamination", "mixing", "token files"]
    kept, tables = docs, []
    for _, stage in corpus_pipeline.STAGES:
        kept = corpus_pipeline.written(stage(spark, kept, sf), "test-stage")
        tables.append(kept)
    for table in tables[:-1]:
        assert table.columns == docs.columns
    ids = [sorted(r["doc_id"] for r in t.select("doc_id").collect()) for t in tables]
    assert set(ids[2]) <= set(ids[1]) <= set(ids[0]) and set(ids[3]) <= set(ids[2])
    assert len(set(ids[1])) == len(ids[1])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert len(set(good) & set(ids[0])) >= 0.97 * len(good)
    # the last stage by plain encoding of the mix
    tokenizer, start, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for doc_id, text in sorted((r["doc_id"], r["text"]) for r in tables[3].collect()):
        n = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((doc_id, start, len(n), zlib.crc32(np.array(n, "<u4").tobytes())))
        start += len(n)
    assert sorted(map(tuple, tables[4].collect())) == want


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0


def plain_near_duplicates(rows):
    """Ids that stay: the least of each group linked by a Jaccard similarity of word five-grams of 0.8."""
    sets = []
    for _, text in rows:
        w = (text or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)), key=lambda i: rows[i][0])
                root[y] = x
    return sorted(rows[i][0] for i in range(len(rows)) if root[i] == i)


def plain_clean(rows, items, width=8):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(TO_LOWER))
    wins = {tuple(w[i : i + width]) for w in map(cut, items) if w for i in range(max(1, len(w) - width + 1))}
    sizes = {len(x) for x in wins}
    return sorted(i for i, t in rows if not any(tuple(w[k : k + n]) in wins for w in [cut(t)] for n in sizes for k in range(len(w) - n + 1)))


def test_filtering_stages_against_plain_code(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    pairs = lambda t: sorted((r["doc_id"], r["text"]) for r in t.collect())
    ids = lambda t: sorted(r["doc_id"] for r in t.select("doc_id").collect())
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.sample(docs, labels)
    vectors = quality.vectors_of(*quality.contexts(docs))
    net = quality.train(rows["text"].tolist(), rows["quality"].to_numpy(), vectors)
    want = sorted(i for i, t in pairs(docs) if net(quality.features(t, vectors)[None, :].astype(float))[0] >= 0.5)
    assert ids(corpus_pipeline.quality_stage(spark, docs, sf)) == want
    assert ids(corpus_pipeline.near_duplicate_stage(spark, docs, sf)) == plain_near_duplicates(pairs(docs))
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert ids(corpus_pipeline.decontamination_stage(spark, docs, sf)) == plain_clean(pairs(docs), items)


def test_odd_rows_and_empty_tables(spark, sf, odd_docs, no_docs, tmp_path):
    for name, docs in (("odd", odd_docs), ("none", no_docs)):
        folder = f"{tmp_path}/{name}"
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, None), (2, "alpha")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        out = corpus_pipeline.run(spark, folder).collect()
        assert all(r["n_tokens"] >= 1 for r in out) and bool(out) == (name == "odd")
        assert sorted(r["start"] for r in out)[:1] == [0][: len(out)]
