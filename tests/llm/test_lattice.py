import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers

from millrace.llm import lattice as L

PATH = public_tokenizers.path("piece_bpe_32k.model")


def every(word, model):
    if not word:
        return [0.0]
    out = []
    for j in range(1, len(word) + 1):
        r = model.row.get(word[:j])
        if r is not None:
            s = model.scores[r]
        elif j == 1:
            s = sum(model.scores[model.bytes_at + b] for b in word[0].encode())
        else:
            continue
        out += [s + rest for rest in every(word[j:], model)]
    return out


def test_forward_sum_equals_all_segmentations():
    model = L.Lattice(*L.load_vocabulary(PATH), 0.0)
    words = ["▁the", "▁ciónas", "▁日本x", "▁", "▁antinhe"]
    for w in words:
        assert math.isclose(model.one(w), np.logaddexp.reduce(every(w, model)), rel_tol=1e-9)
    many = ["▁" + "abcdefgh"[i % 8] * 3 + "xyz"[i % 3] for i in range(60)]
    a, b = np.zeros(len(model.scores)), np.zeros(len(model.scores))
    weights = np.arange(1.0, 61)
    assert np.allclose(model.many(many, a, weights), [model.one(w, b, n) for w, n in zip(many, weights, strict=True)])
    assert np.allclose(a, b)
    assert model.one("▁" + "q" * 5000) < -1000


def test_base_scores_and_better_model(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {r["doc_id"]: re.findall(r"[^\x20\x09-\x0D]+", (r["text"] or "").translate(low)) for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    c, ends = Counter(), 0
    for i, w in tokens.items():
        if not held[i]:
            c.update(w)
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + 1
    out = L.score(docs, PATH).collect()
    assert len(out) == len(tokens)
    first = L.Lattice(*L.load_vocabulary(PATH), math.log(1e-3))
    better = 0
    for r in out:
        w = tokens[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(w) + 1, 1 + sum(c[x] > 0 for x in w), n, held[r["doc_id"]])
        assert math.isclose(r["base_score"], sum(math.log10((k + 0.5) / (n + 0.5 * (v + 1))) for k in [*(c[x] for x in w), ends]), rel_tol=1e-9)
        if r["held_out"]:
            better += r["score"] - (sum(first.many(["▁" + x for x in w])) + first.end) / math.log(10)
    assert better > 0  # re-estimation helps on texts it has not seen


def test_odd_rows(spark, odd_docs, no_docs):
    out = L.score(odd_docs, PATH).collect()
    assert len(out) == odd_docs.count() and all(math.isfinite(r["score"]) and r["score"] < 0 for r in out)
    assert sorted(r["n_tokens"] for r in out)[:3] == [1, 1, 1]
    assert L.score(no_docs, PATH).count() == 0
