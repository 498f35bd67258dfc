import random
from collections import Counter, defaultdict

import pytest

from millrace.llm import near_duplicates as N


def brute(rows):
    sets = {}
    for i, (doc_id, text) in enumerate(rows):
        w = (text or "").lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w and doc_id is not None else set()
    root, degree = {i: i for i in sets}, Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
                degree[a] += 1
                degree[b] += 1
                x, y = sorted((find(a), find(b)), key=lambda i: rows[i][0])
                root[y] = x
    least = defaultdict(list)
    for i in sets:
        least[find(i)].append(rows[i][0])
    return sorted(((rows[i][0], degree[i], min((x for x in least[find(i)] if x is not None), default=None)) for i in sets), key=str)


def sample():
    rng, rows = random.Random(5), []
    for g in range(12):
        words = [rng.choice("abcdefghij") + str(rng.randrange(300)) for _ in range(rng.choice((20, 80, 300)))]
        for _ in range(rng.choice((1, 2, 6, 14))):
            copy = list(words)
            for _ in range(rng.choice((0, 0, 1, 1, 2, 4))):
                copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
            rows.append((len(rows) + 1000 * g, " ".join(copy)))
    return rows


def test_links_equal_brute_force_with_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 5)  # several blocks a node
    rows = sample() + [(7, None), (8, ""), (9, "one two"), (10, "One two"), (11, "one three"), (None, "one two"), (9, "one two")]
    out = N.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r["doc_id"], r["n_links"], r["component_id"]) for r in out), key=str) == brute(rows)


def test_one_of_each_group_stays(spark, odd_docs, no_docs):
    kept = N.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, (1, 2, 3, 4, 5, None, 6, 8)))
    assert N.link(no_docs).count() == 0 and N.keep_one(no_docs).count() == 0


def test_a_hot_group_leaves_no_borderline_pair_out(spark):
    rows = []
    for g in range(400):
        words = [f"g{g}w{k}" for k in range(104)]
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(words[:93] + [f"g{g}x{k}" for k in range(11)]))]
    hot = [f"h{k}" for k in range(300)]
    rows += [(10_000 + i, " ".join([*hot, f"last{i}"])) for i in range(200)]
    out = {r["doc_id"]: (r["n_links"], r["component_id"]) for r in N.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {i: (1, i - i % 2) if i < 10_000 else (199, 10_000) for i, _ in rows}


def test_rows_of_one_id_are_judged_by_their_texts(spark):
    text, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    rows = [(3, text, "a"), (5, text, "b"), (5, other, "c"), (7, other + " more", "z"), (7, other + " more", "y"), (8, "alone here", "q"), (8, "alone here", "p"), (9, text, "r"), (None, other, "n"), (None, other, "n")]
    kept = N.keep_one(spark.createDataFrame(rows, "doc_id long, text string, cls string")).collect()
    assert sorted(((r["doc_id"] or 0, r["text"], r["cls"]) for r in kept)) == sorted([(3, text, "a"), (5, other, "c"), (8, "alone here", "p"), (0, other, "n"), (0, other, "n")])


def test_depths_meet_the_target_or_are_refused():
    for threshold in (0.95, 0.8, 0.5, 0.3):
        assert 1 - (1 - threshold ** N.depths(threshold)[-1]) ** N.TREES >= N.TARGET
    with pytest.raises(ValueError):
        N.depths(0.1)


def test_audit_measures_recall(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = N.link(docs).cache()
    assert N.audit(docs, found, every=1) == 1.0
    assert N.audit(docs, found.withColumn("n_links", N.F.lit(0)), every=1) == 0.0
    assert N.audit(docs.where("doc_id < 0"), found) is None
