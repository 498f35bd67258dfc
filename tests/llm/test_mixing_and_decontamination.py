import re
from collections import Counter, defaultdict

import pytest

from millrace.llm import decontaminate as D
from millrace.llm import mixing as M


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """The excess reshared by weight until no source is above its bound."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, left, free = {}, share * sum(sizes.values()), list(order)
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        out |= {s: most * sizes[s] for s in over}
        left -= sum(most * sizes[s] for s in over)
        free = [s for s in free if s not in out]
    return out


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100, None: 10}, {}, {"a": 0}, {"a": 0, "b": 5}, {"é": 7, "z": 1000, "Z": 3, "": 50, None: 0}, {f"s{i}": i * i for i in range(40)}])
def test_targets_are_water_filled(spark, sizes):
    got = M.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    assert {r["source"]: pytest.approx(r["target"]) for r in got} == plain_targets(sizes)


def test_null_and_empty_sources_are_apart(spark):
    docs = spark.createDataFrame([(1, "a b c", None), (1, "a b c", ""), (2, None, "x"), (2, "", "x"), (None, "q", "x")], "doc_id long, text string, source string")
    plan = M.plan(docs).collect()
    assert len({r["mix_key"] for r in plan}) == 5
    assert sorted((r["doc_id"] or 0, r["size"], r["source_size"]) for r in plan) == [(0, 1, 1), (1, 3, 3), (1, 3, 3), (2, 0, 1), (2, 0, 1)]


def test_plan_of_odd_rows(spark, odd_docs, no_docs):
    plan = M.plan(odd_docs).collect()
    assert len(plan) == odd_docs.count()
    assert all(r["taken"] <= 2 * r["size"] and r["copies"] <= 2 for r in plan)
    again = M.plan(odd_docs.repartition(7)).collect()
    assert sorted(map(str, plan)) == sorted(map(str, again))
    assert M.plan(no_docs).count() == 0
    mixed = M.mix(odd_docs)
    assert mixed.columns == odd_docs.columns and mixed.count() == sum(r["copies"] for r in plan)


def test_sources_come_near_their_targets(spark, sf):
    rows = M.plan(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).toPandas()
    taken = rows.groupby(["target", "source_size"])["taken"].sum().reset_index()
    largest = rows["size"].max()
    assert ((taken["taken"] - taken["target"]).abs() <= 2 * largest).all()


def plain(docs, items, width=8):
    cut = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    wins = defaultdict(set)
    for item, text in items:
        w = cut((text or "").translate(low))
        for s in range(max(1, len(w) - width + 1)) if w else ():
            wins[tuple(w[s : s + width])].add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = cut((text or "").translate(low)), set(), set()
        for n in {len(x) for x in wins}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in wins:
                    hit |= set(range(s, s + n))
                    found |= wins[tuple(w[s : s + n])]
        out.append((doc_id, len(w), len(hit), len(found), len(found) >= 2))
    return sorted(out, key=str)


ITEMS = [(1, "the quick brown fox jumps over the lazy dog again"), (2, "the the the the the the the the the"), (3, "Short Item"), (4, None), (5, "  !! "), (6, "ÉTÉ x1 short item"), (3, "Short Item"), (7, "solo")]
DOCS = [
    (1, "well, THE quick-brown fox; jumps over the lazy dog again and again"), (2, "the " * 40), (3, None), (4, ""), (5, "short item short item solo"), (6, "ÉTÉ X1 short item"),
    (7, "été x1 short"), (8, "the quick brown fox jumps over a lazy dog"), (5, "short item short item solo"), (None, "solo"), (9, "a " * 20_000 + "the quick brown fox jumps over the lazy dog"),
]


def test_contamination_equals_brute_force(spark, no_docs):
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("row", D.F.lit(0)).withColumn("term", D.F.lit("x")), spark.createDataFrame(ITEMS, "item_id long, text string")
    out = D.contamination(docs, items).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in out), key=str) == plain(DOCS, ITEMS)
    assert D.contamination(no_docs, items).count() == 0
    assert {r["n_items"] for r in D.contamination(docs, items.limit(0)).collect()} == {0}
    left = D.clean(docs, items)
    assert left.columns == docs.columns
    assert Counter(str(r["doc_id"]) for r in left.collect()) == Counter(str(d) for d, _, _, n, _ in plain(DOCS, ITEMS) if not n)


def test_proximity_finds_a_passage_with_a_word_put_in(spark):
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    wins = D.windows(items)
    index = D.build_index(docs, wins.select("term").distinct(), 100)
    rows = {r["row"] for r in D.proximity(index, wins).collect()}
    found = {r["doc_id"] for r in index.where("pos = -1").collect() if r["row"] in rows}
    assert {1, 8, 9} <= found
    wide = "the quick small brown fox jumps over some lazy dog again"  # a word put in and one changed
    docs = spark.createDataFrame([(1, wide), (2, "nothing of it"), (3, DOCS[0][1])], "doc_id long, text string")
    near = {r["doc_id"]: (r["n_items"], r["n_near"]) for r in D.contamination(docs, items).collect()}
    assert near == {1: (0, 1), 2: (0, 0), 3: (1, 1)}


def test_an_index_of_all_tokens_gives_the_same_matches(spark):
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    wins = D.windows(items)
    some, all_ = D.build_index(docs, wins.select("term").distinct(), 100), D.build_index(docs)
    assert all_.count() > some.count()
    found = [sorted((r["start"], r["item_id"], r["size"]) for r in D.phrases(index, wins).collect()) for index in (some, all_)]
    assert found[0] == found[1] and found[0]
