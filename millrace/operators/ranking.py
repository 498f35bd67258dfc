"""Retrieval and ranking: BM25, vector top-k, fusion orders, sampling, diversity."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import vectors as V


def top_k(df: DataFrame, by: list[str], order: list, k: int, name: str = "rank") -> DataFrame:
    """First ``k`` rows of each group with their rank from 1; the rank filter is pushed into the window."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= k)


#: Terms of all queries that are sent to the tasks.
BM25_TERMS = 1_000_000


def bm25(docs: DataFrame, queries: DataFrame, k: int, key: str = "doc_id", text: str = "text", qid: str = "qid", query: str = "query", k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """(qid, key, score, rank): every task scores its documents by the terms of the queries and keeps the ``k`` best of each query.

    Where a key has several documents, keys or queries are null, keys aren't bigint or the queries hold over ``BM25_TERMS``
    terms in all, counts of a term in a document are shuffled instead.
    """
    split = lambda c: F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda t: t != "")
    rows = docs.select(key, split(F.col(text)).alias("_w"))
    terms = queries.select(qid, F.explode(F.array_distinct(split(F.col(query)))).alias("term"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("_w")).alias("mean"))
    plain = dict(docs.dtypes)[key] == "bigint" and queries.where(F.col(qid).isNull()).isEmpty() and terms.count() <= BM25_TERMS
    if plain and docs.groupBy(key).count().where((F.col("count") > 1) | F.col(key).isNull()).isEmpty():
        found = _bm25_by_task(docs.select(F.col(key).alias("key"), F.lower(text).alias("text")), terms.select(F.col(qid).alias("qid"), "term"), k, k1, b)
        scored = found.select(F.col("qid").alias(qid), F.col("key").alias(key), "score")
        return top_k(scored, [qid], [F.round("score", 9).desc(), key], k)
    tf = rows.select(key, F.size("_w").alias("len"), F.explode("_w").alias("term")).join(terms.select("term").distinct(), "term", "left_semi")
    tf = tf.groupBy("term", key).agg(F.count(F.lit(1)).alias("tf"), F.first("len").alias("len"))
    df_ = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weighed = tf.join(df_, "term").join(F.broadcast(size))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("len") / F.col("mean")))
    scored = terms.join(weighed.select("term", key, weight.alias("w")), "term").groupBy(qid, key).agg(F.sum("w").alias("score"))
    return top_k(scored, [qid], [F.round("score", 9).desc(), key], k)  # sums in another order must not decide ties


def _bm25_by_task(docs: DataFrame, terms: DataFrame, k: int, k1: float, b: float) -> DataFrame:
    """(qid, key, score) of the ``k`` best of each query and task; documents are (key, lower-case text), keys are unique."""
    spark, kinds = docs.sparkSession, dict(docs.dtypes) | dict(terms.dtypes)
    pairs = terms.toPandas()
    names, at = np.unique(pairs["term"].to_numpy(str), return_inverse=True)
    qids, of = np.unique(pairs["qid"].to_numpy(), return_inverse=True)
    # queries of each term, one after the other
    order = np.argsort(at, kind="stable")
    starts, asked = np.searchsorted(at[order], np.arange(len(names) + 1)), of[order]
    shared = spark.sparkContext.broadcast(({t: i for i, t in enumerate(names.tolist())}, qids, starts, asked))
    word = re.compile("[a-z0-9]+")

    def counts(batches):
        """Rows with each term, then rows and tokens of the task under the places -1 and -2."""
        vocabulary = shared.value[0]
        df, n, tokens = np.zeros(len(vocabulary), np.int64), 0, 0
        for batch in batches:
            for x in batch.column("text"):
                found = word.findall(x.as_py() or "")
                tokens += len(found)
                n += x.is_valid
                for t in vocabulary.keys() & set(found):
                    df[vocabulary[t]] += 1
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": np.concatenate([held, [-1, -2]]), "n": np.concatenate([df[held], [n, tokens]])})

    sums = {r["term"]: r["n"] for r in docs.select("text").mapInArrow(counts, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    rows, texts = docs.count(), sums.pop(-1, 0)
    mean = sums.pop(-2, 0) / texts if texts else 0.0
    df = np.array([sums.get(i, 0) for i in range(len(names))], np.float64)
    idf = spark.sparkContext.broadcast(np.log(1 + (rows - df + 0.5) / (df + 0.5)))

    def scores(batches):
        vocabulary, qids, starts, asked = shared.value
        width = max(1, len(qids))
        kept = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.float64))

        def merged(kept, q, key, score):
            q, key, score = (np.concatenate(x) for x in zip(kept, (q, key, score), strict=True))
            order = np.lexsort((key, -np.round(score, 9), q))
            q = q[order]
            best = order[np.arange(len(q)) - np.searchsorted(q, q) < k]
            return tuple(x[best] for x in (q[np.argsort(order)], key, score))

        for batch in batches:
            share = max(1, 2**21 // width)
            for first in range(0, batch.num_rows, share):
                part = batch.slice(first, share)
                sums = np.zeros((part.num_rows, width))
                for i, x in enumerate(part.column("text")):
                    found = word.findall(x.as_py() or "")
                    tf = Counter(filter(vocabulary.__contains__, found))
                    if not tf:
                        continue
                    t = np.fromiter((vocabulary[w] for w in tf), np.int64, len(tf))
                    f = np.fromiter(tf.values(), np.float64, len(tf))
                    weight = idf.value[t] * f * (k1 + 1) / (f + k1 * (1 - b + b * len(found) / mean))
                    lengths = starts[t + 1] - starts[t]
                    places = np.repeat(starts[t] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
                    sums[i] = np.bincount(asked[places], np.repeat(weight, lengths), width)
                keys = part.column("key").to_numpy(zero_copy_only=False)
                row, q = np.nonzero(sums)
                kept = merged(kept, q, keys[row], sums[row, q])
        yield pa.RecordBatch.from_pydict({"qid": qids[kept[0]], "key": kept[1], "score": kept[2]})

    return docs.mapInArrow(scores, f"qid {kinds['qid']}, key {kinds['key']}, score double")


def _scores(similarity: str, q: np.ndarray, x: np.ndarray) -> np.ndarray:
    if similarity == "cosine":
        n = np.sqrt((q * q).sum(1))[:, None] * np.sqrt((x * x).sum(1))[None, :]
        return np.divide(q @ x.T, n, out=np.full((len(q), len(x)), np.nan), where=n > 0)
    if similarity == "dot":
        return q @ x.T
    if similarity == "euclidean":
        return -np.sqrt(np.maximum(0, (q * q).sum(1)[:, None] + (x * x).sum(1)[None, :] - 2 * q @ x.T))
    return -np.stack([np.abs(x - row).sum(1) for row in q])


def vector_top_k(vectors: DataFrame, queries: DataFrame, k: int, similarity: str = "cosine", key: str = "vec_id", vector: str = "embedding", scale: bool = False, block: int = 4096, share: int = 512) -> DataFrame:
    """(qid, key, score, rank) of a stated query set against all vectors but its own, ``share`` queries and ``block`` vectors at a time.

    Vectors that are null, of another length, or hold nulls are passed over; equal scores (to 9 digits) go by key.
    """
    if similarity not in V.SIMILARITIES:
        raise ValueError(f"unknown similarity {similarity}")
    n, m = vectors.count(), queries.count()
    blocks, shares = -(-n // block) or 1, -(-m // share) or 1
    place = lambda c, parts: F.pmod(F.xxhash64(c), F.lit(parts))
    values = F.col(vector).cast("array<double>").alias("x")
    many = vectors.select(F.lit(1).alias("side"), F.col(key).cast("long").alias("id"), values, place(key, blocks).alias("b"), F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("s"))
    asked = queries.select(F.lit(0).alias("side"), F.col(key).cast("long").alias("id"), values, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), place(key, shares).alias("s"))

    def best(group: pa.Table) -> pa.Table:
        rows = [(side, i, x) for side, i, x in zip(*(group.column(c).to_pylist() for c in ("side", "id", "x")), strict=True) if x is not None and None not in x]
        out = {"qid": [], "id": [], "score": []}
        for length in {len(x) for side, _, x in rows if side == 0}:
            q, v = ([(i, x) for at, i, x in rows if at == side and len(x) == length] for side in (0, 1))
            if not v:
                continue
            ids = np.array([i for i, _ in v])
            scores = _scores(similarity, np.array([x for _, x in q]), np.array([x for _, x in v]))
            if scale:
                scores = (scores + 1) / 2 if similarity == "cosine" else 1 / (1 + np.exp(-scores / 100))
            for (qid, _), line in zip(q, scores, strict=True):
                at = np.flatnonzero((ids != qid) & ~np.isnan(line))
                at = at[np.lexsort((ids[at], -np.round(line[at], 9)))][:k]
                out["qid"] += [qid] * len(at)
                out["id"] += ids[at].tolist()
                out["score"] += line[at].tolist()
        return pa.table({"qid": pa.array(out["qid"], pa.int64()), "id": pa.array(out["id"], pa.int64()), "score": pa.array(out["score"], pa.float64())})

    found = asked.unionByName(many).groupBy("b", "s").applyInArrow(best, "qid long, id long, score double")
    return top_k(found.withColumnRenamed("id", key), ["qid"], [F.round("score", 9).desc(), key], k)


def diverse_order(candidates: DataFrame, by: str, item: str, similarity_to_query: str, vector: str) -> DataFrame:
    """(by, item, position): the most similar to the query first, then always the one least similar on average to those chosen; a group is one query's few candidates."""

    def order(group: pa.Table) -> pa.Table:
        items, first = group.column(item).to_pylist(), np.array(group.column(similarity_to_query).to_pylist())
        x = np.array(group.column(vector).to_pylist(), np.float64)
        x /= np.maximum(np.linalg.norm(x, axis=1), 1e-12)[:, None]
        left = sorted(range(len(items)), key=lambda i: (-round(first[i], 9), items[i]))
        chosen, total = [left.pop(0)], None
        while left:
            last = x @ x[chosen[-1]]
            total = last if total is None else total + last
            at = min(left, key=lambda i: (round(total[i] / len(chosen), 9), items[i]))
            left.remove(at)
            chosen.append(at)
        return pa.table({by: group.column(by).take(pa.array(chosen)), item: pa.array([items[i] for i in chosen], group.column(item).type), "position": pa.array(range(1, len(chosen) + 1), pa.int32())})

    kinds = dict(candidates.dtypes)
    return candidates.groupBy(by).applyInArrow(order, f"{by} {kinds[by]}, {item} {kinds[item]}, position int")


def lost_in_the_middle(df: DataFrame, by: str, rank: str) -> Column:
    """Position that puts the best at both ends: odd ranks go forward from the start, even ranks backward from the end."""
    n = F.count(F.lit(1)).over(Window.partitionBy(by))
    return F.when(F.col(rank) % 2 == 1, F.floor((F.col(rank) + 1) / 2)).otherwise(n - F.floor(F.col(rank) / 2) + 1)


def meta_field_rank(df: DataFrame, by: str, field: str, score: str, weight: float, k: int = 61) -> Column:
    """Rank score of ``field`` (descending, nulls last) blended with the present order by reciprocal ranks."""
    w = Window.partitionBy(by)
    a = F.row_number().over(w.orderBy(F.desc_nulls_last(field), F.desc(score)))
    b = F.row_number().over(w.orderBy(F.desc(score), F.desc_nulls_last(field)))
    return weight / (k + a) + (1 - weight) / (k + b)


def top_p(df: DataFrame, by: str, score: str, item: str, p: float) -> DataFrame:
    """Best rows until their softmax mass reaches ``p``; the best one always stays."""
    every = Window.partitionBy(by)
    before = every.orderBy(F.desc(score), item).rowsBetween(Window.unboundedPreceding, -1)
    e = F.exp(F.col(score) - F.max(score).over(every))
    return df.withColumn("_e", e).withColumn("_s", F.col("_e") / F.sum("_e").over(every)).withColumn("_b", F.coalesce(F.sum("_s").over(before), F.lit(0.0))).where(F.col("_b") < p).drop("_e", "_s", "_b")


def group_adjacent(by: str, group: str, order: str) -> Column:
    """Position that brings rows of a group together, groups in order of their first row."""
    first = F.min(order).over(Window.partitionBy(by, group))
    return F.row_number().over(Window.partitionBy(by).orderBy(first, order))


def hard_negatives(candidates: DataFrame, positives: DataFrame, first: int, last: int) -> DataFrame:
    """Ranked candidates (qid, doc_id, rank) that are not positive, within a range of ranks after removal."""
    left = candidates.join(positives, ["qid", "doc_id"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("qid").orderBy("rank"))
    return left.withColumn("negative_rank", rank).where(F.col("negative_rank").between(first, last))


def balanced_sample(df: DataFrame, label: str, key: str, n: int) -> DataFrame:
    """``n`` rows of each label that has so many, in an order that a digest of the key gives."""
    size = F.count(F.lit(1)).over(Window.partitionBy(label))
    place = F.row_number().over(Window.partitionBy(label).orderBy(F.md5(F.col(key).cast("string")), key))
    return df.withColumn("_n", size).withColumn("_r", place).where((F.col("_n") >= n) & (F.col("_r") <= n)).drop("_n", "_r")


def delete_words(words: Column, seed: str, ratio: float = 0.6) -> Column:
    """Words without about ``ratio`` of them, by a digest of seed and position; one at least stays."""
    share = lambda i: F.conv(F.substring(F.md5(F.concat(F.col(seed).cast("string"), F.lit("-"), i.cast("string"))), 1, 6), 16, 10).cast("double") / 2**24
    kept = F.transform(F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), share(i).alias("s"))), lambda x: x["s"] >= ratio), lambda x: x["w"])
    return F.when(F.size(kept) > 0, kept).otherwise(F.slice(words, 1, 1))


def communities(edges: DataFrame, threshold: float, least: int) -> DataFrame:
    """(node, center) by greedy claim: a node goes to the largest neighbourhood (ties: smaller center) that holds it; small ones are dropped."""
    both = edges.where(F.col("score") >= threshold).select("a", "b").union(edges.where(F.col("score") >= threshold).select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = both.union(both.select("a", F.col("a").alias("b"))).distinct()
    size = both.groupBy(F.col("a").alias("center")).agg(F.count(F.lit(1)).alias("n"))
    claim = both.select(F.col("a").alias("center"), F.col("b").alias("node")).join(size, "center")
    best = claim.groupBy("node").agg(F.max(F.struct("n", (-F.col("center")).alias("c"))).alias("x")).select("node", (-F.col("x.c")).alias("center"))
    kept = best.groupBy("center").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("center")
    return best.join(kept, "center", "left_semi").select("node", "center")


def band_communities(rows: DataFrame, by: str, key: str, value: str, width: float, least: int) -> DataFrame:
    """``communities`` of the edges between keys of one ``by`` whose values are at most ``width`` apart, without the edges.

    Neighbours are a run of the sorted values, so that a task holds the rows of its groups alone.  A key with several
    rows may have several runs; only then are the edges made.
    """
    rows = rows.select(F.col(by).alias("by"), F.col(key).alias("key"), F.col(value).cast("double").alias("value")).where("by IS NOT NULL AND key IS NOT NULL AND abs(value) < double('inf')").distinct()
    kind = dict(rows.dtypes)["key"]
    if not rows.groupBy("key").count().where("count > 1").isEmpty():
        a, b = rows.select("by", F.col("key").alias("a"), F.col("value").alias("x")), rows.select("by", F.col("key").alias("b"), F.col("value").alias("y"))
        edges = a.join(b, "by").where((F.col("a") < F.col("b")) & (F.abs(F.col("x") - F.col("y")) <= width)).select("a", "b", F.lit(1.0).alias("score"))
        return communities(edges, 1.0, least)

    def claim(group: pa.Table) -> pa.Table:
        keys = group.column("key").to_numpy()
        values, at, count = np.unique(group.column("value").to_numpy(), return_inverse=True, return_counts=True)
        n = len(values)
        # the first and the last value within the width: rounded bounds, then put right by the differences themselves
        low, high = np.searchsorted(values, values - width, "left"), np.searchsorted(values, values + width, "right") - 1
        low, high = np.clip(low, 0, np.arange(n)), np.clip(high, np.arange(n), n - 1)
        while (more := (low > 0) & (values - values[np.maximum(low - 1, 0)] <= width)).any():
            low -= more
        while (less := values - values[low] > width).any():
            low += less
        while (more := (high < n - 1) & (values[np.minimum(high + 1, n - 1)] - values <= width)).any():
            high += more
        while (less := values[high] - values > width).any():
            high -= less
        before = np.concatenate([[0], np.cumsum(count)])
        size = before[high + 1] - before[low]
        first = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(first, at, keys)
        # places by size, then by key: the best of a run is its least place, read off runs of twice the length each round
        order = np.lexsort((first, -size))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        best, length, step = np.empty(n, np.int64), high - low + 1, 1
        while step <= n:
            now = (length >= step) & (length < 2 * step)
            best[now] = np.minimum(place[low[now]], place[high[now] - step + 1])
            place = np.minimum(place[:-step], place[step:]) if step < n else place
            step *= 2
        center = first[order[best]][at]
        paired = size[at] > 1
        keys, center = keys[paired], center[paired]
        _, group_of, members = np.unique(center, return_inverse=True, return_counts=True)
        kept = members[group_of] >= least
        return pa.table({"node": keys[kept], "center": center[kept]})

    return rows.groupBy("by").applyInArrow(claim, f"node {kind}, center {kind}")
