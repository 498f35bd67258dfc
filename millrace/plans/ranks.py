"""Queries of retrieval, ranking, windows and sampling."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import ranking, text
from millrace.plans.registry import query, table


@query(
    "bm25_top_k",
    """WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda t: t <> '') AS w FROM documents), n AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM d),
       q AS (SELECT item_id AS qid, unnest(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda t: t <> ''))) AS term FROM benchmark),
       t AS (SELECT doc_id, len(w) AS len, unnest(w) AS term FROM d), f AS (SELECT term, doc_id, count(*) AS tf, any_value(len) AS len FROM t WHERE term IN (SELECT term FROM q) GROUP BY term, doc_id),
       g AS (SELECT term, count(*) AS df FROM f GROUP BY term), s AS (SELECT qid, doc_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len / mean))) AS score FROM q JOIN f USING (term) JOIN g USING (term), n GROUP BY qid, doc_id)
       SELECT qid, doc_id, round(score, 4) AS score, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, doc_id) AS rank FROM s QUALIFY rank <= 5""",
)
def bm25_top_k(spark, sf_dir):
    queries = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("query"))
    return ranking.bm25(table(spark, sf_dir, "documents"), queries, 5).withColumn("score", F.round("score", 4))


@query(
    "vector_top_k",
    """SELECT q.vec_id AS qid, e.vec_id, round(list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 6) AS score,
       row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 9) DESC, e.vec_id) AS rank FROM embeddings q JOIN embeddings e ON q.vec_id <> e.vec_id WHERE q.vec_id % 50 = 0 QUALIFY rank <= 5""",
)
def vector_top_k(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ranking.vector_top_k(vectors, vectors.where("vec_id % 50 = 0"), 5).withColumn("score", F.round("score", 6))


_RANKED = "r AS (SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)"


def _ranked(spark, sf_dir):
    order = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority", F.row_number().over(order).alias("rank"))


@query("lost_in_the_middle", f"WITH {_RANKED} SELECT o_orderkey, CASE WHEN rank % 2 = 1 THEN (rank + 1) // 2 ELSE count(*) OVER (PARTITION BY o_custkey) - rank // 2 + 1 END AS position FROM r")
def lost_in_the_middle(spark, sf_dir):
    ranked = _ranked(spark, sf_dir)
    return ranked.select("o_orderkey", ranking.lost_in_the_middle(ranked, "o_custkey", "rank").alias("position"))


@query(
    "meta_field_ranker",
    """SELECT c_custkey, round(0.6 / (61 + a) + 0.4 / (61 + b), 8) AS score FROM (SELECT c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_nationkey DESC NULLS LAST, c_acctbal DESC) AS a,
       row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_nationkey DESC NULLS LAST) AS b FROM customer)""",
)
def meta_field_ranker(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return customer.select("c_custkey", F.round(ranking.meta_field_rank(customer, "c_mktsegment", "c_nationkey", "c_acctbal", 0.6), 8).alias("score"))


@query("meta_field_grouping", f"WITH {_RANKED} SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY first, rank) AS position FROM (SELECT *, min(rank) OVER (PARTITION BY o_custkey, o_orderpriority) AS first FROM r)")
def meta_field_grouping(spark, sf_dir):
    return _ranked(spark, sf_dir).select("o_orderkey", ranking.group_adjacent("o_custkey", "o_orderpriority", "rank").alias("position"))


@query(
    "top_p_sampler",
    """WITH e AS (SELECT s_nationkey, s_suppkey, s_acctbal / 1000 AS score FROM supplier), x AS (SELECT *, exp(score - max(score) OVER (PARTITION BY s_nationkey)) AS e FROM e), s AS (SELECT *, e / sum(e) OVER (PARTITION BY s_nationkey) AS s FROM x)
       SELECT s_nationkey, s_suppkey FROM s QUALIFY coalesce(sum(s) OVER (PARTITION BY s_nationkey ORDER BY score DESC, s_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 0.9""",
)
def top_p_sampler(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey", (F.col("s_acctbal") / 1000).alias("score"))
    return ranking.top_p(rows, "s_nationkey", "score", "s_suppkey", 0.9).select("s_nationkey", "s_suppkey")


@query("hard_negatives", f"WITH {_RANKED} SELECT o_custkey AS qid, o_orderkey AS doc_id, row_number() OVER (PARTITION BY o_custkey ORDER BY rank) AS negative_rank FROM r WHERE o_orderpriority <> '1-URGENT' QUALIFY negative_rank BETWEEN 2 AND 4")
def hard_negatives(spark, sf_dir):
    ranked = _ranked(spark, sf_dir).select(F.col("o_custkey").alias("qid"), F.col("o_orderkey").alias("doc_id"), "rank", "o_orderpriority")
    positives = ranked.where("o_orderpriority = '1-URGENT'").select("qid", "doc_id")
    return ranking.hard_negatives(ranked.select("qid", "doc_id", "rank"), positives, 2, 4).select("qid", "doc_id", "negative_rank")


@query("balanced_sample", "SELECT label, vec_id FROM embeddings QUALIFY count(*) OVER (PARTITION BY label) >= 20 AND row_number() OVER (PARTITION BY label ORDER BY md5(vec_id::VARCHAR), vec_id) <= 20")
def balanced_sample(spark, sf_dir):
    return ranking.balanced_sample(table(spark, sf_dir, "embeddings").select("label", "vec_id"), "label", "vec_id", 20)


@query(
    "denoising_deletion",
    """WITH w AS (SELECT item_id, string_split(text, ' ') AS w FROM benchmark), k AS (SELECT item_id, w, [w[i + 1] for i in range(len(w)) if ('0x' || substr(md5(item_id || '-' || i), 1, 6))::BIGINT / 16777216.0 >= 0.6] AS k FROM w)
       SELECT item_id, array_to_string(CASE WHEN len(k) > 0 THEN k ELSE w[1:1] END, ' ') AS noisy FROM k""",
)
def denoising_deletion(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", F.array_join(ranking.delete_words(F.split("text", " "), "item_id"), " ").alias("noisy"))


@query(
    "communities",
    """WITH e AS (SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey AND abs(a.s_acctbal - b.s_acctbal) <= 3000),
       s AS (SELECT a, b FROM e UNION SELECT b, a FROM e UNION SELECT a, a FROM e UNION SELECT b, b FROM e), n AS (SELECT a, count(*) AS n FROM s GROUP BY a),
       c AS (SELECT s.b AS node, s.a AS center FROM s JOIN n ON s.a = n.a QUALIFY row_number() OVER (PARTITION BY s.b ORDER BY n.n DESC, s.a) = 1) SELECT node, center FROM c QUALIFY count(*) OVER (PARTITION BY center) >= 2""",
)
def communities(spark, sf_dir):
    return ranking.band_communities(table(spark, sf_dir, "supplier"), "s_nationkey", "s_suppkey", "s_acctbal", 3000.0, 2)


@query("context_window", "SELECT conv_id, turn, concat(coalesce(lag(role) OVER w, '-'), '|', role, '|', coalesce(lead(role) OVER w, '-')) AS context FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def context_window(spark, sf_dir):
    rows = text.expand_window(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", 1)
    return rows.select("conv_id", "turn", F.array_join(F.transform("window", lambda x: F.coalesce(x, F.lit("-"))), "|").alias("context"))


@query(
    "rolling_fragmentation",
    "SELECT event_id, CASE WHEN count(*) OVER w = 16 THEN round(avg(value) OVER w, 8) END AS mean16 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 15 PRECEDING AND CURRENT ROW)",
)
def rolling_fragmentation(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(-15, 0)
    return table(spark, sf_dir, "events").select("event_id", F.when(F.count(F.lit(1)).over(w) == 16, F.round(F.avg("value").over(w), 8)).alias("mean16"))


@query("running_sum_state", "SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id), 4) AS state FROM events")
def running_sum_state(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, sf_dir, "events").select("event_id", F.round(F.sum("value").over(w), 4).alias("state"))


@query("ranking_windows", "SELECT s_suppkey, rank() OVER w AS r, dense_rank() OVER w AS d, ntile(4) OVER w AS q, lag(s_suppkey) OVER w AS before FROM supplier WINDOW w AS (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey)")
def ranking_windows(spark, sf_dir):
    w = Window.partitionBy("s_nationkey").orderBy("s_acctbal", "s_suppkey")
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"), F.ntile(4).over(w).alias("q"), F.lag("s_suppkey").over(w).alias("before"))


@query("sessions", "SELECT user_id, session, count(*) AS n, min(ts) AS started FROM (SELECT user_id, ts, sum(gap) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM (SELECT *, coalesce(date_diff('microsecond', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) > 1800000000, TRUE)::INT AS gap FROM events)) GROUP BY user_id, session")
def sessions(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gap = F.coalesce(F.timestamp_diff("microsecond", F.lag("ts").over(w), F.col("ts")) > 1_800_000_000, F.lit(True)).cast("int")
    rows = table(spark, sf_dir, "events").withColumn("gap", gap).withColumn("session", F.sum("gap").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("user_id", "session").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("started"))
