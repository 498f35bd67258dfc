"""Queries of retrieval, answer, embedding and training-objective metrics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import vectors as V
from millrace.operators import metrics
from millrace.plans.registry import query, table

_HITS = """
r AS (SELECT o_custkey AS qid, o_orderkey AS doc_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) - 1 AS rank, o_orderpriority = '1-URGENT' AS rel FROM orders),
h AS (SELECT qid, rank, rel::INT AS hit, sum(rel::INT) OVER (PARTITION BY qid ORDER BY rank) AS upto, sum(rel::INT) OVER (PARTITION BY qid) AS n_truth FROM r)"""


def _hits(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    order = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    run = orders.select(F.col("o_custkey").alias("qid"), F.col("o_orderkey").alias("doc_id"), (F.row_number().over(order) - 1).alias("rank"))
    truth = orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("qid"), F.col("o_orderkey").alias("doc_id"))
    return metrics.ranked_hits(run, truth)


@query("mean_reciprocal_rank", f"WITH {_HITS} SELECT qid, round(coalesce(1.0 / (min(rank) FILTER (hit = 1) + 1), 0), 8) AS mrr FROM h GROUP BY qid")
def mean_reciprocal_rank(spark, sf_dir):
    return metrics.by_query(_hits(spark, sf_dir)).select("qid", F.round("mrr", 8).alias("mrr"))


@query("mean_average_precision", f"WITH {_HITS} SELECT qid, round(coalesce(avg(upto / (rank + 1)) FILTER (hit = 1), 0), 6) AS map FROM h GROUP BY qid")
def mean_average_precision(spark, sf_dir):
    return metrics.by_query(_hits(spark, sf_dir)).select("qid", F.round("map", 6).alias("map"))


@query(
    "ndcg_and_recall_at_k",
    f"""WITH {_HITS}, k AS (SELECT * FROM h WHERE rank < 5) SELECT qid, max(hit)::DOUBLE AS recall_single, round(CASE WHEN max(n_truth) > 0 THEN sum(hit) / max(n_truth) ELSE 0 END, 6) AS recall_multi,
        round(CASE WHEN max(n_truth) > 0 THEN sum(hit / log2(rank + 2)) / list_sum(list_transform(range(1, least(max(n_truth), 5)::INT + 1), lambda i: 1 / log2(i + 1))) ELSE 0 END, 6) AS ndcg, round(sum(hit) / 5, 6) AS precision FROM k GROUP BY qid""",
)
def ndcg_and_recall_at_k(spark, sf_dir):
    out = metrics.by_query(_hits(spark, sf_dir), k=5)
    return out.select("qid", "recall_single", *[F.round(c, 6).alias(c) for c in ("recall_multi", "ndcg", "precision")])


@query("retrieval_summary", f"WITH {_HITS}, q AS (SELECT qid, coalesce(1.0 / (min(rank) FILTER (hit = 1) + 1), 0) AS mrr FROM h GROUP BY qid) SELECT c_mktsegment AS dataset, round(avg(mrr), 6) AS mrr, count(*) AS n FROM q JOIN customer ON qid = c_custkey GROUP BY 1")
def retrieval_summary(spark, sf_dir):
    by = metrics.by_query(_hits(spark, sf_dir)).join(table(spark, sf_dir, "customer"), F.col("qid") == F.col("c_custkey"))
    return by.groupBy(F.col("c_mktsegment").alias("dataset")).agg(F.round(F.avg("mrr"), 6).alias("mrr"), F.count(F.lit(1)).alias("n"))


@query("exact_match", "SELECT l_returnflag, avg((l_linestatus = CASE WHEN l_returnflag = 'N' THEN 'O' ELSE 'F' END)::INT) AS score FROM lineitem GROUP BY l_returnflag")
def exact_match(spark, sf_dir):
    truth = F.when(F.col("l_returnflag") == "N", "O").otherwise("F")
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.avg(metrics.exact_match(F.col("l_linestatus"), truth)).alias("score"))


_PAIRS = "p AS (SELECT a.p_partkey AS id, string_split(a.p_name, ' ') AS x, string_split(b.p_name, ' ') AS y FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1)"


def _name_pairs(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ").alias("w"))
    a, b = part.select(F.col("p_partkey").alias("id"), F.col("w").alias("x")), part.select((F.col("p_partkey") - 1).alias("id"), F.col("w").alias("y"))
    return a.join(b, "id")


@query("token_f1", f"WITH {_PAIRS} SELECT id, round(2.0 * list_sum(list_transform(list_distinct(list_intersect(x, y)), lambda t: least(len(list_filter(x, lambda u: u = t)), len(list_filter(y, lambda u: u = t))))) / (len(x) + len(y)), 6) AS f1 FROM p WHERE len(list_intersect(x, y)) > 0 UNION ALL SELECT id, 0 FROM p WHERE len(list_intersect(x, y)) = 0")
def token_f1(spark, sf_dir):
    return _name_pairs(spark, sf_dir).select("id", F.round(metrics.token_f1(F.col("x"), F.col("y")), 6).alias("f1"))


@query("label_accuracy", "SELECT label, avg((vec_id % 10 = label)::INT) AS accuracy, count(*) AS n FROM embeddings GROUP BY label")
def label_accuracy(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").groupBy("label").agg(F.avg((F.pmod("vec_id", F.lit(10)) == F.col("label")).cast("int")).alias("accuracy"), F.count(F.lit(1)).alias("n"))


@query(
    "binary_thresholds",
    """WITH e AS (SELECT p_brand, p_size AS s, (p_retailprice > 1400)::INT AS y FROM part), g AS (SELECT p_brand, s, sum(y) AS pos, count(*) - sum(y) AS neg FROM e GROUP BY p_brand, s),
       c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY p_brand) AS p, sum(neg) OVER (PARTITION BY p_brand) AS n FROM g WINDOW w AS (PARTITION BY p_brand ORDER BY s DESC))
       SELECT p_brand, round(max((tp + n - fp) / (p + n)), 6) AS accuracy, round(max(2 * tp / (tp + fp + p)), 6) AS f1, round(sum(pos / p * tp / (tp + fp)), 6) AS average_precision FROM c GROUP BY p_brand""",
)
def binary_thresholds(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_brand", F.col("p_size").alias("s"), (F.col("p_retailprice") > 1400).cast("int").alias("y"))
    out = metrics.binary_thresholds(rows, "s", "y", ["p_brand"])
    return out.select("p_brand", *[F.round(c, 6).alias(c) for c in ("accuracy", "f1", "average_precision")])


@query(
    "embedding_correlation",
    """WITH e AS (SELECT event_type, value AS a, floor(value / 10)::DOUBLE AS b FROM events), r AS (SELECT *, (rank() OVER (PARTITION BY event_type ORDER BY a)) + (count(*) OVER (PARTITION BY event_type, a) - 1) / 2.0 AS ra,
       (rank() OVER (PARTITION BY event_type ORDER BY b)) + (count(*) OVER (PARTITION BY event_type, b) - 1) / 2.0 AS rb FROM e) SELECT event_type, round(corr(a, b), 6) AS pearson, round(corr(ra, rb), 6) AS spearman FROM r GROUP BY event_type""",
)
def embedding_correlation(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_type", F.col("value").alias("a"), F.floor(F.col("value") / 10).cast("double").alias("b"))
    return metrics.spearman(rows, "a", "b", ["event_type"]).select("event_type", F.round("pearson", 6).alias("pearson"), F.round("spearman", 6).alias("spearman"))


_VEC = "v AS (SELECT a.vec_id AS id, a.label AS la, b.label AS lb, c.label AS lc, a.embedding::DOUBLE[] AS x, b.embedding::DOUBLE[] AS y, c.embedding::DOUBLE[] AS z FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 JOIN embeddings c ON c.vec_id = a.vec_id + 2)"


def _triples(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    part = lambda k, v, l: e.select((F.col("vec_id") - k).alias("id"), F.col("embedding").cast("array<double>").alias(v), F.col("label").alias(l))  # noqa: E731, E741
    return part(0, "x", "la").join(part(1, "y", "lb"), "id").join(part(2, "z", "lc"), "id")


@query(
    "vector_similarities",
    f"""WITH {_VEC} SELECT id, round(list_cosine_similarity(x, y), 6) AS cosine, round(list_inner_product(x, y), 5) AS dot, round(-list_distance(x, y), 5) AS euclidean,
        round(-list_sum(list_transform(range(1, len(x) + 1), lambda i: abs(x[i] - y[i]))), 4) AS manhattan FROM v""",
)
def vector_similarities(spark, sf_dir):
    x, y = F.col("x"), F.col("y")
    digits = {"cosine": 6, "dot": 5, "euclidean": 5, "manhattan": 4}
    return _triples(spark, sf_dir).select("id", *[F.round(V.similarity(n, x, y), d).alias(n) for n, d in digits.items()])


@query("triplet_accuracy", f"WITH {_VEC} SELECT la, avg((list_distance(x, y) < list_distance(x, z))::INT) AS accuracy FROM v GROUP BY la")
def triplet_accuracy(spark, sf_dir):
    x, y, z = F.col("x"), F.col("y"), F.col("z")
    return _triples(spark, sf_dir).groupBy("la").agg(F.avg((V.euclidean(x, y) < V.euclidean(x, z)).cast("int")).alias("accuracy"))


@query("vector_mse", f"WITH {_VEC} SELECT la, round(avg(list_distance(x, y) ** 2 / len(x)), 5) AS mse FROM v GROUP BY la")
def vector_mse(spark, sf_dir):
    return _triples(spark, sf_dir).groupBy("la").agg(F.round(F.avg(F.pow(V.euclidean(F.col("x"), F.col("y")), 2) / F.size("x")), 5).alias("mse"))


@query(
    "pair_losses",
    f"""WITH {_VEC}, d AS (SELECT *, list_distance(x, y) AS dp, list_distance(x, z) AS dn, list_cosine_similarity(x, y) AS c, (la = lb)::INT AS same FROM v)
        SELECT la, round(avg(0.5 * (same * dp * dp + (1 - same) * greatest(0.5 - dp, 0) ** 2)), 5) AS contrastive, round(avg(greatest(dp - dn + 1, 0)), 5) AS triplet, round(avg((c - same) ** 2), 5) AS cosine_mse FROM d GROUP BY la""",
)
def pair_losses(spark, sf_dir):
    x, y, z = F.col("x"), F.col("y"), F.col("z")
    d = _triples(spark, sf_dir).select("la", V.euclidean(x, y).alias("dp"), V.euclidean(x, z).alias("dn"), V.cosine(x, y).alias("c"), (F.col("la") == F.col("lb")).cast("int").alias("same"))
    same, dp = F.col("same"), F.col("dp")
    return d.groupBy("la").agg(
        F.round(F.avg(0.5 * (same * dp * dp + (1 - same) * F.pow(F.greatest(0.5 - dp, F.lit(0.0)), 2))), 5).alias("contrastive"),
        F.round(F.avg(F.greatest(dp - F.col("dn") + 1, F.lit(0.0))), 5).alias("triplet"), F.round(F.avg(F.pow(F.col("c") - same, 2)), 5).alias("cosine_mse"),
    )


@query("margin_mse", "SELECT l_returnflag, round(avg(((l_tax - l_discount) - (l_discount - l_tax / 2)) ** 2), 8) AS loss FROM lineitem GROUP BY l_returnflag")
def margin_mse(spark, sf_dir):
    t, d = F.col("l_tax"), F.col("l_discount")
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.round(F.avg(F.pow((t - d) - (d - t / 2), 2)), 8).alias("loss"))


@query(
    "activations",
    """SELECT event_id, round(1 / (1 + exp(-x)), 9) AS sigmoid, greatest(x, 0) AS relu, least(greatest(x, 0), 6) AS relu_k, round(least(greatest(0.2 * x + 0.5, 0), 1), 9) AS hard_sigmoid, least(greatest(x, -1), 1) AS hard_tanh,
       round(x / (1 + exp(-x)), 9) AS swish, round(x * least(greatest(0.2 * x + 0.5, 0), 1), 9) AS hard_swish, round(x * least(greatest(x + 3, 0), 6) / 6, 9) AS hard_swish_mobile, round(x * tanh(ln(1 + exp(x))), 9) AS mish, round(0.5 * x * (x / sqrt(1 + x * x) + 1), 9) AS dish
       FROM (SELECT event_id, value / 10 - 5 AS x FROM events)""",
)
def activations(spark, sf_dir):
    x = F.col("x")
    nine = lambda c: F.round(c, 9)
    return table(spark, sf_dir, "events").select("event_id", (F.col("value") / 10 - 5).alias("x")).select(
        "event_id", nine(V.sigmoid(x)).alias("sigmoid"), V.relu(x).alias("relu"), V.relu_k(x).alias("relu_k"), nine(V.hard_sigmoid(x)).alias("hard_sigmoid"), V.hard_tanh(x).alias("hard_tanh"), nine(V.swish(x)).alias("swish"),
        nine(V.hard_swish(x)).alias("hard_swish"), nine(V.hard_swish_mobile(x)).alias("hard_swish_mobile"), nine(V.mish(x)).alias("mish"), nine(V.dish(x)).alias("dish"),
    )


@query(
    "vector_functions",
    """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings), f AS (SELECT vec_id, x, list_transform(x, lambda v: exp(v - list_max(x))) AS q, list_avg(x) AS m, sqrt(list_inner_product(x, x)) AS n FROM e)
       SELECT vec_id, round(list_max(q) / list_sum(q), 6) AS softmax_top, round(x[1] / n, 6) AS unit_first, round((x[1] - m) / sqrt(list_inner_product(x, x) / len(x) - m * m + 1e-8), 4) AS norm_first, round(list_sum(list_slice(x, 1, 8)), 5) AS truncated_sum,
       len(list_filter(x, lambda v: v <> 0))::INT AS n_sparse, round(list_max(list_slice(x, 1, 4)), 6) AS maxout_first FROM f""",
)
def vector_functions(spark, sf_dir):
    x = F.col("x")
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x")).select(
        "vec_id", F.round(F.array_max(V.softmax(x)), 6).alias("softmax_top"), F.round(F.get(V.l2_normalize(x), F.lit(0)), 6).alias("unit_first"), F.round(F.get(V.layer_norm(x), F.lit(0)), 4).alias("norm_first"),
        F.round(F.aggregate(V.truncate(x, 8), F.lit(0.0), lambda s, v: s + v), 5).alias("truncated_sum"), F.size(V.sparse(x)["indices"]).alias("n_sparse"), F.round(F.get(V.maxout(x, 4), F.lit(0)), 6).alias("maxout_first"),
    )


@query("ragged_reductions", "SELECT label, d, round(sum(v), 4) AS s, round(avg(v), 6) AS m, max(v) AS top, arg_min(v, vec_id) AS first_v, arg_max(v, vec_id) AS last_v FROM (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS d FROM embeddings) GROUP BY label, d")
def ragged_reductions(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.posexplode(F.col("embedding").cast("array<double>")).alias("d", "v"))
    return rows.groupBy("label", "d").agg(F.round(F.sum("v"), 4).alias("s"), F.round(F.avg("v"), 6).alias("m"), F.max("v").alias("top"), F.min_by("v", "vec_id").alias("first_v"), F.max_by("v", "vec_id").alias("last_v"))


@query("mode_top_n", "SELECT user_id, mode, n FROM (SELECT user_id, event_type AS mode, count(*) AS n FROM events GROUP BY user_id, event_type) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, mode) <= 2")
def mode_top_n(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy("user_id", F.col("event_type").alias("mode")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("_r", F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("n"), "mode"))).where("_r <= 2").drop("_r")


@query("weighted_grader", "SELECT vec_id, round(0.7 * (label IN (1, 2, 3))::INT + 0.3 * (vec_id % 2), 4) AS score, 0.7 * (label IN (1, 2, 3))::INT + 0.3 * (vec_id % 2) >= 0.5 AS passed FROM embeddings")
def weighted_grader(spark, sf_dir):
    formula = F.expr("0.7D * int(label IN (1, 2, 3)) + 0.3D * (vec_id % 2)")
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(formula, 4).alias("score"), (formula >= 0.5).alias("passed"))


@query("confusion_counts", "SELECT quality AS predicted, toxic AS label, count(*) AS n FROM labels GROUP BY ALL")
def confusion_counts(spark, sf_dir):
    return table(spark, sf_dir, "labels").groupBy(F.col("quality").alias("predicted"), F.col("toxic").alias("label")).agg(F.count(F.lit(1)).alias("n"))
