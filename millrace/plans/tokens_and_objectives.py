"""Queries of token operators, batch objectives and further relational forms."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import vectors as V
from millrace.operators import ranking
from millrace.operators import tokens as K
from millrace.plans.registry import query, table


@query(
    "vocabulary_tokenizer",
    r"""WITH v AS (SELECT w AS token, row_number() OVER (ORDER BY w) AS id FROM (SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS w FROM benchmark) WHERE w <> ''),
        t AS (SELECT item_id, unnest(w) AS t0, unnest(range(len(w))) AS pos FROM (SELECT item_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM benchmark)),
        s AS (SELECT item_id, pos, t0, trim(t0, '!"#$%&''()*+,-./:;<=>?@[\]^_`{|}~') AS t1 FROM t), f AS (SELECT item_id, pos, 0 AS stage, t0 AS token FROM s UNION ALL SELECT item_id, pos, 1, t1 FROM s UNION ALL SELECT item_id, pos, 2, lower(t1) FROM s)
        SELECT item_id, pos::INT AS pos, arg_min(v.id, stage) AS id FROM f JOIN v USING (token) WHERE token NOT IN ('the', 'of', 'and') GROUP BY item_id, pos""",
)
def vocabulary_tokenizer(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark")
    distinct = items.select(F.explode(F.split(F.lower("text"), " ")).alias("token")).distinct().where("token <> ''")
    vocabulary = distinct.withColumn("id", F.row_number().over(Window.orderBy(F.col("token"))).cast("long"))
    return K.vocabulary_ids(items, "item_id", "text", vocabulary, ["the", "of", "and"])


@query("token_norms", "SELECT conv_id, turn, lower(role) AS norm, '\"' AS quote, '$' AS currency FROM conversations")
def token_norms(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", K.norm(F.col("role")).alias("norm"), K.norm(F.lit("“")).alias("quote"), K.norm(F.lit("€")).alias("currency"))


@query(
    "rule_lemmas",
    """WITH t AS (SELECT DISTINCT lower(p_name) AS p_name FROM part), w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS token FROM t)
       SELECT token, CASE WHEN token = 'were' THEN 'be' WHEN token LIKE '%s' AND left(token, length(token) - 1) IN (SELECT token FROM w) THEN left(token, length(token) - 1)
       WHEN token LIKE '%ing' AND left(token, length(token) - 3) IN (SELECT token FROM w) THEN left(token, length(token) - 3) ELSE token END AS lemma FROM w""",
)
def rule_lemmas(spark, sf_dir):
    forms = table(spark, sf_dir, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("token")).distinct()
    return K.lemmas(forms, "token", [("s", ""), ("ing", "")], {"were": "be"}, forms.select(F.col("token").alias("form"))).select("token", "lemma")


@query(
    "phrase_rules",
    """WITH t AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents), l AS (SELECT doc_id, unnest(w) AS t0, unnest(range(len(w))) AS i FROM t), k AS (SELECT doc_id, i, lower(t0) AS t0 FROM l),
       n AS (SELECT *, lag(t0) OVER w AS p1, lag(t0, 2) OVER w AS p2 FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY i))
       SELECT doc_id, CASE WHEN p1 = 'of' AND p2 = 'and' THEN i - 2 WHEN p1 = 'of' THEN i - 1 ELSE i END::INT AS start, (i + 1)::INT AS end, CASE WHEN p1 = 'of' AND p2 = 'and' THEN 'C' WHEN p1 = 'of' THEN 'A' ELSE 'B' END AS label FROM n WHERE t0 = 'the'""",
)
def phrase_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.split("text", " ").alias("w"))
    patterns = spark.createDataFrame([("of the", "A"), ("the", "B"), ("and of the", "C")], "phrase string, label string")
    return K.phrase_spans(docs, "doc_id", "w", F.broadcast(patterns), 3)


@query(
    "merge_runs",
    """WITH f AS (SELECT *, CASE WHEN label IS NULL OR label IS DISTINCT FROM lag(label) OVER w THEN 1 ELSE 0 END AS fresh FROM (SELECT conv_id, turn, role AS token, CASE WHEN role = 'user' THEN NULL ELSE 'X' END AS label FROM conversations) WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
       r AS (SELECT *, sum(fresh) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM f) SELECT conv_id, min(turn) AS start, string_agg(token, ' ' ORDER BY turn) AS merged, any_value(label) AS label FROM r GROUP BY conv_id, run""",
)
def merge_runs(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").alias("token"), F.when(F.col("role") != "user", "X").alias("label"))
    return K.merge_runs(rows, "conv_id", "turn", "token", "label")


@query(
    "bag_of_words",
    r"""WITH t AS (SELECT item_id, unnest(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS token FROM benchmark), w AS (SELECT * FROM (VALUES ('the', 2.0), ('of', 0.5), ('The', 3.0)) AS v(token, weight)),
        j AS (SELECT item_id, CASE WHEN a.weight IS NOT NULL THEN t.token ELSE coalesce(b.token, '<unknown>') END AS token, coalesce(a.weight, b.weight, 0.25) AS w FROM t LEFT JOIN w a ON t.token = a.token LEFT JOIN w b ON lower(t.token) = b.token)
        SELECT item_id, token, sum(w)::DOUBLE AS value FROM j GROUP BY item_id, token""",
)
def bag_of_words(spark, sf_dir):
    weights = F.broadcast(spark.createDataFrame([("the", 2.0), ("of", 0.5), ("The", 3.0)], "token string, weight double"))
    return K.bag_of_words(table(spark, sf_dir, "benchmark"), "item_id", "text", weights, 0.25)


@query("csv_cleaner", "SELECT n_nationkey, n_name || ',' || n_regionkey || chr(10) || 'x,' AS content FROM nation")
def csv_cleaner(spark, sf_dir):
    made = table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.col("n_name"), F.lit(",,"), F.col("n_regionkey"), F.lit("\n,,\nx,,\n")).alias("text"))
    return K.clean_csv(made, "n_nationkey", "text")


@query("csv_splitter", "SELECT r_regionkey, part, CASE part WHEN 0 THEN 0 ELSE 4 END AS first_row, CASE part WHEN 0 THEN 2 ELSE 1 END AS n_rows FROM region, (VALUES (0), (1)) AS v(part)")
def csv_splitter(spark, sf_dir):
    made = table(spark, sf_dir, "region").select("r_regionkey", F.lit("a,b\nc,d\n,\n,\ne,f\n").alias("text"))
    return K.split_csv(made, "r_regionkey", "text", 2)


_BATCH = "b AS (SELECT vec_id, vec_id // 16 AS batch, label, embedding::DOUBLE[] AS x FROM embeddings)"


def _pairs(spark, sf_dir):
    """Pairs within batches of 16 vectors."""
    b = table(spark, sf_dir, "embeddings").select("vec_id", F.floor(F.col("vec_id") / 16).alias("batch"), "label", F.col("embedding").cast("array<double>").alias("x"))
    other = b.select("batch", F.col("vec_id").alias("other"), F.col("label").alias("l2"), F.col("x").alias("y"))
    return b.join(other, "batch")


def _log_sum_exp(s, by):
    """Cross entropy of each group's own score, the largest score taken out so that nothing overflows."""
    s = s.withColumn("_top", F.max("s").over(Window.partitionBy(*by)))
    return s.groupBy(*by).agg((F.max("_top") + F.log(F.sum(F.exp(F.col("s") - F.col("_top")))) - F.max(F.when(F.col("own"), F.col("s")))).alias("loss"))


@query(
    "multiple_negatives_ranking",
    f"""WITH {_BATCH}, s AS (SELECT a.batch, a.vec_id, a.vec_id = c.vec_id AS own, 20 * list_cosine_similarity(a.x, list_transform(range(1, len(c.x) + 1), lambda i: c.x[i] + 0.1)) AS s FROM b a JOIN b c USING (batch)),
        r AS (SELECT batch, vec_id, ln(sum(exp(s))) - max(s) FILTER (own) AS loss FROM s GROUP BY batch, vec_id) SELECT batch, round(avg(loss), 5) AS loss FROM r GROUP BY batch""",
)
def multiple_negatives_ranking(spark, sf_dir):
    moved = F.transform("y", lambda v: v + 0.1)
    s = _pairs(spark, sf_dir).select("batch", "vec_id", (F.col("vec_id") == F.col("other")).alias("own"), (20 * V.cosine(F.col("x"), moved)).alias("s"))
    rows = _log_sum_exp(s, ["batch", "vec_id"])
    return rows.groupBy("batch").agg(F.round(F.avg("loss"), 5).alias("loss"))


@query(
    "batch_hard_triplet",
    f"""WITH {_BATCH}, d AS (SELECT a.batch, a.vec_id, a.label = c.label AS same, list_distance(a.x, c.x) AS d FROM b a JOIN b c ON a.batch = c.batch AND a.vec_id <> c.vec_id),
        h AS (SELECT batch, vec_id, max(d) FILTER (same) AS p, min(d) FILTER (NOT same) AS n FROM d GROUP BY batch, vec_id) SELECT batch, round(avg(greatest(p - n + 5, 0)), 5) AS hard, round(avg(ln(1 + exp(p - n))), 5) AS soft FROM h WHERE p IS NOT NULL AND n IS NOT NULL GROUP BY batch""",
)
def batch_hard_triplet(spark, sf_dir):
    d = _pairs(spark, sf_dir).where("vec_id <> other").select("batch", "vec_id", (F.col("label") == F.col("l2")).alias("same"), V.euclidean(F.col("x"), F.col("y")).alias("d"))
    h = d.groupBy("batch", "vec_id").agg(F.max(F.when(F.col("same"), F.col("d"))).alias("p"), F.min(F.when(~F.col("same"), F.col("d"))).alias("n")).where("p IS NOT NULL AND n IS NOT NULL")
    gap = F.col("p") - F.col("n")
    return h.groupBy("batch").agg(F.round(F.avg(F.greatest(gap + 5, F.lit(0.0))), 5).alias("hard"), F.round(F.avg(F.log(1 + F.exp(gap))), 5).alias("soft"))


@query(
    "online_contrastive",
    f"""WITH {_BATCH}, d AS (SELECT a.batch, a.label = c.label AS same, list_distance(a.x, c.x) AS d FROM b a JOIN b c ON a.batch = c.batch AND a.vec_id < c.vec_id),
        m AS (SELECT *, max(d) FILTER (same) OVER (PARTITION BY batch) AS top, min(d) FILTER (NOT same) OVER (PARTITION BY batch) AS low FROM d)
        SELECT batch, round(coalesce(sum(d * d) FILTER (same AND d > low), 0) + coalesce(sum(greatest(15 - d, 0) ** 2) FILTER (NOT same AND d < top), 0), 3) AS loss FROM m GROUP BY batch""",
)
def online_contrastive(spark, sf_dir):
    d = _pairs(spark, sf_dir).where("vec_id < other").select("batch", (F.col("label") == F.col("l2")).alias("same"), V.euclidean(F.col("x"), F.col("y")).alias("d"))
    w = Window.partitionBy("batch")
    d = d.withColumn("top", F.max(F.when(F.col("same"), F.col("d"))).over(w)).withColumn("low", F.min(F.when(~F.col("same"), F.col("d"))).over(w))
    pos, neg = F.when(F.col("same") & (F.col("d") > F.col("low")), F.col("d") * F.col("d")), F.when(~F.col("same") & (F.col("d") < F.col("top")), F.pow(F.greatest(15 - F.col("d"), F.lit(0.0)), 2))
    return d.groupBy("batch").agg(F.round(F.coalesce(F.sum(pos), F.lit(0.0)) + F.coalesce(F.sum(neg), F.lit(0.0)), 3).alias("loss"))


@query(
    "ranked_pair_loss",
    f"""WITH {_BATCH}, p AS (SELECT a.batch, a.vec_id, (a.label = c.label)::INT AS y, list_cosine_similarity(a.x, c.x) AS s FROM b a JOIN b c ON a.batch = c.batch AND c.vec_id = a.vec_id + 1)
        SELECT batch, round(ln(1 + coalesce(sum(e), 0)), 5) AS loss FROM (SELECT p.batch, CASE WHEN p.y > q.y THEN exp(20 * (q.s - p.s)) END AS e FROM p JOIN p q USING (batch)) GROUP BY batch""",
)
def ranked_pair_loss(spark, sf_dir):
    p = _pairs(spark, sf_dir).where("other = vec_id + 1").select("batch", (F.col("label") == F.col("l2")).cast("int").alias("y"), V.cosine(F.col("x"), F.col("y")).alias("s"))
    q = p.select("batch", F.col("y").alias("y2"), F.col("s").alias("s2"))
    e = F.when(F.col("y") > F.col("y2"), F.exp(20 * (F.col("s2") - F.col("s"))))
    return p.join(q, "batch").groupBy("batch").agg(F.round(F.log(1 + F.coalesce(F.sum(e), F.lit(0.0))), 5).alias("loss"))


@query(
    "paraphrase_mining",
    """WITH s AS (SELECT a.vec_id AS q, c.vec_id AS o, list_cosine_similarity(a.embedding::DOUBLE[], c.embedding::DOUBLE[]) AS s FROM embeddings a JOIN embeddings c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
       t AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY q ORDER BY round(s, 9) DESC, o) <= 5) SELECT least(q, o) AS a, greatest(q, o) AS b, round(max(s), 6) AS score FROM t GROUP BY ALL""",
)
def paraphrase_mining(spark, sf_dir):
    """The nearest pairs over the whole corpus of the vectors whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = ranking.vector_top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)
    return found.groupBy(F.least("qid", "vec_id").alias("a"), F.greatest("qid", "vec_id").alias("b")).agg(F.round(F.max("score"), 6).alias("score"))


@query("no_duplicate_batches", "SELECT doc_id, row_number() OVER (PARTITION BY lower(trim(source, ' ')) ORDER BY doc_id) - 1 AS batch FROM documents")
def no_duplicate_batches(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", (F.row_number().over(Window.partitionBy(F.lower(F.trim("source"))).orderBy("doc_id")) - 1).alias("batch"))


@query("kl_divergence", "SELECT o_custkey, round(sum(p * ln(p / q)), 6) AS kl FROM (SELECT o_custkey, o_totalprice / sum(o_totalprice) OVER (PARTITION BY o_custkey) AS p, 1.0 / count(*) OVER (PARTITION BY o_custkey) AS q FROM orders) GROUP BY o_custkey")
def kl_divergence(spark, sf_dir):
    w = Window.partitionBy("o_custkey")
    rows = table(spark, sf_dir, "orders").select("o_custkey", (F.col("o_totalprice") / F.sum("o_totalprice").over(w)).alias("p"), (1.0 / F.count(F.lit(1)).over(w)).alias("q"))
    return rows.groupBy("o_custkey").agg(F.round(F.sum(F.col("p") * F.log(F.col("p") / F.col("q"))), 6).alias("kl"))


@query("cube_counts", "SELECT lang, source, count(*) AS n, grouping(lang)::INT AS g FROM documents GROUP BY CUBE (lang, source)")
def cube_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").cube("lang", "source").agg(F.count(F.lit(1)).alias("n"), F.grouping("lang").cast("int").alias("g"))


@query("rollup_sums", "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS q FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def rollup_sums(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("q"))


@query(
    "revenue_by_nation",
    """SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey AND s_nationkey = c_nationkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE o_orderdate >= TIMESTAMP '1994-01-01' AND o_orderdate < TIMESTAMP '1996-01-01' GROUP BY n_name""",
)
def revenue_by_nation(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    orders = t("orders").where((F.col("o_orderdate") >= at("1994-01-01")) & (F.col("o_orderdate") < at("1996-01-01")))
    rows = t("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(t("supplier"), (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("s_nationkey") == F.col("c_nationkey"))).join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("late_orders", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_shipdate > o_orderdate + INTERVAL 60 DAY) GROUP BY o_orderpriority")
def late_orders(spark, sf_dir):
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    late = (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_shipdate") > F.col("o_orderdate") + F.expr("INTERVAL 60 DAY"))
    return orders.join(lines, late, "left_semi").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("forecast_revenue", "SELECT round(sum(l_extendedprice * l_discount), 2) AS revenue FROM lineitem WHERE l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24")
def forecast_revenue(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").where("l_discount BETWEEN 0.05D AND 0.07D AND l_quantity < 24").agg(F.round(F.sum(F.col("l_extendedprice") * F.col("l_discount")), 2).alias("revenue"))


@query("pivot_statuses", "SELECT o_custkey, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS f, sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END)::BIGINT AS o FROM orders GROUP BY o_custkey")
def pivot_statuses(spark, sf_dir):
    wide = table(spark, sf_dir, "orders").groupBy("o_custkey").pivot("o_orderstatus", ["F", "O"]).agg(F.count(F.lit(1)))
    return wide.select("o_custkey", F.coalesce("F", F.lit(0)).alias("f"), F.coalesce("O", F.lit(0)).alias("o"))


@query("unpivot_flags", "SELECT doc_id, 'quality' AS flag, quality AS value FROM labels UNION ALL SELECT doc_id, 'toxic', toxic FROM labels")
def unpivot_flags(spark, sf_dir):
    return table(spark, sf_dir, "labels").unpivot("doc_id", ["quality", "toxic"], "flag", "value")


@query("softmax_loss", "SELECT label, round(avg(ln(list_sum(list_transform(x, lambda v: exp(v)))) - x[label + 1]), 5) AS loss FROM (SELECT label, embedding::DOUBLE[] AS x FROM embeddings) GROUP BY label")
def softmax_loss(spark, sf_dir):
    logits = table(spark, sf_dir, "embeddings").select("label", F.col("embedding").cast("array<double>").alias("x"))
    return logits.groupBy("label").agg(F.round(F.avg(-F.log(F.get(V.softmax(F.col("x")), F.col("label")))), 5).alias("loss"))


@query(
    "batch_all_triplet",
    f"""WITH {_BATCH}, d AS (SELECT a.batch, a.vec_id, c.vec_id AS other, a.label = c.label AS same, list_distance(a.x, c.x) AS d FROM b a JOIN b c ON a.batch = c.batch AND a.vec_id <> c.vec_id),
        t AS (SELECT p.batch, greatest(p.d - n.d + 5, 0) AS l FROM d p JOIN d n ON p.batch = n.batch AND p.vec_id = n.vec_id AND p.same AND NOT n.same) SELECT batch, round(avg(l) FILTER (l > 0), 5) AS loss, count(*) AS n FROM t GROUP BY batch""",
)
def batch_all_triplet(spark, sf_dir):
    d = _pairs(spark, sf_dir).where("vec_id <> other").select("batch", "vec_id", (F.col("label") == F.col("l2")).alias("same"), V.euclidean(F.col("x"), F.col("y")).alias("d"))
    near, far = d.where("same").select("batch", "vec_id", F.col("d").alias("p")), d.where("NOT same").select("batch", "vec_id", F.col("d").alias("n"))
    loss = F.greatest(F.col("p") - F.col("n") + 5, F.lit(0.0))
    rows = near.join(far, ["batch", "vec_id"]).select("batch", loss.alias("l"))
    return rows.groupBy("batch").agg(F.round(F.avg(F.when(F.col("l") > 0, F.col("l"))), 5).alias("loss"), F.count(F.lit(1)).alias("n"))
