"""Further queries: token tests, prompts, pooling, hashing, evaluation at several depths, observation, recursion."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import vectors as V
from millrace.operators import metrics, ranking
from millrace.plans.registry import query, table


@query("stop_words", "SELECT doc_id, len(list_filter(string_split(lower(text), ' '), lambda w: w NOT IN ('the', 'of', 'and', 'to', 'in', 'a')))::INT AS n_content FROM documents")
def stop_words(spark, sf_dir):
    stop = ["the", "of", "and", "to", "in", "a"]
    return table(spark, sf_dir, "documents").select("doc_id", F.size(F.filter(F.split(F.lower("text"), " "), lambda w: ~w.isin(stop))).alias("n_content"))


@query("prompt_builder", "SELECT conv_id, string_agg(role || ': ' || length(text), chr(10) ORDER BY turn) || chr(10) || 'Answer:' AS prompt FROM conversations GROUP BY conv_id")
def prompt_builder(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.format_string("%s: %d", "role", F.length("text").cast("long")).alias("line")))).alias("a"))
    return turns.select("conv_id", F.concat(F.array_join("a.line", "\n"), F.lit("\nAnswer:")).alias("prompt"))


@query("templates", "SELECT n_nationkey, 'Hello, ' || n_name || '! (' || lpad(n_regionkey::VARCHAR, 3, '0') || ')' AS greeting FROM nation")
def templates(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", F.format_string("Hello, %s! (%03d)", "n_name", "n_regionkey").alias("greeting"))


@query("observed_pass_through", "SELECT r_regionkey, r_name FROM region")
def observed_pass_through(spark, sf_dir):
    return table(spark, sf_dir, "region").observe("passed", F.count(F.lit(1)).alias("rows"))


@query("header_footer_lines", "SELECT md5(line) AS line, count(DISTINCT doc_id) AS n FROM (SELECT doc_id, trim(unnest(string_split(text, chr(10))), ' ') AS line FROM documents) WHERE line <> '' GROUP BY line HAVING count(DISTINCT doc_id) >= 3")
def header_footer_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).select("doc_id", F.trim("line").alias("line")).where("line <> ''")
    counts = lines.distinct().groupBy("line").agg(F.count(F.lit(1)).alias("n")).where("n >= 3")
    return counts.select(F.md5("line").alias("line"), "n")


@query("sentencizer", r"SELECT doc_id, len(list_filter(list_transform(string_split(regexp_replace(text, '([.!?])[ \t\n\x0b\f\r]+', '\1' || chr(1), 'g'), chr(1)), lambda s: trim(s, ' ')), lambda s: s <> ''))::INT AS n_sentences FROM documents")
def sentencizer(spark, sf_dir):
    from millrace.operators import text

    return table(spark, sf_dir, "documents").select("doc_id", F.size(text.sentences(F.col("text"))).alias("n_sentences"))


@query("prefix_suffix_tokens", r"SELECT item_id, string_agg(t, '|' ORDER BY i) AS tokens FROM (SELECT item_id, unnest(x) AS t, unnest(range(len(x))) AS i FROM (SELECT item_id, regexp_extract_all(text, '[^\s.,!?;:]+|[.,!?;:]') AS x FROM benchmark)) GROUP BY item_id")
def prefix_suffix_tokens(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", F.array_join(F.regexp_extract_all("text", F.lit(r"[^\s.,!?;:]+|[.,!?;:]"), F.lit(0)), "|").alias("tokens"))


@query("character_ids", "SELECT n_nationkey, array_to_string([ascii(n_name[1]), ascii(n_name[2]), ascii(right(n_name, 1))], ',') AS ids FROM nation")
def character_ids(spark, sf_dir):
    ids = F.array(F.ascii("n_name"), F.ascii(F.substring("n_name", 2, 1)), F.ascii(F.right("n_name", F.lit(1))))
    return table(spark, sf_dir, "nation").select("n_nationkey", F.array_join(F.transform(ids, lambda x: x.cast("string")), ",").alias("ids"))


@query(
    "hash_embedding",
    """WITH n AS (SELECT count(*) AS n FROM embeddings), t AS (SELECT item_id, unnest(string_split(text, ' ')) AS t FROM benchmark), r AS (SELECT item_id, ('0x' || left(md5(seed || ':' || t), 8))::BIGINT % n AS row, count(*) AS times FROM t, n, range(4) AS s(seed) GROUP BY ALL),
       e AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row, embedding FROM embeddings), x AS (SELECT item_id, times, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding)))::INT AS dim FROM r JOIN e USING (row)) SELECT item_id, dim, round(sum(x * times), 4) AS value FROM x GROUP BY ALL""",
)
def hash_embedding(spark, sf_dir):
    """Rows of a table of vectors at four hashes of each token, gathered and added: (item_id, dim, value)."""
    vectors = table(spark, sf_dir, "embeddings")
    rows = vectors.withColumn("row", F.row_number().over(Window.orderBy("vec_id")) - 1).select("row", "embedding")
    tokens = table(spark, sf_dir, "benchmark").select("item_id", F.explode(F.split("text", " ")).alias("t"))
    places = tokens.select("item_id", F.explode(F.array(*[F.concat(F.lit(f"{seed}:"), "t") for seed in range(4)])).alias("t"))
    places = places.select("item_id", (F.conv(F.left(F.md5("t"), F.lit(8)), 16, 10).cast("long") % vectors.count()).alias("row")).groupBy("item_id", "row").agg(F.count(F.lit(1)).alias("times"))
    cells = places.join(rows, "row").select("item_id", "times", F.posexplode(F.col("embedding").cast("array<double>")).alias("dim", "x"))
    return cells.groupBy("item_id", "dim").agg(F.round(F.sum(F.col("x") * F.col("times")), 4).alias("value"))


@query("stable_hash", "SELECT event_id, md5('{\"event_type\":\"' || event_type || '\",\"user_id\":' || user_id || '}') AS hash FROM events")
def stable_hash(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.md5(F.to_json(F.struct("event_type", "user_id"))).alias("hash"))


@query("json_round_trip", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) + 1 AS next FROM events")
def json_round_trip(spark, sf_dir):
    parsed = F.from_json(F.to_json(F.from_json("props", "k long")), "k long")
    return table(spark, sf_dir, "events").select("event_id", (parsed["k"] + 1).alias("next"))


@query("json_schema_check", "SELECT event_id, json_extract(props, '$.k') IS NOT NULL AND json_type(props, '$.k') IN ('UBIGINT', 'BIGINT') AS valid FROM events")
def json_schema_check(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long", {"mode": "PERMISSIVE"})["k"].isNotNull().alias("valid"))


@query("cauchy_similarity", "SELECT a.vec_id, round(1 / (1 + list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i: 0.5 * (a.embedding[i]::DOUBLE - b.embedding[i]::DOUBLE) ** 2))), 6) AS score FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def cauchy_similarity(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    both = e.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("x").alias("y")), "vec_id")
    return both.select("vec_id", F.round(V.cauchy(F.col("x"), F.col("y"), F.transform("x", lambda _: F.lit(0.5))), 6).alias("score"))


@query("top_dimensions", "WITH p AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings) SELECT vec_id, round(sum(abs(x)), 5) AS mass, count(*) AS n FROM (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY abs(x) DESC, i) <= 8) GROUP BY vec_id")
def top_dimensions(spark, sf_dir):
    kept = V.keep_largest(F.col("embedding").cast("array<double>"), 8)
    s = table(spark, sf_dir, "embeddings").select("vec_id", kept.alias("k"))
    return s.select("vec_id", F.round(F.aggregate("k", F.lit(0.0), lambda t, x: t + F.abs(x)), 5).alias("mass"), F.size(F.filter("k", lambda x: x != 0)).cast("long").alias("n"))


@query("layer_pooling", "SELECT label, i, round(sum(w * x) / sum(w), 6) AS pooled FROM (SELECT label, (vec_id % 4 + 1) AS w, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings) GROUP BY label, i")
def layer_pooling(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("label", (F.col("vec_id") % 4 + 1).alias("w"), F.posexplode(F.col("embedding").cast("array<double>")).alias("i", "x"))
    return rows.groupBy("label", "i").agg(F.round(F.sum(F.col("w") * F.col("x")) / F.sum("w"), 6).alias("pooled"))


@query("column_mean_squares", "SELECT round(sum(m * m), 6) AS loss FROM (SELECT i, avg(x) AS m FROM (SELECT unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings) GROUP BY i)")
def column_mean_squares(spark, sf_dir):
    means = table(spark, sf_dir, "embeddings").select(F.posexplode(F.col("embedding").cast("array<double>")).alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m"))
    return means.agg(F.round(F.sum(F.col("m") * F.col("m")), 6).alias("loss"))


@query("padded_lists", "WITH m AS (SELECT max(n) AS n FROM (SELECT count(*) AS n FROM conversations GROUP BY conv_id)), l AS (SELECT conv_id, list(role ORDER BY turn) AS a FROM conversations GROUP BY conv_id) SELECT conv_id, array_to_string(list_resize(a, n, '-'), ',') AS padded FROM l, m")
def padded_lists(spark, sf_dir):
    lists = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role"))).alias("a"))
    longest = lists.agg(F.max(F.size("a")).alias("n")).first()["n"]
    return lists.select("conv_id", F.array_join(V.pad(F.col("a.role"), F.lit(longest), "-"), ",").alias("padded"))


@query(
    "translation_matches",
    """WITH s AS (SELECT a.vec_id, c.vec_id AS other, list_cosine_similarity(a.embedding::DOUBLE[], list_transform(c.embedding::DOUBLE[], lambda v: v + 0.3)) AS s FROM embeddings a JOIN embeddings c ON a.vec_id % 50 = 0),
       t AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY round(s, 9) DESC, other) = 1) SELECT count(*) AS n, avg((vec_id = other)::INT) AS accuracy FROM t""",
)
def translation_matches(spark, sf_dir):
    """Share of the queries whose own target is the nearest of all targets."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    targets = vectors.select("vec_id", F.transform("embedding", lambda v: v + 0.3).alias("embedding"))
    asked = vectors.where("vec_id % 50 = 0").select((-1 - F.col("vec_id")).alias("vec_id"), "embedding")  # names apart from the targets'
    best = ranking.vector_top_k(targets, asked, 1)
    return best.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("vec_id") == -1 - F.col("qid")).cast("int")).alias("accuracy"))


@query(
    "retrieval_at_depths",
    """WITH r AS (SELECT o_custkey AS qid, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) - 1 AS rank, (o_orderpriority = '1-URGENT')::INT AS hit FROM orders)
       SELECT qid, k, round(sum(hit) FILTER (rank < k) / k, 6) AS precision, coalesce(max(hit) FILTER (rank < k), 0)::DOUBLE AS accuracy FROM r, (VALUES (1), (3), (10)) AS v(k) GROUP BY qid, k""",
)
def retrieval_at_depths(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    order = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    run = orders.select(F.col("o_custkey").alias("qid"), F.col("o_orderkey").alias("doc_id"), (F.row_number().over(order) - 1).alias("rank"))
    truth = orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("qid"), F.col("o_orderkey").alias("doc_id"))
    hits = metrics.ranked_hits(run, truth)
    out = None
    for k in (1, 3, 10):
        one = metrics.by_query(hits, k=k).select("qid", F.lit(k).alias("k"), F.round("precision", 6).alias("precision"), F.col("recall_single").alias("accuracy"))
        out = one if out is None else out.unionByName(one)
    return out


@query("recursive_reach", "WITH RECURSIVE r AS (SELECT n_nationkey AS node, 0 AS depth FROM nation WHERE n_nationkey < 3 UNION ALL SELECT node + 3, depth + 1 FROM r WHERE node + 3 < 25) SELECT node, depth FROM r")
def recursive_reach(spark, sf_dir):
    table(spark, sf_dir, "nation").createOrReplaceTempView("reach_nation")
    return spark.sql("WITH RECURSIVE r AS (SELECT CAST(n_nationkey AS INT) AS node, 0 AS depth FROM reach_nation WHERE n_nationkey < 3 UNION ALL SELECT node + 3, depth + 1 FROM r WHERE node + 3 < 25) SELECT node, depth FROM r")


@query("table_catalog", "SELECT 'nation' AS name, count(*) AS n FROM nation UNION ALL SELECT 'region', count(*) FROM region")
def table_catalog(spark, sf_dir):
    parts = [table(spark, sf_dir, n).agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n")) for n in ("nation", "region")]
    return parts[0].unionByName(parts[1])


@query("approximate_aggregates", "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, true AS parts_close, true AS median_close FROM lineitem GROUP BY l_returnflag")
def approximate_aggregates(spark, sf_dir):
    """Exact counts, and whether the sketches come within three standard errors and the rank error asked for."""
    lines = table(spark, sf_dir, "lineitem")
    sketches = lines.groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"), F.approx_count_distinct("l_partkey", 0.02).alias("about"), F.percentile_approx("l_extendedprice", 0.5, 1000).alias("median"))
    ranks = lines.join(F.broadcast(sketches.select("l_returnflag", "median")), "l_returnflag").groupBy("l_returnflag").agg(F.avg((F.col("l_extendedprice") <= F.col("median")).cast("int")).alias("rank"))
    close = sketches.join(ranks, "l_returnflag")
    return close.select("l_returnflag", "parts", (F.abs(F.col("about") - F.col("parts")) <= 0.06 * F.col("parts")).alias("parts_close"), (F.abs(F.col("rank") - 0.5) <= 0.005).alias("median_close"))


@query("user_functions", "SELECT event_id, round(value * 2 + 1, 4) AS y FROM events")
def user_functions(spark, sf_dir):
    """A registered vectorised function, called from SQL."""
    from millrace.functions import registration

    def twice_plus_one(x: pd.Series) -> pd.Series:
        return x * 2 + 1

    registration.scalar(spark, "twice_plus_one", "double", twice_plus_one)
    return table(spark, sf_dir, "events").select("event_id", F.round(F.call_function("twice_plus_one", F.col("value")), 4).alias("y"))
