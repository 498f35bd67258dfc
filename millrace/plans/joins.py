"""Queries of joiners, merges and lookups."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import joining
from millrace.plans.registry import query, table


def _runs(spark, sf_dir):
    """Two ranked lists per customer: by price and by recency."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("qid"), F.col("o_orderkey").alias("doc_id"), "o_totalprice", "o_orderdate", "o_orderstatus")
    a = orders.where("o_orderstatus <> 'P'").select("qid", "doc_id", F.floor("o_totalprice").cast("double").alias("score"))
    b = orders.where("o_orderstatus <> 'F'").select("qid", "doc_id", F.datediff(F.col("o_orderdate").cast("date"), F.lit("1990-01-01").cast("date")).cast("double").alias("score"))
    return a, b


_A = "SELECT o_custkey AS qid, o_orderkey AS doc_id, floor(o_totalprice)::DOUBLE AS score FROM orders WHERE o_orderstatus <> 'P'"
_B = "SELECT o_custkey AS qid, o_orderkey AS doc_id, date_diff('day', DATE '1990-01-01', o_orderdate::DATE)::DOUBLE AS score FROM orders WHERE o_orderstatus <> 'F'"


@query("join_concatenate", f"SELECT qid, doc_id, max(score) AS score FROM ({_A} UNION ALL {_B}) GROUP BY qid, doc_id QUALIFY row_number() OVER (PARTITION BY qid ORDER BY max(score) DESC, doc_id) <= 3")
def join_concatenate(spark, sf_dir):
    return joining.join_results(list(_runs(spark, sf_dir)), "concatenate", top_k=3)


@query("join_merge", f"SELECT qid, doc_id, round(sum(score), 4) AS score FROM (SELECT qid, doc_id, score * 0.75 AS score FROM ({_A}) UNION ALL SELECT qid, doc_id, score * 0.25 FROM ({_B})) GROUP BY qid, doc_id")
def join_merge(spark, sf_dir):
    return joining.join_results(list(_runs(spark, sf_dir)), "merge", weights=[3, 1]).withColumn("score", F.round("score", 4))


@query(
    "join_reciprocal_rank_fusion",
    f"""SELECT qid, doc_id, round(sum(1.0 / (60 + r)), 8) AS score FROM (
        SELECT qid, doc_id, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS r FROM ({_A}) UNION ALL
        SELECT qid, doc_id, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS r FROM ({_B})) GROUP BY qid, doc_id""",
)
def join_reciprocal_rank_fusion(spark, sf_dir):
    return joining.join_results(list(_runs(spark, sf_dir)), "reciprocal_rank_fusion").withColumn("score", F.round("score", 8))


@query(
    "join_distribution_based",
    f"""SELECT qid, doc_id, round(max(s), 6) AS score FROM (
        SELECT qid, doc_id, CASE WHEN d > 0 THEN (score - (m - 3 * d)) / (6 * d) ELSE 0 END AS s FROM (SELECT *, avg(score) OVER (PARTITION BY qid) AS m, stddev_pop(score) OVER (PARTITION BY qid) AS d FROM ({_A})) UNION ALL
        SELECT qid, doc_id, CASE WHEN d > 0 THEN (score - (m - 3 * d)) / (6 * d) ELSE 0 END AS s FROM (SELECT *, avg(score) OVER (PARTITION BY qid) AS m, stddev_pop(score) OVER (PARTITION BY qid) AS d FROM ({_B}))) GROUP BY qid, doc_id""",
)
def join_distribution_based(spark, sf_dir):
    return joining.join_results(list(_runs(spark, sf_dir)), "distribution_based").withColumn("score", F.round("score", 6))


@query("list_joiner", "SELECT 0 AS part, n_nationkey AS key, n_name AS name FROM nation UNION ALL SELECT 1, r_regionkey, r_name FROM region")
def list_joiner(spark, sf_dir):
    frames = [table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name")), table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name"))]
    return joining.union_all(frames, "part")


@query("string_joiner", "SELECT n_regionkey, string_agg(n_name, ' ' ORDER BY n_nationkey) AS joined, len(list(n_name))::INT AS n FROM nation GROUP BY n_regionkey")
def string_joiner(spark, sf_dir):
    lists = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("a"))
    return lists.select("n_regionkey", F.array_join("a.n_name", " ").alias("joined"), F.size("a").alias("n"))


@query("string_list_joiner", "SELECT conv_id, array_to_string(flatten(list(string_split(role, 's') ORDER BY turn)), '|') AS parts FROM conversations GROUP BY conv_id")
def string_list_joiner(spark, sf_dir):
    lists = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role"))).alias("a"))
    return lists.select("conv_id", F.array_join(F.flatten(F.transform("a", lambda x: F.split(x["role"], "s"))), "|").alias("parts"))


@query("state_append", "SELECT user_id, array_to_string(list(event_type ORDER BY event_id), ',') AS merged FROM events GROUP BY user_id")
def state_append(spark, sf_dir):
    states = table(spark, sf_dir, "events").groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("event_id", "event_type"))).alias("a"))
    first, rest = F.transform(F.slice("a", 1, 1), lambda x: x["event_type"]), F.transform(F.slice(F.col("a"), F.lit(2), F.greatest(F.lit(0), F.size("a") - 1)), lambda x: x["event_type"])
    return states.select("user_id", F.array_join(joining.merge_state(first, rest, append=True), ",").alias("merged"))


@query("state_replace", "SELECT user_id, arg_max(event_type, event_id) AS last_type, arg_max(value, event_id) AS last_value FROM events GROUP BY user_id")
def state_replace(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("last_type"), F.max_by("value", "event_id").alias("last_value"))


@query("dictionary_lookup", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE -1 END AS code FROM orders")
def dictionary_lookup(spark, sf_dir):
    return joining.lookup(table(spark, sf_dir, "orders"), "o_orderstatus", {"F": 1, "O": 2}, -1, "code").select("o_orderkey", "code")


@query("compute_once", "SELECT doc_id, md5(source) AS digest FROM documents")
def compute_once(spark, sf_dir):
    return joining.compute_once(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", F.md5("source"), "digest").select("doc_id", "digest")


@query("positional_zip", "SELECT a.doc_id, a.quality, b.n_chars FROM labels a JOIN documents b USING (doc_id)")
def positional_zip(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    sizes = table(spark, sf_dir, "documents").join(labels.select("doc_id"), "doc_id", "left_semi").select("doc_id", "n_chars")
    return joining.zip_rows(labels, sizes, "doc_id")


@query("membership_join", "SELECT event_id, user_id IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS is_member FROM events")
def membership_join(spark, sf_dir):
    members = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("user_id")).distinct().withColumn("_m", F.lit(True))
    return table(spark, sf_dir, "events").join(members, "user_id", "left").select("event_id", F.coalesce("_m", F.lit(False)).alias("is_member"))


@query("cache_checker", "SELECT user_id, count(*) FILTER (c_custkey IS NOT NULL) AS hits, count(*) FILTER (c_custkey IS NULL) AS misses FROM events LEFT JOIN customer ON user_id = c_custkey AND c_acctbal > 0 GROUP BY user_id")
def cache_checker(spark, sf_dir):
    store = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"))
    items = table(spark, sf_dir, "events").select("user_id")
    hits, misses = items.join(store, "user_id"), items.join(store, "user_id", "left_anti")
    both = hits.withColumn("hit", F.lit(1)).unionAll(misses.withColumn("hit", F.lit(0)))
    return both.groupBy("user_id").agg(F.sum("hit").alias("hits"), F.sum(1 - F.col("hit")).alias("misses"))


@query("span_extraction", "SELECT doc_id, array_to_string(list_slice(w, 2, 4), ' ') AS first_span, array_to_string(list_slice(w, 3, 6), ' ') AS second_span FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)")
def span_extraction(spark, sf_dir):
    spans = F.array(F.struct(F.lit(1).alias("start"), F.lit(4).alias("end")), F.struct(F.lit(2).alias("start"), F.lit(6).alias("end")))
    docs = table(spark, sf_dir, "documents").select("doc_id", joining.span_slices(F.split("text", " "), spans).alias("s"))
    return docs.select("doc_id", F.array_join(F.get("s", F.lit(0)), " ").alias("first_span"), F.array_join(F.get("s", F.lit(1)), " ").alias("second_span"))


@query("token_alignment", "SELECT conv_id, turn, array_to_string(list_transform(range(len(role)), lambda i: CASE WHEN i < 2 THEN 0 ELSE 1 END), ',') AS aligned FROM conversations")
def token_alignment(spark, sf_dir):
    left, right = F.split("role", ""), F.array(F.substring("role", 1, 2), F.substring("role", 3, 100))
    aligned = F.flatten(joining.align(left, right))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array_join(F.transform(aligned, lambda i: i.cast("string")), ",").alias("aligned"))


@query("schema_unification", "SELECT n_name AS name, n_regionkey AS region, NULL::DOUBLE AS balance FROM nation UNION ALL SELECT s_name, NULL, s_acctbal FROM supplier")
def schema_unification(spark, sf_dir):
    a = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return joining.union_all([a, b])


@query("as_of_join", "SELECT e.event_id, o.o_orderkey FROM events e ASOF LEFT JOIN (SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL) o ON e.user_id = o.o_custkey AND e.ts >= o.o_orderdate")
def as_of_join(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id"), "o_orderdate", "o_orderkey")
    return joining.as_of(events, orders, "user_id", "ts", "o_orderdate", ["o_orderkey"]).select("event_id", "o_orderkey")


@query("range_join", "SELECT p.p_partkey, s.s_suppkey FROM part p JOIN supplier s ON p.p_retailprice >= abs(s.s_acctbal) AND p.p_retailprice < abs(s.s_acctbal) + 50")
def range_join(spark, sf_dir):
    ranges = table(spark, sf_dir, "supplier").select("s_suppkey", F.abs("s_acctbal").alias("low"), (F.abs("s_acctbal") + 50).alias("high"))
    points = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return joining.range_join(points, ranges, "p_retailprice", "low", "high", 50.0).select("p_partkey", "s_suppkey")


@query("branch_joiner", "SELECT conv_id, turn, coalesce(CASE WHEN role = 'user' THEN text END, CASE WHEN role = 'assistant' THEN upper(role) END, 'none') AS value FROM conversations")
def branch_joiner(spark, sf_dir):
    user, other = F.when(F.col("role") == "user", F.col("text")), F.when(F.col("role") == "assistant", F.upper("role"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce(user, other, F.lit("none")).alias("value"))


@query("answer_joiner", "SELECT source, doc_id, n_chars FROM (SELECT source, doc_id, n_chars FROM documents WHERE lang = 'en' UNION ALL SELECT source, doc_id, n_chars FROM documents WHERE lang <> 'en') QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) <= 5")
def answer_joiner(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars", "lang")
    both = joining.union_all([docs.where("lang = 'en'"), docs.where("lang <> 'en'")])
    order = Window.partitionBy("source").orderBy(F.desc("n_chars"), "doc_id")
    return both.withColumn("_r", F.row_number().over(order)).where("_r <= 5").select("source", "doc_id", "n_chars")
