"""Queries of filters and routers."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from millrace.operators import filters, routers
from millrace.plans.registry import query, table


@query("filter_tree", "SELECT doc_id, lang, source, n_chars FROM documents WHERE (lang = 'en' AND n_chars >= 1000) OR (source IN ('src1', 'src2') AND NOT (n_chars < 500 AND lang IN ('de', 'fr')))")
def filter_tree(spark, sf_dir):
    tree = {
        "operator": "OR",
        "conditions": [
            {"operator": "AND", "conditions": [{"field": "lang", "operator": "==", "value": "en"}, {"field": "n_chars", "operator": ">=", "value": 1000}]},
            {"operator": "AND", "conditions": [
                {"field": "source", "operator": "in", "value": ["src1", "src2"]},
                {"operator": "NOT", "conditions": [{"field": "n_chars", "operator": "<", "value": 500}, {"field": "lang", "operator": "in", "value": ["de", "fr"]}]},
            ]},
        ],
    }
    return table(spark, sf_dir, "documents").where(filters.compile_filter(tree)).select("doc_id", "lang", "source", "n_chars")


@query("filter_nested_field", "SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) > 50 AND event_type <> 'view'")
def filter_nested_field(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("meta", F.from_json("props", "k long"))
    tree = {"operator": "AND", "conditions": [{"field": "meta.k", "operator": ">", "value": 50}, {"field": "event_type", "operator": "!=", "value": "view"}]}
    return events.where(filters.compile_filter(tree)).select("event_id", "event_type", F.col("meta.k").alias("k"))


@query("filter_legacy_form", "SELECT doc_id FROM documents WHERE lang = 'en' AND n_chars >= 100 AND n_chars < 3000 AND (source IN ('src3', 'src4') OR n_chars > 2000)")
def filter_legacy_form(spark, sf_dir):
    old = {"$and": {"lang": {"$eq": "en"}, "n_chars": {"$gte": 100, "$lt": 3000}, "$or": {"source": {"$in": ["src3", "src4"]}, "n_chars": {"$gt": 2000}}}}
    return table(spark, sf_dir, "documents").where(filters.compile_filter(filters.from_legacy(old))).select("doc_id")


@query("filter_attributes", "SELECT vec_id, label FROM embeddings WHERE label >= 3 AND (label <> 5 OR vec_id < 100)")
def filter_attributes(spark, sf_dir):
    tree = {"type": "and", "filters": [{"type": "gte", "key": "label", "value": 3}, {"type": "or", "filters": [{"type": "ne", "key": "label", "value": 5}, {"type": "lt", "key": "vec_id", "value": 100}]}]}
    return table(spark, sf_dir, "embeddings").where(filters.compile_filter(filters.from_attributes(tree))).select("vec_id", "label")


@query("filter_dates", "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1995-06-01' AND o_orderdate < TIMESTAMP '1995-09-01 12:00:00'")
def filter_dates(spark, sf_dir):
    """A day without zone, and a moment two hours ahead of UTC."""
    later = datetime(1995, 9, 1, 14, tzinfo=timezone(timedelta(hours=2)))
    tree = {"operator": "AND", "conditions": [{"field": "o_orderdate", "operator": ">=", "value": "1995-06-01"}, {"field": "o_orderdate", "operator": "<", "value": later}]}
    return table(spark, sf_dir, "orders").where(filters.compile_filter(tree)).select("o_orderkey")


@query("filter_retriever_count", "SELECT lang, count(*) AS n_documents FROM documents WHERE n_chars > 1000 GROUP BY lang")
def filter_retriever_count(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(filters.compare(F.col("n_chars"), ">", 1000)).groupBy("lang").agg(F.count(F.lit(1)).alias("n_documents"))


@query(
    "mask_filter",
    """
    SELECT o_custkey, array_to_string(list_filter(prices, lambda p: p > 100000), ',') AS dropped,
           array_to_string(list_transform(list_filter(flagged, lambda f: f.m IS NULL OR f.m), lambda f: CASE WHEN f.m THEN f.p::VARCHAR ELSE 'null' END), ',') AS emitted
    FROM (SELECT o_custkey, list(p ORDER BY o_orderkey) AS prices,
                 list({'p': p, 'm': CASE WHEN s = 'P' THEN NULL ELSE p > 100000 END} ORDER BY o_orderkey) AS flagged
          FROM (SELECT o_custkey, o_orderkey, o_orderstatus AS s, CAST(floor(o_totalprice) AS BIGINT) AS p FROM orders) GROUP BY o_custkey)
    """,
)
def mask_filter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_orderstatus").alias("s"), F.floor("o_totalprice").cast("long").alias("p"))
    lists = orders.groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "p", "s"))).alias("a"))
    values = F.col("a.p")
    strict, loose = F.transform("a", lambda x: x["p"] > 100000), F.transform("a", lambda x: F.when(x["s"] != "P", x["p"] > 100000))
    text = lambda a: F.array_join(F.transform(a, lambda x: x.cast("string")), ",", "null")
    return lists.select("o_custkey", text(filters.mask_filter(values, strict)).alias("dropped"), text(filters.mask_filter(values, loose, emit_null=True)).alias("emitted"))


@query(
    "string_checks",
    """SELECT doc_id, lang = 'en' AS is_eq, lang <> 'en' AS is_ne, contains(text, 'the ') AS is_like, contains(lower(text), 'the ') AS is_ilike FROM documents""",
)
def string_checks(spark, sf_dir):
    text, lang = F.col("text"), F.col("lang")
    return table(spark, sf_dir, "documents").select(
        "doc_id", filters.string_check("eq", lang, "en").alias("is_eq"), filters.string_check("ne", lang, "en").alias("is_ne"),
        filters.string_check("like", text, "the ").alias("is_like"), filters.string_check("ilike", text, "The ").alias("is_ilike"),
    )


@query(
    "number_tokens",
    r"""
    SELECT doc_id, count(*) AS n_numbers FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS t FROM documents)
    WHERE regexp_full_match(replace(replace(regexp_replace(t, '^[+\-~±]', ''), ',', ''), '.', ''), '[0-9]+|[0-9]+/[0-9]+|[0-9]+(st|nd|rd|th)|(?i:zero|one|two|three|four|five|six|seven|eight|nine|ten)')
    GROUP BY doc_id
    """,
)
def number_tokens(spark, sf_dir):
    tokens = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", " ")).alias("t"))
    return tokens.where(filters.like_number(F.col("t"))).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_numbers"))


@query("url_test", r"SELECT page_id, regexp_matches(url, '^(?i)(https?|ftp)://[^\s/$.?#][^\s]*$') AS is_url FROM pages")
def url_test(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", filters.like_url(F.col("url")).alias("is_url"))


@query("length_router", "SELECT CASE WHEN text IS NULL OR length(text) <= 1000 THEN 'short_documents' ELSE 'long_documents' END AS route, count(*) AS n FROM documents GROUP BY route")
def length_router(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(routers.by_length(F.col("text"), 1000).alias("route")).agg(F.count(F.lit(1)).alias("n"))


@query("language_router", "SELECT doc_id, CASE WHEN lang IN ('en', 'de') THEN lang ELSE 'unmatched' END AS route FROM documents")
def language_router(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", routers.by_language(F.col("lang"), ["en", "de"]).alias("route"))


@query(
    "value_routers",
    """SELECT event_id, CASE WHEN value < 50 THEN 'below' ELSE 'above' END AS threshold, CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS parity,
              'remainder_is_' || (user_id % 3) AS remainder, CASE WHEN value > 90 THEN 'top' WHEN event_type = 'click' THEN 'clicks' ELSE 'rest' END AS conditional FROM events""",
)
def value_routers(spark, sf_dir):
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id", routers.by_threshold(value, 50).alias("threshold"), routers.by_parity(F.col("event_id")).alias("parity"), routers.by_remainder(F.col("user_id"), 3).alias("remainder"),
        routers.by_conditions([(value > 90, "top"), (F.col("event_type") == "click", "clicks")], "rest").alias("conditional"),
    )


@query(
    "file_type_router",
    r"""SELECT page_id, CASE lower(regexp_extract(url, '\.([A-Za-z0-9]+)(?:[?#].*)?$', 1)) WHEN 'html' THEN 'text/html' WHEN 'htm' THEN 'text/html' WHEN 'json' THEN 'application/json'
        WHEN 'txt' THEN 'text/plain' WHEN 'pdf' THEN 'application/pdf' WHEN 'md' THEN 'text/markdown' WHEN 'csv' THEN 'text/csv' WHEN 'png' THEN 'image/png' WHEN 'jpg' THEN 'image/jpeg' ELSE 'unclassified' END AS mime FROM pages""",
)
def file_type_router(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.coalesce(routers.mime_of_path(F.col("url")), F.lit("unclassified")).alias("mime"))


@query(
    "metadata_router",
    """SELECT doc_id, route FROM (SELECT doc_id, 'english' AS route FROM documents WHERE lang = 'en' UNION ALL SELECT doc_id, 'long' FROM documents WHERE n_chars > 3000
       UNION ALL SELECT doc_id, 'unmatched' FROM documents WHERE NOT (lang = 'en' OR n_chars > 3000))""",
)
def metadata_router(spark, sf_dir):
    rules = {"english": filters.compare(F.col("lang"), "==", "en"), "long": filters.compare(F.col("n_chars"), ">", 3000)}
    return routers.by_rules(table(spark, sf_dir, "documents"), rules).select("doc_id", "route")


@query("repeat_fan_out", "SELECT r_regionkey, output FROM region, (VALUES ('a'), ('b'), ('c')) AS v(output)")
def repeat_fan_out(spark, sf_dir):
    return table(spark, sf_dir, "region").select("r_regionkey", F.explode(F.array(*[F.lit(x) for x in "abc"])).alias("output"))
