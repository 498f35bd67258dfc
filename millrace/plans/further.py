"""Queries of languages, file formats, chunks, text graders, further objectives, validation and time zones."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import vectors as V
from millrace.operators import metrics, ranking, routers
from millrace.operators import text as T
from millrace.operators import tokens as K
from millrace.plans.registry import query, table
from millrace.sources import arrow_files, scratch, store

_LANGUAGES = ", ".join(
    f"{{'n': len(list_filter(w, lambda t: t IN ({', '.join(repr(x) for x in words)}))), 'i': {-i}, 'l': '{name}'}}" for i, (name, words) in enumerate(routers.MARKER_WORDS.items())
)


@query(
    "language_detection",
    rf"""WITH t AS (SELECT doc_id, lang, regexp_split_to_array(lower(text), '[^\pL]+') AS w FROM documents), b AS (SELECT doc_id, lang, list_max([{_LANGUAGES}]) AS b FROM t)
        SELECT doc_id, CASE WHEN b.n > 0 THEN b.l END AS detected, CASE WHEN b.n > 0 AND b.l IN ('en', 'de') THEN b.l ELSE 'unmatched' END AS route FROM b""",
)
def language_detection(spark, sf_dir):
    """Language of each text by its marker words, and the router over it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", routers.language_of(F.col("text")).alias("detected"))
    return docs.select("doc_id", "detected", routers.by_language(F.col("detected"), ["en", "de"]).alias("route"))


def _again(df, layout: str, **options):
    """``df`` written in a layout of Spark's and read back."""
    path = scratch.folder(df.sparkSession, layout)
    df.write.format(layout).options(**options).save(path)
    return df.sparkSession.read.format(layout).schema(df.schema).options(**options).load(path)


_SUPPLIER = "SELECT s_suppkey, s_name, s_acctbal FROM supplier"


def _supplier(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")


@query("csv_files_again", _SUPPLIER)
def csv_files_again(spark, sf_dir):
    return _again(_supplier(spark, sf_dir), "csv", header=True, compression="gzip")


@query("json_files_again", "SELECT conv_id, turn, role, text FROM conversations")
def json_files_again(spark, sf_dir):
    return _again(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), "json")


@query("text_files_again", "SELECT md5(n_name) AS digest FROM nation")
def text_files_again(spark, sf_dir):
    return _again(table(spark, sf_dir, "nation").select(F.col("n_name").alias("value")), "text", compression="bzip2").select(F.md5("value").alias("digest"))


def _arrow(df, layout: str):
    spark = df.sparkSession
    arrow_files.register(spark)
    path = scratch.folder(spark, "arrow")
    df.write.format("arrow_ipc").option("layout", layout).mode("append").save(path)
    return spark.read.format("arrow_ipc").schema(df.schema).load(path)


@query("arrow_files_again", _SUPPLIER)
def arrow_files_again(spark, sf_dir):
    """Written in the IPC file format with all columns; the scan reads three."""
    full = _arrow(table(spark, sf_dir, "supplier"), "file")
    return full.select("s_suppkey", "s_name", "s_acctbal")


@query("arrow_streams_again", "SELECT vec_id, label, embedding[1]::DOUBLE AS first FROM embeddings")
def arrow_streams_again(spark, sf_dir):
    return _arrow(table(spark, sf_dir, "embeddings"), "stream").select("vec_id", "label", F.get("embedding", F.lit(0)).cast("double").alias("first"))


@query("csv_append", "SELECT r_regionkey, r_name FROM region UNION ALL SELECT n_regionkey, n_name FROM nation")
def csv_append(spark, sf_dir):
    path = scratch.folder(spark, "csv-append")
    rows = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    store.append_csv(rows, path)
    store.append_csv(table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("r_regionkey"), F.col("n_name").alias("r_name")), path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


@query("delete_documents", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5)")
def delete_documents(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return store.delete(rows, rows.where("c_nationkey < 5").select("c_custkey"), "c_custkey").select("c_custkey", "c_name")


@query("collections", "SELECT 'english' AS collection, count(*) AS n FROM documents WHERE lang = 'en' UNION ALL SELECT 'other', count(*) FROM documents WHERE lang <> 'en'")
def collections(spark, sf_dir):
    """Two collections written side by side; each is a partition of one table."""
    path, docs = scratch.folder(spark, "collections"), table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    for name, rows in (("english", docs.where("lang = 'en'")), ("other", docs.where("lang <> 'en'"))):
        store.write_collection(rows, path, name)
    return spark.read.parquet(path).groupBy("collection").agg(F.count(F.lit(1)).alias("n"))


@query("limits", "SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 5")
def limits(spark, sf_dir):
    return table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(5).limit(25).select("o_orderkey")


@query(
    "scaled_retrieval",
    """SELECT q.vec_id AS qid, e.vec_id, round(1 / (1 + exp(-list_dot_product(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) / 100)), 6) AS score, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(1 / (1 + exp(-list_dot_product(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) / 100)), 9) DESC, e.vec_id) AS rank
       FROM embeddings q JOIN embeddings e ON q.vec_id % 50 = 0 AND q.vec_id <> e.vec_id QUALIFY rank <= 3""",
)
def scaled_retrieval(spark, sf_dir):
    """Dot products squeezed by a sigmoid."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ranking.vector_top_k(vectors, vectors.where("vec_id % 50 = 0"), 3, "dot", scale=True).withColumn("score", F.round("score", 6))


@query("diversity_ranker", None)
def diversity_ranker(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = ranking.vector_top_k(vectors, vectors.where("vec_id % 50 = 0"), 8).join(vectors, "vec_id")
    return ranking.diverse_order(found, "qid", "vec_id", "score", "embedding")


@query(
    "phrase_tokenizer",
    r"""SELECT item_id, md5(array_to_string(list_filter(string_split(regexp_replace(regexp_replace(regexp_replace(' ' || array_to_string(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> ''), '  ') || ' ', '(?i) and  of  the ', ' and_of_the ', 'g'), '(?i) in  the ', ' in_the ', 'g'), '(?i) of  the ', ' of_the ', 'g'), ' '), lambda x: x <> ''), '|')) AS tokens FROM benchmark""",
)
def phrase_tokenizer(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", F.md5(F.array_join(K.join_phrases(F.col("text"), ["of the", "and of the", "in the"]), "|")).alias("tokens"))


def _cut(texts, target: int, table_: np.ndarray):
    """Content-defined chunks of each text's bytes by a rolling gear hash: target/8 at least, 2 * target at most, target on average."""
    least, most, mask = target // 8, 2 * target, np.uint64((target - 1) << (64 - target.bit_length() + 1))
    for text in texts:
        data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
        # the hash of the last 64 bytes: each byte's entry, shifted by its distance
        h = np.zeros(len(data), np.uint64)
        with np.errstate(over="ignore"):
            gear = table_[data]
            for k in range(min(64, len(data))):
                h[k:] += gear[: len(data) - k] << np.uint64(k)
        cuts, at, out = np.flatnonzero((h & mask) == 0) + 1, 0, []
        while at < len(data):
            i = np.searchsorted(cuts, at + least)
            end = int(min(len(data), at + most, cuts[i] if i < len(cuts) else len(data)))
            out.append((at, end - at, data[at:end].tobytes()))
            at = end
        yield out


@query("content_chunks", None)
def content_chunks(spark, sf_dir):
    """(doc_id, chunk, start, length, hash): boundaries depend on the bytes around them alone, so equal passages give equal chunks."""
    gear = np.random.default_rng(64).integers(0, 2**64, 256, dtype=np.uint64)

    def run(batches):
        import hashlib

        for batch in batches:
            rows = [(i, n, s, m, hashlib.sha256(b).hexdigest()) for i, chunks in zip(batch.column(0).to_pylist(), _cut(batch.column(1).to_pylist(), 512, gear), strict=True) for n, (s, m, b) in enumerate(chunks)]
            yield pa.RecordBatch.from_pylist([dict(zip(("doc_id", "chunk", "start", "length", "hash"), r, strict=True)) for r in rows], schema=pa.schema([("doc_id", pa.int64()), ("chunk", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("hash", pa.string())]))

    return table(spark, sf_dir, "documents").select("doc_id", "text").mapInArrow(run, "doc_id long, chunk int, start long, length long, hash string")


@query("byte_groups", "WITH b AS (SELECT n_nationkey, list_transform(range(length(hex(encode(n_comment))) // 2), lambda i: hex(encode(n_comment))[2 * i + 1 : 2 * i + 2]) AS b FROM (SELECT n_nationkey, n_name || ' of region ' || n_regionkey AS n_comment FROM nation)) SELECT n_nationkey, array_to_string(flatten(list_transform(range(4), lambda g: list_filter(b, lambda x, i: (i - 1) % 4 = g))), '') AS grouped FROM b")
def byte_groups(spark, sf_dir):
    """Every fourth byte beside each other, as hex."""
    data = F.concat("n_name", F.lit(" of region "), F.col("n_regionkey").cast("string"))
    return table(spark, sf_dir, "nation").select("n_nationkey", T.byte_groups(data).alias("grouped"))


_GRAMS = " UNION ALL ".join(f"SELECT conv_id, {n} AS n, unnest(list_transform(range(1, len(w) - {n - 1} + 1), lambda i: array_to_string(w[i:i + {n - 1}], ' '))) AS g FROM t WHERE len(w) >= {n}" for n in range(1, 5))


@query(
    "bleu_and_gleu",
    f"""WITH u AS (SELECT conv_id, max(text) FILTER (turn = 0) AS a, max(text) FILTER (turn = 1) AS b FROM conversations GROUP BY conv_id HAVING count(*) FILTER (turn = 1) > 0 AND count(*) FILTER (turn = 0) > 0),
        p AS (SELECT conv_id, n, g, count(*) AS c FROM (WITH t AS (SELECT conv_id, list_filter(regexp_split_to_array(lower(a), '\\s+'), lambda x: x <> '') AS w FROM u) {_GRAMS}) GROUP BY ALL),
        q AS (SELECT conv_id, n, g, count(*) AS c FROM (WITH t AS (SELECT conv_id, list_filter(regexp_split_to_array(lower(b), '\\s+'), lambda x: x <> '') AS w FROM u) {_GRAMS}) GROUP BY ALL),
        j AS (SELECT coalesce(p.conv_id, q.conv_id) AS conv_id, coalesce(p.n, q.n) AS n, coalesce(p.c, 0) AS pc, coalesce(q.c, 0) AS qc FROM p FULL JOIN q ON p.conv_id = q.conv_id AND p.n = q.n AND p.g = q.g),
        s AS (SELECT conv_id, n, sum(least(pc, qc)) AS c, sum(pc) AS p, sum(qc) AS t FROM j GROUP BY ALL),
        r AS (SELECT conv_id, sum(ln(greatest(c, 0.5) / greatest(p, 1))) / count(*) AS m, max(p) FILTER (n = 1) AS p, max(t) FILTER (n = 1) AS t, sum(c) AS c, sum(s.p) AS ps, sum(s.t) AS ts FROM s GROUP BY conv_id)
        SELECT conv_id, round(CASE WHEN p = 0 THEN 0 WHEN p >= t THEN 1 ELSE exp(1 - t / p) END * exp(m), 6) AS bleu, round(c / greatest(ps, ts), 6) AS gleu FROM r""",
)
def bleu_and_gleu(spark, sf_dir):
    """The first turn of each conversation graded against the second."""
    turn = lambda n: F.max(F.when(F.col("turn") == n, F.col("text")))
    both = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turn(0).alias("a"), turn(1).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    pairs = both.select("conv_id", T.words(F.lower("a")).alias("a"), T.words(F.lower("b")).alias("b"))
    graded = metrics.bleu_and_gleu(pairs, "conv_id", "a", "b")
    return graded.select("conv_id", F.round("bleu", 6).alias("bleu"), F.round("gleu", 6).alias("gleu"))


@query(
    "angle_similarity",
    """WITH p AS (SELECT a.vec_id, a.embedding::DOUBLE[] AS x, b.embedding::DOUBLE[] AS y FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1),
       h AS (SELECT vec_id, x[1:len(x) // 2] AS ra, x[len(x) // 2 + 1 : len(x)] AS ia, y[1:len(y) // 2] AS rb, y[len(y) // 2 + 1 : len(y)] AS ib, list_dot_product(x, x) AS nx, list_dot_product(y, y) AS ny FROM p)
       SELECT vec_id, round(abs((list_dot_product(ra, rb) + list_dot_product(ia, ib) + list_dot_product(ia, rb) - list_dot_product(ra, ib)) / ny / sqrt(nx / ny)), 6) AS score FROM h""",
)
def angle_similarity(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    both = e.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("x").alias("y")), "vec_id")
    return both.select("vec_id", F.round(V.angle(F.col("x"), F.col("y")), 6).alias("score"))


_BATCH = "b AS (SELECT vec_id, vec_id // 16 AS batch, label, embedding::DOUBLE[] AS x FROM embeddings)"


def _pairs(spark, sf_dir):
    """Pairs within batches of 16 vectors, as training batches hold them."""
    b = table(spark, sf_dir, "embeddings").select("vec_id", F.floor(F.col("vec_id") / 16).alias("batch"), "label", F.col("embedding").cast("array<double>").alias("x"))
    other = b.select("batch", F.col("vec_id").alias("other"), F.col("label").alias("l2"), F.col("x").alias("y"))
    return b.join(other, "batch")


@query(
    "symmetric_ranking_loss",
    f"""WITH {_BATCH}, s AS (SELECT a.batch, a.vec_id AS i, c.vec_id AS j, 20 * list_cosine_similarity(a.x, list_transform(c.x, lambda v: v + 0.1)) AS s FROM b a JOIN b c USING (batch)),
        r AS (SELECT batch, i AS k, ln(sum(exp(s))) - max(s) FILTER (i = j) AS l FROM s GROUP BY batch, i), c AS (SELECT batch, j AS k, ln(sum(exp(s))) - max(s) FILTER (i = j) AS l FROM s GROUP BY batch, j)
        SELECT r.batch, round(avg((r.l + c.l) / 2), 5) AS loss FROM r JOIN c ON r.batch = c.batch AND r.k = c.k GROUP BY r.batch""",
)
def symmetric_ranking_loss(spark, sf_dir):
    """Cross entropy of each pair among its row and among its column of the batch's scores."""
    s = _pairs(spark, sf_dir).select("batch", F.col("vec_id").alias("i"), F.col("other").alias("j"), (20 * V.cosine(F.col("x"), F.transform("y", lambda v: v + 0.1))).alias("s"))

    def side(k: str, name: str):
        top = s.withColumn("_t", F.max("s").over(Window.partitionBy("batch", k)))
        loss = F.max("_t") + F.log(F.sum(F.exp(F.col("s") - F.col("_t")))) - F.max(F.when(F.col("i") == F.col("j"), F.col("s")))
        return top.groupBy("batch", F.col(k).alias("k")).agg(loss.alias(name))

    both = side("i", "rows").join(side("j", "columns"), ["batch", "k"])
    return both.groupBy("batch").agg(F.round(F.avg((F.col("rows") + F.col("columns")) / 2), 5).alias("loss"))


@query(
    "semi_hard_triplet",
    f"""WITH {_BATCH}, d AS (SELECT a.batch, a.vec_id, c.vec_id AS other, a.label = c.label AS same, list_distance(a.x, c.x) AS d FROM b a JOIN b c ON a.batch = c.batch AND a.vec_id <> c.vec_id),
        t AS (SELECT p.batch, p.vec_id, p.other, any_value(p.d) AS p, min(n.d) FILTER (n.d > p.d) AS beyond, max(n.d) AS far FROM d p JOIN d n ON p.batch = n.batch AND p.vec_id = n.vec_id AND p.same AND NOT n.same GROUP BY p.batch, p.vec_id, p.other)
        SELECT batch, round(avg(greatest(p - coalesce(beyond, far) + 5, 0)), 5) AS loss FROM t GROUP BY batch""",
)
def semi_hard_triplet(spark, sf_dir):
    """For each anchor and positive the nearest negative beyond the positive, else the farthest negative."""
    d = _pairs(spark, sf_dir).where("vec_id <> other").select("batch", "vec_id", "other", (F.col("label") == F.col("l2")).alias("same"), V.euclidean(F.col("x"), F.col("y")).alias("d"))
    near, far = d.where("same").select("batch", "vec_id", "other", F.col("d").alias("p")), d.where("NOT same").select("batch", "vec_id", F.col("d").alias("n"))
    each = near.join(far, ["batch", "vec_id"]).groupBy("batch", "vec_id", "other").agg(F.first("p").alias("p"), F.min(F.when(F.col("n") > F.col("p"), F.col("n"))).alias("semi"), F.max("n").alias("far"))
    return each.groupBy("batch").agg(F.round(F.avg(F.greatest(F.col("p") - F.coalesce("semi", "far") + 5, F.lit(0.0))), 5).alias("loss"))


@query(
    "margin_to_hardest",
    f"""WITH {_BATCH}, s AS (SELECT a.batch, a.vec_id AS i, c.vec_id AS j, list_cosine_similarity(a.x, list_transform(c.x, lambda v: v + 0.1)) AS s FROM b a JOIN b c USING (batch)),
        r AS (SELECT batch, i, max(s) FILTER (i = j) AS p, max(s) FILTER (i <> j) AS n FROM s GROUP BY batch, i) SELECT batch, round(avg(greatest(0.8 - p, 0) + greatest(n - 0.3, 0)), 5) AS loss FROM r WHERE n IS NOT NULL GROUP BY batch""",
)
def margin_to_hardest(spark, sf_dir):
    """Margins on each positive and on the hardest negative of its batch."""
    s = _pairs(spark, sf_dir).select("batch", "vec_id", (F.col("vec_id") == F.col("other")).alias("own"), V.cosine(F.col("x"), F.transform("y", lambda v: v + 0.1)).alias("s"))
    r = s.groupBy("batch", "vec_id").agg(F.max(F.when(F.col("own"), F.col("s"))).alias("p"), F.max(F.when(~F.col("own"), F.col("s"))).alias("n")).where("n IS NOT NULL")
    return r.groupBy("batch").agg(F.round(F.avg(F.greatest(0.8 - F.col("p"), F.lit(0.0)) + F.greatest(F.col("n") - 0.3, F.lit(0.0))), 5).alias("loss"))


@query("json_schema_rules", "SELECT event_id, json_type(props, '$.k') IN ('UBIGINT', 'BIGINT') AND json_extract(props, '$.k')::BIGINT BETWEEN 10 AND 80 AND len(json_keys(props)) = 1 AS valid FROM events")
def json_schema_rules(spark, sf_dir):
    """Required property, type, bounds, and no further properties."""
    schema = {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer", "minimum": 10, "maximum": 80}}, "additionalProperties": False}
    return table(spark, sf_dir, "events").select("event_id", T.matches_schema(F.col("props"), schema).alias("valid"))


@query("zoned_times", "SELECT event_id, strftime(timezone('Europe/Berlin', timezone('UTC', ts)), '%Y-%m-%d %H:%M') AS berlin, strftime(timezone('Asia/Kolkata', timezone('UTC', ts)), '%Y-%m-%d %H:%M') AS kolkata FROM events")
def zoned_times(spark, sf_dir):
    """A moment in UTC as the clocks of two zones show it, summer time included."""
    moment = F.col("ts").cast("timestamp_ntz")
    at = lambda zone: F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(zone), moment), "yyyy-MM-dd HH:mm")
    return table(spark, sf_dir, "events").select("event_id", at("Europe/Berlin").alias("berlin"), at("Asia/Kolkata").alias("kolkata"))


@query("tidy_text", r"SELECT doc_id, md5(regexp_replace(trim(regexp_replace(text, '[ \t]+', ' ', 'g'), ' '), '\n([ \t]*\n)+', chr(10), 'g')) AS digest FROM documents")
def tidy_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.tidy(F.col("text"))).alias("digest"))


@query(
    "preprocessed_chunks",
    r"""WITH c AS (SELECT doc_id, regexp_replace(trim(regexp_replace(text, '[ \t]+', ' ', 'g'), ' '), '\n([ \t]*\n)+', chr(10), 'g') AS t FROM documents), w AS (SELECT doc_id, string_split(t, ' ') AS w FROM c), s AS (SELECT doc_id, w, unnest(range(0, greatest(0, ceil((len(w) - 250) / 250))::INT + 1)) AS split_id FROM w)
        SELECT doc_id, split_id::INT AS split_id, length(array_to_string(w[1 : split_id * 250], ' ')) + (split_id > 0)::INT AS split_start FROM s WHERE array_to_string(w[split_id * 250 + 1 : split_id * 250 + 250], ' ') <> ''""",
)
def preprocessed_chunks(spark, sf_dir):
    """Cleaned, then cut into chunks of 250 words with their first character's place."""
    cleaned = table(spark, sf_dir, "documents").select("doc_id", T.tidy(F.col("text")).alias("text"))
    return T.split_documents(cleaned, "text", "word", 250, 0, keep=["doc_id"]).select("doc_id", "split_id", "split_start")


@query("gated_layers", "SELECT vec_id, round(list_sum(list_transform(embedding::DOUBLE[], lambda x: greatest(x, 0) + x)), 4) AS residual, 2 * len(embedding) AS concatenated, round(list_sum(embedding::DOUBLE[]) * 2, 4) AS added FROM embeddings")
def gated_layers(spark, sf_dir):
    """Layer combinators as functions of Columns: residual, concatenate, add."""
    x = F.col("embedding").cast("array<double>")
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)
    relu = lambda a: F.transform(a, lambda v: F.greatest(v, F.lit(0.0)))
    residual = lambda layer: lambda a: F.zip_with(layer(a), a, lambda u, v: u + v)
    add = lambda f, g: lambda a: F.zip_with(f(a), g(a), lambda u, v: u + v)
    same = lambda a: a
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(total(residual(relu)(x)), 4).alias("residual"), F.size(F.concat(relu(x), x)).cast("long").alias("concatenated"), F.round(total(add(same, same)(x)), 4).alias("added"))


@query(
    "attention_pooling",
    """WITH q AS (SELECT avg(x) AS q, i FROM (SELECT unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings) GROUP BY i), s AS (SELECT vec_id, label, sum(x * q) AS s FROM (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings) JOIN q USING (i) GROUP BY ALL),
       w AS (SELECT vec_id, label, exp(s - max(s) OVER (PARTITION BY label)) AS w FROM s) SELECT label, round(sum(w * w) / sum(w) / sum(w), 6) AS concentration, round(sum(w * vec_id) / sum(w), 4) AS centre FROM w GROUP BY label""",
)
def attention_pooling(spark, sf_dir):
    """Softmax weights of a group's vectors by their product with one query vector, the mean; sums of the weights."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.posexplode(F.col("embedding").cast("array<double>")).alias("i", "x"))
    q = rows.groupBy("i").agg(F.avg("x").alias("q"))
    s = rows.join(F.broadcast(q), "i").groupBy("vec_id", "label").agg(F.sum(F.col("x") * F.col("q")).alias("s"))
    w = s.withColumn("w", F.exp(F.col("s") - F.max("s").over(Window.partitionBy("label"))))
    return w.groupBy("label").agg(F.round(F.sum(F.col("w") * F.col("w")) / F.sum("w") / F.sum("w"), 6).alias("concentration"), F.round(F.sum(F.col("w") * F.col("vec_id")) / F.sum("w"), 4).alias("centre"))


@query(
    "sequential_evaluation",
    """WITH r AS (SELECT o_custkey AS qid, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) - 1 AS rank, (o_orderpriority = '1-URGENT')::INT AS hit FROM orders),
       m AS (SELECT qid, coalesce(1.0 / (min(rank) FILTER (hit = 1) + 1), 0) AS mrr, coalesce(max(hit) FILTER (rank < 3), 0) AS recall FROM r GROUP BY qid), c AS (SELECT corr(quality, toxic) AS c FROM labels)
       SELECT * FROM (SELECT 'orders_mrr' AS name, round(avg(mrr), 6) AS value FROM m UNION ALL SELECT 'orders_recall_at_3', round(avg(recall), 6) FROM m UNION ALL SELECT 'labels_pearson', round(c, 6) FROM c
       UNION ALL SELECT 'sequential_score', round(c, 6) FROM c)""",
)
def sequential_evaluation(spark, sf_dir):
    """Several evaluators in turn, their metrics under prefixes; the last one's score stands for all."""
    orders = table(spark, sf_dir, "orders")
    order = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    run = orders.select(F.col("o_custkey").alias("qid"), F.col("o_orderkey").alias("doc_id"), (F.row_number().over(order) - 1).alias("rank"))
    hits = metrics.ranked_hits(run, orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("qid"), F.col("o_orderkey").alias("doc_id")))
    labels = table(spark, sf_dir, "labels").agg(F.corr("quality", "toxic").alias("pearson"))
    parts = [
        metrics.by_query(hits).agg(F.avg("mrr").alias("mrr")), metrics.by_query(hits, k=3).agg(F.avg("recall_single").alias("recall_at_3")), labels,
    ]
    return metrics.in_sequence(list(zip(("orders", "orders", "labels"), parts, strict=True))).select("name", F.round("value", 6).alias("value"))


@query("tagged_json", "SELECT event_id, 'event' AS kind, user_id, value FROM events WHERE event_id % 2 = 0 UNION ALL SELECT event_id, 'visit', user_id, NULL FROM events WHERE event_id % 2 = 1")
def tagged_json(spark, sf_dir):
    """Two record types through JSON that names its type, read back by the tag."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    coded = events.select(F.when(F.col("event_id") % 2 == 0, T.tagged("event", F.struct("event_id", "user_id", "value"))).otherwise(T.tagged("visit", F.struct("event_id", "user_id"))).alias("j"))
    event, visit = T.untagged(F.col("j"), "event", "event_id long, user_id long, value double"), T.untagged(F.col("j"), "visit", "event_id long, user_id long")
    read = coded.select(event.alias("e"), visit.alias("v"))
    kind = F.when(F.col("e").isNotNull(), "event").when(F.col("v").isNotNull(), "visit")
    return read.select(F.coalesce("e.event_id", "v.event_id").alias("event_id"), kind.alias("kind"), F.coalesce("e.user_id", "v.user_id").alias("user_id"), F.col("e.value").alias("value"))


_TOP = "list_transform(range(1, len({0}) + 1), lambda i: CASE WHEN len(list_filter(range(1, len({0}) + 1), lambda j: abs({0}[j]) > abs({0}[i]) OR (abs({0}[j]) = abs({0}[i]) AND j < i))) < 8 THEN {0}[i] ELSE 0 END)"


@query(
    "sparse_similarity",
    f"""WITH s AS (SELECT vec_id, {_TOP.format("x")} AS x FROM (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings))
        SELECT a.vec_id, round(list_cosine_similarity(a.x, b.x), 6) AS cosine, round(list_dot_product(a.x, b.x), 5) AS dot FROM s a JOIN s b ON b.vec_id = a.vec_id + 1""",
)
def sparse_similarity(spark, sf_dir):
    """Similarities of vectors of which the eight largest components are kept."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", V.keep_largest(F.col("embedding").cast("array<double>"), 8).alias("x"))
    both = e.join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("x").alias("y")), "vec_id")
    return both.select("vec_id", F.round(V.cosine(F.col("x"), F.col("y")), 6).alias("cosine"), F.round(V.dot(F.col("x"), F.col("y")), 5).alias("dot"))
