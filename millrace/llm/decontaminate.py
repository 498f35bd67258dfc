"""Benchmark decontamination over a positional inverted index.

The index holds a posting (row, position, term) for every token of the training
texts, or only for the tokens of given terms, plus one header per document with
its id, length and digest; it is written once to the shared folder.  The queries
here restrict it to the benchmark's terms, for no other posting is ever read;
``build_index(docs)`` stores all of them for use with further benchmarks.

Each benchmark window is found from its rarest term outwards: postings of the
rarest term give candidate starts, those of the next rarest at the right distance
thin them out, and the remaining offsets are intersected last.  Proximity matches
are windows of which three quarters of the words, the two rarest among them,
stand within two words of their place.  Only DataFrame operations run.

Items are arbitrary in number: terms are broadcast only below a checked count.

Defined cases: a null or wordless text has ``n_words`` 0 and no hits; a null,
wordless item has no windows; repeated item rows count once, repeated documents
each for themselves; ties between equally rare terms go by their place in the
window; empty tables give zero counts; other columns, whatever their names, are
ignored by ``contamination`` and kept by ``clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import LOWER, UPPER, read, written

WIDTH = 8
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Terms and windows of the benchmark are broadcast up to so many rows.
BROADCAST_ROWS = 50_000
#: Bits by which documents without a candidate are passed over before postings are shuffled: eight a candidate document, 64 in a broadcast row.
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 26


def words(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, runs of digits, letters a-z and all that is not ASCII."""
    low = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), GAP), "")


def windows(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """(window, item_id, size, off, term): one row for each word of each distinct window of each item."""
    w = items.where("text IS NOT NULL").select("item_id", words(F.col("text")).alias("w")).where("size(w) > 0")
    start = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - width + 1))).alias("s")
    cut = w.select("item_id", "w", start).select("item_id", F.slice("w", F.col("s"), width).alias("w")).distinct()
    cut = cut.withColumn("window", F.xxhash64("item_id", "w")).withColumn("size", F.size("w"))
    return cut.select("window", "item_id", "size", F.posexplode("w").alias("off", "term"))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _of_rows(postings: DataFrame, rows: DataFrame) -> DataFrame:
    """Postings whose document may be in ``rows``: a bitmap over hashes is broadcast (at most 2^20 rows), a join that is exact follows."""
    rows = rows.select("row").distinct()
    bits = 1 << max(LEAST_BITS.bit_length() - 1, min(MOST_BITS.bit_length() - 1, (8 * rows.count()).bit_length()))
    place = F.pmod(F.xxhash64("row"), F.lit(bits))
    map_ = rows.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(xxhash64(row), {bits}L) & 63 AS INT))")).alias("bits"))
    kept = postings.withColumn("word", F.shiftright(place, 6)).join(F.broadcast(map_), "word")
    return kept.where(F.expr(f"(shiftrightunsigned(bits, CAST(pmod(xxhash64(row), {bits}L) & 63 AS INT)) & 1) = 1")).drop("word", "bits")


def build_index(docs: DataFrame, terms: DataFrame | None = None, n_terms: int = 0) -> DataFrame:
    """(row, pos, term, doc_id, n_words, text_md5): postings of every token, or of the tokens that ``terms`` (column ``term``) holds.

    A header has pos -1 and no term; only headers have doc_id, n_words and the text's digest.
    """
    rows = docs.select("doc_id", words(F.col("text")).alias("w"), F.md5("text").alias("text_md5")).withColumn("row", F.monotonically_increasing_id())
    all_ = rows.select("row", "doc_id", "text_md5", F.size("w").alias("n_words"), F.posexplode(F.concat(F.array(F.lit("")), "w")).alias("at", "term"))
    if terms is not None:
        known = _small(terms.select("term").union(docs.sparkSession.createDataFrame([("",)], "term string")), n_terms)
        all_ = all_.join(known, "term", "left_semi")
    header = F.col("at") == 0
    of_header = [F.when(header, F.col(c)).alias(c) for c in ("doc_id", "n_words", "text_md5")]
    return written(all_.select("row", (F.col("at") - 1).alias("pos"), F.when(~header, F.col("term")).alias("term"), *of_header), "positional-index")


class Search:
    """The windows' terms ranked by rarity in an index, and the places where each window's rarest term stands.

    ``ranked`` (window, item_id, size, off, term, n, rank, found); ``starts``
    (row, start, window, item_id, size, found, off2, term2), start may be negative.
    """

    def __init__(self, index: DataFrame, wins: DataFrame):
        self.postings = index.where("pos >= 0").select("row", "pos", "term")
        counts = written(self.postings.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "term-counts")
        order = Window.partitionBy("window").orderBy("n", "off")
        ranked = wins.join(counts, "term").withColumn("rank", F.row_number().over(order)).withColumn("found", F.count(F.lit(1)).over(Window.partitionBy("window")))
        self.ranked = written(ranked, "ranked-windows")
        self.n = self.ranked.count()
        first = _small(self.ranked.where("rank = 1").select("term", "window", "item_id", "size", "off", "found"), self.n)
        starts = self.postings.join(first, "term").select("row", (F.col("pos") - F.col("off")).alias("start"), "window", "item_id", "size", "found")
        second = self.ranked.where("rank = 2").select("window", F.col("off").alias("off2"), F.col("term").alias("term2"))
        self.starts = written(starts.join(_small(second, self.n), "window", "left"), "rarest-starts")
        self.nearby = _of_rows(self.postings, self.starts)

    def _meet_second(self, starts: DataFrame, terms: DataFrame) -> DataFrame:
        """``starts`` (with ``at``, where the second rarest term is looked for) that have a posting of it there."""
        near = self.nearby.join(_small(terms.select(F.col("term2").alias("term")).distinct(), self.n), "term", "left_semi")
        near = near.select(F.col("row").alias("row2"), F.col("pos").alias("pos2"), F.col("term").alias("term3"))
        met = (F.col("row") == F.col("row2")) & (F.col("at") == F.col("pos2")) & (F.col("term2") == F.col("term3"))
        return starts.join(near, met).select("row", "start", "window", "item_id", "size")

    def phrases(self) -> DataFrame:
        """(row, start, window, item_id, size): every occurrence of every window, by offset-adjusted intersection from the rarest term."""
        # a window with a term that the corpus lacks cannot occur
        able = self.starts.where("found = size AND start >= 0")
        second = self.ranked.where("rank = 2 AND found = size").select(F.col("term").alias("term2"))
        alone = able.where("off2 IS NULL").select("row", "start", "window", "item_id", "size")
        starts = self._meet_second(able.where("off2 IS NOT NULL").withColumn("at", F.col("start") + F.col("off2")), second)
        starts = written(starts.union(alone), "candidate-starts")
        rest = _small(self.ranked.where("rank > 2 AND found = size").select("window", "off", "term"), self.n)
        need = starts.where("size > 2").join(rest, "window").select("row", (F.col("start") + F.col("off")).alias("pos"), "term", "start", "window", "item_id", "size")
        whole = need.join(_of_rows(self.postings, starts), ["row", "pos", "term"]).groupBy("row", "start", "window", "item_id", "size").agg(F.count(F.lit(1)).alias("n")).where("n = size - 2").drop("n")
        return whole.union(starts.where("size <= 2"))

    def proximity(self, least: float = 0.75, span: int = 2) -> DataFrame:
        """(row, window, item_id, share): windows of which at least ``least`` of the words, the two rarest among them, stand within ``span`` words of their place."""
        shifts = lambda: F.explode(F.sequence(F.lit(-span), F.lit(span))).alias("shift")
        able = self.starts.where(F.col("found") >= F.col("size") * least)
        alone = able.where("size = 1").select("row", "start", "window", "item_id", "size")
        second = self.ranked.where("rank = 2").select(F.col("term").alias("term2"))
        tried = able.where("off2 IS NOT NULL").select("*", shifts()).withColumn("at", F.col("start") + F.col("off2") + F.col("shift"))
        starts = written(self._meet_second(tried, second).union(alone).distinct(), "near-starts")
        rest = _small(self.ranked.where("rank > 2").select("window", "off", "term"), self.n)
        need = starts.join(rest, "window").select("row", "start", "window", "item_id", "size", "off", "term", shifts())
        need = need.withColumn("pos", F.col("start") + F.col("off") + F.col("shift")).drop("shift")
        met = need.join(_of_rows(self.postings, starts), ["row", "pos", "term"]).groupBy("row", "start", "window").agg(F.countDistinct("off").alias("n"))
        both = starts.join(met, ["row", "start", "window"], "left")
        sure = F.when(F.col("size") > 1, 2).otherwise(1)
        share = both.groupBy("row", "window", "item_id").agg(F.max((F.coalesce("n", F.lit(0)) + sure) / F.col("size")).alias("share"))
        return share.where(F.col("share") >= least)


def phrases(index: DataFrame, wins: DataFrame) -> DataFrame:
    return Search(index, wins).phrases()


def proximity(index: DataFrame, wins: DataFrame, least: float = 0.75, span: int = 2) -> DataFrame:
    return Search(index, wins).proximity(least, span)


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH, least_items: int = 2) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near) for each row of ``docs``; n_near counts the items with a proximity match, exact ones among them."""
    wins = written(windows(items.select("item_id", "text"), width), "windows")
    terms = wins.select("term").distinct()
    index = build_index(docs, terms, terms.count())
    search = Search(index, wins)
    found = written(search.phrases(), "phrases")
    near = search.proximity().select("row", "item_id").distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n_near"))
    # words covered by any occurrence: starts of one document, merged in order
    spans = found.groupBy("row", "start").agg(F.max("size").alias("size"))
    before = F.max(F.col("start") + F.col("size")).over(Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("start") + F.col("size") - F.greatest("start", F.coalesce(before, F.lit(0))))
    hit = spans.withColumn("fresh", fresh).groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    names = found.select("row", F.col("item_id").cast("string").alias("item")).distinct().groupBy("row").agg(F.array_join(F.sort_array(F.collect_list("item")), ",").alias("items"), F.count(F.lit(1)).alias("n_items"))
    out = index.where("pos = -1").select("row", "doc_id", "n_words").join(hit, "row", "left").join(names, "row", "left").join(near, "row", "left")
    n_items = F.coalesce("n_items", F.lit(0)).cast("long")
    return out.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), n_items.alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), (n_items >= least_items).alias("contaminated"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )


def clean(docs: DataFrame, items: DataFrame, width: int = WIDTH, least_items: int = 1) -> DataFrame:
    """The rows of ``docs`` in whose text windows of fewer than ``least_items`` items occur."""
    wins = written(windows(items.select("item_id", "text"), width), "windows")
    terms = wins.select("term").distinct()
    index = build_index(docs, terms, terms.count())
    hit = phrases(index, wins).select("row", "item_id").distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_items)
    # what is found depends on the text alone, so its digest names the rows to drop
    foul = index.where("pos = -1").join(hit, "row", "left_semi").select("text_md5").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc_row"), F.md5("text").alias("text_md5"))
    return rows.join(foul, "text_md5", "left_anti").select("doc_row.*")


def op9_positional_index(spark, sf_dir: str) -> DataFrame:
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


_WORDS = "list_filter(regexp_split_to_array(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
i AS (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
n AS (SELECT DISTINCT item_id, list_slice(w, s, s + 7) AS g FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 7) + 1)) AS s FROM i WHERE len(w) > 0)),
k AS (SELECT DISTINCT len(g) AS size FROM n),
o AS (SELECT r, size, s, list_slice(w, s, s + size - 1) AS g FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, k)),
m AS (SELECT o.r, o.s, o.size, n.item_id FROM o JOIN n ON o.g = n.g),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + size)) AS p FROM m) GROUP BY r),
x AS (SELECT r, unnest(w) AS term, unnest(range(len(w))) AS pos FROM d), c AS (SELECT term, count(*) AS n FROM x GROUP BY term),
v AS (SELECT item_id, g, len(g) AS size, unnest(g) AS term, unnest(range(len(g))) AS off FROM n),
y AS (SELECT v.*, row_number() OVER (PARTITION BY item_id, g ORDER BY c.n, off) AS rank, count(*) OVER (PARTITION BY item_id, g) AS found FROM v JOIN c USING (term)),
z AS (SELECT DISTINCT x.r, x.pos - a.off AS start, a.item_id, a.g, a.size FROM x JOIN y a ON x.term = a.term AND a.rank = 1 AND a.found >= 0.75 * a.size
  LEFT JOIN y b ON b.item_id = a.item_id AND b.g = a.g AND b.rank = 2 LEFT JOIN x x2 ON x2.r = x.r AND x2.term = b.term AND x2.pos BETWEEN x.pos - a.off + b.off - 2 AND x.pos - a.off + b.off + 2 WHERE a.size = 1 OR x2.pos IS NOT NULL),
q AS (SELECT z.r, z.start, z.item_id, z.g, z.size, count(DISTINCT y.off) AS k FROM z JOIN y ON y.item_id = z.item_id AND y.g = z.g JOIN x ON x.r = z.r AND x.term = y.term AND x.pos BETWEEN z.start + y.off - 2 AND z.start + y.off + 2 GROUP BY z.r, z.start, z.item_id, z.g, z.size),
u AS (SELECT r, count(DISTINCT item_id) AS n_near FROM q WHERE k >= 0.75 * size GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM m) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN h ON d.r = h.r LEFT JOIN t ON d.r = t.r LEFT JOIN u ON d.r = u.r
"""
