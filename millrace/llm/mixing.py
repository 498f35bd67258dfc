"""Mixing sources to target weights by weighted fair queueing.

Every document gets a virtual finish time, the cumulative words of its source
(in a shuffled order) divided by the source's target; the mix is the documents
in order of finish time up to the total budget.  Sources whose target exceeds
their size go through a second pass over the same order, so that a document
appears up to ``max_repeats`` times.

Only built-in functions run.  Prefix sums never gather a source in one task: a
source is cut into hash-range buckets, bucket totals (sources x buckets rows)
are summed first, and rows are summed within their bucket.  Targets are worked
out over a table of one row a source; only the total budget and the level of the
weights come to the driver.

Defined cases: null text has size 0, null source is a source of its own that
sorts last, null ids and texts are apart from empty ones, sizes of 0 are never
taken, rows equal in id, source and text are taken together (a source may miss
its target by one such set), an empty table gives an empty result, extra columns
of any name are kept by ``mix`` and ignored by ``plan``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import written

#: Rows that one prefix-sum bucket is to hold, about.
BUCKET_ROWS = 20_000


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) of (source, source_size): weights by code-point order (null last), repeating, water-filled below ``most`` times the size.

    A source is full where its weight's part of the words passes ``most`` times
    its size.  In order of that size over weight, the sources before the level
    are full, and the level is what is left a unit of weight.
    """
    place = Window.orderBy(F.col("source").isNull(), "source")
    rows = sizes.withColumn("_nr", F.row_number().over(place))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("_nr") - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = rows.withColumn("_weight", weight).withColumn("_ratio", F.lit(float(most)) * F.col("source_size") / F.col("_weight"))
    order = Window.orderBy("_ratio", "_nr")
    full = F.coalesce(F.sum(F.lit(float(most)) * F.col("source_size")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    free = F.sum("_weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    total = F.lit(float(share)) * F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    level = rows.select("_ratio", "_nr", ((total - full) / free).alias("_level")).where("_ratio >= _level").agg(F.min_by("_level", F.struct("_ratio", "_nr")).alias("level")).first()["level"]
    goal = F.least(F.lit(float(most)) * F.col("source_size"), F.col("_weight") * F.lit(level).cast("double"))
    return rows.select("source", "source_size", goal.alias("target"))


def _prefix(df: DataFrame, group: list[str], bucket: str, order: list[str], value: str, name: str) -> DataFrame:
    """``name`` is the running sum of ``value`` by ``bucket`` and then ``order`` in each ``group``, in two levels."""
    keys = [*group, bucket]
    sums = df.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    upto = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*[F.col(k).alias(f"_{k}") for k in keys], F.coalesce(F.sum("_sum").over(upto), F.lit(0)).alias("_before"))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.join(before, on).withColumn(name, F.col("_before") + F.sum(value).over(within)).drop(*[f"_{k}" for k in keys], "_before")


def _key() -> F.Column:
    """Digest of id, source and text, each with its length; null apart from empty."""
    texts = [F.col(c).cast("string") for c in ("doc_id", "source", "text")]
    return F.md5(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("n")) for t in texts]))


def plan(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """(mix_key, doc_id, size, source_size, target, copies, taken), one row for every row of ``docs``.

    Documents are shuffled by ``mix_key``, a digest of id, source and text, so
    that reruns agree.  Rows that are equal in all three are taken together.  A
    document whose finish time lies beyond twice the end of the budget is out.
    """
    size = F.size(F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), ""))
    rows = docs.select("doc_id", "source", F.when(F.col("text").isNull(), 0).otherwise(size).cast("long").alias("size"), _key().alias("mix_key"))
    rows = written(rows, "mix-rows")
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    by_source = written(targets(sums, weights, share, most), "mix-targets")
    total = by_source.agg(F.count(F.lit(1)).alias("sources"), F.coalesce(F.sum("target"), F.lit(0.0)).alias("budget")).first()
    buckets = max(64, rows.count() // BUCKET_ROWS)
    by_source = by_source.withColumnRenamed("source", "_source")
    if total["sources"] <= 10_000:
        by_source = F.broadcast(by_source)

    units = rows.groupBy("mix_key").agg(F.first("source").alias("source"), F.sum("size").alias("size"))
    units = units.join(by_source, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    units = units.withColumn("mix_bucket", F.floor(F.conv(F.substring("mix_key", 1, 8), 16, 10).cast("double") * buckets / 2.0**32).cast("long"))
    units = _prefix(units, ["source"], "mix_bucket", ["mix_key"], "size", "mix_upto")
    # pass k over a source begins where pass k - 1 ended
    turns = units.select("mix_key", "size", "mix_upto", "source_size", "target", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("mix_turn"))
    turns = turns.withColumn("mix_finish", (F.col("mix_upto") + F.col("mix_turn") * F.col("source_size")) / F.nullif(F.col("target"), F.lit(0.0))).where("size > 0 AND mix_finish <= 2")
    turns = turns.withColumn("mix_range", F.floor(F.col("mix_finish") * buckets).cast("long"))
    turns = _prefix(turns, [], "mix_range", ["mix_finish", "mix_key", "mix_turn"], "size", "mix_total")
    copies = turns.where(F.col("mix_total") <= total["budget"] + 1e-6).groupBy("mix_key").agg(F.count(F.lit(1)).alias("copies"))
    out = rows.join(copies, "mix_key", "left").join(by_source, F.col("source").eqNullSafe(F.col("_source")))
    copies = F.coalesce("copies", F.lit(0)).cast("long")
    return out.select("mix_key", "doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it takes it."""
    chosen = plan(docs, **options).where("copies > 0").groupBy("mix_key").agg(F.first("copies").alias("mix_copies"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("mix_row"), _key().alias("mix_key")).join(chosen, "mix_key")
    return rows.select("mix_row", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int")))).select("mix_row.*")


def op10_weighted_fair_mix(spark, sf_dir: str) -> DataFrame:
    return plan(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", F.round("target", 4).alias("target"), "taken")


ORACLE = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')), 0) AS size,
         md5(concat(coalesce(length(doc_id::VARCHAR) || ':' || doc_id, 'n'), coalesce(length(source) || ':' || source, 'n'), coalesce(length(text) || ':' || text, 'n'))) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS r FROM d GROUP BY source),
w AS (SELECT *, CASE r % 3 WHEN 1 THEN 3 WHEN 2 THEN 1 ELSE 2 END AS weight FROM s),
o AS (SELECT *, 2.0::DOUBLE * source_size / weight AS ratio FROM w),
c AS (SELECT *, coalesce(sum(2 * source_size) OVER (ORDER BY ratio, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(weight) OVER (ORDER BY ratio, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
         1.5::DOUBLE * sum(source_size) OVER () AS budget, row_number() OVER (ORDER BY ratio, r) AS nr FROM o),
l AS (SELECT arg_min((budget - capped) / free, nr) FILTER (ratio >= (budget - capped) / free) AS level FROM c),
t AS (SELECT c.source, c.source_size, c.budget, least(2.0 * c.source_size, c.weight * l.level)::DOUBLE AS target FROM c, l),
u AS (SELECT d.*, t.source_size, t.target, t.budget, sum(size) OVER (PARTITION BY d.source ORDER BY k ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
f AS (SELECT *, (upto + turn * source_size)::DOUBLE / target AS finish FROM u, (VALUES (0), (1)) AS v(turn) WHERE size > 0),
g AS (SELECT *, sum(size) OVER (ORDER BY finish, k, turn ROWS UNBOUNDED PRECEDING) AS total FROM f WHERE finish <= 2),
n AS (SELECT k, count(*) AS copies FROM g WHERE total <= budget + 1e-6 GROUP BY k)
SELECT u.doc_id, u.size::BIGINT AS size, u.source_size, round(u.target, 4) AS target, (u.size * coalesce(n.copies, 0))::BIGINT AS taken
FROM u LEFT JOIN n ON u.k = n.k
"""
