"""Retrieval, answer and embedding metrics as aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked_hits(run: DataFrame, truth: DataFrame, qid: str = "qid", item: str = "doc_id", rank: str = "rank") -> DataFrame:
    """``run`` (qid, item, rank from 0) with ``hit`` and the query's ``n_truth``; a null item keeps its rank and hits nothing.

    A query of ``truth`` for which nothing was retrieved gets one row without item and rank.
    """
    relevant = truth.select(qid, item).distinct()
    totals = relevant.groupBy(qid).agg(F.count(F.lit(1)).alias("n_truth"))
    marked = run.join(relevant.withColumn("hit", F.lit(1)), [qid, item], "left")
    found = marked.join(totals, qid, "left").select(*run.columns, F.coalesce("hit", F.lit(0)).alias("hit"), F.coalesce("n_truth", F.lit(0)).alias("n_truth"))
    empty = totals.join(run.select(qid).distinct(), qid, "left_anti")
    none = [F.col(c) if c == qid else F.lit(None).cast(run.schema[c].dataType).alias(c) for c in run.columns]
    return found.unionByName(empty.select(*none, F.lit(0).alias("hit"), "n_truth"))


def by_query(hits: DataFrame, qid: str = "qid", rank: str = "rank", k: int | None = None) -> DataFrame:
    """Per query: mrr, average precision over hits, recall (both kinds), ndcg, precision and accuracy, all at ``k`` if given."""
    if k:
        hits = hits.where((F.col(rank) < k) | F.col(rank).isNull())
    order = Window.partitionBy(qid).orderBy(rank).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hits = hits.withColumn("_p", F.sum("hit").over(order) / (F.col(rank) + 1)).withColumn("_g", F.col("hit") / F.log2(F.col(rank) + 2))
    limit = F.lit(k) if k else F.col("n_truth")
    ideal = F.aggregate(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least("n_truth", limit)).cast("int")), F.lit(0.0), lambda s, i: s + 1 / F.log2(i + 1))
    out = hits.groupBy(qid).agg(
        F.coalesce(1 / (F.min(F.when(F.col("hit") == 1, F.col(rank))) + 1), F.lit(0.0)).alias("mrr"),
        F.coalesce(F.avg(F.when(F.col("hit") == 1, F.col("_p"))), F.lit(0.0)).alias("map"),
        F.sum("hit").alias("n_hits"), F.max("hit").alias("recall_single"), F.coalesce(F.sum("_g"), F.lit(0.0)).alias("dcg"), F.first("n_truth").alias("n_truth"), F.count(rank).alias("n"),
    )
    return out.select(
        qid, "mrr", "map", F.col("recall_single").cast("double").alias("recall_single"), F.when(F.col("n_truth") > 0, F.col("n_hits") / F.col("n_truth")).otherwise(0.0).alias("recall_multi"),
        F.when(F.col("n_truth") > 0, F.col("dcg") / ideal).otherwise(0.0).alias("ndcg"), F.coalesce(F.try_divide(F.col("n_hits"), F.lit(k) if k else F.col("n")), F.lit(0.0)).alias("precision"),
    )


def in_sequence(parts: list[tuple[str, DataFrame]]) -> DataFrame:
    """(name, value): the metrics of one-row results in turn under their prefixes, then ``sequential_score``, the last result's first metric."""
    out = None
    for prefix, result in parts:
        names = result.columns
        long = result.select(F.explode(F.array(*[F.struct(F.lit(f"{prefix}_{c}").alias("name"), F.col(c).cast("double").alias("value")) for c in names])).alias("m")).select("m.*")
        out = long if out is None else out.unionByName(long)
    last = parts[-1][1]
    return out.unionByName(last.select(F.lit("sequential_score").alias("name"), F.col(last.columns[0]).cast("double").alias("value")))


def exact_match(predicted: Column, truth: Column) -> Column:
    return predicted.eqNullSafe(truth).cast("int")


def token_f1(predicted: Column, truth: Column) -> Column:
    """F1 of two token arrays as multisets."""
    kinds = F.array_intersect(predicted, truth)
    count = lambda a, x: F.size(F.filter(a, lambda y: y == x))
    common = F.aggregate(kinds, F.lit(0), lambda n, x: n + F.least(count(predicted, x), count(truth, x)))
    total = F.size(predicted) + F.size(truth)
    return F.when(total == 0, 1.0).otherwise(2.0 * common / total)


def ngrams(tokens: Column, n: int) -> Column:
    count = F.size(tokens) - n + 1
    return F.when(count > 0, F.transform(F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice(tokens, i, n), " "))).otherwise(F.array().cast("array<string>"))


def rouge_n(predicted: Column, truth: Column, n: int) -> Column:
    return token_f1(ngrams(predicted, n), ngrams(truth, n))


def gram_overlap(pairs: DataFrame, key: str, predicted: str, truth: str, most: int = 4) -> DataFrame:
    """(key, n, common, of_predicted, of_truth): clipped common n-grams and totals of two token arrays, for n up to ``most``."""

    def counted(tokens: str, name: str) -> DataFrame:
        sizes = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), ngrams(F.col(tokens), n).alias("g")) for n in range(1, most + 1)])).alias("x")
        return pairs.select(key, sizes).select(key, "x.n", F.explode("x.g").alias("g")).groupBy(key, "n", "g").agg(F.count(F.lit(1)).alias(name))

    both = counted(predicted, "a").join(counted(truth, "b"), [key, "n", "g"], "full")
    return both.groupBy(key, "n").agg(F.sum(F.least(F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0)))).alias("common"), F.coalesce(F.sum("a"), F.lit(0)).alias("of_predicted"), F.coalesce(F.sum("b"), F.lit(0)).alias("of_truth"))


def bleu_and_gleu(pairs: DataFrame, key: str, predicted: str, truth: str, most: int = 4) -> DataFrame:
    """(key, bleu, gleu): geometric mean of clipped precisions (zero counts plus one half) with brevity penalty; least of precision and recall over all n-grams."""
    by_n = gram_overlap(pairs, key, predicted, truth, most)
    precision = F.greatest(F.col("common").cast("double"), F.lit(0.5)) / F.greatest("of_predicted", F.lit(1))
    sums = by_n.groupBy(key).agg(
        F.sum(F.log(precision)).alias("logs"), F.count(F.lit(1)).alias("kinds"), F.max(F.when(F.col("n") == 1, F.col("of_predicted"))).alias("p"), F.max(F.when(F.col("n") == 1, F.col("of_truth"))).alias("t"),
        F.sum("common").alias("c"), F.sum("of_predicted").alias("ps"), F.sum("of_truth").alias("ts"),
    )
    brevity = F.when(F.col("p") == 0, 0.0).when(F.col("p") >= F.col("t"), 1.0).otherwise(F.exp(1 - F.col("t") / F.nullif(F.col("p"), F.lit(0))))
    return sums.select(key, (brevity * F.exp(F.col("logs") / F.col("kinds"))).alias("bleu"), (F.col("c") / F.greatest("ps", "ts")).alias("gleu"))


def binary_thresholds(df: DataFrame, score: str, label: str, by: list[str] | None = None) -> DataFrame:
    """Best accuracy, best F1 and average precision of scores over 0/1 labels, by running counts over the scores."""
    by = by or []
    each = df.groupBy(*by, score).agg(F.sum(label).alias("pos"), (F.count(F.lit(1)) - F.sum(label)).alias("neg"))
    down = Window.partitionBy(*by).orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_ = Window.partitionBy(*by)
    each = each.withColumn("tp", F.sum("pos").over(down)).withColumn("fp", F.sum("neg").over(down)).withColumn("p", F.sum("pos").over(all_)).withColumn("n", F.sum("neg").over(all_))
    return each.groupBy(*by).agg(
        F.max((F.col("tp") + F.col("n") - F.col("fp")) / (F.col("p") + F.col("n"))).alias("accuracy"),
        F.max(2 * F.col("tp") / (F.col("tp") + F.col("fp") + F.col("p"))).alias("f1"),
        F.sum(F.try_divide(F.col("pos"), F.col("p")) * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("average_precision"),
    )


def spearman(df: DataFrame, a: str, b: str, by: list[str] | None = None) -> DataFrame:
    """Pearson and Spearman correlation; ties take their average rank, from counts and not from one global sort of rows."""
    by = by or []

    def ranks(c: str, name: str) -> DataFrame:
        counts = df.groupBy(*by, c).agg(F.count(F.lit(1)).alias("_n"))
        upto = Window.partitionBy(*by).orderBy(c).rowsBetween(Window.unboundedPreceding, -1)
        return counts.select(*by, c, (F.coalesce(F.sum("_n").over(upto), F.lit(0)) + (F.col("_n") + 1) / 2).alias(name))

    both = df.join(ranks(a, "_ra"), [*by, a]).join(ranks(b, "_rb"), [*by, b])
    return both.groupBy(*by).agg(F.corr(a, b).alias("pearson"), F.corr("_ra", "_rb").alias("spearman"))
