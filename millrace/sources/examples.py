"""Readers of labelled examples: scored pairs, inference pairs, parallel lines, triplets, labels, tagged tokens."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Labels of inference pairs (fixed values).
INFERENCE = {"contradiction": 0, "entailment": 1, "neutral": 2}


def scored_pairs(spark: SparkSession, path: str, first: int = 0, second: int = 1, score: int = 2, low: float = 0.0, high: float = 5.0, limit: int | None = None) -> DataFrame:
    """(guid, a, b, score) of tab-separated lines (also .gz); scores are brought to 0..1."""
    rows = spark.read.csv(path, sep="\t", quote="")
    columns = rows.columns
    out = rows.select(F.xxhash64(*columns).alias("guid"), F.col(columns[first]).alias("a"), F.col(columns[second]).alias("b"), ((F.col(columns[score]).cast("double") - low) / (high - low)).alias("score"))
    return out.limit(limit) if limit else out


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, value) of one text file, in its order."""
    return spark.read.text(path, wholetext=True).select(F.posexplode(F.split(F.regexp_replace("value", "\\r?\\n$", ""), "\\r?\\n")).alias("line_no", "value"))


def parallel_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(line_no, texts) of files read side by side, until the shortest ends."""
    parts = [lines(spark, p).withColumnRenamed("value", f"v{i}") for i, p in enumerate(paths)]
    return reduce(lambda a, b: a.join(b, "line_no"), parts).select("line_no", F.array(*[f"v{i}" for i in range(len(paths))]).alias("texts"))


def inference_pairs(spark: SparkSession, first: str, second: str, labels: str) -> DataFrame:
    """(line_no, a, b, label) of three files of lines."""
    pairs = [F.lit(x) for kv in INFERENCE.items() for x in kv]
    return parallel_lines(spark, [first, second, labels]).select("line_no", F.col("texts")[0].alias("a"), F.col("texts")[1].alias("b"), F.element_at(F.create_map(*pairs), F.trim(F.col("texts")[2])).alias("label"))


def triplets(spark: SparkSession, path: str, columns: tuple[int, int, int] = (0, 1, 2), header: bool = False, sep: str = "\t", limit: int | None = None) -> DataFrame:
    rows = spark.read.csv(path, sep=sep, header=header, quote="")
    out = rows.select(*[F.col(f"`{rows.columns[c]}`").alias(n) for c, n in zip(columns, ("anchor", "positive", "negative"), strict=True)])
    return out.limit(limit) if limit else out


def labelled_sentences(rows: DataFrame, position: str, label: str) -> DataFrame:
    """Adds label_id: labels numbered in the order in which they come first."""
    first = rows.groupBy(label).agg(F.min(position).alias("_first"))
    ids = first.withColumn("label_id", F.row_number().over(Window.orderBy("_first")) - 1).drop("_first")  # one row a label
    return rows.join(ids, label)


def iob_spans(tagged: Column) -> Column:
    """(start, end, label) token spans of lines ``token|tag|iob`` or ``token|iob``, blank between tokens."""
    tags = F.transform(F.filter(F.split(tagged, " "), lambda x: x != ""), lambda x: F.element_at(F.split(x, "\\|"), -1))
    kinds = F.transform(tags, lambda t: F.when(t == "O", None).otherwise(F.regexp_replace(t, "^[BIUL]-", "")))
    begins = F.transform(tags, lambda t, i: (t != "O") & (t.startswith("B-") | t.startswith("U-") | (i == 0) | ~F.get(kinds, i - 1).eqNullSafe(F.get(kinds, i))))
    starts = F.filter(F.sequence(F.lit(0), F.size(tags) - 1), lambda i: F.get(begins, i))

    def end(i: Column) -> Column:
        after = F.filter(F.sequence(F.lit(1), F.size(tags)), lambda j: (j > i) & ((j == F.size(tags)) | F.coalesce(F.get(begins, j), F.lit(True)) | F.get(kinds, j).isNull()))
        return F.get(after, F.lit(0))

    return F.transform(starts, lambda i: F.struct(i.alias("start"), end(i).alias("end"), F.get(kinds, i).alias("label")))
