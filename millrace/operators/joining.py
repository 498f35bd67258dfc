"""Joiners: merging result lists, state, lookups, spans, as-of and range joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_all(frames: list[DataFrame], ordinal: str | None = None) -> DataFrame:
    """Rows of all frames by column name; columns that a frame lacks are null."""
    if ordinal:
        frames = [f.withColumn(ordinal, F.lit(i)) for i, f in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def join_results(runs: list[DataFrame], mode: str = "concatenate", keys: tuple[str, ...] = ("qid",), item: str = "doc_id", score: str = "score", weights: list[float] | None = None, top_k: int | None = None, k: int = 61) -> DataFrame:
    """Merge ranked lists: ``concatenate`` (best score of an item), ``merge`` (weighted sum), ``reciprocal_rank_fusion``, ``distribution_based``."""
    weights = [w / sum(weights) for w in weights] if weights else [1 / len(runs)] * len(runs)
    cols = [*keys, item, score]
    parts = []
    for run, weight in zip(runs, weights, strict=True):
        run = run.select(*cols)
        by = Window.partitionBy(*keys)
        if mode == "merge":
            run = run.withColumn(score, F.col(score) * weight)
        elif mode == "reciprocal_rank_fusion":
            rank = F.row_number().over(by.orderBy(F.desc(score), item))
            run = run.withColumn(score, weight * len(runs) / (k - 1 + rank))
        elif mode == "distribution_based":
            mean, dev = F.avg(score).over(by), F.stddev_pop(score).over(by)
            run = run.withColumn(score, F.when(dev > 0, (F.col(score) - (mean - 3 * dev)) / (6 * dev)).otherwise(0.0))
        elif mode != "concatenate":
            raise ValueError(f"unknown join mode {mode}")
        parts.append(run)
    best = F.max(score) if mode in ("concatenate", "distribution_based") else F.sum(score)
    out = union_all(parts).groupBy(*keys, item).agg(best.alias(score))
    if top_k:
        order = Window.partitionBy(*keys).orderBy(F.desc(score), item)
        out = out.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= top_k).drop("_r")
    return out


def lookup(df: DataFrame, column: str, mapping: dict, default, name: str) -> DataFrame:
    """``name`` is the mapped value of ``column``, else ``default``; a mapping of the code becomes a map literal."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return df.withColumn(name, F.coalesce(F.element_at(F.create_map(*pairs), F.col(column)), F.lit(default)))


def compute_once(df: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    """Computes ``value`` for each distinct ``key`` and joins it back; for costly expressions over repeated keys."""
    once = df.select(key).distinct().withColumn(name, value)
    return df.join(once, df[key].eqNullSafe(once[key])).drop(once[key])


def zip_rows(left: DataFrame, right: DataFrame, position: str) -> DataFrame:
    """Positional join of two relations; a position that one lacks raises."""
    both = left.join(right, position, "full_outer")
    names = [c for c in right.columns if c != position][:1] + [c for c in left.columns if c != position][:1]
    check = F.when(F.col(names[0]).isNull() | F.col(names[1]).isNull(), F.raise_error(F.lit("the lists differ in length")).cast("boolean")).otherwise(True)
    return both.where(check)


def as_of(left: DataFrame, right: DataFrame, by: str, left_time: str, right_time: str, values: list[str]) -> DataFrame:
    """For each left row the latest right row at or before it: one union, one shuffle by key, one running last value."""
    row = F.struct(*[F.col(c).alias(c) for c in values])
    a = left.select(F.col(by), F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_l"), F.lit(None).cast(right.select(row).schema[0].dataType).alias("_r"))
    b = right.select(F.col(by), F.col(right_time).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(a.schema["_l"].dataType).alias("_l"), row.alias("_r"))
    order = Window.partitionBy(by).orderBy("_t", "_side", *[F.col("_r")[c] for c in values]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = a.unionByName(b).withColumn("_r", F.last("_r", ignorenulls=True).over(order)).where("_side = 1")
    return out.select("_l.*", *[F.col("_r")[c].alias(c) for c in values])


def range_join(points: DataFrame, ranges: DataFrame, point: str, start: str, end: str, width: float, by: list[str] | None = None, block: int = 4096) -> DataFrame:
    """Points inside [start, end): ranges are cut into cells of ``width``, so that the join is an equi-join.

    The points and the ranges of a cell that holds many are dealt by hash to parts of about ``block``, and each pair of
    parts meets under a key of its own; there are as many tasks as the pairs to be compared ask for.
    """
    on = [*(by or []), "_cell"]
    cell = lambda c: F.floor(F.col(c) / width).cast("long")
    points = points.withColumn("_place", F.xxhash64(*points.columns)).withColumn("_cell", cell(point))
    ranges = ranges.withColumn("_place", F.xxhash64(*ranges.columns)).withColumn("_cell", F.explode(F.sequence(cell(start), cell(end))))
    both = points.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).join(ranges.groupBy(*on).agg(F.count(F.lit(1)).alias("_m")), on)
    pairs = both.agg(F.sum(F.col("_n").cast("double") * F.col("_m"))).first()[0] or 0
    # below the session's number of partitions Spark would deal anew, and join the small shuffles into few tasks
    tasks = max(int(min(2000, pairs // 2**22)), int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # one row at most for every ``block`` rows of the input
    large = F.broadcast(both.where((F.col("_n") > block) | (F.col("_m") > block)).select(*on, *[F.ceil(F.col(c) / block).cast("int").alias(c) for c in ("_n", "_m")]))

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        parts = df.join(large, on, "left").withColumn(own, F.pmod("_place", F.coalesce(own, F.lit(1))).cast("int"))
        parts = parts.withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)))
        parts = parts.drop("_place")
        return parts.repartition(tasks, *on, "_n", "_m") if pairs > 2**24 else parts

    found = dealt(points, "_n", "_m").join(dealt(ranges, "_m", "_n").hint("merge"), [*on, "_n", "_m"])
    return found.where((F.col(point) >= F.col(start)) & (F.col(point) < F.col(end))).drop("_cell", "_n", "_m")


def merge_state(current: Column, new: Column, append: bool) -> Column:
    """List state appends (null is empty), other state is replaced by what is new."""
    return F.concat(F.coalesce(current, F.array().cast("array<string>")), F.coalesce(new, F.array().cast("array<string>"))) if append else F.coalesce(new, current)


def span_slices(tokens: Column, spans: Column) -> Column:
    """Sub-lists of ``tokens`` for (start, end) spans, overlaps allowed."""
    return F.transform(spans, lambda s: F.slice(tokens, s["start"] + 1, s["end"] - s["start"]))


def align(left: Column, right: Column) -> Column:
    """For each token of ``left`` the positions in ``right`` that share characters, when both spell the same text without spaces."""

    def bounds(tokens: Column) -> Column:
        return F.transform(tokens, lambda t, i: F.struct(F.length(F.array_join(F.slice(tokens, 1, i), "")).alias("a"), F.length(F.array_join(F.slice(tokens, 1, i + 1), "")).alias("b")))

    other = F.transform(bounds(right), lambda y, j: F.struct(y["a"].alias("a"), y["b"].alias("b"), j.alias("j")))
    return F.transform(bounds(left), lambda x: F.transform(F.filter(other, lambda y: (y["a"] < x["b"]) & (x["a"] < y["b"])), lambda y: y["j"]))
