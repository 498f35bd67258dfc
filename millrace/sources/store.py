"""Keyed document tables: upsert, delete, count and append sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _matched(a: DataFrame, b: DataFrame, key: str, how: str) -> DataFrame:
    return a.join(b.select(F.col(key).alias("_key")), F.col(key).eqNullSafe(F.col("_key")), how)


def upsert(existing: DataFrame, new: DataFrame, key: str, policy: str = "fail") -> DataFrame:
    """Rows of a keyed table after a write; ``policy`` for keys that are there: skip, overwrite or fail. Of repeated new keys the greatest row stays; a null key is a key like others."""
    new = new.groupBy(key).agg(F.max(F.struct(*new.columns)).alias("_row")).select("_row.*").select(*new.columns)
    if policy == "skip":
        return existing.unionByName(_matched(new, existing, key, "left_anti"))
    if policy == "overwrite":
        return _matched(existing, new, key, "left_anti").unionByName(new)
    if policy == "fail":
        if not _matched(new, existing, key, "left_semi").isEmpty():
            raise ValueError(f"{key} is there already")
        return existing.unionByName(new)
    raise ValueError(f"unknown policy {policy}")


def delete(existing: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows without ``keys``; a key that is not there raises."""
    if not _matched(keys, existing, key, "left_anti").isEmpty():
        raise KeyError(f"a {key} to delete is not there")
    return _matched(existing, keys, key, "left_anti")


def write_collection(df: DataFrame, path: str, collection: str, mode: str = "append") -> None:
    """One partition of a table of collections."""
    df.withColumn("collection", F.lit(collection)).write.mode(mode).partitionBy("collection").parquet(path)


def append_csv(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", True).csv(path)
