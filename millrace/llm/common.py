"""Shared helpers of the training-data operators: shared folder, written tables, shingles, components."""

from __future__ import annotations

import posixpath
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What counts as white space between words.
SPACE = "\\x20\\x09-\\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TO_LOWER = str.maketrans(UPPER, LOWER)


_LOCAL: list[str] = []


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, what: str) -> str:
    """A new path below the folder that driver and executors share (``spark.checkpoint.dir``); only a local session may lack that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _LOCAL:
            _LOCAL.append(f"file://{tempfile.mkdtemp(prefix='millrace-')}")
        base = _LOCAL[0]
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, what: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there."""
    path = shared_dir(df.sparkSession, what)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(uri: str):
    """pyarrow file system and path of a folder URI (file, hdfs, s3, gs)."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def put_file(uri: str, name: str, data: bytes) -> str:
    """Write one file whole or not at all: repeated and concurrent attempts leave the same bytes."""
    system, folder = file_system(uri)
    system.create_dir(folder, recursive=True)
    final = posixpath.join(folder, name)
    attempt = f"{final}.{uuid.uuid4().hex[:8]}.part"
    with system.open_output_stream(attempt) as out:
        out.write(data)
    system.move(attempt, final)
    return final


# Byte n-gram hashing with numpy: prefix sums of a polynomial over odd base, modulo 2**64.
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BYTE = (np.random.default_rng(20240917).integers(1, 2**63, 256, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_POWERS = [np.ones(1, np.uint64)]


def _powers(n: int) -> np.ndarray:
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 17)
        with np.errstate(over="ignore"):
            _POWERS[0] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, _BASE, np.uint64))])
    return _POWERS[0][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _inverse_powers(n: int) -> np.ndarray:
    if len(_INVERSE[0]) < n:
        inverse = pow(int(_BASE), -1, 2**64)
        with np.errstate(over="ignore"):
            _INVERSE[0] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(max(n, 1 << 17), inverse, np.uint64))])
    return _INVERSE[0][:n]


_INVERSE = [np.ones(1, np.uint64)]


def word_hashes(text: str) -> np.ndarray:
    """64-bit hash of each white-space word of the lower-cased text."""
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _powers(len(data)))])
        own = (total[end] - total[start]) * _inverse_powers(len(data))[start]
    return mix(own)


def shingles(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word ``width``-grams; a shorter text is one shingle, no words none."""
    words = word_hashes(text or "")
    if not len(words):
        return words
    n = max(1, len(words) - width + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(min(width, len(words))):
            out = out * np.uint64(0xD6E8FEB86659FD93) + words[i : i + n]
    return np.unique(mix(out))


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 40) -> DataFrame:
    """(node, component) of every node of ``edges``; component is its smallest reachable node.

    Alternating large-star and small-star steps; minima are combined map-side,
    each round is a written table, so that lost executors cost one round.
    """
    spark = edges.sparkSession
    now = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    now = written(now, "edges")
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = written(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        if now.groupBy("a").count().where("count > 1").isEmpty() and now.join(now.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
