"""Folders for what a query writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []


def folder(spark: SparkSession, what: str) -> str:
    """A new path below ``spark.checkpoint.dir``; only a local session may lack that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _LOCAL:
            _LOCAL.append(f"file://{tempfile.mkdtemp(prefix='millrace-')}")
        base = _LOCAL[0]
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` written and read again."""
    path = folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
