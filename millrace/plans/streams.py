"""Streaming queries over ``events``, drained to their end, with batch oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.plans.registry import query, table
from millrace.streaming import events as E


def _stream(spark, sf_dir):
    return E.read_events(spark, sf_dir, table(spark, sf_dir, "events").schema, "events.parquet")


def _name(kind: str) -> str:
    return f"{kind}_{uuid.uuid4().hex[:8]}"


@query("stream_tumbling_windows", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def stream_tumbling_windows(spark, sf_dir):
    out = E.drain(E.tumbling(_stream(spark, sf_dir), "ts", "1 hour", ["event_type"]), _name("tumbling"), "complete")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("stream_sliding_windows", "SELECT time_bucket(INTERVAL 30 MINUTE, ts) - to_minutes(30 * k) AS window_start, count(*) AS n FROM events, (VALUES (0), (1)) AS s(k) GROUP BY 1")
def stream_sliding_windows(spark, sf_dir):
    out = E.drain(E.sliding(_stream(spark, sf_dir), "ts", "1 hour", "30 minutes"), _name("sliding"), "complete")
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n")


@query("stream_distinct_users", "SELECT DISTINCT user_id FROM events")
def stream_distinct_users(spark, sf_dir):
    out = E.drain(E.distinct(_stream(spark, sf_dir).select("ts", "user_id"), "ts", ["user_id"], "36500 days"), _name("distinct"), "append")
    return out.select("user_id")


@query("stream_accumulate", "SELECT user_id, round(sum(value), 4) AS state, count(*) AS n FROM events GROUP BY user_id")
def stream_accumulate(spark, sf_dir):
    out = E.drain(E.accumulate(_stream(spark, sf_dir), "user_id", "value"), _name("accumulate"), "update")
    return out.groupBy("user_id").agg(F.max_by("state", "n").alias("state"), F.max("n").alias("n")).withColumn("state", F.round("state", 4))
