"""Event streams: watermarked windows, deduplication and keyed state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.sources import scratch


def read_events(spark: SparkSession, folder: str, schema, files: str = "*.parquet", files_per_trigger: int = 1) -> DataFrame:
    """Parquet files of a folder as they arrive, oldest first."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).option("pathGlobFilter", files).parquet(folder)


def tumbling(events: DataFrame, time: str, width: str, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """Counts and sums by event-time window; windows close once the watermark has passed them."""
    at = F.window(F.col(time).cast("timestamp"), width)
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(at.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), *keys, "n", "total")


def sliding(events: DataFrame, time: str, width: str, slide: str, late: str = "10 minutes") -> DataFrame:
    at = F.window(F.col(time).cast("timestamp"), width, slide)
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(at.alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), "n")


def session_counts(events: DataFrame, time: str, key: str, gap: str, late: str = "10 minutes") -> DataFrame:
    at = F.session_window(F.col(time).cast("timestamp"), gap)
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(at.alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("session_start"), key, "n")


def distinct(events: DataFrame, time: str, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """First row of each key within the watermark."""
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def accumulate(events: DataFrame, key: str, value: str, fold: Callable[[float, float], float] = lambda a, b: a + b) -> DataFrame:
    """Running ``fold`` of ``value`` for each key (long), kept in the state store; emits the state after each batch."""

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now, n = state.get if state.exists else (None, 0)
        for frame in frames:
            for v in frame.sort_values("_seq")[value]:
                now, n = (v if now is None else fold(now, v)), n + 1
        state.update((now, n))
        yield pd.DataFrame({key: [k[0]], "state": [now], "n": [n]})

    rows = events.select(F.col(key).cast("long").alias(key), F.col(value).cast("double").alias(value), F.col("event_id").alias("_seq"))
    return rows.groupBy(key).applyInPandasWithState(step, f"{key} long, state double, n long", "state double, n long", "update", GroupStateTimeout.NoTimeout)


def drain(stream: DataFrame, name: str, mode: str, checkpoint: str | None = None) -> DataFrame:
    """Runs a stream over all that is there into a Parquet table, a folder for each batch, and returns that: the last batch in complete mode, else all."""
    spark, folder, done = stream.sparkSession, scratch.folder(stream.sparkSession, name), []

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={epoch}")  # a repeated batch takes its own place
        done.append(epoch)

    writer = stream.writeStream.foreachBatch(keep).outputMode(mode).trigger(availableNow=True)
    writer.option("checkpointLocation", checkpoint or f"{folder}-progress").start().awaitTermination()
    if not done:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(f"{folder}/batch={max(done)}" if mode == "complete" else f"{folder}/*")


def upsert_batches(stream: DataFrame, path: str, key: str, order: str):
    """Starts a sink that keeps the latest row of each key in a Parquet table, one version folder per batch."""

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        rows = batch
        if epoch:  # a late, older row must not take the place of a newer one
            rows = spark.read.schema(batch.schema).parquet(f"{path}/v{epoch - 1}").unionByName(batch)
        latest = rows.groupBy(key).agg(F.max_by(F.struct(*batch.columns), order).alias("r")).select("r.*")
        latest.write.mode("overwrite").parquet(f"{path}/v{epoch}")

    return stream.writeStream.foreachBatch(write).trigger(availableNow=True).start()
