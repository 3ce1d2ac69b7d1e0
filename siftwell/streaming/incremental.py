"""Streams: duplicates within a watermark, and windows of metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_stream(stream: DataFrame, text: str, time: str, delay: str = "1 hour") -> DataFrame:
    """First record of each text among those that arrive within the delay; the state is bounded by the watermark."""
    return stream.withColumn("__key", F.sha2(F.col(text), 256)).withWatermark(time, delay).dropDuplicatesWithinWatermark(["__key"]).drop("__key")


def latency_windows(stream: DataFrame, by: str, value: str, time: str, width: str = "10 minutes", delay: str = "10 minutes") -> DataFrame:
    return stream.withWatermark(time, delay).groupBy(F.window(time, width), by).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.max(value).alias("most"))


def resume(batch: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a restarted run still has to do; for foreachBatch."""
    return batch.join(done.select(key), key, "left_anti")
