"""Ad counters and visit windows over streams, complete in every hour.

Counts are sums, so each batch is counted on its own and batches are added up when they are read.
Nothing waits for a watermark: the newest minute is there at once, and rows that
arrive late, in whatever order, add to the minute they belong to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendue.plans.events import COUNTER_KEYS, ad_counters
from vendue.streaming.micro import merged, run_merged

COUNTS = [
    "pv_count", "click_count", "view_count", "cart_count", "buy_count", "clip_count", "quick_count", "share_count",
    "pop_count",
]
WINDOW_KEYS = ["from_ts", "to_ts", "visitor_id"]


def sliding_counts(rows: DataFrame, length: str = "6 hours", slide: str = "1 hour") -> DataFrame:
    """Visits per visitor in windows of ``length`` that start every ``slide``."""
    return (
        rows.withColumn("ts", F.col("ts").cast("timestamp"))
        .groupBy(F.window("ts", length, slide).alias("_window"), "visitor_id")
        .agg(F.count(F.lit(1)).alias("visits"))
        .select(F.col("_window.start").alias("from_ts"), F.col("_window.end").alias("to_ts"), "visitor_id", "visits")
    )


def ad_counters_stream(stream: DataFrame, target: str, checkpoint: str) -> DataFrame:
    """Take what has arrived, and give out the ad counters of everything taken so far."""
    run_merged(stream, target, checkpoint, ad_counters)
    return merged(stream.sparkSession, target, COUNTER_KEYS, COUNTS)


def sliding_stream(
    stream: DataFrame, target: str, checkpoint: str, length: str = "6 hours", slide: str = "1 hour"
) -> DataFrame:
    """Take what has arrived, and give out the visits per window of everything taken so far."""
    run_merged(stream, target, checkpoint, lambda rows: sliding_counts(rows, length, slide))
    return merged(stream.sparkSession, target, WINDOW_KEYS, ["visits"])
