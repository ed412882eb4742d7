"""Windows and sessions in event time: state is held until a watermark passes, results are written once.

A run takes what has arrived since the last one. Rows are counted per batch and window first; counts of windows that
the watermark has passed already go to a table of late counts, the others to a second stream that adds them up in
its state and writes each window when it closes. Neither reads anything twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from vendue.plans.events import COUNTER_KEYS, ad_counts, ad_dimensions
from vendue.streaming.ads import COUNTS, WINDOW_KEYS, sliding_counts


class Windows:
    """Event-time counts below a folder: open windows in a state store, closed and late ones as files.

    ``count`` turns rows into one row per window and key with the columns ``keys`` and ``counts``; ``end`` is the key that
    tells when a window ends. A window closes when a row is seen whose window ends ``delay`` or more after it.
    """

    def __init__(self, folder: str, count: Callable[[DataFrame], DataFrame], keys: Sequence[str], counts: Sequence[str], end: str, delay: timedelta):
        self.folder, self.count, self.delay = folder.rstrip("/"), count, delay
        self.keys, self.counts, self.end = list(keys), list(counts), end

    def _read(self, spark: SparkSession, part: str) -> DataFrame | None:
        try:
            return spark.read.parquet(f"{self.folder}/{part}")
        except AnalysisException:  # nothing was written there yet
            return None

    def _seen_until(self, spark: SparkSession, batch: int):
        """The newest window end of the batches before; one row a batch is read."""
        seen = self._read(spark, "progress")
        return None if seen is None else seen.where(F.col("batch") < batch).agg(F.max("newest")).first()[0]

    def run(self, stream: DataFrame, finish: bool = False) -> list[StreamingQuery]:
        """Take what has arrived and stop. ``finish`` closes every window: nothing may follow that is not late."""
        spark = stream.sparkSession

        def split(batch: DataFrame, number: int) -> None:
            own = batch.sparkSession
            newest = self._seen_until(own, number)
            counted = self.count(batch).persist()
            late = F.lit(False) if newest is None else F.col(self.end) <= F.lit(newest - self.delay)
            counted.where(late).write.mode("overwrite").parquet(f"{self.folder}/late/batch={number}")
            counted.where(~late).write.mode("overwrite").parquet(f"{self.folder}/arrived/batch={number}")
            progress = counted.agg(F.max(self.end).alias("newest"))
            progress.write.mode("overwrite").parquet(f"{self.folder}/progress/batch={number}")
            counted.unpersist()

        taken = stream.writeStream.foreachBatch(split).option("checkpointLocation", f"{self.folder}/state-arrived").trigger(availableNow=True).start()
        taken.awaitTermination()
        if self._read(spark, "arrived") is None:
            return [taken]
        schema = self._read(spark, "arrived").drop("batch").schema
        if finish:
            far = self._seen_until(spark, 1 << 60)
            if far is not None:
                marker = [far + 2 * self.delay + timedelta(days=1) if f.name == self.end else None for f in schema]
                spark.createDataFrame([tuple(marker)], schema).write.mode("overwrite").parquet(f"{self.folder}/arrived/batch=-1")
        counts = spark.readStream.schema(schema).parquet(f"{self.folder}/arrived").drop("batch")
        closed = (
            counts.withWatermark(self.end, f"{int(self.delay.total_seconds())} seconds")
            .groupBy(*self.keys)
            .agg(*[F.sum(c).alias(c) for c in self.counts])
        )
        added = (
            closed.writeStream.format("parquet").outputMode("append").option("path", f"{self.folder}/closed")
            .option("checkpointLocation", f"{self.folder}/state-closed").trigger(availableNow=True).start()
        )
        added.awaitTermination()
        return [taken, added]

    def closed(self, spark: SparkSession) -> DataFrame:
        """Windows written so far, as they were when they closed."""
        return spark.read.parquet(f"{self.folder}/closed").select(*self.keys, *self.counts)

    def late(self, spark: SparkSession) -> DataFrame:
        """Counts that came after their window had closed."""
        return spark.read.parquet(f"{self.folder}/late").select(*self.keys, *self.counts)

    def complete(self, spark: SparkSession) -> DataFrame:
        """Closed windows with the late counts added once."""
        both = self.closed(spark).unionByName(self.late(spark))
        return both.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in self.counts])


def ad_windows(folder: str, delay: timedelta = timedelta(hours=1)) -> Windows:
    """Ad counters per minute; a minute ends with its beginning, as windows are told apart by it."""

    def count(rows: DataFrame) -> DataFrame:
        rows = ad_dimensions(rows).withColumn("minute", F.date_trunc("minute", F.col("ts").cast("timestamp")))
        return rows.groupBy(*COUNTER_KEYS).agg(*ad_counts())

    return Windows(folder, count, COUNTER_KEYS, COUNTS, "minute", delay)


def visit_windows(folder: str, length: str = "6 hours", slide: str = "1 hour", delay: timedelta = timedelta(hours=1)) -> Windows:
    """Visits per visitor in sliding windows."""
    return Windows(folder, lambda rows: sliding_counts(rows, length, slide), WINDOW_KEYS, ["visits"], "to_ts", delay)


def sessions(rows: DataFrame, gap: str = "30 minutes", keys: Sequence[str] = ("visitor_id",)) -> DataFrame:
    """Sessions of each key: events with the gap at most between neighbours. ``to_ts`` is the last event.

    On a stream with a watermark on ``ts`` a late event joins the sessions on both sides of it, as long
    as the watermark has not passed them.
    """
    found = rows.groupBy(F.session_window("ts", gap).alias("_session"), *keys).agg(
        F.min("ts").alias("from_ts"), F.max("ts").alias("to_ts"), F.count(F.lit(1)).alias("events")
    )
    return found.select(*keys, "from_ts", "to_ts", "events")


def run_sessions(stream: DataFrame, folder: str, gap: str = "30 minutes", delay: str = "1 hour", keys: Sequence[str] = ("visitor_id",)) -> StreamingQuery:
    """Take what has arrived and write the sessions that the watermark has passed, each once."""
    rows = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    query = (
        sessions(rows, gap, keys).writeStream.format("parquet").outputMode("append").option("path", f"{folder}/sessions")
        .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
