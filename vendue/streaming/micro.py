"""Hourly jobs as micro-batches over what has arrived."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from vendue.sources.delimited import Layout, parse_lines


def read_stream(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Files of a folder as a stream."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def read_log_stream(spark: SparkSession, path: str, layout: Layout, **options: str) -> DataFrame:
    """Text log files of a folder as a stream of parsed rows."""
    return parse_lines(read_stream(spark, path, "value string", "text", **options), layout)


def run_available(
    stream: DataFrame,
    sink: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Take all files that arrived since the last run, write Parquet, stop.

    The checkpoint remembers the files taken, so a run that failed is repeated
    without loss or duplicates.
    """
    rows = transform(stream) if transform else stream
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.trigger(availableNow=True).start(sink)
    query.awaitTermination()
    return query


def run_merged(
    stream: DataFrame, target: str, checkpoint: str, count: Callable[[DataFrame], DataFrame]
) -> StreamingQuery:
    """Take all files that arrived since the last run and keep the counts of each batch in a folder of its own.

    A batch that runs again after a failure overwrites its folder, so no row counts twice.
    """

    def keep(batch: DataFrame, number: int) -> None:
        count(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    query = (
        stream.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def merged(spark: SparkSession, target: str, keys: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """Counts of all batches, added up per key."""
    rows = spark.read.parquet(target)
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts])
