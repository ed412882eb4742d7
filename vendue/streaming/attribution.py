"""Last-touch attribution over streams: an interval join of carts and visits with watermarks on both sides.

The state store keeps visits for the look-back only and carts until the visits before them are there. What a join finds is
written by the hour of the cart; when hours are over, their carts are attributed by the same rules as in a batch, from
the visits that were found for them.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from vendue.operators.attribution import KEYS, attribute_last_touch
from vendue.streaming.micro import run_available


def _hour(time: str):
    return F.date_format(F.date_trunc("hour", time), "yyyyMMddHH").alias("hour")


class StreamedTouch:
    """Carts and the visits before them, below a folder.

    ``delay`` is how late rows may come. Visits of a nameless visitor meet carts of a nameless one, as in the batch.
    """

    def __init__(self, folder: str, cart_schema: StructType, visit_schema: StructType, lookback: str = "6 hours", delay: str = "1 hour"):
        self.folder, self.lookback, self.delay = folder.rstrip("/"), lookback, delay
        self.cart_schema, self.visit_schema = cart_schema, visit_schema

    def run(self, carts: DataFrame, visits: DataFrame) -> StreamingQuery:
        """Take what has arrived of both streams and stop."""
        run_available(carts.withColumn("hour", _hour("ts")), f"{self.folder}/carts", f"{self.folder}/state-carts", partition_by=["hour"])
        visit = F.struct(*[F.col(f"`{c}`") for c in visits.columns]).alias("visit")
        ours = carts.withWatermark("ts", self.delay).select(*[F.col(k).alias(f"_{k}") for k in KEYS], "ts", _hour("ts"))
        theirs = visits.withWatermark("ts", self.delay).select(*KEYS, F.col("ts").alias("visit_ts"), visit)
        same = F.lit(True)
        for key in KEYS:
            same = F.col(f"_{key}").eqNullSafe(F.col(key)) if key == KEYS[0] else same & F.col(f"_{key}").eqNullSafe(F.col(key))
        within = (F.col("visit_ts") <= F.col("ts")) & (F.col("visit_ts") >= F.col("ts") - F.expr(f"INTERVAL {self.lookback}"))
        found = ours.join(theirs, same & within).select("hour", "visit")

        def keep(batch: DataFrame, number: int) -> None:
            # a visit once for the carts of an hour; ranges of hours, so that there are about as many files as hours and tasks together
            once = batch.distinct().repartitionByRange("hour", F.xxhash64("visit"))
            once.write.mode("overwrite").partitionBy("hour").parquet(f"{self.folder}/visits/batch={number}")

        query = found.writeStream.foreachBatch(keep).option("checkpointLocation", f"{self.folder}/state-join").trigger(availableNow=True).start()
        query.awaitTermination()
        return query

    def _hours(self, spark: SparkSession, part: str, schema: StructType, after: datetime, until: datetime) -> DataFrame:
        rows = spark.read.schema(schema.add("hour", "string")).option("basePath", f"{self.folder}/{part}")
        rows = rows.parquet(f"{self.folder}/{part}")
        return rows.where(F.col("hour").between(after.strftime("%Y%m%d%H"), until.strftime("%Y%m%d%H"))).drop("hour")

    def closed(self, spark: SparkSession, after: datetime, until: datetime, **rules) -> DataFrame:
        """Attribution of the cart lines from after ``after`` to ``until``; only the folders of these hours are read.

        Equal to the batch over these lines and all visits, once the watermarks have passed ``until``.
        """
        carts = self._hours(spark, "carts", StructType(list(self.cart_schema)), after, until)
        carts = carts.where((F.col("ts") > F.lit(after)) & (F.col("ts") <= F.lit(until)))
        kept = StructType().add("visit", self.visit_schema)
        visits = self._hours(spark, "visits", kept, after, until).select("visit.*").distinct()
        return attribute_last_touch(carts, visits, self.lookback, **rules)
