"""Known visitors as keyed state of a stream, with a time to live in event time.

The daily job unites the whole state with the logins of a day. Here the state store holds a visitor's
member and last login; a login touches that visitor alone, and a timer drops who has not been seen for
six months.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, date, datetime, time, timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from vendue.functions.text import present
from vendue.plans.search_best import LOGIN_MONTHS

STATE = "member_id long, updated date"
CHANGES = "visitor_id string, member_id long, updated date, gone boolean"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def months_before(day: date, months: int) -> date:
    """The day so many months earlier, the last one of a month that is too short."""
    at = day.year * 12 + day.month - 1 - months
    year, month = divmod(at, 12)
    following = date(year + (month == 11), (month + 1) % 12 + 1, 1)
    return date(year, month + 1, min(day.day, (following - timedelta(days=1)).day))


class KnownVisitor(StatefulProcessor):
    """Largest member and newest login of a visitor.

    A login within the time to live joins what is known; after a longer gap the visitor starts anew, and a login from
    before such a gap is of no use any more. The timer stands at the first day the state is too old.
    """

    def __init__(self, months: int):
        self.months = months

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", STATE)

    def _too_old(self, updated: date) -> int:
        day = updated + timedelta(days=28 * self.months)
        while months_before(day, self.months) <= updated:
            day += timedelta(days=1)
        return int(datetime.combine(day, time(), UTC).timestamp() * 1000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = held = self.known.get() if self.known.exists() else None
        logins = sorted((d, m) for part in rows for d, m in zip(part["updated"], part["member_id"], strict=True))
        for day, member in logins:
            member = int(member)
            if held is None or held[1] < months_before(day, self.months):
                held = (member, day)
            elif day >= months_before(held[1], self.months):
                held = (max(held[0], member), max(held[1], day))
        if held == before:
            return
        self.known.update(held)
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(self._too_old(held[1]))
        yield pd.DataFrame({"visitor_id": [key[0]], "member_id": [held[0]], "updated": [held[1]], "gone": [False]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.known.exists():
            member, updated = self.known.get()
            self.known.clear()
            yield pd.DataFrame({"visitor_id": [key[0]], "member_id": [member], "updated": [updated], "gone": [True]})

    def close(self) -> None:
        pass


def logins_of_clicks(clicks: DataFrame) -> DataFrame:
    """Logins of clicks with a member and a visitor; a day's clicks are known two days later."""
    return clicks.where(F.col("member_id").isNotNull() & present("visitor_id")).select(
        F.col("member_id").cast("long"), "visitor_id", F.date_add("visit_date", 2).alias("updated")
    )


def run_logins(stream: DataFrame, folder: str, months: int = LOGIN_MONTHS, delay: str = "7 days") -> StreamingQuery:
    """Take the logins (``member_id, visitor_id, updated``) that have arrived, write the visitors they change.

    Logins may be ``delay`` late. A batch that runs again overwrites its own folder.
    """
    spark = stream.sparkSession
    rows = stream.withColumn("at", F.col("updated").cast("timestamp")).withWatermark("at", delay)
    rows = rows.withColumn("visitor_id", F.col("visitor_id").cast("string"))
    changes = rows.groupBy("visitor_id").transformWithStateInPandas(
        KnownVisitor(months), outputStructType=CHANGES, outputMode="Update", timeMode="EventTime"
    )

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/changes/batch={number}")

    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKS)  # keyed state with timers needs it; read when the query starts
    try:
        query = (
            changes.writeStream.foreachBatch(keep).outputMode("update")
            .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        spark.conf.set(name, before)
    return query


def known_logins(spark: SparkSession, folder: str, as_of: date, months: int = LOGIN_MONTHS) -> DataFrame:
    """``visitor_id, member_id, updated`` of the visitors known on a day, as the daily job has them."""
    changes = spark.read.parquet(f"{folder}/changes")
    newest = F.struct("batch", "updated", ~F.col("gone"))
    last = changes.groupBy("visitor_id").agg(F.max_by(F.struct("member_id", "updated", "gone"), newest).alias("last"))
    updated = F.least(F.col("last.updated"), F.lit(as_of - timedelta(days=1)))
    rows = last.where(~F.col("last.gone")).select("visitor_id", F.col("last.member_id").alias("member_id"), updated.alias("updated"))
    return rows.where(F.col("updated") >= F.add_months(F.lit(as_of - timedelta(days=1)), -months))
