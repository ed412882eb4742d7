"""Distinct counts from stored sketches: one small value per hour and key, united for any span of hours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Binary logarithm of the registers of a sketch. The standard error is 1.04 / sqrt(2 ** LOG_REGISTERS), 1.6 %.
LOG_REGISTERS = 12


def hourly_sketches(rows: DataFrame, value: str, keys: Sequence[str] = (), time: str = "ts", log_registers: int = LOG_REGISTERS) -> DataFrame:
    """``hour``, the keys and a sketch of the distinct values of each hour; null values count as none.

    To be stored; later hours and late parts of an hour are further rows, and uniting them gives what one
    pass over all rows would give.
    """
    hour = F.date_trunc("hour", F.col(time).cast("timestamp")).alias("hour")
    sketch = F.hll_sketch_agg(F.col(value), F.lit(log_registers)).alias("sketch")
    return rows.where(F.col(time).isNotNull()).groupBy(hour, *keys).agg(sketch)


def distinct_in(sketches: DataFrame, keys: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """The keys and ``estimate``, the distinct values in the hours of ``where`` (all of them without)."""
    rows = sketches if where is None else sketches.where(where)
    return rows.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def distinct_sliding(sketches: DataFrame, hours: int, keys: Sequence[str] = (), every: int = 1) -> DataFrame:
    """``from_ts``, ``to_ts``, the keys and ``estimate`` for windows of ``hours`` hours that start every ``every`` hours.

    Windows are those of Spark's ``window``; an hour's sketch goes to the windows it lies in, so a span costs a row for
    each hour and key however many rows there were.
    """
    window = F.window("hour", f"{hours} hours", f"{every} hours")
    found = sketches.groupBy(window.alias("_window"), *keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
    return found.select(F.col("_window.start").alias("from_ts"), F.col("_window.end").alias("to_ts"), *keys, "estimate")
