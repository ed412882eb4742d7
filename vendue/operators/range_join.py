"""Pairs of rows with equal keys whose times lie within an interval."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendue.operators.ranking import small_or_plain

#: Right rows of a bin from which it is split, and the rows of a part then.
HEAVY_BIN = 100_000


def _micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    start: timedelta,
    end: timedelta,
    heavy: int = HEAVY_BIN,
) -> DataFrame:
    """All pairs with equal ``on`` and ``right_time`` from ``left_time + start`` to ``left_time + end``, both ends included.

    Columns: ``on``, the others of ``left``, the others of ``right``; these must differ in name. Rows with a null key or time
    have no partner; repeated rows make pairs of their own.

    Times are cut into bins as wide as the interval, so a left row looks into two bins and a pair is found in one of them.
    Joining on key and bin keeps a hot key from being one group; a bin with more than ``heavy`` right rows is
    dealt to parts, and the left rows that look into it go to all of them.
    """
    if end < start:
        raise ValueError("the interval ends before it starts")
    low, high = (int(t / timedelta(microseconds=1)) for t in (start, end))
    width = max(1, high - low)
    others = [c for c in left.columns if c not in on], [c for c in right.columns if c not in on]
    if set(others[0]) & set(others[1]):
        raise ValueError(f"columns on both sides: {sorted(set(others[0]) & set(others[1]))}")
    keys = [f"_key{i}" for i in range(len(on))]
    at, row = _micros(F.col("_time")), F.struct

    def side(frame: DataFrame, time: str, columns: Sequence[str]) -> DataFrame:
        named = [F.col(f"`{k}`").alias(n) for k, n in zip(on, keys, strict=True)]
        rows = frame.select(*named, F.col(f"`{time}`").alias("_time"), row(*[F.col(f"`{c}`") for c in columns], F.lit(0).alias("_")).alias("_row"))
        return rows.dropna(subset=[*keys, "_time"]).withColumn("_at", at).drop("_time")

    ours, theirs = side(left, left_time, others[0]), side(right, right_time, others[1])
    theirs = theirs.withColumn("_bin", F.floor(F.col("_at") / F.lit(width)).cast("long"))
    first = F.floor((F.col("_at") + low) / F.lit(width)).cast("long")
    last = F.floor((F.col("_at") + high) / F.lit(width)).cast("long")
    ours = ours.withColumn("_bin", F.explode(F.sequence(first, last)))
    # bins that are too full, with the number of their parts
    full = theirs.groupBy(*keys, "_bin").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > heavy)
    full = small_or_plain(full.select(*keys, "_bin", F.ceil(F.col("_n") / F.lit(heavy)).cast("int").alias("_parts")))
    if full.isEmpty():
        ours, theirs = (f.withColumn("_part", F.lit(0)) for f in (ours, theirs))
    else:
        parts = F.coalesce(F.col("_parts"), F.lit(1))
        theirs = theirs.join(full, [*keys, "_bin"], "left").withColumn("_part", F.pmod(F.xxhash64("_at", "_row"), parts).cast("int"))
        ours = ours.join(full, [*keys, "_bin"], "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    near = F.col("_there") - F.col("_at")
    theirs = theirs.select(*keys, "_bin", "_part", F.col("_at").alias("_there"), F.col("_row").alias("_other"))
    pairs = ours.join(theirs, [*keys, "_bin", "_part"]).where(near.between(low, high))
    named = [F.col(n).alias(k) for k, n in zip(on, keys, strict=True)]
    return pairs.select(*named, *[F.col(f"_row.`{c}`").alias(c) for c in others[0]], *[F.col(f"_other.`{c}`").alias(c) for c in others[1]])
