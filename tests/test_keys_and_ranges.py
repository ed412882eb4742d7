"""Interval joins, bucketed tables and sketches."""

import os
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vendue.operators.range_join import interval_join
from vendue.operators.sketches import distinct_in, distinct_sliding, hourly_sketches
from vendue.sinks.buckets import BucketStore

START = datetime(2024, 1, 1)


@pytest.mark.parametrize("heavy", [100_000, 3])
@pytest.mark.parametrize(("low", "high"), [(-10, 120), (0, 0), (5, 6), (-300, -100)])
def test_interval_join(spark, heavy, low, high):
    """Skewed keys, ends of the interval, nulls, repeated rows, times before 1970."""
    rng = random.Random(low)
    at = lambda: START + timedelta(seconds=rng.randrange(2000)) if rng.random() < 0.9 else datetime(1960, 1, 1) + timedelta(seconds=rng.randrange(300))
    left = [("hot" if rng.random() < 0.5 else rng.choice("abc"), at(), i) for i in range(120)] + [(None, START, 900), ("hot", None, 901), ("hot", START, 902), ("hot", START, 902)]
    right = [("hot" if rng.random() < 0.5 else rng.choice("abd"), at(), i) for i in range(150)] + [(None, START, 900), ("hot", None, 901), ("hot", START + timedelta(seconds=high), 902), ("hot", START + timedelta(seconds=low), 903), ("hot", START + timedelta(seconds=high, microseconds=1), 904)]
    found = interval_join(
        spark.createDataFrame(left, "k string, t timestamp, _row long"), spark.createDataFrame(right, "k string, u timestamp, _bin long"),
        ["k"], "t", "u", timedelta(seconds=low), timedelta(seconds=high), heavy=heavy,
    )
    assert found.columns == ["k", "t", "_row", "u", "_bin"]
    expected = Counter(
        (k, t, i, u, j) for k, t, i in left for k2, u, j in right
        if k and k == k2 and t and u and t + timedelta(seconds=low) <= u <= t + timedelta(seconds=high)
    )
    assert Counter(map(tuple, found.collect())) == expected


def test_interval_join_refuses(spark):
    rows = spark.createDataFrame([("a", START)], "k string, t timestamp")
    with pytest.raises(ValueError, match="both sides"):
        interval_join(rows, rows, ["k"], "t", "t", timedelta(0), timedelta(1))
    with pytest.raises(ValueError, match="ends before"):
        interval_join(rows, rows.withColumnRenamed("t", "u"), ["k"], "t", "u", timedelta(1), timedelta(0))
    assert interval_join(rows.where("false"), rows.withColumnRenamed("t", "u"), ["k"], "t", "u", timedelta(0), timedelta(1)).count() == 0


def test_bucket_upsert_leaves_other_files(spark, tmp_path):
    store = BucketStore(spark, f"{tmp_path}/t", 8)
    schema = "id long, part string, score int"
    rows = {(i, p): i for i in range(60) for p in ("x", "y")}
    as_frame = lambda some: spark.createDataFrame([(i, p, s) for (i, p), s in some.items()], schema)
    with pytest.raises(ValueError, match="no table"):
        store.read("best")
    assert store.upsert("best", as_frame(rows), ["id", "part"], START) == list(range(8))
    before = store.files("best")
    change = {(3, "x"): 300, (1000, "z"): 1}
    touched = store.upsert("best", as_frame(change), ["id", "part"], START)
    assert 1 <= len(touched) <= 2
    after = store.files("best")
    assert {b for b in before if before[b] != after.get(b)} <= set(touched)
    rows |= change
    got = {(r["id"], r["part"]): r["score"] for r in store.read("best").collect()}
    assert got == rows and store.read("best").count() == len(rows)
    # the same load again, an empty one, null keys, and two rows of a key
    store.upsert("best", as_frame(change), ["id", "part"], START)
    assert store.upsert("best", as_frame({(1, "x"): 0}).where("false"), ["id", "part"], START) == []
    twice = spark.createDataFrame([(None, "n", 1), (None, "n", 1), (5, "x", 7), (5, "x", 8)], schema)
    store.upsert("best", twice, ["id", "part"], START)
    again = store.read("best")
    assert again.count() == len(rows) + 1
    first = again.where("id = 5 and part = 'x'").first()["score"]
    store.upsert("best", twice, ["id", "part"], START)
    assert store.read("best").where("id = 5 and part = 'x'").first()["score"] == first in (7, 8)
    with pytest.raises(ValueError, match="columns"):
        store.upsert("best", twice.withColumn("more", F.lit(1)), ["id", "part"], START)


@pytest.mark.parametrize("limit", [10_000, 2])
def test_lookup_reads_few_files(spark, tmp_path, limit):
    store = BucketStore(spark, f"{tmp_path}/t", 16)
    rows = spark.range(5000).select("id", (F.col("id") % 7).cast("string").alias("part"), F.col("id").alias("v"))
    store.upsert("t", rows, ["id", "part"], START)
    wanted = spark.createDataFrame([(17, "3"), (17, "4"), (4999, "1"), (9999, "1"), (None, "1"), (17, "3")], "id long, part string")
    found = store.lookup("t", wanted, ["id", "part"], limit)
    assert sorted(r["v"] for r in found.collect()) == [17, 4999]
    if limit > 2:
        scanned = {os.path.dirname(f) for f in found.inputFiles()}
        assert len(scanned) <= 4 < 16
        assert "PushedFilters: [" in found._jdf.queryExecution().toString() and "In(id" in found._jdf.queryExecution().toString()
    with pytest.raises(ValueError, match="no table"):
        store.lookup("other", wanted, ["id", "part"])


def test_sketches_merge(spark):
    """Sketches of parts united are those of the whole; estimates are within the error; nulls count as none."""
    rng = random.Random(1)
    rows = [(START + timedelta(minutes=rng.randrange(600)), rng.randrange(3000), rng.choice("ab")) for _ in range(8000)] + [(START, None, "c"), (None, 1, "a")]
    frame = spark.createDataFrame(rows, "ts timestamp, v long, k string")
    parts = [hourly_sketches(frame.where(F.pmod(F.xxhash64("v", "ts"), F.lit(3)) == i), "v", ["k"]) for i in range(3)]
    stored = parts[0].unionByName(parts[1]).unionByName(parts[2])
    whole = {r["k"]: r["estimate"] for r in distinct_in(hourly_sketches(frame, "v", ["k"]), ["k"]).collect()}
    united = {r["k"]: r["estimate"] for r in distinct_in(stored, ["k"]).collect()}
    exact = {k: len({v for t, v, own in rows if own == k and t and v is not None}) for k in "abc"}
    assert whole == united and whole["c"] == 0
    for k in "ab":
        assert abs(whole[k] - exact[k]) < 0.05 * exact[k]
    one = distinct_in(stored, where=F.col("hour") == F.lit(START).cast("timestamp")).first()["estimate"]
    assert abs(one - len({v for t, v, _ in rows if t and t < START + timedelta(hours=1) and v is not None})) <= 0.05 * one
    spans = distinct_sliding(stored, 3).collect()
    assert len(spans) == 12
    for r in spans:
        true = len({v for t, v, _ in rows if t and r["from_ts"] <= t < r["to_ts"] and v is not None})
        assert abs(r["estimate"] - true) <= max(2, 0.06 * true)
