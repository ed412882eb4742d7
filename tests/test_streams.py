"""Streams that are complete whatever arrives when."""

from datetime import datetime

from vendue.streaming.ads import sliding_stream
from vendue.streaming.micro import read_stream


def test_late_hours_are_merged(spark, tmp_path):
    schema = "ts timestamp, visitor_id string"
    hours = [9, 12, 7]  # the last one arrives after a newer one
    for run, hour in enumerate(hours):
        spark.createDataFrame([(datetime(2024, 1, 1, hour, m), "v") for m in (5, 50)], schema).write.parquet(f"{tmp_path}/in/run{run}")
        stream = read_stream(spark, f"{tmp_path}/in/*", spark.createDataFrame([], schema).schema)
        found = sliding_stream(stream, f"{tmp_path}/out", f"{tmp_path}/state", "2 hours", "1 hour").collect()
        seen = {(r["from_ts"].hour, r["to_ts"].hour): r["visits"] for r in found}
        expected = {}
        for h in hours[: run + 1]:
            for start in (h - 1, h):
                expected[start, start + 2] = expected.get((start, start + 2), 0) + 2
        assert seen == expected
