"""Serving tables laid out by key bucket: an upsert rewrites the buckets it touches, a lookup reads those of its keys.

A bucket's rows are sorted by key in files with Bloom filters. A load writes the touched buckets to a folder
of its own and then one row of the manifest, which tells for every bucket which load has it. Readers follow the newest
manifest row, so they see the table before or after a load, never between.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from vendue.operators.ranking import latest_per_key

MANIFEST = "turn bigint, load_ts timestamp, schema string, loads map<int,bigint>"
BUCKETS = 64
#: Touched buckets are written by this many files each, split by key range, when the load is large.
ROWS_PER_FILE = 1_000_000


class BucketStore:
    """Tables below one folder, each with a fixed number of buckets and key columns."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def _bucket(self, keys: Sequence[str]) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def _newest(self, name: str):
        try:
            rows = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/{name}/_manifest")
        except AnalysisException:  # nothing has been loaded
            return None
        return rows.orderBy(F.desc("turn")).first()

    def _folders(self, name: str, loads: dict[int, int], wanted: Sequence[int] | None = None) -> list[str]:
        return [f"{self.root}/{name}/load={turn}/bucket={b}" for b, turn in sorted(loads.items()) if wanted is None or b in wanted]

    def _read(self, name: str, newest, wanted: Sequence[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(_json(newest["schema"]))
        folders = self._folders(name, newest["loads"], wanted)
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def read(self, name: str) -> DataFrame:
        """Current rows of all buckets."""
        newest = self._newest(name)
        if newest is None:
            raise ValueError(f"no table {name}")
        return self._read(name, newest)

    def files(self, name: str) -> dict[int, list[str]]:
        """Files of each bucket that readers see now."""
        newest = self._newest(name)
        out: dict[int, list[str]] = {}
        for path in sorted(self._read(name, newest).inputFiles()) if newest else ():  # Spark gives them in any order
            out.setdefault(int(os.path.basename(os.path.dirname(path)).split("=")[1]), []).append(path)
        return out

    def upsert(self, name: str, df: DataFrame, keys: Sequence[str], load_ts: datetime) -> list[int]:
        """Rows replace those of equal key; others stay. Gives the buckets that were rewritten.

        Of equal keys within a load the row with the largest hash over its columns counts, so a repeated load
        gives the same table. Null keys are equal to each other. Columns must be those of the table.
        """
        newest = self._newest(name)
        turn = 1 if newest is None else newest["turn"] + 1
        content = F.xxhash64(*[f"`{c}`" for c in df.columns])
        rank = lambda load: F.struct(F.lit(load).alias("load"), content.alias("row"))
        rows = df.withColumns({"_bucket": self._bucket(keys), "_rank": rank(turn)})
        touched = sorted(r[0] for r in rows.select("_bucket").distinct().collect())  # at most the number of buckets
        if not touched:
            return []
        if newest is not None:
            wanted = [b for b in touched if b in newest["loads"]]
            before = self._read(name, newest, wanted)
            if sorted(before.columns) != sorted(df.columns):
                raise ValueError(f"columns of {name} are {before.columns}")
            before = before.select(*df.columns)
            rows = before.withColumns({"_bucket": self._bucket(keys), "_rank": rank(0)}).unionByName(rows)
        rows = rows.withColumn("_turn", F.col("_rank.load"))
        kept = latest_per_key(rows, [*keys, "_bucket"], "_turn", ties="_rank").drop("_turn", "_rank")
        parts = max(len(touched), kept.count() // ROWS_PER_FILE)
        writer = kept.withColumnRenamed("_bucket", "bucket").repartitionByRange(parts, "bucket", *keys).sortWithinPartitions("bucket", *keys).write
        for key in keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        writer.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/{name}/load={turn}")
        loads = {} if newest is None else dict(newest["loads"])
        loads |= {b: turn for b in touched}
        row = [(turn, load_ts, df.schema.json(), loads)]
        self.spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/{name}/_manifest")
        return touched

    def lookup(self, name: str, wanted: DataFrame, keys: Sequence[str], limit: int = 10_000) -> DataFrame:
        """Rows whose key is among those of ``wanted``.

        Only buckets of the keys are read. Up to ``limit`` keys go to the scan as conditions on every key column, which
        skip row groups by their bounds and Bloom filters; more are joined.
        """
        newest = self._newest(name)
        if newest is None:
            raise ValueError(f"no table {name}")
        wanted = wanted.select(*keys).dropna().distinct()
        buckets = {r[0] for r in wanted.select(self._bucket(keys)).distinct().collect()}  # at most the number of buckets
        rows = self._read(name, newest, sorted(buckets))
        few = wanted.limit(limit + 1).collect()
        if len(few) <= limit:
            for key in keys:
                rows = rows.where(F.col(key).isin(sorted({r[key] for r in few})))
        return rows.join(wanted, list(keys), "left_semi")


def _json(text: str):
    import json

    return json.loads(text)
