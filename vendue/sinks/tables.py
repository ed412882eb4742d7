"""Serving tables as Parquet with two slots and a pointer.

A load goes to the idle slot; then one row is appended to the pointer table.
Readers follow the newest pointer row and never see half a load.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from vendue.operators.ranking import latest_per_key
from vendue.plans.recommend import item_master

SLOTS = ("10", "20")
POINTER = "name string, slot string, turn bigint, load_ts timestamp"


class Store:
    """Serving tables below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _pointers(self, name: str) -> DataFrame:
        return self.spark.read.schema(POINTER).parquet(f"{self.root}/_pointer").where(F.col("name") == name)

    def current_slot(self, name: str) -> str | None:
        """Slot that readers of the table use."""
        return self._current(name)[0]

    def _current(self, name: str) -> tuple[str | None, int]:
        try:
            row = self._pointers(name).agg(F.max_by("slot", "turn").alias("slot"), F.max("turn").alias("turn")).first()
        except AnalysisException:  # no pointer table yet
            return None, 0
        return row["slot"], row["turn"] or 0

    def exists(self, name: str) -> bool:
        return self.current_slot(name) is not None

    def read(self, name: str, cols: Sequence[str] | None = None) -> DataFrame:
        """Current rows; with ``cols`` those columns, missing values as blanks."""
        slot = self.current_slot(name)
        if slot is None:
            raise ValueError(f"no table {name}")
        rows = self.spark.read.parquet(f"{self.root}/{name}/slot={slot}")
        return rows if cols is None else rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in cols])

    def swap(self, name: str, df: DataFrame, load_ts: datetime | None = None) -> str:
        """Load the idle slot, then point readers to it."""
        slot, turn = self._current(name)
        idle = SLOTS[1] if slot == SLOTS[0] else SLOTS[0]
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/slot={idle}")
        moment = load_ts or datetime.now()
        self.spark.createDataFrame([(name, idle, turn + 1, moment)], POINTER).coalesce(1).write.mode("append").parquet(
            f"{self.root}/_pointer"
        )
        return idle

    def replace(self, name: str, df: DataFrame, load_ts: datetime | None = None) -> None:
        """Empty the table and load it."""
        self.swap(name, df, load_ts)

    def upsert(self, name: str, df: DataFrame, keys: Sequence[str], load_ts: datetime) -> None:
        """Rows replace those of equal key; others stay. Rows carry the time of their load.

        Of equal times the load that comes now wins, and of equal keys within a load the row
        with the largest hash over its columns, so a repeated load gives the same table.
        """
        content = F.xxhash64(*df.columns)
        stamped = df.withColumn("load_ts", F.lit(load_ts).cast("timestamp")).withColumn("_rank", F.struct(F.lit(1).alias("load"), content.alias("row")))
        if self.exists(name):
            before = self.read(name).withColumn("_rank", F.struct(F.lit(0).alias("load"), content.alias("row")))
            stamped = before.unionByName(stamped)
        self.swap(name, latest_per_key(stamped, keys, "load_ts", ties="_rank").drop("_rank"), load_ts)

    def copy(self, source: str, target: str) -> None:
        """Copy of a table under another name."""
        self.swap(target, self.read(source))

    def publish_items(self, items: DataFrame, name: str = "item") -> str:
        """Item, brand and category of all items, as a new slot."""
        return self.swap(name, item_master(items))
