"""Short forms of relational steps that the plans and their users repeat."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_cols(df: DataFrame, mapping: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Columns by name, or renamed from old to new."""
    if isinstance(mapping, Mapping):
        return df.select(*[F.col(old).alias(new) for old, new in mapping.items()])
    return df.select(*mapping)


def orders_since(df: DataFrame, since: date) -> DataFrame:
    return df.where(F.col("order_date") >= F.lit(since))


def pick_max(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One row per key with the largest value of each column."""
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in cols])


def count_by(df: DataFrame, keys: Sequence[str], out: str = "cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def count_distinct(df: DataFrame, keys: Sequence[str], col: str, out: str = "cnt", approx: bool = False) -> DataFrame:
    """Distinct values per key, exact or by sketch."""
    func = F.approx_count_distinct if approx else F.countDistinct
    return df.groupBy(*keys).agg(func(col).alias(out))


def sum_by(df: DataFrame, keys: Sequence[str], col: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(col).alias(out))


def total(df: DataFrame, col: str, out: str = "total") -> DataFrame:
    return df.agg(F.sum(col).alias(out))
