"""Text and Parquet output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendue.plans.recommend import rule_lines


def write(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Parquet; with partition columns only the partitions written are replaced."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", single_file: bool = False, mode: str = "overwrite") -> None:
    """Text rows without header. One file only on request: it makes the last stage one task."""
    out = df.repartition(1) if single_file else df
    out.write.mode(mode).option("sep", sep).option("emptyValue", "").option("nullValue", "").csv(path)


def write_tsv(df: DataFrame, path: str, end_marker: bool = True, single_file: bool = False) -> None:
    """Tab rows; the closing marker keeps empty fields at the end of a line."""
    out = df.withColumn("_end", F.lit("END")) if end_marker else df
    write_csv(out, path, "\t", single_file)


def write_rules(rules: DataFrame, path: str) -> None:
    """Association rules as text, one line per item of the consequent."""
    rule_lines(rules).write.mode("overwrite").text(path)
