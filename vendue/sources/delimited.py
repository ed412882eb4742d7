"""Delimited text with fields by position, described by a layout."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vendue.functions.text import blank_to_null, clean, split_fields

# column -> position, or (position, type); types are SQL types, "epoch_ms" and "raw" (kept as it is)
Columns = Mapping[str, int | tuple[int, str]]


@dataclass(frozen=True)
class Layout:
    """Separator, columns by position, fewest fields of a line, and the header's first field."""

    sep: str
    columns: Columns
    min_fields: int = 0
    header: str | None = None
    strip: bool = True
    required: tuple[str, ...] = field(default=())

    @property
    def fields(self) -> int:
        """Fields a line needs: the stated number, or what the highest position asks for."""
        highest = max(at if isinstance(at, int) else at[0] for at in self.columns.values()) + 1
        return max(self.min_fields, highest)


def typed(value: Column, kind: str) -> Column:
    """Value of a text field; text that does not fit the type gives null."""
    if kind in ("string", "raw"):
        return value
    if kind == "epoch_ms":
        return F.timestamp_millis(value.try_cast("bigint"))
    if kind == "date":
        return F.substring(value, 1, 10).try_cast("date")
    return value.try_cast(kind)


def parse_lines(lines: DataFrame, layout: Layout, col: str = "value") -> DataFrame:
    """Columns of text lines; other columns of ``lines`` are kept. Blanks become null."""
    fields = F.col("_fields")
    split = lines.withColumn("_fields", split_fields(col, layout.sep)).where(F.size(fields) >= layout.fields)
    if layout.header:
        split = split.where(clean(fields[0]) != layout.header)
    kept = [c for c in lines.columns if c != col]
    out = []
    for name, at in layout.columns.items():
        position, kind = (at, "string") if isinstance(at, int) else at
        value = fields[position]
        if layout.strip and kind != "raw":
            value = clean(value)
        out.append(typed(blank_to_null(value), kind).alias(name))
    parsed = split.select(*out, *kept)
    for name in layout.required:
        parsed = parsed.where(F.col(name).isNotNull())
    return parsed


def read_delimited(spark: SparkSession, path: str, layout: Layout, where: Column | None = None) -> DataFrame:
    """Files of one layout. ``where`` may use partition columns of the path (``dt=``, ``hh=``),
    so that only the folders asked for are listed and read."""
    lines = spark.read.text(path)
    if where is not None:
        lines = lines.where(where)
    return parse_lines(lines, layout)
