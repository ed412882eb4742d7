"""JSON logs as VARIANT: typed fields of the records that fit, the others with the reason, and the schema of each day.

A text is parsed once. What a job needs is named with a type; a record that lacks it, or has another type there, is
set apart instead of stopping the job or getting lost. Fields that come and go show in the schema per day.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_variant(rows: DataFrame, text: str, out: str = "record") -> DataFrame:
    """``rows`` with the text as a VARIANT, null where it is no JSON."""
    return rows.withColumn(out, F.try_parse_json(F.col(text)))


def _path(field: str) -> str:
    return "$" if not field else f"$.{field}"


def reject_reason(text: Column, record: Column, fields: Mapping[str, str]) -> Column:
    """Why a record is of no use, null for a good one: the first of ``missing``, ``blank``, ``malformed``, ``no object``,
    ``no <field>`` and ``type of <field>``. A field that is JSON null is not there."""
    reason = (
        F.when(text.isNull(), "missing").when(F.trim(text) == "", "blank").when(record.isNull(), "malformed")
        .when(~F.schema_of_variant(record).startswith("OBJECT"), "no object")
    )
    for field, kind in fields.items():
        there = F.try_variant_get(record, _path(field), "variant")
        reason = reason.when(there.isNull() | F.is_variant_null(there), f"no {field}")
        reason = reason.when(F.try_variant_get(record, _path(field), kind).isNull(), f"type of {field}")
    return reason


def split_records(rows: DataFrame, text: str, fields: Mapping[str, str], extra: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Accepted rows with a column for each field, and rejected rows with ``reason``; together they are all rows.

    ``fields`` and ``extra`` map paths like ``unit.id`` to types; ``extra`` may be missing and is null then. A column is named by
    the last part of its path and replaces one of that name in accepted rows. Repeated rows stay.
    """
    marked = with_variant(rows, text, "_record")
    marked = marked.withColumn("_reason", reject_reason(F.col(text), F.col("_record"), fields))
    typed = {path.rsplit(".", 1)[-1]: F.try_variant_get("_record", _path(path), kind) for path, kind in {**fields, **(extra or {})}.items()}
    accepted = marked.where(F.col("_reason").isNull()).withColumns(typed).drop("_record", "_reason")
    rejected = marked.where(F.col("_reason").isNotNull()).drop("_record").withColumnRenamed("_reason", "reason")
    return accepted, rejected


def schema_by(rows: DataFrame, text: str, day: str) -> DataFrame:
    """Per day the schema that all its records have together, and how many are JSON: where it changes, the log did."""
    own = with_variant(rows, text, "_record").where(F.col("_record").isNotNull())
    return own.groupBy(day).agg(F.schema_of_variant_agg("_record").alias("schema"), F.count(F.lit(1)).alias("records"))
