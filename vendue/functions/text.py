"""Text predicates and clean-up used by readers and queries."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def alias_value(name: str | Column, mapping: Mapping[str, str]) -> Column:
    """Replace some values by others; the rest stays."""
    col = _col(name)
    out = col
    for source, target in mapping.items():
        out = F.when(col == source, F.lit(target)).otherwise(out)
    return out


def map_code(name: str | Column, rules: Mapping[str, str], default: str | None = None) -> Column:
    """Code table lookup; values not listed give ``default``."""
    col = _col(name)
    out = F.lit(default)
    for source, target in reversed(list(rules.items())):
        out = F.when(col == source, F.lit(target)).otherwise(out)
    return out


def present(name: str | Column) -> Column:
    """Neither null nor empty."""
    col = _col(name)
    return col.isNotNull() & (col != "")


def blank_to_null(name: str | Column) -> Column:
    col = _col(name)
    return F.when(col != "", col)


def default_if_blank(name: str | Column, value: str | Column) -> Column:
    other = value if isinstance(value, Column) else F.lit(value)
    return F.coalesce(blank_to_null(name), other)


def valid_key(name: str | Column, n: int = 13) -> Column:
    """Exactly ``n`` digits."""
    return _col(name).rlike(f"^[0-9]{{{n}}}$")


def any_of(patterns: Sequence[str]) -> str:
    """Regular expression that matches any of the literal texts."""
    return "|".join(re.escape(p) for p in patterns)


def page_in(name: str | Column, patterns: Sequence[str]) -> Column:
    """Contains one of the texts; one scan of the value for all of them."""
    return _col(name).rlike(any_of(patterns))


def replace_text(name: str | Column, mapping: Mapping[str, str]) -> Column:
    out = _col(name)
    for source, target in mapping.items():
        out = F.replace(out, F.lit(source), F.lit(target))
    return out


def clean(name: str | Column) -> Column:
    """Drop double quotes, then blanks at both ends."""
    return F.trim(F.replace(_col(name), F.lit('"'), F.lit("")))


def rstrip(name: str | Column) -> Column:
    return F.regexp_replace(_col(name), r"\s+$", "")


def split_fields(name: str | Column, sep: str) -> Column:
    """Fields between literal separators, empty ones at the end included."""
    return F.split(_col(name), re.escape(sep), -1)


def pad_key(name: str | Column, n: int = 13) -> Column:
    """Zeros in front up to ``n`` characters; longer keys stay as they are."""
    col = _col(name)
    return F.when(F.length(col) < n, F.lpad(col, n, "0")).otherwise(col)


def starts_with_any(name: str | Column, prefixes: Sequence[str]) -> Column:
    col = _col(name)
    out = F.lit(False)
    for prefix in prefixes:
        out = out | col.startswith(prefix)
    return out
