"""The page predicates as SQL functions, so that conditions are written in SQL and values come as parameters.

No text templates: a query names functions, and what changes from run to run (dates, sites, tables) is bound by
``:name`` markers.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from vendue.functions import pages
from vendue.functions.text import any_of


def _ends(values) -> str:
    return f"({any_of(values)})$"


def _starts(values) -> str:
    return f"^({any_of(values)})"


#: Name, arguments and pattern of each; the families are pages that explain nothing, item pages, and search.
PATTERNS: dict[str, tuple[str, str]] = {
    "noise_url": ("url", any_of(pages.NOISE_URLS)),
    "noise_screen": ("screen_code", any_of(pages.NOISE_SCREENS)),
    "detail_url": ("url", any_of(pages.DETAIL_URLS)),
    "detail_screen": ("screen_code", any_of(pages.DETAIL_SCREENS)),
    "item_view_url": ("url", any_of(pages.ITEM_VIEW_URLS)),
    "item_view_screen": ("screen_code", any_of(pages.ITEM_VIEW_SCREENS)),
    "item_url": ("url", any_of(pages.MODEL_ITEM_URLS)),
    "item_screen": ("screen_code", _ends(pages.MODEL_ITEM_SCREENS)),
    "search_url": ("url", any_of(pages.SEARCH_URLS)),
    "search_screen": ("screen_code", _ends(pages.SEARCH_SCREENS)),
    "search_area": ("area", _starts(pages.SEARCH_AREAS)),
}
#: Functions of two columns, made of those above.
EITHER = {"is_noise": ("noise_url", "noise_screen"), "is_detail": ("detail_url", "detail_screen"), "is_item_view": ("item_view_url", "item_view_screen")}


def register(spark: SparkSession) -> None:
    """Make the predicates known to the session, as temporary functions that the optimiser sees through."""
    for name, (column, pattern) in PATTERNS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({column} STRING) RETURNS BOOLEAN RETURN {column} RLIKE r'{pattern}'")
    for name, (url, screen) in EITHER.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(url STRING, screen_code STRING) RETURNS BOOLEAN"
            f" RETURN {url}(url) OR {screen}(screen_code)"
        )


def query(spark: SparkSession, text: str, frames: dict[str, DataFrame] | None = None, **values: Any) -> DataFrame:
    """The result of a SQL text with the predicates, views of ``frames`` and ``:name`` parameters.

    A table that changes from run to run is written ``IDENTIFIER(:name)``.
    """
    register(spark)
    for name, frame in (frames or {}).items():
        frame.createOrReplaceTempView(name)
    return spark.sql(text, args=values or None)
