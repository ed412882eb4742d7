"""Boilerplate lines by their frequency relative to their site.

Pages are grouped by site, equal texts as one page; a line that more than a ratio of the
site's pages have is boilerplate there and dropped from them, while the same line on other sites stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendue.llm.common import stored

#: A line on one of ten pages of a site comes from the site, not from its authors.
MAX_RATIO = 0.1
MIN_PAGES = 5

#: Boilerplate lines (8 bytes each) that may be broadcast; beyond it pages are joined by a shuffle.
BROADCAST_LINES = 500_000
#: Parts into which each site is dealt when pages are joined by a shuffle.
SALT = 64


def line_hashes():
    """Hash of each ``\\n``-split line of ``text``; lines of white space alone have none."""
    lines = F.split("text", "\n", -1)
    return F.transform(lines, lambda x: F.when(F.trim(x, F.lit(" \t\r\x0b\x0c")) != "", F.xxhash64(x)))


def boilerplate(
    docs: DataFrame, site: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, copies: bool = False
) -> DataFrame:
    """``site, lines``: hashes of the lines that more than ``max_ratio`` of a site's pages have.

    Pages of a site with equal texts are one page, for lines and totals alike, so the lines of a page
    that is copied often are no boilerplate; with ``copies`` every row is a page. A line counts
    once per page and only from ``min_pages`` pages on. Pages without a site are not
    counted. The lines of a site are at most its mean number of lines per page divided
    by ``max_ratio``, so the array stays small however large the site is.
    """
    pages = docs.where(F.col(site).isNotNull()).select(F.col(site).cast("string").alias("site"), "text")
    if copies:
        pages = pages.select("site", F.array_distinct(line_hashes()).alias("own"))
    else:
        hashed = [F.xxhash64("text").alias("h1"), F.xxhash64("text", F.lit(1)).alias("h2")]
        pages = pages.select("site", *hashed, F.array_distinct(line_hashes()).alias("own"))
        pages = stored(pages.groupBy("site", "h1", "h2").agg(F.first("own").alias("own")), "page-texts")
    total = pages.groupBy("site").agg(F.count("*").alias("pages"))
    own = pages.select("site", F.explode("own").alias("line")).where("line is not null")
    seen = own.groupBy("site", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    common = seen.join(total, "site").where(F.col("n") > F.lit(max_ratio) * F.col("pages"))
    return common.groupBy("site").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def drop_boilerplate(
    docs: DataFrame, site: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, copies: bool = False
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and ``n_dropped``, how many they were.

    Lines are compared as they are, split at ``\\n``; lines of white space alone stay. A null text
    stays null, a text of boilerplate alone becomes empty. Pages without a site stay as they are. Every row
    stays, repeated ones and null ids as well; a column named ``n_dropped`` is replaced.
    Other columns are carried along, whatever their names. Copies of a page count as in ``boilerplate``. Only hashes of texts and lines are shuffled. Whole texts stay where they are read as long as the
    boilerplate of all sites is below ``BROADCAST_LINES``; else pages are joined by site and
    salt.
    """
    found = stored(boilerplate(docs, site, max_ratio, min_pages, copies), "boilerplate")
    columns = [c for c in docs.columns if c != "n_dropped"]
    # the caller's columns travel in one, so their names are free
    row = F.struct(*(F.col(f"`{c}`") for c in columns if c != "text"))
    rows = docs.select(row.alias("row"), F.col("text"), F.col(f"`{site}`").cast("string").alias("site"))
    size = found.agg(F.coalesce(F.sum(F.size("lines") + 10), F.lit(0))).first()[0]
    if size <= BROADCAST_LINES:
        joined = rows.join(F.broadcast(found.toDF("site", "lines")), "site", "left")
    else:
        salted = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("text"), F.lit(SALT)).cast("int"))
        joined = rows.join(salted.toDF("site", "lines", "salt"), ["site", "salt"], "left")
    own = F.array_intersect(line_hashes(), "lines")
    rows = joined.withColumn("own", F.when(F.col("lines").isNotNull() & F.col("text").isNotNull(), own))
    pairs = F.arrays_zip(F.split("text", "\n", -1).alias("line"), line_hashes().alias("hash"))
    kept = F.filter(pairs, lambda p: p["hash"].isNull() | ~F.array_contains("own", p["hash"]))
    some = F.size("own") > 0
    text = F.when(some, F.array_join(F.transform(kept, lambda p: p["line"]), "\n")).otherwise(F.col("text"))
    dropped = F.when(some, F.size(pairs) - F.size(kept)).otherwise(0).cast("long")
    out = rows.withColumn("n_dropped", dropped).withColumn("text", text)
    return out.select(*(F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in columns), "n_dropped")
