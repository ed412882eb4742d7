"""URL rules by a sort-merge range join over reversed-host keys.

A rule for a host and a path is a prefix of the key ``reversed host, then path``, so it covers an
interval of sorted keys; intervals of prefixes nest or are apart. Rules and URLs are
sorted together, and a sweep over every partition keeps the stack of rules whose
interval is open: the top one is the longest that fits.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vendue.llm.common import ascii_lower
from vendue.session import pin

#: Ends the host part of a key; smaller than any other character, so a host's paths come before its subdomains.
END = "\x00"

RULES = "host string, path string, verdict string"


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules ``host, path, verdict`` as a frame."""
    return spark.createDataFrame(rules, RULES)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a URL; both empty without ``://`` or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def _reversed(labels: Column) -> Column:
    return F.concat_ws(".", F.reverse(labels))


def _sweep(parts: Iterator[pd.DataFrame], open_at: dict[int, list[tuple[str, str, str]]]) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    # rules whose interval began in an earlier partition and holds this partition's first key
    stack = list(open_at.get(TaskContext.get().partitionId(), ()))
    for part in parts:
        rows = []
        for key, is_url, host, path, rule, verdict in part.itertuples(index=False, name=None):
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if not is_url:
                stack.append((key, rule, verdict))
            elif stack:
                rows.append((host, path, *stack[-1][1:]))
        yield pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"], dtype=object)


def longest_rules(urls: DataFrame, rules: DataFrame, partitions: int | None = None) -> DataFrame:
    """``host, path, rule, verdict`` for every distinct ``host, path`` of ``urls`` that a rule fits.

    A rule fits its host and all subdomains if the path starts with the rule's. The longest rule
    wins (host and path together, then the longer host; of equal rules block). A
    host has one key for each number of labels that rules have, bounded by their labels.
    Rules with a null or empty host fit nothing.
    """
    spark = urls.sparkSession
    urls = urls.select("host", "path").where("host <> ''").distinct()
    # the stronger verdict of equal rules: block sorts after allow
    rules = rules.where("host is not null and host <> ''").select(ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    labels = F.split("host", r"\.", -1)
    rules = rules.select(
        F.concat(_reversed(labels), F.lit(END), "path").alias("key"), F.lit(False).alias("is_url"), "host", "path",
        F.concat("host", "path").alias("rule"), "verdict", F.size(labels).alias("depth"),
    )
    depths = [r[0] for r in rules.select("depth").distinct().collect()]  # a host has 127 labels at most
    if not depths:
        return rules.select("host", "path", "rule", "verdict").limit(0)
    own = F.filter(F.array(*(F.lit(d) for d in sorted(depths))), lambda d: d <= F.size(labels))
    suffix = F.slice(labels, F.size(labels) - F.col("depth") + 1, F.col("depth"))
    keyed = urls.withColumn("depth", F.explode(own)).select(
        F.concat(_reversed(suffix), F.lit(END), "path").alias("key"), F.lit(True).alias("is_url"), "host", "path",
        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"),
    )
    events = keyed.union(rules.drop("depth"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a host with a third of all URLs is divided by its paths and, within one, by the whole host
    order = ["key", "is_url", "host", "path"]
    events = pin(events.repartitionByRange(n, *order).sortWithinPartitions(*order))
    # as many rows as partitions, and for each the rules that are prefixes of one key
    first = events.groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct("key", "is_url")).alias("first"))
    first = first.select("part", F.col("first.key").alias("start"))
    sizes = [r[0] for r in rules.select(F.length("key").alias("n")).distinct().collect()]
    cuts = first.withColumn("n", F.explode(F.array(*(F.lit(x) for x in sizes)))).where("n <= length(start)")
    cuts = cuts.select("part", F.expr("substring(start, 1, n)").alias("key"))
    reach = rules.join(F.broadcast(cuts), "key").select("part", "key", "rule", "verdict")
    open_at: dict[int, list] = {}
    for part, key, rule, verdict in sorted(reach.collect(), key=lambda r: len(r[1])):
        open_at.setdefault(part, []).append((key, rule, verdict))
    fits = events.mapInPandas(lambda parts: _sweep(parts, open_at), "host string, path string, rule string, verdict string")
    best = F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), F.length("rule") - F.length(F.regexp_extract("rule", "(/.*)?$", 0))))
    return fits.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.rule", "best.verdict")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages``.

    Without a fitting rule, rule is null and the verdict is ``default``. A null url, or one without ``://``,
    has an empty host and path. Null ids and repeated rows stay. Each distinct host and path is
    judged once, so a URL that many rows repeat is reduced before the sort.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    found = longest_rules(rows, rules)
    return rows.join(found, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
