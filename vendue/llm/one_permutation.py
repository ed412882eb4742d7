"""Document fingerprints by one-permutation MinHash with optimal densification.

Every shingle of five words is hashed once; the hash chooses one of ``BINS`` bins, and a bin keeps its smallest
hash. An empty bin borrows from the first filled bin in a probing order of its own, which is as good as a filled
bin chosen at random for it, and the same for any two documents. ``BITS`` low-order bits of each bin, mixed anew
with the number of the bin, are packed; two fingerprints match in a bin by accident once in ``2 ** BITS`` times,
and the likeness is corrected for that.

Texts are compared with their successors in the order of ids. A pass over ids and hashes finds split points; texts
are then shuffled once, into ranges, with the first row of every range sent to the range before as well.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendue.llm.common import small_batches, stored
from vendue.llm.hamming_join import _mixed, shingle_set

BINS, BITS, WORDS = 512, 4, 5
#: Probes of an empty bin that are made for all empty bins at once; what is left then ranks all filled bins.
QUICK_PROBES = 8
#: Text of a range, and the share of a range that equal rows may have before they are counted in place of sent.
RANGE_BYTES = 64 << 20
HOT_SHARE = 4

_SHIFT = np.uint64(64 - (BINS.bit_length() - 1))
_SALT = _mixed(np.arange(1, BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ORDER = np.argsort(_mixed(_mixed(np.arange(1, BINS * BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))).reshape(BINS, BINS), axis=1)
_RANK = np.argsort(_ORDER, axis=1).astype(np.uint16)


def bin_sources(filled: np.ndarray) -> np.ndarray:
    """For each bin the filled bin whose value it has: itself, or the first filled one in its probing order."""
    source = np.arange(BINS)
    empty = np.flatnonzero(~filled)
    for probe in range(QUICK_PROBES):
        if not len(empty):
            return source
        tried = _ORDER[empty, probe]
        hit = filled[tried]
        source[empty[hit]] = tried[hit]
        empty = empty[~hit]
    if len(empty):
        have = np.flatnonzero(filled)
        source[empty] = have[np.argmin(_RANK[empty[:, None], have], axis=1)]
    return source


def fingerprint_of(codes: np.ndarray) -> bytes:
    """Packed fingerprint of sorted distinct shingle hashes; no shingles, no bytes."""
    if not len(codes):
        return b""
    bins = (codes >> _SHIFT).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
    value, filled = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    value[bins[first]], filled[bins[first]] = codes[first], True
    low = (_mixed(value[bin_sources(filled)] + _SALT) >> np.uint64(64 - BITS)).astype(np.uint8)
    return (low[::2] << 4 | low[1::2]).tobytes()


def fingerprint(text: str | None) -> bytes:
    """Fingerprint of a whole text: A-Z lower-cased, words between white space, fewer than five are one shingle."""
    return fingerprint_of(shingle_set(text, WORDS))


def likeness(one: bytes, two: bytes) -> float:
    """Estimated similarity of the shingle sets, 0 to 1. Texts without words are alike, and like no others."""
    if not one or not two:
        return float(one == two)
    apart = np.frombuffer(one, np.uint8) ^ np.frombuffer(two, np.uint8)
    same = (np.count_nonzero(apart & 0xF0 == 0) + np.count_nonzero(apart & 0x0F == 0)) / BINS
    by_chance = 2.0**-BITS
    return float(max(0.0, (same - by_chance) / (1 - by_chance)))


def fingerprints(text: Column) -> Column:
    """Fingerprints of a text column as lower-case hex, one digit a bin."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t).hex() for t in texts], dtype=object)

    return run(text)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many characters from the start of the next one, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("__times", pa.int64()),
])
COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare every row with the row after it in its range; rows come sorted, and each range ends with a guest."""
    import hashlib

    def row(held: tuple, text: str, fp: bytes, times: int) -> tuple:
        _, doc_id, own, own_fp, _ = held
        new = edited(own, text)
        new_fp = fingerprint(new)
        digest = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
        return doc_id, len(own), digest, own_fp.hex(), new_fp.hex(), likeness(own_fp, new_fp), likeness(own_fp, fp), times

    held = None
    for batch in batches:
        rows = []
        for span, guest, doc_id, text, times in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
            if guest and (held is None or held[0] != span):
                continue
            fp = fingerprint(text)
            if held is not None and held[0] == span:
                rows.append(row(held, text, fp, 1))
            held = None if guest else (span, doc_id, text, fp, times)
            if times > 1 and not guest:
                rows.append(row(held, text, fp, times - 1))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _OUT, strict=True)], schema=_OUT)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every row.

    The next document is that with the next doc_id, after the last one the first. Equal ids stand in the order of
    a hash of their texts, then of the texts; rows without an id come last. Repeated rows follow one another, so all but the last
    have an equal text as the next one. A null text is empty; an empty text has an empty fingerprint, which is
    like another empty one (1) and nothing else (0). A single row is its own successor, an empty table gives no rows. Other
    columns are not read, whatever their names.

    Scale: ids and hashes go to the range partitioner, texts are shuffled once. A task reads its rows in order and
    holds one at a time. Rows equal in id and text that would fill a quarter of a range are sent once, with their number.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    key = ["no_id", "doc_id", "h"]
    keyed = rows.select(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "h", F.octet_length("text").alias("bytes"))
    keys = stored(keyed.groupBy(*key).agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")), "keys")
    n_rows, n_bytes = keys.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    if not n_rows:
        return spark.createDataFrame([], COLUMNS)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // RANGE_BYTES))
    dealt = keys.repartitionByRange(n, *key).groupBy(F.spark_partition_id()).agg(F.min(F.struct(*key)).alias("first"))
    splits = sorted(tuple(r["first"]) for r in dealt.collect())  # a row for each range

    @F.pandas_udf("array<struct<span:int,guest:boolean>>")
    def spans(no_id: pd.Series, doc_id: pd.Series, h: pd.Series) -> pd.Series:
        out = []
        for one in zip(no_id, doc_id, h, strict=True):
            k = bisect_right(splits, one) - 1
            out.append([(k, False), ((k - 1) % len(splits), True)] if splits[k] == one else [(k, False)])
        return pd.Series(out, dtype=object)

    # at most HOT_SHARE * n keys have so many rows
    hot = keys.where((F.col("n") > 1) & (F.col("n") * F.lit(HOT_SHARE * n) >= F.lit(n_rows)) & (F.col("n") >= 64)).select(*key, "n")
    hot_keys = [] if n_rows < 64 else hot.collect()
    rows = rows.withColumns({"no_id": F.col("doc_id").isNull(), "id": F.coalesce("doc_id", F.lit(0))})
    place = spans("no_id", "id", "h")
    if hot_keys:
        marked = F.broadcast(spark.createDataFrame([tuple(r) for r in hot_keys], "no_id boolean, id long, h long, times long"))
        often = rows.join(marked, ["no_id", "id", "h"]).groupBy("no_id", "id", "h", "text").agg(F.count("*").alias("times"))
        rest = rows.join(marked, ["no_id", "id", "h"], "left_anti").withColumn("times", F.lit(1).cast("long"))
        rows = rest.select("no_id", "id", "h", "text", "times").unionByName(often)
    else:
        rows = rows.withColumn("times", F.lit(1).cast("long"))
    dealt = rows.select(F.inline(place), F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), "text", "times", "h")
    dealt = dealt.repartitionById(n, "span").sortWithinPartitions("span", "guest", F.col("doc_id").asc_nulls_last(), "h", "text")
    found = dealt.select("span", "guest", "doc_id", "text", "times").mapInArrow(_along, f"{COLUMNS}, __times long")
    if hot_keys:  # equal results of hot rows are multiplied in tasks of their own
        slices = F.sequence(F.lit(0).cast("long"), (F.col("__times") - 1).cast("long"), F.lit(1000).cast("long"))
        found = stored(found, "compared")
        several = found.where("__times > 1").withColumn("at", F.explode(slices)).repartition(n, "doc_id", "at")
        copies = F.sequence(F.col("at"), F.least(F.col("at") + 999, F.col("__times") - 1))
        several = several.withColumn("copy", F.explode(copies)).drop("at", "copy")
        found = found.where("__times = 1").unionByName(several)
    return found.drop("__times")
