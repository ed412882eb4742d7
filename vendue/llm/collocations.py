"""Phrase collocations: frequent n-grams by mergeable Misra-Gries summaries, then exact counts and scores.

The first pass turns texts into n-gram hashes. The hashes of each length are dealt to hash partitions, every task
sends one summary for each, and summaries of a partition are merged. A summary beyond its capacity takes the same
amount from all its counters. The capacity is twice the mass of a partition divided by the threshold, or more, so what is
taken in all stays below the threshold and every n-gram that is frequent enough survives. The second pass counts what
survived exactly, under the phrases themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vendue.llm.common import small_batches, stored
from vendue.llm.hamming_join import _MIX, _mixed

THRESHOLD, LONGEST, TOP = 100, 5, 2000

#: Bytes of text that are split into words at once, and words that are summarised at once.
SLICE_BYTES, SUMMARY_WORDS = 2 << 20, 1_000_000
#: Counters of a summary at least.
LEAST_CAPACITY = 1 << 16
#: Text of a hash partition.
PARTITION_BYTES = 256 << 20
#: The second pass drops n-grams by a bitmap of the survivors, of 16 bits for each and at most 16 MB.
BITS_EACH, MOST_BITS = 16, 1 << 27
BITMAP_SLICE = 1 << 19

# 0xFF and 0xFE are in no UTF-8 text: the end of a piece, the end of a document.
_PIECE, _DOCUMENT = b"\xff", b"\xfe"
_ENDS = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d", b"\n" * 10)


def _hash_words(words: list[bytes]) -> np.ndarray:
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False) if words else np.empty(0, np.uint64)


_PIECE_HASH, _DOCUMENT_HASH = _hash_words([_PIECE, _DOCUMENT])


class Words:
    """Words of a slice of a task's texts, with their hashes and languages.

    ``held`` words at the start belong to the slice before, for n-grams that cross the cut; ``lang`` is
    the number of each word's language in ``langs``.
    """

    def __init__(self, words: list[bytes], held: int, langs: list[str], first_lang: int, lang_of: list[int]):
        self.words, self.held, self.langs = words, held, langs
        hashes = _hash_words(words)
        ends = hashes == _DOCUMENT_HASH
        self.stop = ends | (hashes == _PIECE_HASH)
        numbers = np.array([first_lang, *lang_of], np.int64)
        self.lang = numbers[np.cumsum(ends)]  # after the end of a document comes the next one's language
        seeds = _hash_words([x.encode("utf-8", "surrogatepass") + b"\xfe" for x in langs])
        self.hash = _mixed(hashes * _MIX[0] + seeds[self.lang])

    def grams(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Length, hashes and places of all n-grams that end in this slice."""
        code, good = self.hash, ~self.stop
        for size in range(1, longest + 1):
            if size > 1:
                code = _mixed(code[:-1] * _MIX[0] + self.hash[size - 1 :])
                good = good[:-1] & ~self.stop[size - 1 :]
            at = np.flatnonzero(good)
            at = at[at + size > self.held]
            yield size, code[at], at


def slices(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[Words]:
    """Words of rows ``lang, text`` as bytes, however long, in slices cut at white space or between documents."""
    langs: dict[str, int] = {}
    parts: list[bytes] = []
    lang_of: list[int] = []  # languages of the documents that start in the slice
    first, size, tail = 0, 0, []

    def done() -> Words:
        nonlocal parts, lang_of, first, size, tail
        data = b" ".join(parts).translate(_ENDS).replace(b"\n", b" " + _PIECE + b" ")
        words = [*tail, *data.split()]
        out = Words(words, len(tail), list(langs), first, lang_of)
        tail = words[-(longest - 1) :] if longest > 1 else []
        inside = sum(w == _DOCUMENT for w in tail)
        numbers = [first, *lang_of]
        first = numbers[len(numbers) - 1 - inside]
        parts, lang_of, size = [], numbers[len(numbers) - inside :], 0
        return out

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            data = (text or b"").lower()
            parts.append(_DOCUMENT)
            lang_of.append(langs.setdefault(lang, len(langs)))
            at = 0
            while size + len(data) - at >= SLICE_BYTES:
                end = max(at, at + SLICE_BYTES - size)
                while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r.,;:!?":
                    end += 1
                parts.append(data[at:end])
                yield done()
                at = end
            parts.append(data[at:])
            size += len(data) - at + 2
    if parts:
        yield done()


def cut_summary(keys: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """At most ``capacity`` counters, and what was taken from each to get there."""
    if len(keys) <= capacity:
        return keys, counts, 0
    taken = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
    keep = counts > taken
    return keys[keep], counts[keep] - np.uint32(taken), taken


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counters with equal keys added up, in the order of keys."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    sums = np.add.reduceat(counts.astype(np.uint64), first) if len(first) else np.empty(0, np.uint64)
    return keys[first], np.minimum(sums, 2**32 - 1).astype(np.uint32)


class Summary:
    """Counters of one hash partition. ``taken`` is by how much a count may be too low, always under the threshold.

    The capacity should be twice the mass to come divided by the threshold. A partition that gets more than that
    grows, rather than taking half the threshold.
    """

    def __init__(self, threshold: int, capacity: int):
        self.threshold, self.capacity = threshold, capacity
        self.keys, self.counts, self.taken = np.empty(0, np.uint32), np.empty(0, np.uint32), 0

    def add(self, keys: np.ndarray, counts: np.ndarray, taken: int = 0) -> None:
        self.keys, self.counts = merged(np.r_[self.keys, keys], np.r_[self.counts, counts])
        self.taken += taken
        while len(self.keys) > self.capacity:
            kept = cut_summary(self.keys, self.counts, self.capacity)
            if self.taken + kept[2] >= self.threshold // 2:
                self.capacity *= 2
            else:
                self.keys, self.counts = kept[:2]
                self.taken += kept[2]

    def survivors(self) -> np.ndarray:
        return self.keys[self.counts.astype(np.int64) + self.taken >= self.threshold]


def _planes(values: np.ndarray) -> bytes:
    """Bytes by place value: small numbers leave long runs of zeros, which shuffles compress."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def pack_summary(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted keys as differences, and counts."""
    return _planes(np.diff(keys, prepend=np.uint32(0))), _planes(counts)


def unpack_summary(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(_from_planes(keys), dtype=np.uint32), _from_planes(counts)


def _place(codes: np.ndarray, parts: int) -> np.ndarray:
    """Hash partition in the upper and key in the lower half."""
    return ((codes >> np.uint64(32)) % np.uint64(parts)) << np.uint64(32) | codes & np.uint64(0xFFFFFFFF)


def survivors(docs: DataFrame, threshold: int, longest: int, parts: int, size_of: int) -> DataFrame:
    """``size, part, keys``: per n-gram length and hash partition the keys of all n-grams that may reach the threshold.

    Texts of ``size_of`` bytes have half as many words at most, and not more n-grams of any length.
    """
    capacity = max(LEAST_CAPACITY, 1 + size_of // (parts * threshold))
    schema = pa.schema([("size", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        words = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for size in list(held):
                places, counts = np.unique(np.concatenate(held.pop(size)), return_counts=True)
                if not len(places):
                    continue
                keys, counts = places.astype(np.uint32), counts.astype(np.uint32)
                part = (places >> np.uint64(32)).astype(np.int32)
                starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
                rows = [(size, int(part[a]), *pack_summary(keys[a:b], counts[a:b])) for a, b in zip(starts, [*starts[1:], len(part)], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for part in slices(batches, longest):
            for size, codes, _ in part.grams(longest):
                held.setdefault(size, []).append(_place(codes, parts))
            words += len(part.words)
            if words >= SUMMARY_WORDS:
                yield from flush()
                words = 0
        yield from flush()

    def merge(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        summary = Summary(threshold, capacity)
        for batch in batches:
            each = [unpack_summary(*own) for own in zip(batch["keys"], batch["counts"], strict=True)]
            if each:
                summary.add(*(np.concatenate(own) for own in zip(*each, strict=True)))
        found = summary.survivors()
        if len(found):
            yield pd.DataFrame({"size": [key[0]], "part": [key[1]], "n": [len(found)], "keys": [found.astype("<u4").tobytes()]})

    summaries = docs.mapInArrow(summarise, "size int, part int, keys binary, counts binary")
    return summaries.groupBy("size", "part").applyInPandas(merge, "size int, part int, n long, keys binary")


def _bit(places: np.ndarray, size: int, bits: int) -> np.ndarray:
    return (_mixed(places * _MIX[0] + np.uint64(size)) & np.uint64(bits - 1)).astype(np.int64)


def bitmap(found: DataFrame) -> np.ndarray:
    """Bits of all survivors: 16 for each, at most 16 MB however many they are."""
    n = found.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = min(MOST_BITS, max(BITMAP_SLICE, 1 << (BITS_EACH * n).bit_length()))

    def spread(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for size, number, keys in zip(part["size"], part["part"], part["keys"], strict=True):
                places = np.uint64(number) << np.uint64(32) | np.frombuffer(keys, "<u4").astype(np.uint64)
                bit = np.unique(_bit(places, size, bits))
                cuts = np.flatnonzero(np.r_[True, bit[1:] // BITMAP_SLICE != bit[:-1] // BITMAP_SLICE])
                rows = [(int(bit[a]) // BITMAP_SLICE, (bit[a:b] % BITMAP_SLICE).astype("<u4").tobytes()) for a, b in zip(cuts, [*cuts[1:], len(bit)], strict=True)]
                yield pd.DataFrame(rows, columns=["slice", "own"])

    def join(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = np.zeros(BITMAP_SLICE, bool)
        for part in parts:
            for data in part["own"]:
                own[np.frombuffer(data, "<u4")] = True
        yield pd.DataFrame({"slice": [key[0]], "own": [np.packbits(own, bitorder="little").tobytes()]})

    out = np.zeros(bits // 8, np.uint8)
    sets = found.select("size", "part", "keys").mapInPandas(spread, "slice int, own binary")
    for r in sets.groupBy("slice").applyInPandas(join, "slice int, own binary").collect():  # 16 MB in all
        out[r["slice"] * BITMAP_SLICE // 8 :][: BITMAP_SLICE // 8] = np.frombuffer(r["own"], np.uint8)
    return out


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST) -> DataFrame:
    """``lang, size, phrase, f``: exact counts of all phrases of 1 to ``longest`` words that reach the threshold.

    ``phrase`` is joined by blanks. The row of size 0 and an empty phrase has the number of all words of a language.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").cast("binary").alias("text"))
    size_of = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size_of // PARTITION_BYTES))
    wanted = spark.sparkContext.broadcast(bitmap(stored(survivors(docs, threshold, longest, parts, size_of), "survivors")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "size", "phrase", "f"]
        bits = wanted.value
        for part in slices(batches, longest):
            own = ~part.stop
            own[: part.held] = False
            total = np.bincount(part.lang[own], minlength=len(part.langs))
            rows = [(lang, 0, "", int(n)) for lang, n in zip(part.langs, total, strict=True) if n]
            for size, codes, at in part.grams(longest):
                bit = _bit(_place(codes, parts), size, 8 * len(bits))
                good = bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1 == 1
                _, first, n = np.unique(codes[good], return_index=True, return_counts=True)
                for k, times in zip(at[good][first].tolist(), n.tolist(), strict=True):
                    rows.append((part.langs[part.lang[k]], size, b" ".join(part.words[k : k + size]).decode("utf-8", "surrogatepass"), times))
            for a in range(0, len(rows), 20_000):
                columns = list(zip(*rows[a : a + 20_000], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.int64())], names=names)

    counts = docs.mapInArrow(count, "lang string, size int, phrase string, f long")
    counts = counts.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
    return counts.where((F.col("f") >= threshold) | (F.col("size") == 0))


def collocations(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language.

    A phrase of 2 to ``longest`` words counts if it is there ``threshold`` times. Cut after its first words, its score is
    1000 * a * n / (l * r), rounded down, of the cut with the lowest score, of equal ones the first. A phrase that stands as
    often inside a longer one is left out. Order: score and a descending, phrase ascending by bytes. Words are what is
    between blanks and tabs inside pieces between ``.,;:!?`` and line ends, A-Z lower-cased. Null texts are empty; without a
    language it is ``und``; repeated rows count each; an empty table gives no rows. Only ``lang`` and ``text`` are read.

    Within a slice of 2 MB n-grams are told apart by 64-bit hashes, across slices by their text.

    Scale: two scans of the texts. A task holds a slice of words or a summary; what is sent is one entry for each
    distinct n-gram of a million words, two to five bytes, and then counts of surviving phrases. The bitmap is 16 MB at most;
    with more survivors it lets others pass, which are counted exactly and fall below the threshold.
    """
    counts = stored(frequent_phrases(docs, threshold, longest), "phrases")
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    phrases = counts.where("size > 0")
    found = phrases.where("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    # what is left out of a longer phrase that is as frequent: it is enough to look one word further
    longer = found.where("size > 2")
    inner = longer.select("lang", F.array_join(F.slice("words", 1, F.col("size") - 1), " ").alias("phrase"), "a").unionByName(
        longer.select("lang", F.array_join(F.slice("words", F.lit(2), F.col("size") - 1), " ").alias("phrase"), "a"))
    kept = found.join(inner, ["lang", "phrase", "a"], "left_anti")
    cut = kept.select("lang", "phrase", "a", "size", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("head"),
                     F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"))
    cut = cut.join(phrases.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cut = cut.join(phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cut = cut.join(F.broadcast(totals) if totals.count() <= 1000 else totals, "lang")
    # 38 digits hold the products; division of whole decimals rounds down
    score = "(1000 * (cast(a as decimal(18,0)) * cast(n as decimal(16,0)))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
    cut = cut.withColumn("score", F.expr(score))
    best = cut.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("best")).select("lang", "phrase", "best.*")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the first of each of 16 shares of a language, then the first of these
    share = Window.partitionBy("lang", "share").orderBy(*order)
    best = best.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(16))).withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= top)
    whole = Window.partitionBy("lang").orderBy(*order)
    best = best.withColumn("rank", F.row_number().over(whole).cast("long")).where(F.col("rank") <= top)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
