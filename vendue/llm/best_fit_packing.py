"""Best-fit packing of token pieces by exact complements over a histogram of lengths.

The plan is made from the number of pieces of each length alone, at most ``capacity``
numbers however many pieces there are. An index has the lengths by the sums of one, two and three of
them; combinations that fill a gap exactly are looked up there and used up as often as pieces are left, all at once;
the rest goes best-fit. The pieces then find their places by their rank among those of
equal length, so no task and no driver ever holds the pieces.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vendue.llm.common import small_batches, stored

CAPACITY = 2048
END_ID = 0
#: White space characters in a row from which a text is encoded by ``tokenizers`` itself.
LONG_RUN = 1000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@cache
def _encoders(path: str):
    """The tokenizer, and the same vocabulary in the form that encodes whole texts four times as fast."""
    import re

    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    spec = json.loads(whole.to_str())
    letter = {c: b for b, c in _byte_letters().items()}
    ranks = {bytes(letter[c] for c in token): n for token, n in spec["model"]["vocab"].items() if all(c in letter for c in token)}
    special = {t["content"] for t in spec["added_tokens"]}
    ranks = {b: n for b, n in ranks.items() if b.decode("latin-1") not in special}
    fast = tiktoken.Encoding("pieces", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
    # Special tokens, letters beyond Latin, where versions of Unicode may differ, and long runs of white space, which
    # the fast form would go back over blank by blank, go the plain way.
    plain = re.compile("|".join([*map(re.escape, special), "[^\\x00-\\u024F\\u2010-\\u2026]", f"(?<!\\s)\\s{{{LONG_RUN}}}"]))
    return whole, fast, plain


# Fixed value: the pattern of the tokenizer file's byte-level pre-tokenizer.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + n) for n, b in enumerate(rest)}


def token_ids(text: str | None, path: str) -> np.ndarray:
    """Token numbers of the whole text, as ``tokenizers`` gives them without added tokens, then the end id."""
    text = text or ""
    whole, fast, plain = _encoders(path)
    if plain.search(text):
        ids = np.array(whole.encode(text, add_special_tokens=False).ids, "<u4")
    else:
        ids = fast.encode_to_numpy(text, disallowed_special=()).astype("<u4")
    return np.append(ids, np.array([END_ID], "<u4"))


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """``start, length`` of the pieces of ``n`` tokens; only the first may be shorter than the capacity."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))] if n > capacity else [(0, n)]


def tokenize(docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Pieces of every row's whole text: ``doc_id, piece, start, length, ids_crc32`` and ``ids`` if asked for.

    A null or empty text is the end id alone. Null ids and repeated rows give pieces of their own.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for doc_id, text in zip(part["doc_id"], part["text"], strict=True):
                ids = token_ids(text, path)
                for k, (start, n) in enumerate(cut(len(ids), capacity)):
                    own = ids[start : start + n]
                    rows.append((doc_id, k, start, n, zlib.crc32(own), own if keep_ids else None))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out if keep_ids else out.drop(columns="ids")

    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInPandas(run, PIECES + (", ids array<long>" if keep_ids else ""))


class SumIndex:
    """Lengths by the sums of one, two and three of them, up to the capacity.

    A pair has the longer length first. A triple is its longest length, with the pair of what is left of the sum, none of
    it longer. Which of them are still available is up to the caller's counts.
    """

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.singles = set(lengths.tolist())
        one, two = np.tril_indices(len(lengths))
        one, two = lengths[one], lengths[two]
        fits = one + two <= capacity
        one, two = one[fits], two[fits]
        order = np.lexsort((one, one + two))
        self.longer, self.shorter = one[order], two[order]
        self.pair_at = np.searchsorted(self.longer + self.shorter, np.arange(capacity + 2))
        sums = np.flatnonzero(np.diff(self.pair_at))
        # of a sum the pairs stand by their longer length, so the first one tells if any is short enough
        most, left = np.meshgrid(lengths, sums, indexing="ij")
        good = (most + left <= capacity) & (self.longer[self.pair_at[left]] <= most)
        most, left = most[good], left[good]
        order = np.lexsort((most, most + left))
        self.longest = most[order]
        self.triple_at = np.searchsorted((most + left)[order], np.arange(capacity + 2))

    def pairs(self, total: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(self.pair_at[total], self.pair_at[total + 1])
        return self.longer[own], self.shorter[own]

    def triples(self, total: int) -> np.ndarray:
        return self.longest[self.triple_at[total] : self.triple_at[total + 1]]


class Plan:
    """Bins as patterns: so many sequences of these lengths in this order."""

    def __init__(self, histogram: dict[int, int], capacity: int = CAPACITY):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in histogram.items():
            self.left[length] += n
        self.patterns: list[tuple[tuple[int, ...], int]] = []
        if self.left[capacity]:
            self._take((capacity,), int(self.left[capacity]))
        self._fill_exactly()
        self._fill_best()

    def _take(self, lengths: tuple[int, ...], times: int) -> None:
        for x in lengths:
            self.left[x] -= times
        self.patterns.append((lengths, times))

    def _times(self, lengths: tuple[int, ...]) -> int:
        """How often all of these lengths are left together."""
        return min(int(self.left[x]) // lengths.count(x) for x in lengths)

    def _fill_exactly(self) -> None:
        """From the longest length down: complements of one, two, then three pieces, as often as they last."""
        lengths = np.flatnonzero(self.left)
        if not len(lengths):
            return
        index = SumIndex(lengths, self.capacity)
        for longest in lengths[::-1].tolist():
            gap = self.capacity - longest
            for rest in self._complements(index, gap, longest):
                if not self.left[longest]:
                    break
                if times := self._times((longest, *rest)):
                    self._take((longest, *rest), times)

    def _complements(self, index: SumIndex, gap: int, most: int) -> Iterator[tuple[int, ...]]:
        """Combinations of available lengths that sum to the gap, none of them longer than ``most``."""
        if gap in index.singles and gap <= most and self.left[gap]:
            yield (gap,)
        yield from self._pairs(index, gap, most)
        for longest in index.triples(gap).tolist():
            if longest > most:
                return
            if self.left[longest]:
                yield from ((longest, *pair) for pair in self._pairs(index, gap - longest, longest))

    def _pairs(self, index: SumIndex, total: int, most: int) -> Iterator[tuple[int, int]]:
        longer, shorter = index.pairs(total)
        good = (longer <= most) & (self.left[longer] > 0) & (self.left[shorter] > 0)
        for pair in zip(longer[good].tolist(), shorter[good].tolist(), strict=True):
            if self.left[pair[0]] and self.left[pair[1]]:  # they may have gone meanwhile
                yield pair

    def _fill_best(self) -> None:
        """Longest first; the longest piece that fits goes into each gap, for all equal bins at once."""
        sizes = [int(x) for x in np.flatnonzero(self.left)]
        while sizes:
            lengths, gap = (sizes[-1],), self.capacity - sizes[-1]
            while (k := bisect_right(sizes, gap)) > 0:
                best = sizes[k - 1]
                room = int(self.left[best]) - lengths.count(best)
                if room <= 0:  # all of this length are in the bin: the next shorter one
                    shorter = [x for x in sizes[: k - 1] if self.left[x] > lengths.count(x)]
                    if not shorter:
                        break
                    best = shorter[-1]
                lengths, gap = (*lengths, best), gap - best
            self._take(lengths, self._times(lengths))
            sizes = [x for x in sizes if self.left[x] > 0]

    @property
    def sequences(self) -> int:
        return sum(times for _, times in self.patterns)

    def slots(self) -> pd.DataFrame:
        """Per pattern and place: ranks ``first`` on of a length go to sequences ``base`` on at ``offset``."""
        used = np.zeros(self.capacity + 1, np.int64)
        rows, base = [], 0
        for lengths, times in self.patterns:
            offset = 0
            for x in lengths:
                rows.append((x, int(used[x]), base, offset))
                used[x] += times
                offset += x
            base += times
        return pd.DataFrame(rows, columns=["length", "first", "base", "offset"]).sort_values(["length", "first"])


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; each length is 1 to the capacity.

    Ranks within a length are a count inside the partition plus the counts of the
    partitions before, so a length that a third of all pieces have is spread over tasks.
    """

    def number(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        seen = np.zeros(capacity + 1, np.int64)
        for part in parts:
            part["__part"] = TaskContext.get().partitionId()
            part["__rank"] = part.groupby("length").cumcount() + seen[part["length"]]
            seen += np.bincount(part["length"], minlength=capacity + 1)
            yield part

    columns = pieces.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    ranked = stored(pieces.mapInPandas(number, f"{fields}, __part int, __rank long"), "pieces")
    counts = ranked.groupBy("length", "__part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "counts")
    # at most `capacity` rows
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}
    slots = Plan(histogram, capacity).slots()
    key = (slots["length"].to_numpy() << 48) | slots["first"].to_numpy()
    first, base, at = (slots[c].to_numpy() for c in ("first", "base", "offset"))

    @F.pandas_udf("sequence_id long, offset long")
    def find(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        k = np.searchsorted(key, (length.to_numpy() << 48) | rank.to_numpy(), "right") - 1
        return pd.DataFrame({"sequence_id": base[k] + rank.to_numpy() - first[k], "offset": at[k]})

    # counts grow with the number of partitions, so they are not broadcast
    joined = ranked.join(counts.select("length", "__part", "before").hint("merge"), ["length", "__part"])
    placed = joined.withColumn("__at", find("length", F.col("__rank") + F.col("before")))
    return placed.select(*(f"`{c}`" for c in columns), "__at.sequence_id", "__at.offset")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of all rows of ``docs``."""
    return place(tokenize(docs, tokenizer, capacity), capacity)
