"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton of all items is built once per block of items and sent to the tasks; the
words of the documents stream through it, which gives the longest match ending at every
word. Matches of ``window`` words (or of a whole shorter item) mark words as hit.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendue.llm.common import raw_bytes, small_batches, stored

WINDOW = 13
#: Words of benchmark items in one automaton; more items make more blocks, each a pass.
BLOCK_WORDS = 200_000
#: Bytes of text that a task matches at once.
BATCH_BYTES = 4_000_000

# Everything in ASCII but 0-9 and letters separates words; A-Z become a-z.
_TABLE = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)


def item_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the whole text, A-Z lower-cased."""
    return raw_bytes(text).translate(_TABLE).split()


class SuffixAutomaton:
    """Generalised suffix automaton over word numbers of several items.

    ``items[state]`` holds the items in which the strings of a state occur, for states that
    can be a whole window; ``shorts[state]`` the whole short items that end a match there.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.length, self.link, self.step = [0], [-1], [{}]
        number = self.vocabulary
        coded = [(item, [number.setdefault(w, len(number)) for w in words]) for item, words in items if words]
        ends = []
        for item, word_ids in coded:
            last = 0
            for w in word_ids:
                last = self._extend(last, w)
                ends.append((last, item))
        self._mark(ends, coded)
        pairs = np.unique(np.concatenate([self._pairs(np.array(w, np.int64)) for _, w in coded] or [np.empty(0, np.int64)]))
        self.pairs = pairs
        # of every state the shortest suffix of a window's length or more, so that no match climbs a chain of links
        self.window_state = list(range(len(self.length)))
        for state in np.argsort(self.length, kind="stable").tolist()[1:]:
            if self.length[self.link[state]] >= window:
                self.window_state[state] = self.window_state[self.link[state]]
        #: Words a match needs at least to count.
        self.least = min([window, *(len(w) for _, w in coded)])

    def _pairs(self, ids: np.ndarray) -> np.ndarray:
        return (ids[:-1] << 32) | ids[1:]

    def _extend(self, last: int, w: int) -> int:
        step, link, length = self.step, self.link, self.length
        if w in step[last]:
            there = step[last][w]
            return there if length[there] == length[last] + 1 else self._split(last, w, there)
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        step.append({})
        at = last
        while at >= 0 and w not in step[at]:
            step[at][w] = new
            at = link[at]
        if at >= 0:
            there = step[at][w]
            link[new] = there if length[there] == length[at] + 1 else self._split(at, w, there)
        return new

    def _split(self, at: int, w: int, there: int) -> int:
        step, link, length = self.step, self.link, self.length
        copy = len(length)
        length.append(length[at] + 1)
        link.append(link[there])
        step.append(dict(step[there]))
        link[there] = copy
        while at >= 0 and step[at].get(w) == there:
            step[at][w] = copy
            at = link[at]
        return copy

    def _mark(self, ends: list[tuple[int, str]], coded: list[tuple[str, list[int]]]) -> None:
        """Items of every state that a window can reach, and the short items."""
        self.items: dict[int, set[str]] = {}
        self.shorts: dict[int, list[tuple[int, str]]] = {}
        for state, item in ends:
            while state > 0 and self.length[state] >= self.window:
                own = self.items.setdefault(state, set())
                if item in own:
                    break
                own.add(item)
                state = self.link[state]
        for item, word_ids in coded:
            if len(word_ids) < self.window:
                state = 0
                for w in word_ids:
                    state = self.step[state][w]
                self.shorts.setdefault(state, []).append((len(word_ids), item))

    def matches(self, word_ids: list[int]) -> Iterator[tuple[int, int]]:
        """``state, length`` of the longest match that ends at each word."""
        step, link, length = self.step, self.link, self.length
        state = n = 0
        for w in word_ids:
            while state and w not in step[state]:
                state = link[state]
                n = length[state]
            if w in step[state]:
                state = step[state][w]
                n += 1
            yield state, n

    def hits(self, word_ids: list[int]) -> Iterator[tuple[int, int, set[str]]]:
        """``last word, words, items`` of every window that occurs."""
        window, link = self.window, self.link
        for i, (state, n) in enumerate(self.matches(word_ids)):
            at = state
            if n >= window:
                at = self.window_state[state]
                yield i, window, self.items.get(at, set())
            if self.shorts:
                while at > 0:
                    for k, item in self.shorts.get(at, ()):
                        if k <= n:
                            yield i, k, {item}
                    at = link[at]

    def runs(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Stretches that can hold a match of ``least`` words: all neighbours known as pairs.

        Unknown words have the number -1. Anything outside these stretches leaves the
        automaton with a match too short to count.
        """
        if self.least < 2:
            good = np.r_[False, ids >= 0, False]
            edge = np.flatnonzero(good[1:] != good[:-1])
            yield from zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)
            return
        if len(ids) < self.least:
            return
        codes = self._pairs(ids)
        at = np.searchsorted(self.pairs, codes)
        at[at == len(self.pairs)] = 0
        good = np.r_[False, (ids[:-1] >= 0) & (ids[1:] >= 0) & (self.pairs[at] == codes), False]
        edge = np.flatnonzero(good[1:] != good[:-1])
        start, stop = edge[::2], edge[1::2] + 1
        long = stop - start >= self.least
        yield from zip(start[long].tolist(), stop[long].tolist(), strict=True)


def scan(automaton: SuffixAutomaton, texts: list[str | None]) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
    """``n_words, hit spans [first, last), items`` of whole texts; items without an id give spans only."""
    get = automaton.vocabulary.get
    counts, numbers = [], []
    for text in texts:
        words = item_words(text)
        counts.append(len(words))
        numbers.extend([get(w, -1) for w in words])
        numbers.append(-1)
    ids = np.array(numbers, np.int64)
    starts = np.cumsum([0, *(c + 1 for c in counts)])
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[set[str]] = [set() for _ in texts]
    if automaton.vocabulary:
        for first, last in automaton.runs(ids):
            doc = int(np.searchsorted(starts, first, "right")) - 1
            base, own = first - int(starts[doc]), spans[doc]
            for i, k, found in automaton.hits(ids[first:last].tolist()):
                lo, hi = base + i - k + 1, base + i + 1
                while own and own[-1][1] >= lo:
                    lo = min(lo, own.pop()[0])
                own.append((lo, hi))
                items[doc] |= found
    return [(n, s, sorted(x - {None})) for n, s, x in zip(counts, spans, items, strict=True)]


def _blocks(items: DataFrame, block_words: int) -> list[tuple[DataFrame, int]]:
    """The items packed into blocks of bounded size: the table of blocks and each block's number."""
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null")
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    # a word takes two characters at least, so a block holds block_words words on average at most
    n_blocks = max(1, -(-size // (2 * block_words)))
    parts = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)))

    def pack(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["item_id", "text"], kind="stable")
        data = pickle.dumps([(i if isinstance(i, str) else None, item_words(t)) for i, t in zip(part["item_id"], part["text"], strict=True)])
        return pd.DataFrame({"block": [key[0]], "data": [data]})

    packed = stored(parts.groupBy("block").applyInPandas(pack, "block long, data binary"), "items")
    return [(packed, b[0]) for b in packed.select("block").orderBy("block").collect()]


FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def _scanner(data: bytes, window: int):
    shared: dict = {}

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if "automaton" not in shared:
            shared["automaton"] = SuffixAutomaton(pickle.loads(data), window)
        automaton = shared["automaton"]
        for part in texts:
            out, batch, size = [], [], 0
            for text in part:
                batch.append(text)
                size += len(text or "")
                if size >= BATCH_BYTES:
                    out += scan(automaton, batch)
                    batch, size = [], 0
            out += scan(automaton, batch)
            yield pd.DataFrame(out, columns=["n_words", "hit_spans", "items"])

    # else a filter on what was found would go below it and scan all texts a second time, in workers of its own
    return F.pandas_udf(run, FOUND).asNondeterministic()


def merge_spans(spans: list) -> list[tuple[int, int]]:
    """Union of half-open spans, in order."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((int(a), int(b)) for a, b in spans):
        if out and out[-1][1] >= lo:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def find_test_items(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``docs`` with ``__found``: ``n_words, hit_spans, items`` of each whole text.

    A hit is every word inside an occurrence of ``window`` consecutive words of an item, or
    of a whole item with fewer words. Items with a null text are left out, those with a null id
    give hits but no id; equal ids count once. Null and empty texts have no words. Rows pass through one by one, so repeated
    rows and null ids stay as they are, and other columns are carried along (a column
    named ``__found`` is replaced).

    The items go to the tasks in blocks of ``block_words``, whatever their number; each
    block is a further pass over the text column within the same scan, no shuffle.
    """
    small_batches(docs.sparkSession)
    out, names = docs.drop("__found"), []
    own = "__found_"  # a prefix that no column has
    while any(c.lower().startswith(own) for c in out.columns):
        own += "_"
    for number, (packed, block) in enumerate(_blocks(items, block_words)):
        data = packed.where(F.col("block") == block).select("data").first()[0]
        names.append(f"{own}{number}")
        out = out.withColumn(names[-1], _scanner(bytes(data), window)("text"))
    if not names:
        names = [f"{own}0"]
        out = out.withColumn(names[0], _scanner(pickle.dumps([]), window)("text"))
    if len(names) == 1:
        return out.withColumnRenamed(names[0], "__found")

    @F.pandas_udf(FOUND)
    def union(n_words: pd.Series, spans: pd.Series, found: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "n_words": n_words,
                "hit_spans": [merge_spans([p for part in row for p in part]) for row in spans],
                "items": [sorted({i for part in row for i in part}) for row in found],
            }
        )

    merged = union(
        F.col(f"{names[0]}.n_words"),
        F.array(*(F.col(f"{n}.hit_spans") for n in names)),
        F.array(*(F.col(f"{n}.items") for n in names)),
    )
    return out.withColumn("__found", merged).drop(*names)


def contaminated(n_words, n_hit, percent: int):
    """A document is contaminated when it has a hit and hits are ``percent`` of its words or more."""
    return (n_hit > 0) & (n_hit * 100 >= n_words * percent)


def judge(docs: DataFrame, items: DataFrame, window: int = WINDOW, percent: int = 5) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document row."""

    @F.pandas_udf("string")
    def digest(found: pd.Series) -> pd.Series:
        return found.map(lambda ids: hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest())

    found = find_test_items(docs.select("doc_id", "text"), items, window)
    n_hit = F.aggregate("__found.hit_spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    out = found.select(
        "doc_id",
        F.col("__found.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("__found.items").cast("long").alias("n_items"),
        digest("__found.items").alias("items_sha256"),
    )
    return out.withColumn("contaminated", contaminated(F.col("n_words"), F.col("n_hit"), percent))


def remove_spans(docs: DataFrame, items: DataFrame, window: int = WINDOW, percent: int = 5) -> DataFrame:
    """Documents without what comes from test items, columns as in ``docs``.

    Documents over the coverage limit go. Of the others the hit words go, from the first to
    the last character of each span, and the text around stays as it is.
    """
    # the caller's columns travel in one, so their names are free
    n_hit = F.aggregate("__found.hit_spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text"), F.lit(0))
    found = find_test_items(docs.select(row.alias("row"), "text"), items, window)
    kept = found.where(~contaminated(F.col("__found.n_words"), n_hit, percent))

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([cut_words(t, s) for t, s in zip(text, spans, strict=True)], dtype=object)

    text = F.when(n_hit > 0, cut(F.when(n_hit > 0, F.col("text")), F.col("__found.hit_spans"))).otherwise(F.col("text"))
    return kept.select(*(text.alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns))


def cut_words(text: str | None, spans) -> str | None:
    """The text without the words of the spans (first, last), given in order."""
    if text is None or spans is None or len(spans) == 0:
        return text
    data = raw_bytes(text)
    plain = np.frombuffer(data.translate(_TABLE), np.uint8) != 0x20
    edge = np.flatnonzero(np.diff(np.r_[False, plain, False].astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    out, at = [], 0
    for lo, hi in spans:
        out.append(data[at : begin[lo]])
        at = int(end[hi - 1])
    out.append(data[at:])
    return b"".join(out).decode("utf-8", "surrogatepass")
