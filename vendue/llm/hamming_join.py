"""Near-duplicate documents by a multi-index Hamming join over b-bit MinHash signatures.

Documents with equal shingle sets form one class. A class has a signature of ``CHUNKS`` times
``WIDTH`` values of 16 bits. Two signatures that differ in fewer than ``CHUNKS * (ERRORS + 1)``
values have, by pigeonhole, a chunk with at most ``ERRORS`` errors; every allowed set of
errors in a chunk is enumerated as a key of the values that remain, so all such pairs share
a key. Pairs whose signatures are near become edges: all pairs of a key with few classes; of a
key with many those to one of its classes, and then only pairs that are not connected yet. Edges
make clusters, and inside clusters links are confirmed on full shingle sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vendue.llm.common import components, raw_bytes, removed, small_batches, stored

#: 16 chunks of 4 values with one error each: every pair with up to 31 of 64 values apart is
#: found. At a similarity of 0.8 one pair in ten million is further apart than that.
CHUNKS, WIDTH, ERRORS = 16, 4, 1
VALUES = CHUNKS * WIDTH
MOST_APART = CHUNKS * (ERRORS + 1) - 1

#: Pairs of a key with more classes than this are compared in a task of their own, without those that are connected already.
PAIRED_BUCKET = 8
#: Classes of a key that are compared in one task; a key with more is compared in pairs of blocks.
BUCKET_BLOCK = 32_768

#: Shingles that are confirmed together in one task.
BLOCK_SHINGLES = 1_000_000
#: Classes of a cluster of several blocks that every block gets, to connect the blocks.
PIVOTS = 16

#: Candidates may be broadcast up to this many rows of 24 bytes; beyond it they are joined by a shuffle.
BROADCAST_ROWS = 500_000
#: What a bitmap lets through is shuffled for that: 16 bits for each candidate, 16 MB at most.
BITS_EACH, MOST_BITS, BITMAP_SLICE = 16, 1 << 27, 1 << 15

WORD_BYTES = 4_000_000
_RANDOM = np.random.default_rng(20240101)
_SCALE = _RANDOM.integers(1, 2**63, VALUES, dtype=np.uint64) | np.uint64(1)
_SHIFT = _RANDOM.integers(0, 2**63, VALUES, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    return x ^ (x >> np.uint64(29))


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of a lower-cased text, however long, in slices cut at white space."""
    parts, at = [], 0
    while at < len(data):
        end = at + WORD_BYTES
        while end < len(data) and not data[end : end + 1].isspace():
            end += 1
        words = data[at:end].split()
        if words:
            parts.append(pd.util.hash_array(np.array(words, dtype=object), categorize=False))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of ``size`` words; fewer words are one shingle."""
    words = word_hashes(raw_bytes(text).lower())
    if not len(words):
        return words
    size = min(size, len(words))
    codes = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        codes = _mixed(codes * _MIX[0] + words[k : k + len(codes)])
    return np.unique(codes)


def signature(shingles: np.ndarray) -> np.ndarray:
    """16 bits of the smallest value of every hash function over a set."""
    low = np.full(VALUES, 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), 512):
        low = np.minimum(low, (shingles[at : at + 512, None] * _SCALE + _SHIFT).min(axis=0))
    return (_mixed(low) >> np.uint64(48)).astype("<u2")


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """Keys of every signature: chunk, left-out places, hash of the values that remain."""
    out = []
    for chunk in range(CHUNKS):
        own = signatures[:, chunk * WIDTH : (chunk + 1) * WIDTH].astype(np.uint64)
        for gone in combinations(range(WIDTH), ERRORS):
            key = np.full(len(own), chunk * 1000 + sum(1 << g for g in gone), np.uint64)
            for k in range(WIDTH):
                if k not in gone:
                    key = _mixed(key * _MIX[0] + own[:, k])
            out.append(key)
    return np.stack(out, axis=1).view(np.int64)


def _measure(docs: DataFrame, size: int) -> DataFrame:
    """Per row: set size, 128 bits that name the set, a hash of the text and the signature."""

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            rows = []
            for text in part:
                s = shingle_set(text, size)
                one = int(np.bitwise_xor.reduce(_mixed(s + _MIX[0]))) if len(s) else 0
                two = int(s.sum(dtype=np.uint64)) if len(s) else 0
                rows.append((len(s), one - 2**63, two - 2**63, signature(s).tobytes() if len(s) else None))
            yield pd.DataFrame(rows, columns=["n_shingles", "k1", "k2", "sig"])

    measure = F.pandas_udf(run, "n_shingles long, k1 long, k2 long, sig binary")
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), measure("text").alias("m")).select("doc_id", "text_hash", "m.*")


def _classes(rows: DataFrame) -> DataFrame:
    """One row per distinct set: a node number, the row that stands for it, size and signature."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("rep")
    found = rows.where("n_shingles > 0").groupBy("k1", "k2", "n_shingles").agg(first, F.first("sig").alias("sig"))
    # ids and texts may repeat, so each set has a number of its own; it is fixed when the classes are stored
    return found.select(
        "k1", "k2", F.col("n_shingles").alias("n"), F.monotonically_increasing_id().alias("node"), F.col("rep.doc_id").alias("rep_id"),
        F.col("rep.text_hash").alias("text_hash"), "sig",
    )


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.count_nonzero(x != y, axis=1)


def near_links(node: np.ndarray, label: np.ndarray, n: np.ndarray, signatures: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Near pairs of classes that the labels don't connect yet, enough of them to connect what near pairs connect.

    Labels are numbers of groups known to be connected. A class is compared with all larger classes
    within the size bound that are in another group.
    """
    order = np.argsort(n, kind="stable")
    sizes, group, own = n[order], _roots(label)[order], signatures[order]
    links = []
    for i in range(len(order)):
        stop = int(np.searchsorted(sizes, sizes[i] * 100 // percent, "right"))
        other = np.flatnonzero(group[i + 1 : stop] != group[i]) + i + 1
        if not len(other):
            continue
        for j in other[_apart(own[other], own[i]) <= MOST_APART]:
            if group[j] != group[i]:
                links.append((int(node[order[i]]), int(node[order[j]])))
                group[group == group[j]] = group[i]
    return links


def _values(signatures: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(signatures), "<u2").reshape(-1, VALUES)


def _near_links(rows: DataFrame, percent: int) -> DataFrame:
    """``a, b`` from rows ``key, node, n, members, label, sig`` of the classes of popular keys."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        found = near_links(part["node"].to_numpy(), part["label"].to_numpy(), part["n"].to_numpy(), _values(part["sig"]), percent)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    blocks = F.ceil(F.col("members") / F.lit(BUCKET_BLOCK)).cast("long")
    rows = rows.withColumns({"mine": F.pmod(F.xxhash64("node"), blocks), "other": F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))})
    rows = rows.select("key", "node", "n", "label", "sig", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"))
    return rows.groupBy("key", "p", "q").applyInPandas(run, "a long, b long")


def _candidates(classes: DataFrame, percent: int) -> DataFrame:
    """``a, b``: edges that put all pairs of classes under the signature distance into one cluster.

    Keys are made and shuffled once. Every edge is a pair under the distance, so classes that only share a
    key with the same others stay in clusters of their own.
    """

    def keys_of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            keys = chunk_keys(_values(part["sig"]))
            yield pd.DataFrame({"key": keys.ravel()} | {c: np.repeat(part[c].to_numpy(), keys.shape[1]) for c in ("node", "n")})

    keys = classes.select("node", F.col("n").cast("int").alias("n"), "sig").mapInPandas(keys_of, "key long, node long, n int")
    own = Window.partitionBy("key")
    keys = keys.withColumns({"members": F.count("*").over(own), "hub": F.min(F.struct(F.xxhash64("node"), "node", "n")).over(own)})
    members = keys.where("members > 1").select("key", "node", "n", "members", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"))
    members = stored(members, "buckets")
    few = members.where(F.col("members") <= PAIRED_BUCKET).select("key", "node", "n")
    many = members.where(F.col("members") > PAIRED_BUCKET)
    left, right = few.toDF("key", "a", "na"), few.toDF("key", "b", "nb")
    ends = F.struct("n", "node"), F.struct(F.col("hub_n").alias("n"), F.col("hub").alias("node"))
    stars = many.where("node <> hub").select(F.least(*ends).alias("x"), F.greatest(*ends).alias("y")).select("x.node", "x.n", "y.node", "y.n")
    pairs = left.join(right, "key").where("na < nb or na = nb and a < b").select("a", "na", "b", "nb").union(stars)
    pairs = pairs.where(f"100L * na >= {percent}L * nb").select("a", "b").distinct()
    sig = classes.select("node", "sig")

    @F.pandas_udf("boolean")
    def near(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(_apart(_values(x), _values(y)) <= MOST_APART)

    pairs = pairs.join(sig.toDF("a", "sa"), "a").join(sig.toDF("b", "sb"), "b").where(near("sa", "sb")).select("a", "b")
    known = stored(components(pairs), "near")
    # what the pairs have connected is not compared again, and a key whose classes are all connected not at all
    many = many.join(known, "node", "left").select("key", "node", "n", "members", F.coalesce("label", "node").alias("label"))
    many = stored(many, "popular")
    mixed = many.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    links = stored(_near_links(many.join(mixed, "key").join(sig, "node"), percent), "near-links")
    for done in (members, many):
        removed(classes.sparkSession, done)
    return known.where("node <> label").select(F.col("label").alias("a"), F.col("node").alias("b")).union(links)


def _roots(label: np.ndarray) -> np.ndarray:
    return np.unique(label, return_inverse=True)[1]


def confirm(node: np.ndarray, label: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between sets that the labels don't connect yet, enough of them to connect what is connected.

    Labels are numbers of groups known to be connected. A set is compared with all larger sets
    within the size bound that are in another group.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    sizes = np.array([len(sets[i]) for i in order], np.int64)
    group = _roots(label)[order]
    ids = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)[1]
    starts = np.r_[0, np.cumsum(sizes)]
    mark = np.zeros(ids.max() + 1, bool)
    links = []
    for i in range(len(order)):
        stop = int(np.searchsorted(sizes, sizes[i] * 100 // percent, "right"))
        other = np.flatnonzero(group[i + 1 : stop] != group[i]) + i + 1
        if not len(other):
            continue
        own = ids[starts[i] : starts[i + 1]]
        mark[own] = True
        if 4 * len(other) > stop - i:
            shared = np.add.reduceat(mark[ids[starts[i + 1] : starts[stop]]], starts[i + 1 : stop] - starts[i + 1], dtype=np.int64)[other - i - 1]
        else:
            shared = np.array([np.count_nonzero(mark[ids[starts[j] : starts[j + 1]]]) for j in other])
        mark[own] = False
        for j in other[100 * shared >= percent * (sizes[i] + sizes[other] - shared)]:
            if group[j] != group[i]:
                links.append((int(node[order[i]]), int(node[order[j]])))
                group[group == group[j]] = group[i]
    return links


def _confirmed(blocks: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """``a, b`` from blocks of rows ``node, label, shingles``."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates("node")
        found = confirm(part["node"].to_numpy(), part["label"].to_numpy(), [np.asarray(s) for s in part["shingles"]], percent)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return blocks.select(*keys, "node", "label", "shingles").groupBy(*keys).applyInPandas(run, "a long, b long")


def _blocks_of(shingles: str) -> F.Column:
    return F.ceil(F.col(shingles) / F.lit(BLOCK_SHINGLES)).cast("long")


def _passing(hashes: DataFrame) -> Callable[[Column], Column]:
    """A condition that holds for all of the hashes and for about one in 16 others."""
    bits = min(MOST_BITS, max(BITMAP_SLICE, 1 << (BITS_EACH * hashes.count()).bit_length()))
    place = F.pmod(F.col("text_hash"), F.lit(bits)) + 1
    parts = hashes.groupBy(F.bitmap_bucket_number(place).alias("slice")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("own"))
    found = np.zeros(bits // 8, np.uint8)
    for r in parts.collect():  # 16 MB at most
        found[(r["slice"] - 1) * BITMAP_SLICE // 8 :][: BITMAP_SLICE // 8] = np.frombuffer(r["own"], np.uint8)
    shared = hashes.sparkSession.sparkContext.broadcast(found)

    @F.pandas_udf("boolean")
    def passes(text_hash: pd.Series) -> pd.Series:
        at = text_hash.to_numpy() & (bits - 1)
        return pd.Series(shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1)

    return passes


def _with_texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows ``node, rep_id, text_hash, ...`` with their ``text``; it is shuffled once, and other texts are not."""
    keys = ["text_hash", "id", "no_id"]
    docs = docs.select(F.xxhash64("text").alias("text_hash"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.isnull("doc_id").alias("no_id"), "text")
    nodes = nodes.withColumns({"id": F.coalesce("rep_id", F.lit(0)), "no_id": F.isnull("rep_id")}).drop("rep_id")
    if nodes.count() <= BROADCAST_ROWS:
        texts = docs.join(F.broadcast(nodes.select("node", *keys)), keys).groupBy("node").agg(F.first("text").alias("text"))
        return nodes.drop(*keys).join(texts, "node")
    texts = docs.where(_passing(nodes.select("text_hash"))("text_hash")).join(nodes, keys)
    # grouped by the keys as well, so what the join has dealt out stays where it is
    rest = [c for c in nodes.columns if c not in ("node", *keys)]
    return texts.groupBy(*keys, "node").agg(*[F.first(c).alias(c) for c in (*rest, "text")]).drop(*keys)


def _links(docs: DataFrame, classes: DataFrame, clusters: DataFrame, size: int, percent: int) -> DataFrame:
    """Confirmed links ``a, b`` that connect all connected classes of each cluster."""
    clusters = clusters.withColumnRenamed("label", "cluster").join(classes.select("node", "n", "rep_id", "text_hash"), "node")
    clusters = stored(clusters, "clusters")

    @F.pandas_udf("array<long>")
    def shingles(text: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t, size).view(np.int64) for t in text], dtype=object)

    def with_sets(nodes: DataFrame) -> DataFrame:
        """Sets are made from the texts where they are needed; they are twice as large."""
        return _with_texts(docs, nodes).withColumn("shingles", shingles("text")).drop("text")

    sums = clusters.groupBy("cluster").agg(F.sum("n").alias("all"), F.count("*").alias("classes"))
    sums = sums.withColumn("blocks", _blocks_of("all"))
    placed = stored(clusters.join(sums, "cluster"), "placed")
    pivot = (F.col("blocks") > 1) & (F.pmod(F.xxhash64("node", F.lit(1)), F.col("classes")) < PIVOTS)
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    every = F.when(pivot, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array(own))
    inside = with_sets(placed).select("node", F.col("node").alias("label"), "cluster", F.explode(every).alias("block"), "shingles")
    links = stored(_confirmed(inside, ["cluster", "block"], percent), "links")
    several = placed.where("blocks > 1")
    if several.isEmpty():
        return links
    # What the blocks have not connected yet is compared across blocks. The largest connected
    # part of a cluster is not compared with itself.
    known = components(links).withColumnRenamed("label", "known")
    parts = several.select("cluster", "node", "n", "rep_id", "text_hash").join(known, "node", "left").withColumn("label", F.coalesce("known", "node"))
    parts = stored(parts.drop("known"), "parts")
    main = parts.groupBy("cluster", "label").agg(F.sum("n").alias("size")).groupBy("cluster").agg(F.max_by("label", "size").alias("main"))
    parts = parts.join(main, "cluster").withColumn("in_main", F.col("label") == F.col("main"))
    size_of = parts.groupBy("cluster").agg(
        F.sum(F.when(F.col("in_main"), F.col("n")).otherwise(0)).alias("main_n"),
        F.sum(F.when(F.col("in_main"), 0).otherwise(F.col("n"))).alias("rest_n"),
    )
    size_of = size_of.select("cluster", _blocks_of("main_n").alias("mains"), _blocks_of("rest_n").alias("rests")).where("rests > 0")
    parts = parts.join(size_of, "cluster")
    zero = F.lit(0).cast("long")
    mine = F.when(F.col("in_main"), F.col("rests") + F.pmod(F.xxhash64("node"), F.col("mains"))).otherwise(F.pmod(F.xxhash64("node"), F.col("rests")))
    others = F.sequence(zero, F.when(F.col("in_main"), F.col("rests") - 1).otherwise(F.col("rests") + F.col("mains") - 1))
    parts = with_sets(stored(parts, "parts-across")).withColumn("mine", mine)
    across = parts.select("cluster", "node", "label", "shingles", "mine", F.explode(others).alias("other"))
    across = across.select("cluster", "node", "label", "shingles", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"))
    return links.union(stored(_confirmed(across, ["cluster", "p", "q"], percent), "links-across"))


def _judged(docs: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, label`` of every row; a row without shingles has no label."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = stored(_measure(docs, shingle_words), "signatures")
    classes = stored(_classes(rows), "classes")
    clusters = components(_candidates(classes, percent))
    labels = components(_links(docs, classes, clusters, shingle_words, percent))
    named = classes.select("k1", "k2", "n", "node", "rep_id").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    lead = named.groupBy("label").agg(F.min("rep_id").alias("component_id"))
    named = named.join(lead, "label").select("k1", "k2", F.col("n").alias("n_shingles"), "component_id", "label")
    columns = ["doc_id", "text_hash", "n_shingles"]
    some = rows.where("n_shingles > 0").select(*columns, "k1", "k2").join(named, ["k1", "k2", "n_shingles"])
    none = rows.where("n_shingles = 0").select(*columns, F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("label"))
    return some.select(*columns, "component_id", "label").union(none)


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``.

    Documents are linked when ``100 * |A and B| >= percent * |A or B|`` for their sets of word
    shingles (A-Z lower-cased, fewer words are one shingle); component_id is the smallest
    doc_id reachable over links; different texts under one id are judged apart. Null and empty texts, or texts of white space, have no
    shingles, are linked with nothing and kept. Rows of equal id and text are one document and get equal
    results; rows without an id take part, and a component of these alone has a null id and is kept. Other
    columns are not read. Every link is confirmed on full sets; pairs are missed only if their signatures
    are more than ``MOST_APART`` values apart.

    Scale: classes, keys and buckets are counted before they are joined; of a key that many classes
    share, signatures are compared in blocks of bounded size, without those that are connected already.
    Confirming compares a cluster in blocks of bounded size, and across blocks only what is not connected yet.
    """
    judged = _judged(docs, shingle_words, percent).drop("text_hash", "label")
    return judged.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` for each component, and all rows without shingles; columns as they are.

    The row is one of the smallest doc_id, without any of the smallest text hash; of repeated rows of this id and
    text the one with the smallest hash over all columns.
    """
    judged = _judged(docs, shingle_words, percent).where("label is not null")
    texts = stored(judged.groupBy("label", "doc_id", "text_hash").agg(F.count("*").alias("n")), "texts")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    best = texts.groupBy("label").agg(F.min(order).alias("best"))
    chosen = texts.join(best, "label").withColumn("chosen", order.eqNullSafe(F.col("best")))
    marked = chosen.where("not chosen or n > 1").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "chosen")
    marked = stored(marked, "marked")
    own_id, own_hash = docs["doc_id"].cast("long"), F.xxhash64(docs["text"].cast("string"))
    same = own_id.eqNullSafe(marked["__id"]) & (own_hash == marked["__hash"])
    # whole texts stay where they are unless the rows that go are many
    kept = docs.join(F.broadcast(marked) if marked.count() <= BROADCAST_ROWS else marked, same, "left_anti")
    repeated = marked.where("chosen")
    if repeated.isEmpty():
        return kept
    names = [f"`{c}`" for c in docs.columns]
    row_hash = F.xxhash64(*(f"`{c}`" for c, kind in docs.dtypes if "map<" not in kind))
    rows = docs.join(repeated, own_id.eqNullSafe(repeated["__id"]) & (own_hash == repeated["__hash"]))
    one = rows.groupBy("__id", "__hash").agg(F.min_by(F.struct(*names), row_hash).alias("__row"))
    return kept.unionByName(one.select("__row.*"))
