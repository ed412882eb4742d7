"""Fingerprints, whitening and collocations against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vendue.llm import collocations, one_permutation, whitening

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similarity(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def successors(docs):
    """Rows ``doc_id, text, next text`` in the order of ids, hashes and texts."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text")).collect()
    rows = sorted(((r["doc_id"], r["text"], r["h"]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[2], r[1]))
    return [(i, t, rows[(k + 1) % len(rows)][1]) for k, (i, t, _) in enumerate(rows)]


def some_texts(seed, n):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    out = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 300))) for _ in range(n)]
    return [*out, out[0], out[1].upper(), out[2] + " and a little more", "", None, "one", "äöü ß \U0001f600 é", "x" * 200_000, "a b " * 50_000]


def check_compared(docs):
    expected = {}
    for doc_id, text, following in successors(docs):
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        row = (doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), one_permutation.fingerprint(text).hex(), one_permutation.fingerprint(new).hex())
        expected.setdefault(row, []).append((similarity(text, new), similarity(text, following)))
    found = one_permutation.compare_with_next(docs).collect()
    assert Counter(tuple(r)[:5] for r in found) == Counter({k: len(v) for k, v in expected.items()})
    for r in found:
        near = expected[tuple(r)[:5]]
        assert min(abs(r["near_edited"] - e) for e, _ in near) < 0.12
        assert min(abs(r["near_next"] - e) for _, e in near) < 0.12


def test_compared_with_next(make_docs):
    rows = [(i * 7 % 1000 - 50, t) for i, t in enumerate(some_texts(1, 60))]
    random.Random(2).shuffle(rows)
    check_compared(make_docs([*rows, (None, "no id here"), (None, "no id here"), (None, None), rows[3], (rows[3][0], "another text of one id")]).repartition(5))


def test_compared_with_hot_rows(make_docs):
    """A third of all rows equal in id and text, and a third without an id."""
    rows = [(5, "the very same text of one id")] * 300 + [(None, f"text number {i}") for i in range(300)] + [(i, f"other text {i}") for i in range(300)]
    check_compared(make_docs(rows).repartition(7))


def test_compared_few(make_docs):
    assert one_permutation.compare_with_next(make_docs([])).collect() == []
    one = one_permutation.compare_with_next(make_docs([(1, "abc")])).collect()
    assert [(r["n_chars"], r["near_edited"], r["near_next"]) for r in one] == [(3, 0.0, 1.0)]
    both = one_permutation.compare_with_next(make_docs([(1, ""), (2, None)])).collect()
    assert {(r["near_edited"], r["near_next"], r["fingerprint"]) for r in both} == {(1.0, 1.0, "")}


@pytest.mark.parametrize("n", [1, 4, 40, 300, 3000])
def test_likeness_is_unbiased(n):
    rng = np.random.default_rng(n)
    off = []
    for _ in range(60):
        shared = rng.integers(0, n + 1)
        draw = [rng.integers(0, 2**64, n, dtype=np.uint64) for _ in range(2)]
        a, b = np.unique(draw[0]), np.unique(np.r_[draw[0][:shared], draw[1][shared:]])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        off.append(one_permutation.likeness(one_permutation.fingerprint_of(a), one_permutation.fingerprint_of(b)) - true)
    assert abs(np.mean(off)) < 0.015
    assert np.std(off) < 0.05


def test_empty_bins_choose_filled_ones_evenly():
    filled = np.zeros(one_permutation.BINS, bool)
    filled[[3, 100, 101, 500]] = True
    source = one_permutation.bin_sources(filled)
    assert set(source) == {3, 100, 101, 500}
    assert min(Counter(source.tolist()).values()) > 90


def test_fingerprints_of_a_column(make_docs):
    docs = make_docs([(1, "One two three four five six"), (2, "one TWO three four five six"), (3, None)])
    got = {r[0]: r[1] for r in docs.select("doc_id", one_permutation.fingerprints(F.col("text"))).collect()}
    assert got[1] == got[2] and len(got[1]) == 512
    assert not got[3]


def whitened_by_numpy(vectors, components=16):
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    apart = (fit * n - s) / n
    v = apart.T @ apart / n
    e, vectors = np.linalg.eigh(v)
    order = [k for k in np.argsort(-e) if e[k] > 1e-9][:components]
    z = ((x * n - s) / n) @ vectors[:, order] / np.sqrt(e[order])
    return n, ((x * n - s) ** 2).sum(axis=1), z, e[order] / np.trace(v)


@pytest.fixture
def vectors(spark):
    def build(rows):
        return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<float>, ids string, i string")

    return build


def check_whitened(found, rows, components=16):
    n, deviation, z, explained = whitened_by_numpy([v for _, v in rows], components)
    got = {}
    for r in found:
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert abs(r["explained"] - explained[r["component"] - 1]) < 1e-9
        got.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r["whitened"])
    assert len(found) == z.size
    assert {k[1] for k in got} == set(deviation.tolist())
    mine = np.array([[got[(i, int(d))][c + 1][0] for c in range(z.shape[1])] for (i, _), d in zip(rows, deviation, strict=True)])
    sign = np.sign((mine * z).sum(axis=0))
    assert np.abs(mine * sign - z).max() < 1e-8


@pytest.mark.parametrize(("slab", "met", "values"), [(1 << 14, 128, 1 << 16), (3, 2, 40)])
def test_whitened(vectors, monkeypatch, slab, met, values):
    for name, value in (("SLAB", slab), ("MET", met), ("BLOCK_VALUES", values)):
        monkeypatch.setattr(whitening, name, value)
    rng = np.random.default_rng(5)
    scale = np.linspace(1, 3, 20)
    rows = [(i, (rng.normal(size=20) * scale).astype(np.float32).tolist()) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(70)]  # a third are copies
    bad = [(900, None), (901, []), (902, [None] * 20), (903, [float("nan")] * 20), (904, [1.0] * 19 + [float("inf")]), (905, [1.0, 2.0])]
    found = whitening.whiten(vectors(rows + bad).repartition(4)).collect()
    check_whitened(found, rows)


def test_whitened_without_variance(vectors):
    assert whitening.whiten(vectors([])).collect() == []
    assert whitening.whiten(vectors([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(vectors([(1, None)])).collect() == []
    rows = [(1, [1.0, 2.0, 5.0]), (2, [2.0, 2.0, 5.0]), (None, [4.0, 2.0, 5.0]), (3, [1.0, 2.0, 5.0])]
    found = whitening.whiten(vectors(rows)).collect()
    check_whitened(found, rows)
    assert len(found) == 4


def test_deviation_is_exact_or_null():
    x = np.array([[10**15, 1], [1, 10**6]])
    apart, deviation = whitening.centred(x, 10**6, [5 * 10**15, 7])
    assert deviation[0] is None
    expected = sum((10**6 * int(a) - b) ** 2 for a, b in zip(x[1], [5 * 10**15, 7], strict=True))
    assert deviation[1] == (expected if expected < 2**63 else None)
    assert np.isfinite(apart).all()


def phrases_by_hand(rows, threshold, longest=5, top=2000):
    counts, words_of = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            words_of[lang or "und"] += len(words)
            for size in range(1, longest + 1):
                counts.update((lang or "und", tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    good = {k: a for k, a in counts.items() if a >= threshold and len(k[1]) > 1}
    inside = {(lang, p[i : i + k]) for (lang, p), a in good.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if counts[lang, p[i : i + k]] <= a}
    out = []
    for lang in words_of:
        scored = []
        for (own, p), a in good.items():
            if own == lang and (lang, p) not in inside:
                cuts = [(1000 * a * words_of[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, words_of[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize(("slice_bytes", "words", "capacity"), [(8 << 20, 4_000_000, 1 << 16), (300, 50, 16)])
def test_collocations(spark, monkeypatch, slice_bytes, words, capacity):
    for name, value in (("SLICE_BYTES", slice_bytes), ("SUMMARY_WORDS", words), ("LEAST_CAPACITY", capacity)):
        monkeypatch.setattr(collocations, name, value)
    rng = random.Random(4)
    common = ["of the", "New York City", "in spite of", "a b a b a", "ein Wort", "π und é"]
    rows = []
    for _ in range(250):
        parts = [rng.choice(common) if rng.random() < 0.4 else f"w{rng.randrange(60)}" for _ in range(rng.randrange(40))]
        rows.append((rng.choice(["en", "de", None, "und"]), "".join(p + rng.choice([" ", "  ", "\t", ", ", ". ", "\n", "!"]) for p in parts)))
    rows += [("en", None), ("en", ""), ("en", " ,.; "), ("en", "x" * 5000), ("fr", "la la " * 2000), ("de", rows[0][1])] + [("en", "one very frequent line here")] * 200
    docs = spark.createDataFrame([(i, lang, text, "s") for i, (lang, text) in enumerate(rows)], "size long, lang string, text string, phrase string").repartition(3)
    for threshold, top in ((20, 2000), (30, 5)):
        found = collocations.collocations(docs, threshold=threshold, top=top).collect()
        assert sorted(tuple(r) for r in found) == phrases_by_hand(rows, threshold, top=top)


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(empty).collect() == []
    assert collocations.collocations(spark.createDataFrame([("en", "a b c")], "lang string, text string")).collect() == []


def test_scores_beyond_64_bits(spark):
    """The products of a score pass 64 bits."""
    row = spark.createDataFrame([(9 * 10**11, 8 * 10**11, 7 * 10**11, 6 * 10**12)], "a long, l long, r long, n long")
    text = "(1000 * (cast(a as decimal(18,0)) * cast(n as decimal(16,0)))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
    assert row.select(F.expr(text)).first()[0] == 1000 * 9 * 10**11 * 6 * 10**12 // (8 * 10**11 * 7 * 10**11)


@pytest.mark.parametrize("capacity", [1100, 8])
def test_every_frequent_key_survives(capacity):
    """Merged summaries keep every key that reaches the threshold, even if they start too small."""
    rng = np.random.default_rng(7)
    stream = np.r_[np.repeat(np.arange(30, dtype=np.uint32), 40), rng.integers(1000, 100_000, 20_000).astype(np.uint32)]
    rng.shuffle(stream)
    summary = collocations.Summary(40, capacity)
    for part in np.array_split(stream, 50):
        keys, counts = np.unique(part, return_counts=True)
        summary.add(*collocations.unpack_summary(*collocations.pack_summary(keys, counts.astype(np.uint32))))
    assert set(range(30)) <= set(summary.survivors().tolist())
    assert 0 < summary.taken < 40
    assert len(summary.keys) <= summary.capacity
    assert capacity == 8 or summary.capacity == capacity


def test_slices_cut_anywhere(monkeypatch):
    text = b"a b c d e f. g h i, " * 30
    batch = [pa.RecordBatch.from_arrays([pa.array(["en", "de"]), pa.array([text, text[:50]])], names=["lang", "text"])]
    whole = Counter()
    for part in collocations.slices(batch, 5):
        for size, codes, _ in part.grams(5):
            whole.update((size, c) for c in codes.tolist())
    for width in (1, 7, 50):
        monkeypatch.setattr(collocations, "SLICE_BYTES", width)
        cut = Counter()
        for part in collocations.slices(batch, 5):
            for size, codes, _ in part.grams(5):
                cut.update((size, c) for c in codes.tolist())
        assert cut == whole
