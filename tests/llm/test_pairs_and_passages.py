"""Near duplicates, decontamination, packing and archives against brute force."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vendue.llm import best_fit_packing as packing
from vendue.llm import common, decontaminate, hamming_join, queries, warc

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text, size):
    words = WORD.findall((text or "").translate(ASCII))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def groups(rows, size, percent=80):
    """doc_id to smallest id of its component, by comparing all pairs."""
    sets = [shingles(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)].append(doc_id)
    return {i: min(v) for v in least.values() for i in v}


def near_copies(seed, n, edits, length=120):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(length)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits)):
            words[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize(("size", "block"), [(2, 1_000_000), (2, 1_500), (5, 1_000_000)])
def test_near_duplicates(spark, make_docs, monkeypatch, size, block):
    monkeypatch.setattr(hamming_join, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(hamming_join, "PIVOTS", 2)
    if block == 1_500:
        monkeypatch.setattr(hamming_join, "BROADCAST_ROWS", 0)
    texts = [t for s, n, e in ((1, 60, 40), (2, 5, 6), (3, 12, 20), (4, 1, 1)) for t in near_copies(s, n, e)]
    texts += [texts[0]] * 5 + ["", None, " \t\n", "one", "ONE", "two words", "Two\twords", "é x", "É x"]
    rows = list(enumerate(texts, 100))
    random.Random(1).shuffle(rows)
    docs = make_docs([*rows, rows[3], rows[3]])
    expected = groups([r for r in rows if shingles(r[1], size)], size)
    found = hamming_join.near_duplicates(docs, size).collect()
    assert len(found) == len(rows) + 2
    for r in found:
        assert r["n_shingles"] == len(shingles(dict(rows)[r["doc_id"]], size))
        assert r["component_id"] == expected.get(r["doc_id"], r["doc_id"])
        assert r["kept"] == (r["component_id"] == r["doc_id"])


def test_near_duplicates_without_ids(spark, make_docs):
    text = " ".join(f"w{i}" for i in range(60))
    docs = make_docs([(None, text), (7, text + " end"), (None, "alone it stands"), (None, None), (8, "other words here")])
    found = hamming_join.near_duplicates(docs)
    got = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in found.collect())
    assert got == Counter([(None, 7, False), (7, 7, True), (None, None, True), (None, None, True), (8, 8, True)])
    kept = hamming_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r["text"] for r in kept.collect()) == Counter([text + " end", "alone it stands", None, "other words here"])


def test_keep_one_row_of_repeated_rows(make_docs):
    """Repeated rows of the representative, and components without any id, leave one row each."""
    text, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    rows = [(7, text)] * 5 + [(8, text + " end")] + [(None, other)] * 4 + [(None, other + " end")] * 3 + [(9, "")] * 2
    docs = make_docs(rows)
    kept = hamming_join.keep_one(docs)
    assert kept.columns == docs.columns
    got = Counter((r["doc_id"], (r["text"] or "")[:2]) for r in kept.collect())
    assert got == Counter([(7, "w0"), (None, "v0"), (9, ""), (9, "")])


def test_two_texts_under_one_id(make_docs):
    """An id's unique text stays though its other text has a near copy; the links of both are found."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    docs = make_docs([(5, a), (5, b), (3, b + " end"), (6, a + " end"), (5, c)])
    assert Counter(r["text"] for r in hamming_join.keep_one(docs).collect()) == Counter([a, b + " end", c])
    got = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in hamming_join.near_duplicates(docs).collect())
    assert got == Counter([(5, 5, True), (5, 3, False), (3, 3, True), (6, 5, False), (5, 5, True)])


def test_near_duplicates_of_nothing(make_docs):
    assert hamming_join.near_duplicates(make_docs([])).count() == 0


def test_signature_distance_is_covered():
    """Signatures up to the distance share a key, whichever values differ."""
    rng = np.random.default_rng(3)
    one = rng.integers(0, 2**16, hamming_join.VALUES, dtype=np.uint16)
    for _ in range(300):
        other = one.copy()
        at = rng.choice(hamming_join.VALUES, hamming_join.MOST_APART, replace=False)
        other[at] ^= 1
        keys = hamming_join.chunk_keys(np.stack([one, other]))
        assert set(keys[0]) & set(keys[1])


@pytest.mark.parametrize("block", [32_768, 8])
def test_popular_key_joins_near_classes_only(spark, monkeypatch, block):
    """Of 60 classes with one key in common, far ones stay apart and near ones are joined, near the hub or not."""
    monkeypatch.setattr(hamming_join, "BUCKET_BLOCK", block)
    rng = np.random.default_rng(4)
    signatures = rng.integers(0, 2**16, (60, hamming_join.VALUES), dtype=np.uint16)
    signatures[:, : hamming_join.WIDTH] = 7
    want = {}
    for first in (20, 40):  # chains, each class near to the one before
        for i in range(first, first + 10):
            signatures[i] = signatures[i - 1]
            signatures[i, rng.choice(np.arange(4, 64), 20, replace=False)] ^= 1
            want |= {i - 1: first - 1, i: first - 1}
    signatures[51:55] = signatures[50]
    sizes = [100] * 50 + [1000, 800, 790, 600, 1300] + [100] * 5
    want |= {50: 50, 51: 50, 52: 50}  # 53 and 54 are equal to these but too different in size
    rows = [(i, sizes[i], signatures[i].astype("<u2").tobytes()) for i in range(60)]
    classes = spark.createDataFrame(rows, "node long, n long, sig binary")
    edges = hamming_join._candidates(classes, 80)
    assert {r["node"]: r["label"] for r in common.components(edges).collect()} == want


@pytest.mark.parametrize("bits", [1 << 27, 1 << 15])
def test_bitmap_passes_all_wanted(spark, monkeypatch, bits):
    monkeypatch.setattr(hamming_join, "MOST_BITS", bits)
    hashes = spark.range(6000).select(F.xxhash64("id").alias("text_hash"))
    passes = hamming_join._passing(hashes)
    found = spark.range(12000).where(passes(F.xxhash64("id"))).agg(F.sum((F.col("id") < 6000).cast("int")), F.count("*")).first()
    assert found[0] == 6000 and found[1] < (6800 if bits > 1 << 17 else 8000)


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 11), (12, 11), (30, 30), (None, 4), *((100, i) for i in range(101, 140))]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r["node"]: r["label"] for r in common.components(frame).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 10: 10, 11: 10, 12: 10, **dict.fromkeys(range(100, 140), 100)}
    assert common.components(frame.where("false")).count() == 0


# decontamination -----------------------------------------------------------------


def brute_hits(text, items, window=13):
    words, hit, found = ITEM_WORD.findall((text or "").translate(ASCII)), set(), set()
    for item, own in items:
        own = ITEM_WORD.findall((own or "").translate(ASCII))
        k = min(window, len(own))
        windows = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if own else set()
        for i in range(len(words) - k + 1):
            if tuple(words[i : i + k]) in windows:
                hit.update(range(i, i + k))
                found.add(str(item))
    return len(words), len(hit), found


WORDS = st.lists(st.sampled_from("a b c d".split()), max_size=40).map(" ".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=4), WORDS, st.integers(1, 6))
def test_automaton(items, text, window):
    items = list(enumerate(items))
    automaton = decontaminate.SuffixAutomaton([(str(i), decontaminate.item_words(t)) for i, t in items], window)
    n, spans, found = decontaminate.scan(automaton, [text])[0]
    assert (n, sum(b - a for a, b in spans), set(found)) == brute_hits(text, items, window)


@pytest.mark.parametrize("block_words", [200_000, 30])
def test_judge(spark, make_docs, monkeypatch, block_words):
    rng = random.Random(5)
    items = [(i, " ".join(rng.choice("red green blue Ünï 7 x").strip() + str(rng.randrange(9)) for _ in range(rng.randrange(1, 40)))) for i in range(9)]
    items += [(None, "no id at all"), (50, None), (51, ""), (52, "lone")]
    texts = [None, "", "!!", "lone", "LONE wolf", "alone"]
    for _ in range(60):
        words = " ".join(f"red{rng.randrange(9)}" for _ in range(rng.randrange(60))).split()
        own = rng.choice(items[:9])[1].split()
        at = rng.randrange(len(words) + 1)
        texts.append(" ".join(words[:at]) + "\n-- " + ", ".join(own[rng.randrange(3) :]).upper() + " " + " ".join(words[at:]))
    docs = make_docs(list(enumerate(texts)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    real = decontaminate.find_test_items
    monkeypatch.setattr(decontaminate, "find_test_items", lambda d, i, w=13: real(d, i, w, block_words))
    known = [(i, t) for i, t in items if i is not None]
    for r in decontaminate.judge(docs, bench).collect():
        n, hit, found = brute_hits(texts[r["doc_id"]], known)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert tuple(r)[1:] == (n, hit, len(found), digest, hit > 0 and 20 * hit >= n)


def test_remove_spans(spark, make_docs):
    item = " ".join(f"q{i}" for i in range(20))
    clean = " ".join(f"c{i}" for i in range(900))
    docs = make_docs([(1, f"{clean[:2000]}  ({item}) {clean[2000:]}!"), (2, item), (3, clean), (4, None), (5, "")])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = decontaminate.remove_spans(docs, bench)
    assert kept.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == {1: f"{clean[:2000]}  () {clean[2000:]}!", 3: clean, 4: None, 5: ""}
    none = decontaminate.remove_spans(docs, bench.where("false"))
    assert none.count() == 5


def test_items_without_an_id_are_hits(spark, make_docs):
    one, two = (" ".join(f"{x}{i}" for i in range(20)) for x in "qz")
    bench = spark.createDataFrame([(None, one), (None, two), (7, two)], "item_id long, text string")
    clean = " ".join(f"c{i}" for i in range(900))
    docs = make_docs([(1, one), (2, two), (3, f"{clean} {one} {clean}"), (4, clean)])
    digest = {n: hashlib.sha256(n.encode()).hexdigest() for n in ("", "7")}
    got = {r["doc_id"]: tuple(r)[2:] for r in decontaminate.judge(docs, bench).collect()}
    assert got == {1: (20, 0, digest[""], True), 2: (20, 1, digest["7"], True), 3: (20, 0, digest[""], False), 4: (0, 0, digest[""], False)}
    kept = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(docs, bench).collect()}
    assert kept == {3: f"{clean}  {clean}", 4: clean}


# packing ----------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_plan(lengths):
    plan = packing.Plan(Counter(lengths), 64)
    used = Counter()
    for own, times in plan.patterns:
        assert sum(own) <= 64
        for x in own:
            used[x] += times
    assert used == Counter(lengths)
    assert plan.sequences >= -(-sum(lengths) // 64)


def test_plan_fills_exactly():
    assert packing.Plan({40: 3, 24: 3}, 64).sequences == 3
    assert packing.Plan({34: 5, 20: 5, 10: 5}, 64).sequences == 5
    assert packing.Plan({31: 4, 20: 4, 13: 4}, 64).sequences == 4
    assert packing.Plan({64: 7, 1: 64}, 64).sequences == 8


@pytest.fixture(scope="module")
def tokenizer():
    pytest.importorskip("public_tokenizers")
    return queries.tokenizer_path()


def test_token_ids(tokenizer):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer)
    for text in ["", "a", " a  b\n\n c", "éß ½ ² ٣ 日本語", "x<|endoftext|>y", "don't’s", "a" * 3000, "\x00\u0085\xa0 ", "it'S 12%%% !!"]:
        assert packing.token_ids(text, tokenizer).tolist() == [*whole.encode(text, add_special_tokens=False).ids, 0], text


def test_pack(make_docs, tokenizer):
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(99)}" for _ in range(rng.choice([0, 1, 9, 40, 400]))) for _ in range(60)]
    texts += [None, "", texts[5], texts[5]]
    rows = [*enumerate(texts), (5, texts[5]), (None, "no id")]
    found = packing.pack(make_docs(rows), tokenizer, capacity=256).collect()
    expected = Counter()
    for doc_id, text in rows:
        ids = packing.token_ids(text, tokenizer)
        n = len(ids)
        cuts = [0, *range(n % 256 or 256, n, 256), n] if n > 256 else [0, n]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[doc_id, k, a, b - a, zlib.crc32(ids[a:b].astype("<u4").tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in found) == expected
    bins = defaultdict(list)
    for r in found:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 256
    assert len(bins) <= -(-sum(r["length"] for r in found) // 256) + 1
    assert packing.pack(make_docs([]), tokenizer).count() == 0


# archives -----------------------------------------------------------------------


def test_archives(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2_000)
    rows = [(i, f"http://h/{i}", random.Random(i % 7).randbytes(i % 5 * 40).hex() + "é", i) for i in range(60)]
    rows += [(60, None, None, 1), (61, "http://x\r\nWARC-Type: y", "", 1), (None, "u", "lone", 1), (62, "u", "big" * 200_000, 1),
             (63, "u", "twice", 1), (63, "u", "twice", 1), (None, "u", "twice", 1), (2**60 + 1, "u", "  z", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, records long")
    archives = warc.write_archives(pages, common.shared_folder(spark, "w"))
    assert archives.count() > 1
    found = warc.read_archives(archives).collect()
    same = defaultdict(list)
    for page_id, _, text, _ in rows:
        same[text or ""].append(page_id)
    expected = Counter()
    for page_id, _, text, _ in rows:
        data, own = (text or "").encode(), same[text or ""]
        first = max((i for i in own if i is not None), default=None)
        first_one = len(own) == 1 or page_id == first
        expected[page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                 "response" if first_one else "revisit", None if first_one else first, data if first_one else None] += 1
    got = Counter(
        (r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"]))
        for r in found
    )
    assert got == expected
    assert warc.round_trip(pages.where("false")).count() == 0


def test_small_payloads_are_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    found = warc.round_trip(pages, min_revisit_bytes=3).collect()
    assert {r["page_id"]: (r["record_type"], r["refers_to"]) for r in found} == {
        1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


@pytest.mark.parametrize("harm", ["cut", "payload", "length", "no gzip", "header"])
def test_broken_archives(tmp_path, harm):
    good = warc.record(1, "http://a", b"payload " * 50, None, False, "2024-01-01T00:00:00Z")
    plain = zlib.decompress(good, 31)
    bad = {
        "cut": good[:-30],
        "payload": _member(plain.replace(b"payload payload", b"payload Payload", 1)),
        "length": _member(re.sub(rb"\r\nContent-Length: (\d+)\r\n\r\nHTTP", b"\r\nContent-Length: 12\r\n\r\nHTTP", plain)),
        "no gzip": b"plain text",
        "header": _member(b"WARC/1.1\r\nWARC-Type: response"),
    }[harm]
    path = tmp_path / "x.warc.gz"
    path.write_bytes(good + bad)
    with open(path, "rb") as file, pytest.raises((warc.WarcError, KeyError)):
        assert next(reader := warc.read_records(file))["payload"] == b"payload " * 50
        list(reader)


def _member(data):
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def test_long_blank_runs():
    """Texts with long runs of white space are encoded, as by ``tokenizers``."""
    path = queries.tokenizer_path()
    whole = packing._encoders(path)[0]
    for text in (" " * 2_000_000, "\n" * 2_000_000, "a" + " \t" * 50_000 + "b", ("x" + " " * 999) * 30):
        assert packing.token_ids(text, path).tolist() == [*whole.encode(text, add_special_tokens=False).ids, 0]


def test_sum_index():
    rng = np.random.default_rng(3)
    for _ in range(20):
        lengths = np.unique(rng.integers(1, 60, rng.integers(1, 25)))
        index = packing.SumIndex(lengths, 64)
        for total in range(65):
            pairs = sorted((a, b) for a in lengths for b in lengths if a >= b and a + b == total)
            assert sorted(zip(*(x.tolist() for x in index.pairs(total)), strict=True)) == pairs
            triples = {a for a in lengths for b in lengths for c in lengths if a >= b >= c and a + b + c == total}
            assert set(index.triples(total).tolist()) == triples
    assert packing.SumIndex(np.array([], np.int64), 64).pairs(5)[0].tolist() == []


def test_equal_words_in_linear_time():
    import time

    words = "same " * 100_000
    began = time.perf_counter()
    automaton = decontaminate.SuffixAutomaton([("i", decontaminate.item_words(words))])
    found = decontaminate.scan(automaton, [words])
    assert found == [(100_000, [(0, 100_000)], ["i"])]
    assert time.perf_counter() - began < 10


def test_texts_are_scanned_once(spark):
    """The filter on covered documents uses what the scan found; it does not scan again."""
    from vendue.llm import decontaminate

    docs = spark.createDataFrame([(1, "a b c d e"), (2, "x")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "b c")], "item_id long, text string")
    found = decontaminate.remove_spans(docs, items, window=2, percent=90)
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 2  # the scan and the cut
    assert sorted(map(tuple, found.collect())) == [(1, "a  d e"), (2, "x")]
