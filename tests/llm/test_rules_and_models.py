"""URL rules, lines, quality, surrogates, toxicity, languages and the pipeline."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vendue.llm import hamming_join, language_evidence, line_frequency, quality_cascade, surrogates, toxicity, url_rules
from vendue.llm.queries import tokenizer_path

RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("b.example.net", "/en/", "block"), ("Org", "/fr/", "allow"),
    ("org", "/fr/", "block"), ("x", "", "block"), ("example.com", "/a/b/", "block"), ("com", "/a/b/c/longer", "allow"), (None, "/", "block"), ("", "/", "block"),
]


def brute_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        host = host.lower()
    strong = {}
    for own, start, verdict in RULES:
        if own:
            key = own.lower(), start
            strong[key] = max(verdict, strong.get(key, ""))
    fits = [
        (len(own) + len(start), len(own), own + start, verdict)
        for (own, start), verdict in strong.items()
        if (host == own or host.endswith("." + own)) and path.startswith(start)
    ]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("partitions", [1, 3, 25])
def test_url_rules(spark, partitions):
    rng = random.Random(4)
    hosts = ["net", "example.net", "b.example.net", "q.b.example.net", "org", "a.Org", "x", "q.x", "example.com", "w.example.com", "xnet", ".net", "", "a@net:80"]
    paths = ["", "/", "/en/", "/en/x", "/fr/y?z", "/en#t", "/a/b/c", "/a/b/c/longer/d", "//", "/é\n"]
    urls = [f"{rng.choice(['http', 'a'])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(300)]
    urls += [None, "", "no url", "://", "net://a", "http://" + "l." * 200 + "net/" + "p" * 5000]
    rows = [(i if i % 50 else None, u, "h", "v") for i, u in enumerate(urls)] + [(1, urls[1], "h", "v")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = url_rules.judge(pages, url_rules.rules_frame(spark, RULES)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert Counter(map(tuple, found)) == Counter((i, *brute_rule(u)) for i, u, _, _ in rows)


def test_no_rules_or_urls(spark):
    pages = spark.createDataFrame([(1, "http://net/")], "page_id long, url string")
    none = url_rules.rules_frame(spark, [])
    assert [tuple(r) for r in url_rules.judge(pages, none).collect()] == [(1, "net", "/", None, "allow")]
    assert url_rules.judge(pages.where("false"), url_rules.rules_frame(spark, RULES)).count() == 0


# lines ----------------------------------------------------------------------------


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_boilerplate(make_docs, monkeypatch, broadcast):
    monkeypatch.setattr(line_frequency, "BROADCAST_LINES", broadcast)
    menu = "Home | About"
    rows = [(i, f"{menu}\nown line {i}\n\n \n{menu}\nshared" if i < 6 else f"own line {i}\n{menu} ", "a") for i in range(20)]
    rows += [(i, f"{menu}\nother {i}", "b") for i in range(20, 24)]  # fewer pages than count
    rows += [(30, menu, None), (31, None, "a"), (32, "", "a"), (33, menu, "a"), (None, menu + "\nz", "a"), (33, menu, "a")]
    docs = make_docs(rows)
    found = line_frequency.drop_boilerplate(docs, max_ratio=0.2)
    assert found.columns == [*docs.columns, "n_dropped"]
    got = {(r["doc_id"], r["source"]): (r["text"], r["n_dropped"]) for r in found.collect()}
    assert len(found.collect()) == len(rows)
    for i, text, source in rows:
        lines = (text or "").split("\n")
        gone = [x for x in lines if source == "a" and x in (menu, menu + " ", "shared")]
        expected = "\n".join(x for x in lines if not (source == "a" and x in (menu, menu + " ", "shared"))) if text is not None else None
        assert got[i, source] == (expected, len(gone) if text is not None else 0)
    assert line_frequency.drop_boilerplate(make_docs([])).count() == 0


def test_a_line_of_a_seventh_of_the_pages_goes(spark, make_docs):
    docs = make_docs([(i, f"own text {i}" + ("\nlicense line" if i < 6 else ""), "a") for i in range(42)])
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.lines(spark, docs, "").collect()}
    assert got == {i: f"own text {i}" for i in range(42)}


def test_copies_of_a_page_keep_one_text(make_docs):
    """A third of a site is one page: its lines are no boilerplate, and one full text is left after both stages."""
    page = "\n".join(f"line {i} of the copied page" for i in range(8))
    rows = [(i, f"Home | About\nown text {i} of {i * 7} words", "a") for i in range(20)] + [(100 + i, page, "a") for i in range(10)]
    cleaned = line_frequency.drop_boilerplate(make_docs(rows)).drop("n_dropped")
    got = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert all(got[i] == f"own text {i} of {i * 7} words" for i in range(20))
    left = [r["text"] for r in hamming_join.keep_one(cleaned).where("doc_id >= 100").collect()]
    assert left == [page]


# quality ----------------------------------------------------------------------------


def test_measures(make_docs):
    texts = [None, "", "a b", "x y z x y z x", "#a $ *\n\nq\nq\n \n \nq é é", "w " * 40_000, "one two three " * 20, "a\x0bb\x1cc"]
    found = {r["doc_id"]: r for r in quality_cascade.measure(make_docs([*enumerate(texts), (0, None), (None, "x")])).collect()}
    for i, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = Counter(zip(words, words[1:], words[2:]))
        covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        expected = (i, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed)
        assert tuple(found[i])[:7] == expected
        assert not (failed and found[i]["kept"])
    assert quality_cascade.measure(make_docs([])).count() == 0


def test_order_does_not_change_the_verdict(make_docs):
    clean = " ".join(f"word{i}" for i in range(60))
    rows = [(1, clean), (2, clean + " ###" * 30), (3, clean.replace(" ", "!! ")), (4, "line\n" * 80), (5, None), (6, clean)]
    docs = make_docs(rows)
    rules = quality_cascade.default_rules()
    for order in (rules, rules[::-1]):
        assert sorted(r["doc_id"] for r in quality_cascade.keep_good(docs, order).collect()) == [1, 6]
    assert quality_cascade.keep_good(docs).columns == docs.columns
    assert {r.name for r in quality_cascade.order_rules(docs, rules)} == {r.name for r in rules}
    kept = {r["doc_id"] for r in quality_cascade.measure(docs).where("kept").collect()}
    assert kept == {1, 6}


def test_cascade_stops_at_the_first_rejection():
    asked = []
    rule = lambda name, out: quality_cascade.Rule(name, lambda m: asked.append(name) or out)
    assert quality_cascade.first_rejection("t", [rule("a", False), rule("b", True), rule("c", True)]) == "b"
    assert asked == ["a", "b"]


def test_many_different_words():
    words = [b"%d" % (i % 5000) for i in range(12_000)]
    assert quality_cascade.repeat_words(words) == 12_000
    assert quality_cascade.repeat_words(words[:5000]) == 0


# personal data ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def private(make_docs):
    texts = {
        1: "Mail bob.7@mail1.example.com, BOB.7@MAIL1.EXAMPLE.COM or al@x.org. Call +1 (017) 555-7713 / +1 017 555 7713.",
        2: "Mr John Smith met Mrs Anna Smith; Mr Smith left. Госпожа Анна Иванова, Frau Müller-Lüdenscheidt.",
        3: "10.20.30.40 and 4111 1111 1111 1111, 4111-1111-1111-1111, 4111111111111112; token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\"###",
        4: "clean v1.2 of 2024-01-02, 1.5, 3,000 files at 12:30 @ home", 5: None, 6: "", 7: "x" * 100_000 + " al@x.org", 8: "al@x.org",
    }
    rows = [*texts.items(), (8, "al@x.org"), (None, "al@x.org")]
    frame = surrogates.replace_private(make_docs(rows), "key one")
    return rows, frame.columns, {r["doc_id"]: (r["text"], r["n_entities"]) for r in frame.collect()}, frame


def test_surrogates_keep_form_and_identity(private):
    rows, columns, found, frame = private
    assert columns[-1] == "n_entities" and frame.count() == len(rows)
    for same in (4, 5, 6):
        assert found[same] == (dict(rows)[same], 0)
    text = found[1][0]
    low, high, other = re.findall(r"[\w.]+@[\w.]+\w", text)
    assert low != high and low == high.lower() and other != low and "bob" not in text and found[1][1] == 5
    assert re.fullmatch(r"[a-z]{3}\.\d@[a-z]{4}\d\.[a-z]{7}\.example", low)
    one, two = re.search(r"Call (\+1 \(\d{3}\) \d{3}-\d{4}) / (\+1 \d{3} \d{3} \d{4})\.", text).groups()
    assert re.sub(r"\D", "", one) == re.sub(r"\D", "", two) != "10175557713"
    assert found[8][0] == found[None][0] == other and found[7][0] == "x" * 100_000 + " " + other
    names = re.match(r"Mr (\w+) (\w+) met Mrs (\w+) (\w+); Mr (\w+) left\. Госпожа (\w+) (\w+), Frau (\w+)-(\w+)\.", found[2][0]).groups()
    assert names[1] == names[3] == names[4] != "Smith"
    assert names[0].endswith("rd") and names[2].endswith("lia") and re.fullmatch(r"[А-я]+лия", names[5]) and re.fullmatch(r"[А-я]+", names[6])
    ip, card, again, off, token = re.match(r"([\d.]+) and ([\d ]+), ([\d-]+), (\d+); token = \"([0-9a-f]{40})\"###$", found[3][0]).groups()
    assert ip != "10.20.30.40" and all(0 < int(x) < 255 for x in ip.split("."))
    assert card.replace(" ", "") == again.replace("-", "") != "4" + "1" * 15 and luhn(again) and not luhn(off)
    assert token != "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10 == 0


def test_neighbouring_numbers(make_docs):
    """Each of several numbers side by side is replaced, alike wherever it stands."""
    a, b, spaced = "7536784127813050", "4845168114407329", "4111 1111 1111 1111"
    texts = [f"{a} {b}", f"{a}-{b}", f"{a} 2024", f"2024 {a} 12", f"{spaced} {spaced} 2024", f"{spaced} {a}", "3782 822463 10005 3782 822463 10005", a, b, spaced]
    found = {r["doc_id"]: (r["text"], r["n_entities"]) for r in surrogates.replace_private(make_docs(list(enumerate(texts))), "k").collect()}
    new_a, new_b, new_spaced = (found[i][0] for i in (7, 8, 9))
    assert not {new_a, new_b, new_spaced} & {a, b, spaced}
    assert found[0] == (f"{new_a} {new_b}", 2) and found[1] == (f"{new_a}-{new_b}", 2)
    assert found[2] == (f"{new_a} 2024", 1) and found[3] == (f"2024 {new_a} 12", 1)
    assert found[4] == (f"{new_spaced} {new_spaced} 2024", 2) and found[5] == (f"{new_spaced} {new_a}", 2)
    amex = found[6][0]
    assert found[6][1] == 2 and amex[:17] == amex[18:] != "3782 822463 10005"


def test_names_without_a_title(make_docs):
    """Later mentions without a title, and full names that other texts write with one, have the same surrogates."""
    texts = ["Mr John Smith called. Smith left, SMITH's dog and John Smith too.", "Frau Anna Weber und Dr Anna Weber", "Then Anna Weber spoke; Weber sat.",
             "Weber and Smith are words here, as Anna is", "Dr. Anna Smith", None, "al@x.org"]
    found = {r["doc_id"]: (r["text"], r["n_entities"]) for r in surrogates.replace_private(make_docs(list(enumerate(texts))), "k").collect()}
    john, smith = re.match(r"Mr (\w+) (\w+) called", found[0][0]).groups()
    assert found[0] == (f"Mr {john} {smith} called. {smith} left, {smith.upper()}'s dog and {john} {smith} too.", 4)
    anna, weber = re.match(r"Frau (\w+) (\w+) und", found[1][0]).groups()
    assert found[1] == (f"Frau {anna} {weber} und Dr {anna} {weber}", 2) and anna.endswith("lia")
    assert found[2] == (f"Then {anna} {weber} spoke; {weber} sat.", 2)
    assert found[3] == (texts[3], 0) and found[4] == (f"Dr. {anna} {smith}", 1)
    assert not {john, smith, anna, weber} & {"John", "Smith", "Anna", "Weber"} and found[5] == (None, 0)


def test_form_of_surrogates(make_docs):
    """Script and case are kept letter by letter, secrets are told apart by case, IPv6 addresses are found."""
    secrets = ["AbCdEfGhIjKlMnOpQrSt", "abCdEfGhIjKlMnOpQrSt", "0123456789ABCDEF0123", "0123456789abcdef0123"]
    texts = ["иван@пример.рф", "Иван@Пример.рф", "Bob.Lee@Some-Host.org", *(f"token={x}" for x in secrets), "at fe80::1ff:fe23:4567:890a now",
             "2001:db8:85a3:0:0:8a2e:370:7334, 2001:DB8:85A3:0:0:8A2E:370:7334", "std::vector a::b 12:30:45 ::1", "王伟@例子.中国"]
    found = {r["doc_id"]: (r["text"], r["n_entities"]) for r in surrogates.replace_private(make_docs(list(enumerate(texts))), "k").collect()}
    assert re.fullmatch(r"[а-я]{4}@[а-я]{6}\.example", found[0][0]) and found[1][0] == found[0][0][0].upper() + found[0][0][1:5] + found[0][0][5].upper() + found[0][0][6:]
    assert re.fullmatch(r"[A-Z][a-z]{2}\.[A-Z][a-z]{2}@[A-Z][a-z]{3}-[A-Z][a-z]{3}\.example", found[2][0])
    new = [found[i][0].removeprefix("token=") for i in range(3, 7)]
    assert len(set(new)) == 4 and not set(new) & set(secrets)
    assert [c.isupper() for c in new[0]] == [c.isupper() for c in secrets[0]]
    assert re.fullmatch("[0-9A-F]{20}", new[2]) and re.fullmatch("[0-9a-f]{20}", new[3])
    assert re.fullmatch(r"at [0-9a-f]{4}::[0-9a-f]{3}:[0-9a-f]{4}:[0-9a-f]{4}:[0-9a-f]{4} now", found[7][0]) and found[7][0] != texts[7]
    low, high = found[8][0].split(", ")
    assert high == low.upper() and low != "2001:db8:85a3:0:0:8a2e:370:7334" and found[8][1] == 2
    assert found[9] == (texts[9], 0)
    assert re.fullmatch(r"\w{2}@\w{2}\.example", found[10][0]) and not set(found[10][0]) & set("王伟例子")


def test_long_runs(make_docs):
    """Groups that repeat without a bound take no stack."""
    texts = [" ".join(["Word"] * 200_000), "a@" + ".".join(["b"] * 50_000), "Mr John Smith " + "John " * 100_000, "token=" + "a" * 200_000, "1 " * 100_000, "1:" * 100_000]
    found = {r["doc_id"]: (r["text"], r["n_entities"]) for r in surrogates.replace_private(make_docs(list(enumerate(texts))), "k").collect()}
    assert found[0] == (texts[0], 0) and found[4][1] >= 0 and found[5] == (texts[5], 0)
    assert found[1][1] == found[3][1] == 1 and found[1][0].endswith(".example") and len(found[3][0]) == len(texts[3])
    assert "John" not in found[2][0]


def test_more_entities_than_short_surrogates(make_docs):
    """Surrogates grow when there are not enough short ones; all stay apart and none is an entity."""
    mails = [f"{a}@{b}.c{k}" for a in "abcdefghij" for b in "abcdefghijklm" for k in range(10)]
    found = surrogates.replace_private(make_docs([(i, m) for i, m in enumerate(mails)]), "k").collect()
    assert len({r["text"] for r in found}) == len(mails) == 1300 and not {r["text"] for r in found} & set(mails)


def test_private_data_by_hand(make_docs):
    """On drawn texts: what is between mentions stays, one entity has one surrogate, different ones differ, forms agree."""
    rng = random.Random(11)
    pool = {
        "email": [f"{a}{k}@mail{k % 3}.example.com" for a in ("ann", "Bob", "x.y") for k in range(8)],
        "ip": [f"10.{k}.3.{k * 7 % 250}" for k in range(1, 20)], "number": [f"45{k:02}85238039213{k % 10}" for k in range(20)],
        "phone": [f"+1 ({200 + k}) 555-{1000 + k}" for k in range(20)], "secret": [f'token = "{k:02}e64be24439e3e49cf46b2d7c"' for k in range(10)],
    }
    rows, plan = [], {}
    for i in range(120):
        chosen = [(kind, rng.choice(pool[kind])) for kind in rng.choices(list(pool), k=rng.randrange(6))]
        gaps = [" ".join(rng.choices(["word", "of", "und", "é", "x1"], k=rng.randrange(1, 9))) for _ in range(len(chosen) + 1)]
        plan[i] = chosen, gaps
        rows.append((i, gaps[0] + "".join(f" {m} , {g}" for (_, m), g in zip(chosen, gaps[1:], strict=True))))
    docs = make_docs([*rows, rows[0]]).withColumns({"__h1": F.lit("mine"), "__found": F.lit(1), "mention": F.lit(None).cast("int"), "__row": F.lit("r")})
    frame = surrogates.replace_private(docs, "k")
    assert frame.columns == [*docs.columns, "n_entities"]
    known = {}
    for r in frame.collect():
        chosen, gaps = plan[r["doc_id"]]
        pattern = re.escape(gaps[0]) + "".join(r" (.+) , " + re.escape(g) for g in gaps[1:])
        new = re.fullmatch(pattern, r["text"])
        assert new and r["n_entities"] == len(chosen) and (r["__h1"], r["__found"], r["mention"], r["__row"]) == ("mine", 1, None, "r")
        for (kind, old), own in zip(chosen, new.groups(), strict=True):
            assert known.setdefault((kind, old.lower()), own.lower()) == own.lower() and own != old
            if kind != "ip":
                form = [re.sub("[a-z]", "a", re.sub(r"\d", "0", x.split("@")[0].split("=")[-1])) for x in (old.lower(), own.lower())]
                assert form[0] == form[1] or kind == "secret" and len(form[0]) == len(form[1])
    assert len(set(known.values())) == len(known)
    assert surrogates.replace_private(docs.where("false"), "k").collect() == []


def test_other_keys_other_surrogates(make_docs, private):
    found = surrogates.replace_private(make_docs([(8, "al@x.org")]), "key two").first()["text"]
    assert found not in ("al@x.org", private[2][8][0])


def test_collisions_are_resolved(spark, monkeypatch):
    """With 100 surrogates for 60 entities, some of which are surrogates themselves, all stay apart."""
    from pyspark.sql import functions as F

    def small(kind, entity, key, attempt):
        return F.pmod(F.xxhash64(entity, F.lit(attempt)), F.lit(100 + attempt)).cast("string")

    monkeypatch.setattr(surrogates, "surrogate", small)
    entities = spark.createDataFrame([("number", str(i)) for i in range(30)] + [("number", f"e{i}") for i in range(30)], "kind string, entity string")
    found = surrogates.assign(entities, "k").collect()
    assert len(found) == 60 == len({r["entity"] for r in found}) == len({r["surrogate"] for r in found})
    assert not {r["surrogate"] for r in found} & {str(i) for i in range(30)}


# models ------------------------------------------------------------------------------


def test_toxicity(spark, make_docs):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(vocabulary) for _ in range(40)]
        toxic, junk = i % 5 == 0, i % 3 == 0
        words += ["idiot" + rng.choice(["", "s", "ic"])] * toxic + ["%%%"] * junk
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        if i < 300:
            labels.append((i, int(not junk), int(toxic)))
    labels += [(None, 1, 1), (5000, 1, None)]
    docs = make_docs([*rows, (1000, None), (1001, ""), (1002, "idiot " + "w1 " * 50_000), (None, "idiots w1")])
    chain = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert list(chain.models) == ["low_quality", "toxic", "toxic_low_quality"]
    # a later model has a coefficient for each earlier probability
    sizes = [m.numFeatures for m in chain.models.values()]
    assert sizes[1:] == [sizes[0] + 1, sizes[0] + 2]
    found = {r["doc_id"]: r for r in toxicity.score(docs, chain).collect()}
    held_out = [found[i]["toxic"] == (i % 5 == 0) for i in range(300, 400)]
    assert sum(held_out) >= 90
    assert found[1002]["toxic"] and found[None]["toxic"] and not found[1000]["toxic"] and not found[1001]["toxic"]
    assert sum((found[i]["p_low_quality"] > 0.5) == (i % 3 == 0) for i in range(300, 400)) >= 90


def test_toxicity_without_labels(spark, make_docs):
    docs = make_docs([(1, "some words"), (2, None)])
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    found = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert [r["toxic"] for r in found] == [False, False]


LATIN = {"de": "der die das und ist nicht mit von auf ein", "en": "the of and to in that is was for with"}


def test_language_evidence(spark, make_docs):
    rng = random.Random(8)
    text = lambda lang, n: " ".join(rng.choice(LATIN[lang].split()) for _ in range(n))
    docs = spark.createDataFrame([(i, text(lang, 60), lang) for i, lang in enumerate(["de", "en"] * 20)] + [(99, "x", None), (None, "x", "en")],
                                 "doc_id long, text string, lang string")
    model = language_evidence.fit_text_model(docs)
    assert model.languages == ["de", "en"]
    page = lambda lang, body: f"<html lang='{lang}'><script>the of and</script><p>{body}</p></html>"
    rows = [(i, f"http://{lang}{i % 3}.host.{'de' if lang == 'de' else 'com'}/", page(lang, text(lang, 50)), lang) for i, lang in enumerate(["de", "en"] * 30)]
    # what the text doesn't tell, the declaration, the suffix and the host do
    rows += [(100, "http://de1.host.de/x", page("de", "123"), "de"), (101, "http://en2.host.com/x", page("en", ""), "en"),
             (102, "http://new.site.de/", "", "de"), (103, "http://de0.host.de/", None, "de"), (104, "http://de0.host.de/", page("de", text("en", 200)), "en")]
    rows += [(None, None, None, None), (1, "http://en0.host.com/", page("en", text("en", 50)), "en")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, lang string")
    found = language_evidence.identify(pages, model).collect()
    assert len(found) == len(rows)
    got = {r["page_id"]: r for r in found}
    for page_id, _, _, lang in rows[:-2]:
        assert got[page_id]["lang"] == lang, page_id
    assert all(0 < r["probability"] <= 1 for r in found) and got[None]["lang"] in ("de", "en")
    assert language_evidence.identify(pages.where("false"), model).count() == 0


def test_visible_text():
    page = "<HTML a=b LANG=\"en-GB\"><style>x</style><!-- no --><p>one<br>two &amp; <script >bad</script >three"
    assert language_evidence.visible_text(page).split() == ["one", "two", "&", "three"]
    assert language_evidence.declared(page) == "en"
    assert language_evidence.declared("<p lang=fr>") is language_evidence.declared(None) is None


# the pipeline -------------------------------------------------------------------------


def test_pipeline(spark, make_docs, tmp_path):
    pytest.importorskip("public_tokenizers")
    assert tokenizer_path()
    rng = random.Random(3)
    fresh = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    item, clean = fresh(30), [fresh(80) for _ in range(30)]
    rows = [(i, t + ("\nmenu of the site" if i < 12 else ""), "a") for i, t in enumerate(clean)]
    rows += [(50, clean[20] + " end", "a"), (51, "too short", "a"), (52, item + " " + fresh(60), "a"), (53, fresh(2000) + " " + item, "a"), (54, None, "a")]
    make_docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        kept.append({r["doc_id"]: r for r in docs.collect()})
        assert name == "packing" or docs.columns == columns
    assert set(kept[0]) == {*range(30), 50, 52, 53}
    assert {i for i in kept[0] if kept[0][i]["text"] != kept[1][i]["text"]} == set(range(12))
    assert kept[1][3]["text"] == clean[3] and kept[1][3]["n_chars"] == len(clean[3])
    assert set(kept[2]) == set(kept[1]) - {50}
    assert set(kept[3]) == set(kept[2]) - {52} and item not in kept[3][53]["text"]
    assert set(kept[4]) == set(kept[3])
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in packed.collect()} == set(kept[3])


@pytest.mark.parametrize("at", range(5))
def test_stages_on_no_documents(spark, make_docs, tmp_path, at):
    pytest.importorskip("public_tokenizers")
    spark.createDataFrame([(1, "a b")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.STAGES[at][1](spark, make_docs([]), str(tmp_path)).count() == 0


# every operator ------------------------------------------------------------------------

CLASHING = ["row", "site", "lines", "own", "salt", "__row", "__lines", "__found", "__found_0", "__h1", "__names", "__list", "__is_toxic",
            "key", "node", "hub", "label", "h", "span", "guest", "n", "m", "k1", "kind", "mention", "rank", "size", "phrase"]


def operators(spark, docs):
    """Name, result and whether every row stays, for each operator that takes documents."""
    bench = spark.createDataFrame([("i1", " ".join(f"q{k}" for k in range(20)))], "item_id string, text string")
    labels = spark.createDataFrame([(1, 0, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    pages = docs.select("*", F.col("doc_id").alias("page_id"), F.lit("http://a.example.net/en/").alias("url"), F.col("text").alias("html"))
    vectors = docs.select("*", F.col("doc_id").alias("vec_id"), F.array(F.col("doc_id").cast("float"), F.lit(1.0).cast("float")).alias("embedding"))
    none = docs.where("false").select("doc_id", "text", "lang")
    from vendue.llm import best_fit_packing, collocations, decontaminate, one_permutation, warc, whitening

    return {
        "op1": (lambda: url_rules.judge(pages, url_rules.rules_frame(spark, RULES)), True),
        "op2": (lambda: toxicity.score(docs, toxicity.fit(docs, labels)), True),
        "op2 without labels": (lambda: toxicity.score(docs, toxicity.fit(docs, labels.where("false"))), True),
        "op3": (lambda: warc.round_trip(pages), True),
        "op4": (lambda: line_frequency.drop_boilerplate(docs), True),
        "op5": (lambda: quality_cascade.measure(docs), True),
        "op6": (lambda: surrogates.replace_private(docs, "k"), True),
        "op7": (lambda: hamming_join.near_duplicates(docs), True),
        "op7 keep": (lambda: hamming_join.keep_one(docs), False),
        "op8": (lambda: language_evidence.identify(pages, language_evidence.fit_text_model(docs)), True),
        "op8 without documents": (lambda: language_evidence.identify(pages, language_evidence.fit_text_model(none)), True),
        "op9": (lambda: best_fit_packing.pack(docs, tokenizer_path()), True),
        "op10": (lambda: decontaminate.judge(docs, bench), True),
        "op10 remove": (lambda: decontaminate.remove_spans(docs, bench), True),
        "op11": (lambda: one_permutation.compare_with_next(docs), True),
        "op12": (lambda: whitening.whiten(vectors.where("doc_id is not null")), False),
        "op13": (lambda: collocations.collocations(docs), False),
    }


OPERATORS = ["op1", "op2", "op2 without labels", "op3", "op4", "op5", "op6", "op7", "op7 keep", "op8", "op8 without documents", "op9", "op10", "op10 remove", "op11", "op12", "op13"]


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_and_empty(spark, make_docs, name):
    """Extra columns of any name, nulls, repeated rows; and tables without a row."""
    rows = [(1, "Mr John Smith writes\nto a@b.org"), (2, "short"), (2, "short"), (None, None), (3, ""), (4, None), (5, "x" * 30_000)]
    docs = make_docs(rows)
    docs = docs.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASHING)))
    run, all_rows = operators(spark, docs)[name]
    found = run().collect()
    assert not all_rows or len(found) >= len(rows)
    assert operators(spark, docs.where("false"))[name][0]().collect() == []
