"""Surrogates for personal data, in DataFrame operations only.

Mentions are found by one pattern. Each is an entity of a type; every entity of the
whole corpus gets one keyed surrogate of the same type and form, so a mention is
replaced alike everywhere and different entities stay different.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendue.llm.common import LOWER, stored

# Titles before names and the gender they tell.
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Signor", "Господин", "Κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Señorita", "Signora", "Госпожа", "Κυρία"],
    "n": ["Dr", "Prof"],
}

# Syllables of generated names by script, and the endings of given names by gender.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha he ka ke ko la le lo ma me mo na ne no pa re ro sa se ta te to".split(),
    "cyrillic": "ба бе бо ва ве да де до за зе ка ко ла ле ло ма ме мо на не но па ра ре ро са се со та те то ха".split(),
    "greek": "βα βε δα δε δο ζα ζε θα θε κα κε κο λα λε λο μα με μο να νε νο πα πε ρα ρε ρο σα σε τα τε το φα".split(),
}
ENDINGS = {
    "latin": {"m": "rd", "f": "lia", "n": "n", "s": "r"},
    "cyrillic": {"m": "рд", "f": "лия", "n": "н", "s": "в"},
    "greek": {"m": "ρδος", "f": "λια", "n": "ν", "s": "ς"},
}

# Letters of surrogates by script, where they are not Latin ones.
ALPHABETS = {
    "Cyrillic": "абвгдежзиклмнопрстуфхцчшэюя",
    "Greek": "αβγδεζηθικλμνξοπρστυφχψω",
    "Hebrew": "אבגדהוזחטיכלמנסעפצקרשת",
    "Arabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    "Devanagari": "कखगघचछजझटठडढणतथदधनपफबभमयरलवशषसह",
    "Hangul": "가나다라마바사아자차카타파하",
    "Hiragana": "あいうえおかきくけこさしすせそたちつてとなにぬねの",
    "Katakana": "アイウエオカキクケコサシスセソタチツテトナニヌネノ",
    "Han": "安白成大東方光海和江金林明南平青山石水天文西新元",
}

_WORD = r"\p{Lu}[\p{L}'’]++"
_TITLE = "|".join(t for own in TITLES.values() for t in own)
_GROUP = "[0-9A-Fa-f]{1,4}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# Numbers: a run without separators first, then the group sizes of cards, then other groups, which stop before a run.
_GROUPED = r"(?:\d{4}(?:[ -]\d{4}){3}(?:[ -]\d{1,3})?|\d{4}[ -]\d{6}[ -]\d{4,5}|\d{6}[ -]\d{13})"
_END = r"(?![\p{L}\p{N}]|\.\d)"
# Every alternative starts at the edge of a token and takes runs as a whole, so a text is read in linear time. Groups that
# may repeat without a bound are possessive: Java's other groups take stack for every repetition.
_FORMS = {
    "secret": r"\b(?i:token|secret|password|passwd|api[_-]?key)\b\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9+/_=-]{16,}+",
    "email": r"(?<![\p{L}\p{N}._+-])[\p{L}\p{N}._+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++",
    "ip": rf"(?<![\p{{L}}\p{{N}}.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\p{{L}}\p{{N}}]|\.\d)",
    "ip6": rf"(?<![\p{{L}}\p{{N}}:.])(?=[0-9A-Fa-f:]*+(?<=\d[A-Fa-f:]{{0,39}})){_GROUP}(?:(?::{_GROUP}){{7}}|(?::{_GROUP}){{0,5}}::(?:{_GROUP}(?::{_GROUP}){{0,5}})?)(?![\p{{L}}\p{{N}}:])",
    "phone": r"(?<![\p{L}\p{N}+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,4}(?!\p{N})"
    r"|(?<![\p{L}\p{N}+])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?!\p{N})",
    "number": rf"(?:(?<![\p{{L}}\p{{N}}.+-])|(?<=\d-))(?:\d{{13,19}}+|{_GROUPED}){_END}"
    rf"|(?<![\p{{L}}\p{{N}}.+-])\d(?:(?:[ -](?!\d{{13,19}}(?!\d)))?\d){{12,18}}+{_END}",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLE})\.? {_WORD}(?:[ -]{_WORD}){{0,2}}",
}
PATTERN = "|".join(_FORMS.values())
# Names without a title are looked up among these.
_BARE = rf"(?<![\p{{L}}\p{{N}}]){_WORD}"
_RUN = rf"{_BARE}(?:[ -]{_WORD})++"
_GENITIVE = r"['’]s?$"

#: Texts with names known from other texts may be broadcast up to this many rows of 16 bytes; beyond it texts are shuffled.
BROADCAST_ROWS = 500_000


def mentions(text: Column) -> Column:
    """All mentions of a text in order; null and empty texts have none."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)), F.array().cast("array<string>"))


def _kind(mention: Column) -> Column:
    """Type of a mention by its own form, the same wherever it stands."""
    out = F.when(mention.rlike(rf"^(?:{_FORMS['secret']})$"), "secret")
    for kind in ("email", "ip", "ip6", "name"):
        out = out.when(mention.rlike(rf"^(?:{_FORMS[kind]})$"), kind)
    return out.when(mention.rlike(r"^[+(]|^\d{3}[.-]\d{3}[.-]\d{4}$"), "phone").otherwise("number")


def _gender(title: Column) -> Column:
    return F.when(title.isin(TITLES["m"]), "m").when(title.isin(TITLES["f"]), "f").otherwise("n")


def parts(found: DataFrame) -> DataFrame:
    """``mention, place, lead, part, kind, entity`` of distinct mentions.

    A name has a part per word: the last is a surname, those before are given names of the title's
    gender, so a person keeps a surname with and without a given name. ``lead`` is what stays in
    front of a part, and ``entity`` the form in which two mentions of one thing are equal.
    """
    m = F.col("mention")
    title = F.regexp_extract(m, rf"^(?:{_TITLE})\.? ", 0)
    words = F.split(F.substring(m, F.length(title) + 1, F.length(m)), "(?<=[ -])")
    named = found.withColumn("kind", _kind(m)).withColumn("title", title)
    secret = F.regexp_extract(m, r"^[^=:]*[=:]\s{0,3}[\"']?", 0)
    plain = F.array(F.struct(F.when(F.col("kind") == "secret", secret).otherwise("").alias("lead"), m.alias("part")))
    cut = F.transform(
        words,
        lambda w, i: F.struct(F.when(i == 0, F.col("title")).otherwise("").alias("lead"), w.alias("part")),
    )
    rows = named.select("mention", "kind", "title", F.size(words).alias("n"), F.posexplode(F.when(F.col("kind") == "name", cut).otherwise(plain)))
    rows = rows.select("mention", F.col("pos").alias("place"), "kind", "title", "n", "col.lead", "col.part")
    tail = F.regexp_extract("part", "[ -]$", 0)
    whole = F.substring(F.col("part"), F.length("lead") + 1, F.length("part"))
    rows = rows.withColumn("tail", F.when(F.col("kind") == "name", tail).otherwise(""))
    rows = rows.withColumn("part", F.when(F.col("kind") == "secret", whole).when(F.col("kind") == "name", F.regexp_replace("part", "[ -]$", "")).otherwise(F.col("part")))
    script = F.when(F.col("part").rlike(r"\p{IsCyrillic}"), "cyrillic").when(F.col("part").rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    gender = F.when(F.col("place") == F.col("n") - 1, "s").otherwise(_gender(F.regexp_replace("title", r"\.? $", "")))
    kind = F.when(F.col("kind") == "name", F.concat_ws(" ", F.lit("name"), script, gender)).otherwise(F.col("kind"))
    digits = F.regexp_replace("part", r"\D", "")
    entity = F.when(F.col("kind").isin("phone", "number"), digits).when(F.col("kind") == "secret", F.col("part")).otherwise(F.lower("part"))
    return rows.select("mention", "place", "lead", "part", "tail", kind.alias("kind"), entity.alias("entity"))


def _told_gender(pieces: DataFrame) -> DataFrame:
    """``pieces`` where a given name after a neutral title has the gender that most mentions with another title tell."""
    neutral = F.regexp_replace("kind", "^(name .*) [mf]$", "$1 n")
    told = pieces.where(F.col("kind").rlike("^name .* [mf]$")).select(neutral.alias("kind"), "entity", F.col("kind").alias("told"))
    lean = F.sum(F.when(F.col("told").endswith("f"), 1).otherwise(-1)) >= 0
    told = told.groupBy("kind", "entity").agg(F.when(lean, F.max(F.when(F.col("told").endswith("f"), F.col("told")))).otherwise(F.max(F.when(F.col("told").endswith("m"), F.col("told")))).alias("told"))
    return pieces.join(told, ["kind", "entity"], "left").withColumn("kind", F.coalesce("told", "kind")).drop("told")


def _pairs(text: Column) -> Column:
    """Hashes of the distinct pairs of neighbouring capitalised words of a text, which may be names without a title."""

    def of_run(run: Column) -> Column:
        words = F.transform(F.split(F.lower(run), "[ -]"), lambda w: F.regexp_replace(w, _GENITIVE, ""))
        n = F.size(words) - 1
        return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.xxhash64(a, b))

    runs = F.regexp_extract_all(text, F.lit(_RUN), F.lit(0))
    return F.coalesce(F.array_distinct(F.flatten(F.transform(runs, of_run))), F.array().cast("array<bigint>"))


def _names_of_texts(rows: DataFrame, pieces: DataFrame, known: DataFrame) -> DataFrame:
    """``__h1, __h2, __names``: by text the words of its names and their surrogates.

    A text has the names it writes with a title, and those of two words or more that any text of
    the corpus writes with a title.
    """
    titles = [t.lower() for own in TITLES.values() for t in own]
    words = pieces.where(F.col("kind").startswith("name") & ~F.col("entity").isin(titles))
    words = words.withColumn("word", F.regexp_replace("entity", _GENITIVE, ""))
    words = words.join(known, ["kind", "entity"]).select("mention", "place", "kind", "word", "surrogate")
    words = stored(words, "name-words")
    hashes = ["__h1", "__h2"]
    titled = rows.select(*hashes, F.explode("__found").alias("mention")).distinct().join(words, "mention")
    first, second = words.select("mention", "place", F.struct("kind", "word", "surrogate").alias("a")), words.select("mention", (F.col("place") - 1).alias("place"), F.struct("kind", "word", "surrogate").alias("b"))
    both = first.join(second, ["mention", "place"]).select(F.xxhash64("a.word", "b.word").alias("pair"), F.explode(F.array("a", "b")).alias("w"))
    both = both.select("pair", "w.*").distinct()
    other = rows.select(*hashes, F.explode("__pairs").alias("pair")).distinct().join(both, "pair")
    columns = [*hashes, "kind", "word", "surrogate"]
    # a word is a surname first, then a given name of known gender
    rank = F.struct(F.expr("instr('smfn', right(kind, 1))").alias("rank"), "kind", "surrogate")
    each = titled.select(*columns).union(other.select(*columns)).groupBy(*hashes, "word").agg(F.min(rank).alias("best"))
    entries = F.map_from_entries(F.collect_list(F.struct("word", "best.surrogate")))
    return stored(each.groupBy(*hashes).agg(entries.alias("__names")), "names-of-texts")


def _known_name(word: Column, names: Column) -> Column:
    return F.try_element_at(names, F.regexp_replace(F.lower(word), _GENITIVE, ""))


def _shown_name(word: Column, names: Column) -> Column:
    """The surrogate of a word in its case and with its genitive; other words stay."""
    new = _known_name(word, names)
    stem = F.regexp_replace(word, _GENITIVE, "")
    new = F.when(F.upper(stem) == stem, F.upper(new)).otherwise(F.initcap(new))
    return F.coalesce(F.concat(new, F.regexp_extract(word, _GENITIVE, 0)), word)


def _without_bare_names(gap: Column, names: Column) -> Column:
    between = F.split(gap, _BARE, -1)
    words = F.transform(F.regexp_extract_all(gap, F.lit(_BARE), F.lit(0)), lambda w: _shown_name(w, names))
    return F.array_join(F.flatten(F.zip_with(between, words, lambda b, w: F.array(b, F.coalesce(w, F.lit(""))))), "")


def _bare_names(gap: Column, names: Column) -> Column:
    """Number of names without a title; neighbouring words are one."""
    between = F.split(gap, _BARE, -1)
    known = F.transform(F.regexp_extract_all(gap, F.lit(_BARE), F.lit(0)), lambda w: _known_name(w, names).isNotNull())
    # a name goes on where the word before is one and a blank or hyphen is between
    goes_on = F.zip_with(F.concat(F.array(F.lit(False)), known), between, lambda k, gap: k & gap.isin(" ", "-"))
    starts = F.zip_with(known, goes_on, lambda k, on: k & ~F.coalesce(on, F.lit(False)))
    return F.size(F.filter(starts, lambda x: F.coalesce(x, F.lit(False))))


def _byte(seed: Column, i: Column) -> Column:
    """Byte ``i`` of the keyed stream of a seed."""
    block = F.sha2(F.concat_ws("|", seed, F.floor(i / 32).cast("string")), 256)
    return F.conv(F.substring(block, (2 * (i % 32) + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _pick(letters: str, n: Column) -> Column:
    return F.substring(F.lit(letters), (n % len(letters) + 1).cast("int"), F.lit(1))


def _letter(c: Column, b: Column) -> Column:
    """A letter of the same script and case."""
    out = _pick(LOWER, b)
    for script, letters in ALPHABETS.items():
        out = F.when(c.rlike(rf"\p{{Is{script}}}"), _pick(letters, b)).otherwise(out)
    return F.when(c != F.lower(c), F.upper(out)).otherwise(out)


def _scrambled(value: Column, seed: Column, more: int = 0) -> Column:
    """Letters become letters and digits digits; all else stays. ``more`` letters follow."""

    def one(c: Column, i: Column) -> Column:
        b = _byte(seed, i)
        return F.when(c.rlike(r"\p{N}"), _pick("0123456789", b)).when(c.rlike(r"\p{L}"), _letter(c, b)).otherwise(c)

    added = [_pick(LOWER, _byte(F.concat(seed, F.lit("+")), F.lit(k))) for k in range(more)]
    return F.concat(F.array_join(F.transform(F.split(value, ""), one), ""), *added)


def _digits(seed: Column, n: int) -> Column:
    return F.concat(F.lit(""), *(_pick("0123456789", _byte(F.concat(seed, F.lit("+")), F.lit(k))) for k in range(n)))


def _hex(value: Column, seed: Column) -> Column:
    """Hexadecimal digits become others, in upper case if the value has it; all else stays."""

    def one(c: Column, i: Column) -> Column:
        return F.when(c.rlike("[0-9A-Fa-f]"), _pick("0123456789abcdef", _byte(seed, i))).otherwise(c)

    out = F.array_join(F.transform(F.split(value, ""), one), "")
    return F.when(value.rlike("[A-F]"), F.upper(out)).otherwise(out)


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10 of a string of digits."""
    values = F.transform(F.reverse(F.split(digits, "")), lambda c, i: c.cast("int") * (1 + i % 2))
    return F.aggregate(values, F.lit(0), lambda s, v: s + F.when(v > 9, v - 9).otherwise(v)) % 10


def _number(value: Column, seed: Column, more: int) -> Column:
    """Digits anew, and ``more`` of them; the last one keeps a valid check digit valid and an invalid one invalid."""
    body = F.concat(F.substring(_scrambled(value, seed), F.lit(1), (F.length(value) - 1).cast("int")), _digits(seed, more))
    check = (10 - _luhn(F.concat(body, F.lit("0")))) % 10
    off = F.when(_luhn(value) == 0, 0).otherwise(1 + _byte(seed, F.lit(95)) % 9)
    return F.concat(body, ((check + off) % 10).cast("int").cast("string"))


def _name(kind: Column, seed: Column, attempt: int) -> Column:
    """A generated name of the script, with an ending of the gender; later attempts are longer."""
    out = F.lit(None).cast("string")
    for script, syllables in SYLLABLES.items():
        own = F.array(*map(F.lit, syllables))
        body = [F.element_at(own, _byte(seed, F.lit(k)) % len(syllables) + 1) for k in range(3 + attempt)]
        for gender, end in ENDINGS[script].items():
            out = F.when(kind == f"name {script} {gender}", F.concat(*body, F.lit(end))).otherwise(out)
    return out


def surrogate(kind: Column, entity: Column, key: str, attempt: int) -> Column:
    """The keyed surrogate of an entity, in the same normal form as the entity.

    From the third attempt on it is longer by one more character each time, so there is room for any number of entities.
    IPv4 addresses can't be longer and get the later form of addresses instead.
    """
    seed = F.sha2(F.concat_ws("|", F.lit(key), kind, entity, F.lit(str(attempt))), 256)
    # bound to a variable, so that it is not worked out again for every character
    return F.transform(F.array(seed), lambda own: _surrogate(kind, entity, own, attempt))[0]


def _surrogate(kind: Column, entity: Column, seed: Column, attempt: int) -> Column:
    more = max(0, attempt - 1)
    host = F.substring_index(entity, "@", -1)
    local = F.substring(entity, F.lit(1), (F.length(entity) - F.length(host) - 1).cast("int"))
    labels = F.regexp_replace(host, r"\.[^.]*$", "")
    # the name ends in a reserved top level, so no real mailbox is hit
    email = F.concat(_scrambled(local, seed, more), F.lit("@"), _scrambled(labels, F.concat(seed, F.lit("h"))), F.lit(".example"))
    octets = F.concat_ws(".", *((_byte(seed, F.lit(k)) % 254 + 1).cast("string") for k in range(4)))
    groups = F.concat_ws(":", *(F.substring(seed, 4 * k + 1, 4) for k in range(8)))
    first = F.substring(entity, 1, 1)
    phone = F.concat(first, _scrambled(F.substring(entity, F.lit(2), F.length(entity)), seed), _digits(seed, more))
    is_hex = entity.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")
    secret = F.when(is_hex, F.concat(_hex(entity, seed), _digits(seed, more))).otherwise(_scrambled(entity, seed, more))
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", octets if attempt < 8 else groups)
        .when(kind == "ip6", _hex(entity, seed) if attempt < 2 else groups)
        .when(kind == "phone", phone)
        .when(kind == "number", _number(entity, seed, more))
        .when(kind == "secret", secret)
        .otherwise(_name(kind, seed, attempt))
    )


def assign(entities: DataFrame, key: str) -> DataFrame:
    """``kind, entity, surrogate`` for distinct entities; no two of a kind share one, and none is an entity.

    Attempts go on while any entity is without a surrogate: of those with an equal candidate the
    smallest entity has it, the others try again with the next number.
    """
    pending, taken = entities, []
    attempt = 0
    while True:
        tried = pending.withColumn("surrogate", surrogate(F.col("kind"), F.col("entity"), key, attempt))
        real = entities.select("kind", F.col("entity").alias("surrogate"))
        free = tried.join(real, ["kind", "surrogate"], "left_anti")
        for earlier in taken:
            free = free.join(earlier.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        won = stored(free.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity")), "surrogates")
        taken.append(won)
        left = stored(pending.join(won, ["kind", "entity"], "left_anti"), "pending")
        if left.isEmpty():
            return reduce(DataFrame.unionByName, taken).select("kind", "entity", "surrogate")
        pending, attempt = left, attempt + 1


def _rendered() -> Column:
    """A surrogate in the form of its mention: case, and separators between digits."""
    part, new = F.col("part"), F.col("surrogate")
    n = F.length(F.regexp_replace(part, r"\D", ""))
    spread = F.array_join(
        F.transform(
            F.split(part, ""),
            lambda c, i: F.when(
                c.rlike("[0-9]"),
                F.substring(new, F.length(F.regexp_replace(F.substring(part, F.lit(1), i + 1), r"\D", "")), F.lit(1)),
            ).otherwise(c),
        ),
        "",
    )
    spread = F.concat(spread, F.substring(new, n + 1, F.length(new)))
    cased = F.array_join(F.zip_with(F.split(new, ""), F.split(part, ""), lambda c, own: F.when(own.rlike(r"\p{Lu}"), F.upper(c)).otherwise(c)), "")
    upper = (F.upper(part) == part) & (F.lower(part) != part) & (F.length("part") > 1)
    shown = (
        F.when(F.col("kind").isin("phone", "number"), spread)
        .when(F.col("kind") == "secret", new)
        .when(upper, F.upper(new))
        .when(F.col("kind").startswith("name"), F.initcap(new))
        .otherwise(cased)
    )
    return F.concat("lead", shown, "tail")


def replace_private(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with every mention in ``text`` replaced, and ``n_entities``, the number of mentions.

    Types are secrets after a key word, e-mail, IPv4 and IPv6 addresses, phone numbers, numbers of 13 to 19
    digits, and names. Null and empty texts and texts without a mention stay as they are,
    as do all rows and columns, whatever their names; a column named ``n_entities`` is replaced. Mentions that differ in
    case or separators alone are one entity, but for secrets, where case counts. A surrogate has the script and case of each
    letter it stands for. The key decides the surrogates; keep it secret. An empty table gives an empty one.

    In a text that has a name, by a title or as two neighbouring words that some text of the corpus writes after a
    title, all capitalised words equal to a part of it are replaced by the same surrogate, with a title or without.

    The pattern runs once over the texts, which are written with their mentions. Only texts with mentions or
    such names are joined with their replacements, on a hash of the text, so copies are treated once.
    """
    # the caller's columns travel in one, so their names are free
    columns = [c for c in docs.columns if c not in ("n_entities", "text")]
    row = F.struct(*(F.col(f"`{c}`") for c in columns)) if columns else F.struct(F.lit(0))
    hashed = [F.xxhash64("text").alias("__h1"), F.xxhash64("text", F.lit(1)).alias("__h2")]
    hashes = ["__h1", "__h2"]
    rows = docs.select(row.alias("__row"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("__found", mentions(F.col("text"))).withColumn("__pairs", _pairs(F.col("text")))
    rows = stored(rows.select("*", *hashed), "mentions")
    found, clean = rows.where(F.size("__found") > 0), rows.where(F.size("__found") == 0)
    distinct = found.select(F.explode("__found").alias("mention")).distinct()
    pieces = stored(_told_gender(stored(parts(distinct), "parts")), "parts")
    known = assign(stored(pieces.select("kind", "entity").distinct(), "entities"), key)
    shown = pieces.join(known, ["kind", "entity"]).select("mention", F.struct("place", _rendered().alias("new")).alias("piece"))
    new = F.array_join(F.transform(F.array_sort(F.collect_list("piece")), lambda p: p["new"]), "")
    replaced = stored(shown.groupBy("mention").agg(new.alias("new")), "replacements")  # a mention has three parts at most
    names = _names_of_texts(rows, pieces, known)
    places = found.select(*hashes, F.posexplode("__found").alias("place", "mention")).distinct().join(replaced, "mention")
    of_text = places.groupBy(*hashes).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "new"))), lambda p: p["new"]).alias("__new"))
    of_text = of_text.join(names, hashes, "full")
    named = stored(clean.where(F.size("__pairs") > 0).select(*hashes).distinct().join(names.select(*hashes), hashes, "left_semi"), "named")
    if named.count() <= BROADCAST_ROWS:
        named = F.broadcast(named)
    private = found.unionByName(clean.where(F.size("__pairs") > 0).join(named, hashes, "left_semi").select(*rows.columns))
    clean = clean.join(named, hashes, "left_anti")
    gaps, own = F.split("text", PATTERN, -1), F.col("__names")
    shown_gaps = F.when(own.isNull(), gaps).otherwise(F.transform(gaps, lambda g: _without_bare_names(g, own)))
    text = F.array_join(F.flatten(F.zip_with(shown_gaps, F.coalesce("__new", F.array().cast("array<string>")), lambda g, n: F.array(g, F.coalesce(n, F.lit(""))))), "")
    bare = F.when(own.isNull(), 0).otherwise(F.aggregate(F.transform(gaps, lambda g: _bare_names(g, own)), F.lit(0), lambda a, b: a + b))
    n = F.size("__found").cast("long")
    private = private.join(of_text, hashes).withColumn("n_entities", n + bare).withColumn("text", text)
    out = clean.withColumn("n_entities", n).select("__row", "text", "n_entities").unionByName(private.select("__row", "text", "n_entities"))
    own = [F.col("text") if c == "text" else F.col(f"__row.`{c}`") for c in docs.columns if c != "n_entities"]
    return out.select(*own, "n_entities")
