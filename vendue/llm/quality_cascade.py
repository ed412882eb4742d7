"""Quality rules as a short-circuit cascade ordered by rejection per cost.

Every rule looks at measures of the whole text. Costs and rejection rates come from a bounded
sample; the order follows from them, the verdict does not depend on it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendue.llm.common import SPACES, raw_bytes, small_batches

SYMBOLS = "#*$%&|<>"

#: Rows of the sample on which costs and rejections are estimated, the smallest ids by hash.
SAMPLE_ROWS = 200


class Measures:
    """Measures of one text, each computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self._kept: dict[str, int] = {}

    def __getattr__(self, name: str) -> int:
        compute = MEASURES.get(name)
        if compute is None:
            raise AttributeError(name)
        if name not in self._kept:
            self._kept[name] = compute(self)
        return self._kept[name]


def _words(m: Measures) -> list[bytes]:
    return raw_bytes(m.text).split()


def _word_chars(m: Measures) -> int:
    return len(m.text) - sum(m.text.count(c) for c in SPACES)


def _dup_lines(m: Measures) -> int:
    lines = [line for line in raw_bytes(m.text).split(b"\n") if line.split(None, 1)]
    return len(lines) - len(set(lines))


def repeat_words(words: list[bytes], window: int = 3) -> int:
    """Words inside windows of consecutive words that the text has twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    codes, kinds = ids[:n], len(number)
    for k in range(1, window):
        codes = codes * len(number) + ids[k : n + k]
        kinds *= len(number)
        if k < window - 1 and kinds * len(number) >= 2**63:  # number the prefixes anew
            codes = np.unique(codes, return_inverse=True)[1]
            kinds = int(codes[codes.argmax()]) + 1
    _, at, counts = np.unique(codes, return_inverse=True, return_counts=True)
    many = counts[at] > 1
    covered = np.zeros(len(words), bool)
    for k in range(window):
        covered[k : n + k] |= many
    return int(covered.sum())


MEASURES: dict[str, Callable[[Measures], object]] = {
    "words": _words,
    "n_words": lambda m: len(m.words),
    "word_chars": _word_chars,
    "n_symbols": lambda m: sum(m.text.count(c) for c in SYMBOLS),
    "n_bangs": lambda m: m.text.count("!"),
    "n_dup_lines": _dup_lines,
    "n_lines": lambda m: 1 + m.text.count("\n"),
    "n_repeat_words": lambda m: repeat_words(m.words),
}


@dataclass(frozen=True)
class Rule:
    """``rejects`` tells from the measures whether a text goes; base rules make ``base_failed``."""

    name: str
    rejects: Callable[[Measures], bool]
    base: bool = False


def default_rules(
    min_words: int = 50,
    repeat_percent: int = 50,
    symbol_percent: int = 30,
    bang_percent: int = 50,
    max_word_chars: int = 25,
    dup_line_percent: int = 50,
) -> list[Rule]:
    """Rules on length, repetition, symbols, shouting, word length and repeated lines."""
    return [
        Rule("few words", lambda m: m.n_words < min_words, True),
        Rule("repeated words", lambda m: 100 * m.n_repeat_words > repeat_percent * m.n_words, True),
        Rule("symbols", lambda m: 100 * m.n_symbols > symbol_percent * m.n_words),
        Rule("exclamation marks", lambda m: 100 * m.n_bangs > bang_percent * m.n_words),
        Rule("long words", lambda m: m.word_chars > max_word_chars * m.n_words),
        Rule("repeated lines", lambda m: 100 * m.n_dup_lines > dup_line_percent * m.n_lines),
    ]


def order_rules(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejections per second on a sample of ``sample_rows`` texts.

    The sample is bounded by that parameter; it only moves work around. Every rule is timed
    from nothing on every text of the sample. Without rows the given order stays.
    """
    hashed = F.xxhash64("text")
    # hashes alone are sorted; no more texts than the sample has are sent to the driver
    last = docs.select(hashed.alias("h")).orderBy("h").limit(sample_rows).agg(F.max("h")).first()[0]
    if last is None:
        return rules
    texts = [r[0] for r in docs.where(hashed <= last).select("text").limit(sample_rows).collect()]
    gain = []
    for rule in rules:
        start = time.perf_counter()
        rejected = sum(rule.rejects(Measures(t)) for t in texts)
        gain.append((rejected + 0.5) / (time.perf_counter() - start + 1e-9))
    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: -gain[i])]


def first_rejection(text: str | None, ordered: list[Rule]) -> str | None:
    """The first rule of the cascade that rejects; later rules are not evaluated."""
    measures = Measures(text)
    return next((rule.name for rule in ordered if rule.rejects(measures)), None)


MEASURED = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"


def measure(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Measures and verdict of every row, one output row each, in one pass without a shuffle.

    Null and empty texts have no words and fail as too short. Null ids and repeated rows stay;
    other columns are not carried.
    """
    small_batches(docs.sparkSession)
    rules = rules or default_rules()
    ordered = order_rules(docs, rules)
    base = [r for r in ordered if r.base]
    rest = [r for r in ordered if not r.base]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            rows = []
            for text in part:
                m = Measures(text)
                failed = any(r.rejects(m) for r in base)
                rows.append((*(getattr(m, n) for n in names), failed, not failed and not any(r.rejects(m) for r in rest)))
            yield pd.DataFrame(rows, columns=[*names, "base_failed", "kept"])

    judged = F.pandas_udf(run, MEASURED.split(", ", 1)[1])
    return docs.select("doc_id", judged("text").alias("m")).select("doc_id", "m.*")


def keep_good(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """The rows that no rule rejects, columns as they are; the cascade stops at the first rejection."""
    small_batches(docs.sparkSession)
    ordered = order_rules(docs, rules or default_rules())

    @F.pandas_udf("boolean")
    def passes(text: pd.Series) -> pd.Series:
        return text.map(lambda t: first_rejection(t, ordered) is None).astype(bool)

    return docs.where(passes("text"))
