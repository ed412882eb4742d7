"""Language of web pages by Bayesian fusion of evidence.

The text gives likelihoods under a model per language. The language declared in the markup and the
suffix of the address are further evidence, whose meaning is learned from all pages:
how often pages of a language, as their texts tell, have it. Hosts give priors, smoothed towards
those of their domain and of all pages. All counts are grouped aggregations.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vendue.llm.common import raw_bytes, small_batches, stored
from vendue.llm.url_rules import host_and_path

#: Labelled texts per language that the model is fitted on: those with the smallest hashes of their ids.
TRAIN_ROWS = 1_000
BUCKETS = 1 << 15
#: A text of more trigrams than this counts as if it had so many, as neighbours depend on each other.
FULL_WEIGHT = 200

#: Pages that the wider level counts as when a narrower one is smoothed.
SMOOTH_HOST, SMOOTH_DOMAIN, SMOOTH_ALL = 5.0, 20.0, 1.0
#: Pages without information that are added to each kind of evidence.
SMOOTH_EVIDENCE = 2.0

UNIT = 1_000_000  # soft counts are whole millionths, so sums don't depend on their order

_HIDDEN = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->")
_TAG = re.compile(r"<[^<>]*>")
_LANG = re.compile(r"""(?is)<html\b[^<>]*?\blang\s*=\s*["']?([a-z]+)""")


def visible_text(page: str | None) -> str:
    """Text outside of tags, comments, scripts and styles."""
    return html.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", page or "")))


def declared(page: str | None) -> str | None:
    """Primary subtag of the ``lang`` of the html tag, if it has two or three letters."""
    found = _LANG.search(page or "")
    tag = found[1].lower() if found else ""
    return tag if len(tag) in (2, 3) else None


def trigrams(text: str) -> np.ndarray:
    """Bucket numbers of the byte trigrams of a whole text, lower-cased, runs of other than letters as one space."""
    clean = re.sub(r"[\W\d_]+", " ", text.lower()).strip()
    data = np.frombuffer(raw_bytes(f" {clean} "), np.uint8).astype(np.uint32) if clean else np.empty(0, np.uint32)
    if len(data) < 3:
        return np.empty(0, np.int64)
    code = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


class TextModel:
    """Naive Bayes over byte trigrams."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smoothed = counts + 0.5
        self.scores = np.log(smoothed / smoothed.sum(axis=1, keepdims=True))

    def log_likelihoods(self, text: str) -> np.ndarray:
        """Log-likelihoods of a whole text, the best one 0; all are 0 without letters."""
        grams = trigrams(text)
        if not len(grams) or not self.languages:
            return np.zeros(len(self.languages))
        n = np.bincount(grams, minlength=BUCKETS)
        at = np.flatnonzero(n)
        sums = self.scores[:, at] @ n[at] * min(1.0, FULL_WEIGHT / len(grams))
        return sums - sums.max()


def fit_text_model(docs: DataFrame, language: str = "lang", train_rows: int = TRAIN_ROWS) -> TextModel:
    """A model from ``doc_id, text`` and a column of languages; rows without a language or id are left out.

    At most ``train_rows`` texts per language are used. What comes to the driver is ``BUCKETS`` counts a language.
    """
    from pyspark.sql import Window

    order = Window.partitionBy("language").orderBy("h")
    ids = docs.where(F.col(language).isNotNull() & F.col("doc_id").isNotNull())
    ids = ids.select(F.col(language).alias("language"), "doc_id", F.xxhash64("doc_id").alias("h"))
    ids = ids.withColumn("k", F.row_number().over(order)).where(F.col("k") <= train_rows).select("doc_id", "language")
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("language", "text")

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for part in parts:
            for language, text in zip(part["language"], part["text"], strict=True):
                own = sums.setdefault(language, np.zeros(BUCKETS, np.int64))
                own += np.bincount(trigrams(text or ""), minlength=BUCKETS)
        for language, own in sums.items():
            at = np.flatnonzero(own)
            yield pd.DataFrame({"language": language, "bucket": at, "n": own[at]})

    found = texts.mapInPandas(count, "language string, bucket long, n long").groupBy("language", "bucket").agg(F.sum("n").alias("n"))
    rows = found.toPandas()
    languages = sorted(rows["language"].unique())
    counts = np.zeros((len(languages), BUCKETS))
    for i, name in enumerate(languages):
        own = rows[rows["language"] == name]
        counts[i, own["bucket"]] = own["n"]
    return TextModel(languages, counts)


def evidence(pages: DataFrame, model: TextModel) -> DataFrame:
    """``page_id, host, domain, suffix, declared, logs`` of every row: what each page itself tells."""

    def read(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = [(declared(p), model.log_likelihoods(visible_text(p))) for p in part]
            yield pd.DataFrame(rows, columns=["declared", "logs"])

    small_batches(pages.sparkSession)
    host = host_and_path(F.col("url"))[0]
    own = F.pandas_udf(read, "declared string, logs array<double>")("html")
    rows = pages.select("page_id", F.regexp_replace(host, r"^.*@|:\d*$", "").alias("host"), own.alias("own"))
    labels = F.split("host", r"\.")
    return rows.select(
        "page_id", "host", F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), F.lit(2)), ".").alias("domain"),
        F.element_at(labels, -1).alias("suffix"), F.coalesce("own.declared", F.lit("")).alias("declared"), "own.logs",
    )


def _sums(rows: DataFrame, keys: list[str], n: int, name: str) -> DataFrame:
    total = F.array(*(F.sum(F.col("soft")[i]) for i in range(n)))
    return rows.groupBy(*keys).agg(total.alias(name))


def identify(pages: DataFrame, model: TextModel) -> DataFrame:
    """``page_id, host, declared, lang, probability`` of every row of ``pages`` (``page_id, url, html``).

    The whole visible text counts. A null or empty page has no text and no declaration, a null url an
    empty host; what is missing says nothing but how common that is. Equal probabilities go to
    the language first in order; a model without languages leaves language and probability null. Null ids and repeated rows stay, other columns are not carried. A page
    doesn't count for the prior of its own host and domain.
    """
    n = len(model.languages)
    if not n:
        own = evidence(pages, model).select("page_id", "host", "declared")
        return own.withColumns({"lang": F.lit(None).cast("string"), "probability": F.lit(None).cast("double")})
    names = F.array(*map(F.lit, model.languages))
    rows = stored(evidence(pages, model), "evidence")
    total = F.aggregate("logs", F.lit(0.0), lambda s, x: s + F.exp(x))
    rows = rows.withColumn("soft", F.transform("logs", lambda x: F.floor(F.exp(x) / total * UNIT)))
    everywhere = _sums(rows, [], n, "all").first()["all"] if n else []
    everywhere = [x or 0 for x in everywhere]
    joined = rows
    for name, keys in (("of_host", ["host"]), ("of_domain", ["domain"]), ("of_suffix", ["suffix"]), ("of_declared", ["declared"])):
        joined = joined.join(_sums(rows, keys, n, name), keys)

    def score(i: int) -> Column:
        soft, whole = F.col("soft")[i], F.aggregate("soft", F.lit(0).cast("long"), lambda s, x: s + x)

        def less_own(name: str) -> tuple[Column, Column]:
            sums = F.aggregate(name, F.lit(0).cast("long"), lambda s, x: s + x)
            return (F.col(name)[i] - soft) / UNIT, (sums - whole) / UNIT

        p_all = (everywhere[i] / UNIT + SMOOTH_ALL) / (sum(everywhere) / UNIT + SMOOTH_ALL * n)
        own, pages_of = less_own("of_domain")
        p_domain = (own + SMOOTH_DOMAIN * p_all) / (pages_of + SMOOTH_DOMAIN)
        own, pages_of = less_own("of_host")
        p_host = (own + SMOOTH_HOST * p_domain) / (pages_of + SMOOTH_HOST)
        out = F.col("logs")[i] + F.log(p_host)
        for name in ("of_suffix", "of_declared"):
            # how much likelier the evidence is among pages of this language than among all
            own, pages_of = less_own(name)
            share = (own + SMOOTH_EVIDENCE * p_all) / (pages_of + SMOOTH_EVIDENCE)
            out = out + F.log(share / p_all)
        return out

    scored = joined.withColumn("scores", F.array(*(score(i) for i in range(n))))
    best = F.array_max("scores")
    weights = F.aggregate("scores", F.lit(0.0), lambda s, x: s + F.exp(x - best))
    return scored.select(
        "page_id", "host", "declared", F.element_at(names, F.array_position("scores", best).cast("int")).alias("lang"),
        F.round(1 / weights, 6).alias("probability"),
    )
