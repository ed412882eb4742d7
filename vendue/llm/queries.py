"""Registered queries of the text operators and, where there is one, the same query in SQL.

Every query applies its operator with production parameters to whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vendue.llm import (
    best_fit_packing,
    collocations,
    decontaminate,
    hamming_join,
    language_evidence,
    line_frequency,
    one_permutation,
    quality_cascade,
    surrogates,
    toxicity,
    url_rules,
    warc,
    whitening,
)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_frequency.drop_boilerplate(docs)


def op5_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cascade.measure(table(spark, sf_dir, "documents"))


# Rules as host, path and verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), url_rules.rules_frame(spark, URL_RULES))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url")


def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace_private(table(spark, sf_dir, "documents").select("doc_id", "text"), key="registered query")


def op7_hamming_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_join.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2)


def op8_language_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language_evidence.fit_text_model(table(spark, sf_dir, "documents"))
    return language_evidence.identify(table(spark, sf_dir, "pages"), model)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_one_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_permutation.compare_with_next(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_url_rules,
        op2_toxicity,
        op3_warc,
        op4_line_frequency,
        op5_quality_cascade,
        op6_surrogates,
        op7_hamming_join,
        op8_language_evidence,
        op9_best_fit_packing,
        op10_decontaminate,
        op11_one_permutation,
        op12_whitening,
        op13_collocations,
    )
}

SQL: dict[str, str] = {
    "op1_url_rules": """
WITH p AS (SELECT row_number() OVER () AS r, page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT r, page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
u(rh, rp, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
f AS (SELECT r, rh || rp AS rule, v, row_number() OVER (PARTITION BY r ORDER BY length(rh || rp) DESC) AS k
      FROM h JOIN u ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM h LEFT JOIN f ON h.r = f.r AND k = 1
""",
    "op4_line_frequency": """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
l AS (SELECT r, source, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d WHERE text IS NOT NULL),
u AS (SELECT source, text, min(r) AS r FROM d GROUP BY source, text),
t AS (SELECT source, count(*) AS pages FROM u GROUP BY source),
b AS (SELECT source, line FROM (SELECT DISTINCT r, l.source, line FROM l JOIN u USING (r)) JOIN t USING (source)
      WHERE trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''
      GROUP BY source, line, pages HAVING count(*) >= 5 AND count(*) > 0.1 * pages),
k AS (SELECT l.r, string_agg(l.line, chr(10) ORDER BY i) FILTER (WHERE b.source IS NULL) AS text,
        count(b.source) AS n_dropped
      FROM l LEFT JOIN b ON l.source = b.source AND l.line = b.line GROUP BY l.r)
SELECT doc_id, d.source, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
  coalesce(n_dropped, 0) AS n_dropped
FROM d LEFT JOIN k ON d.r = k.r
""",
    "op5_quality_cascade": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word,
        generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) AS i FROM d),
g AS (SELECT r, i, word, lead(word) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
c AS (SELECT r, i, count(*) OVER (PARTITION BY r, word, w2, w3) AS n FROM g WHERE w3 IS NOT NULL),
m AS (SELECT DISTINCT r, i + k AS i FROM c, (VALUES (0), (1), (2)) AS v(k) WHERE n > 1),
p AS (SELECT r, count(*) AS n_repeat_words FROM m GROUP BY r),
n AS (SELECT r, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars FROM w GROUP BY r),
u AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
l AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM u
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
a AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        length(text) - length(replace(text, '!', '')) AS n_bangs,
        coalesce(n_dup_lines, 0) AS n_dup_lines, 1 + length(text) - length(replace(text, chr(10), '')) AS n_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM d LEFT JOIN n USING (r) LEFT JOIN l USING (r) LEFT JOIN p USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * n_symbols <= 30 * n_words AND 100 * n_bangs <= 50 * n_words
    AND word_chars <= 25 * n_words AND 100 * n_dup_lines <= 50 * n_lines AS kept
FROM b
""",
    "op7_hamming_join": r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[i] || ' ' || coalesce(w[i + 1], '') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pr AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM pr JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 80 * (x.n + y.n - m)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
""",
    "op10_decontaminate": r"""
WITH iw AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS gram
        FROM (SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
              FROM iw WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM win),
dw AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
g AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS gram
      FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, ks WHERE len(w) >= k)),
h AS (SELECT g.r, g.i, g.k, win.item_id FROM g JOIN win ON g.k = win.k AND g.gram = win.gram),
n AS (SELECT r, count(DISTINCT i + o) AS n_hit FROM (SELECT r, i, unnest(range(0, k)) AS o FROM (SELECT DISTINCT r, i, k FROM h)) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
      FROM (SELECT DISTINCT r, item_id::VARCHAR AS item_id FROM h) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN n USING (r) LEFT JOIN t USING (r)
""",
    "op13_collocations": r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4), (5)) AS v(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase HAVING count(*) >= 100),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
x AS (SELECT lang, k, a, array_to_string(w[i:i + j - 1], ' ') AS phrase
      FROM (SELECT lang, k, a, w, j, unnest(range(1, k - j + 2)) AS i FROM c, (VALUES (2), (3), (4)) AS v(j) WHERE j < k)),
o AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.lang = c.lang AND x.phrase = c.phrase AND 100 * x.a >= 100 * c.a)),
u AS (SELECT lang, phrase, a, w, k, unnest(range(1, k)) AS j FROM o),
s AS (SELECT u.lang, u.phrase, j, a, h.f AS l, e.f AS r, n, (1000::HUGEINT * a * n) // (h.f::HUGEINT * e.f) AS score
      FROM u JOIN f h ON h.lang = u.lang AND h.phrase = array_to_string(w[1:j], ' ')
      JOIN f e ON e.lang = u.lang AND e.phrase = array_to_string(w[j + 1:], ' ') JOIN t ON t.lang = u.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM k WHERE rank <= 2000
""",
}
