"""DuckDB text shared by the SQL checks.

The checks restate the semantics in plain SQL. RE2 has no look-around, so word
boundaries are spelled as captured neighbours or as ASCII ``\\b``.
"""

from __future__ import annotations

from docsift.functions import text as T
from docsift.operators.lemmas import NOUN_RULES

BLANK = r"\s\x0b\x1c-\x1f\x{85}\pZ"
WORD = r"\p{L}\p{N}_"


def quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def in_list(values) -> str:
    return ", ".join(quote(v) for v in values)


def regex(expr: str, pattern: str, by: str = " ", flags: str = "g") -> str:
    return f"regexp_replace({expr}, {quote(pattern)}, {quote(by)}, '{flags}')"


EMAIL = r"\b[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}\b"
EMAIL_MASKED = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
PHONE = (
    rf"\b(?:\+?\p{{Nd}}{{1,3}}[{BLANK}.\-]?)?(?:\(?\p{{Nd}}{{2,4}}\)?[{BLANK}.\-]?)?"
    rf"\p{{Nd}}{{3,4}}[{BLANK}.\-]?\p{{Nd}}{{4}}\b"
)


def without_urls(x: str) -> str:
    return regex(x, rf"https?://[^{BLANK}]+|www\.[^{BLANK}]+")


def without_emails(x: str) -> str:
    return regex(x, EMAIL)


def without_phones(x: str) -> str:
    return regex(x, PHONE)


def without_social(x: str) -> str:
    return regex(regex(regex(x, r"\b(?:RT|cc)\b"), rf"@[^{BLANK}]+"), rf"#[^{BLANK}]+")


def non_words_blank(x: str) -> str:
    return regex(x, rf"[^{WORD}{BLANK}]")


def words(x: str) -> str:
    return f"regexp_extract_all({x}, '[^{BLANK}]+')"


def stripped(x: str) -> str:
    return regex(x, rf"^[{BLANK}]+|[{BLANK}]+$", "")


def masked(x: str) -> str:
    return regex(regex(x, EMAIL_MASKED, T.EMAIL_TAG), PHONE, T.PHONE_TAG)


def decomposed(x: str) -> str:
    """Accented letters as base letter and one combining mark."""
    return (
        f"array_to_string(list_transform(string_split({x}, ''), lambda c: "
        "CASE WHEN strip_accents(c) <> c THEN strip_accents(c) || chr(769) ELSE c END), '')"
    )


def protected(x: str) -> str:
    """Two rounds per term, because neighbours share a separator."""
    for written, placeholder, _ in T.TECH_TERMS:
        body = "".join("\\" + ch if ch in ".+#/-" else ch for ch in written)
        pattern = rf"(^|[^{WORD}]){body}([^{WORD}]|$)"
        for _ in range(2):
            x = regex(x, pattern, rf"\1 {placeholder} \2", "gi")
    return x


def restored(x: str) -> str:
    for _, placeholder, display in T.TECH_TERMS:
        x = f"replace({x}, {quote(placeholder.lower())}, {quote(display)})"
    return x


def kept_tokens(x: str) -> str:
    """Token list of lower-cased text without short tokens and stop words."""
    plain = (
        f"list_transform({words(x)}, lambda k: CASE WHEN k IN ({in_list(T.PROTECTED)}) THEN k "
        f"ELSE trim(k, {quote(T.PUNCTUATION)}) END)"
    )
    return f"list_filter({plain}, lambda k: length(k) >= 2 AND k NOT IN ({in_list(T.STOP_WORDS)}))"


def prepared(x: str) -> str:
    return f"lower({non_words_blank(without_social(without_phones(without_emails(without_urls(x)))))})"


NORMAL = f"normal AS MATERIALIZED (SELECT *, {decomposed('text')} AS norm FROM documents)"
CLEAN = f"""{NORMAL},
token_lists AS MATERIALIZED (SELECT doc_id, lang, source, text, {kept_tokens(prepared('norm'))} AS tokens FROM normal),
clean AS MATERIALIZED (SELECT *, array_to_string(tokens, ' ') AS clean, length(text) AS raw_chars,
  len({words('text')}) AS raw_words, length(array_to_string(tokens, ' ')) AS clean_chars, len(tokens) AS clean_words
  FROM token_lists)"""


def _stems(token: str) -> str:
    cases = [
        f"CASE WHEN {token} LIKE '%{s}' AND length({token}) > {len(s)} THEN left({token}, -{len(s)}) || {quote(e)} END"
        for s, e in NOUN_RULES
    ]
    return f"list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL)"


def lemmas(rows: str) -> str:
    """``lemmas(token, lemma)``; the distinct tokens of ``rows`` are the lexicon."""
    return f"""lemma_words AS MATERIALIZED (SELECT DISTINCT unnest(tokens) AS token FROM {rows}),
lemma_forms AS (SELECT token, unnest(list_concat([token], {_stems('token')})) AS form FROM lemma_words
  WHERE token NOT IN ({in_list(T.PROTECTED)})),
lemmas AS MATERIALIZED (SELECT token, arg_min(form, (length(form), form)) AS lemma FROM lemma_forms
  WHERE form IN (SELECT token FROM lemma_words) GROUP BY token)"""


#: The clean corpus with lemmas in place of tokens, to stand where ``CLEAN`` stands.
LEMMA_CLEAN = f"""{CLEAN.replace("clean AS MATERIALIZED", "plain AS MATERIALIZED")},
{lemmas('plain')},
lemma_lists AS MATERIALIZED (SELECT doc_id, list(coalesce(lemma, token) ORDER BY pos) AS found FROM (
  SELECT doc_id, unnest(tokens) AS token, unnest(generate_series(1, len(tokens))) AS pos FROM plain)
  LEFT JOIN lemmas USING (token) GROUP BY doc_id),
clean AS MATERIALIZED (SELECT doc_id, lang, source, text, coalesce(found, tokens) AS tokens,
  array_to_string(coalesce(found, tokens), ' ') AS clean, raw_chars, raw_words,
  length(array_to_string(coalesce(found, tokens), ' ')) AS clean_chars, clean_words
  FROM plain LEFT JOIN lemma_lists USING (doc_id))"""
USABLE = f"""{CLEAN},
usable AS MATERIALIZED (SELECT * FROM clean WHERE length({stripped('clean')}) > 10)"""


def ranked(rows: str, category: str, row_id: str = "doc_id") -> str:
    return f"""ranked AS (SELECT {row_id}, {category} AS category,
  row_number() OVER (PARTITION BY {category} ORDER BY md5('42:' || {row_id}), {row_id}) AS place,
  count(*) OVER (PARTITION BY {category}) AS class_rows FROM {rows}),
split AS MATERIALIZED (SELECT {row_id}, category, place <= round(0.2 * class_rows) AS is_test,
  CAST((place - 1) % 5 AS INTEGER) AS fold FROM ranked)"""


def gram_counts(source: str = "usable", text: str = "clean", extra: str = "lang AS category") -> str:
    return f"""term_lists AS (SELECT doc_id, {extra}, regexp_extract_all({text}, '[{WORD}]{{2,}}') AS t FROM {source}),
counts AS MATERIALIZED (SELECT doc_id, category, term, count(*) AS n FROM (
  SELECT doc_id, category, unnest(list_concat(t, list_transform(generate_series(1, len(t) - 1),
    lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM term_lists) GROUP BY ALL)"""


def vocabulary(rows: str, where: str, features: int = 30_000, min_df: int = 2, max_df: float = 0.95) -> str:
    """Terms of the documents in ``rows`` that satisfy ``where``."""
    return f"""fit_docs AS MATERIALIZED (SELECT doc_id, category FROM {rows} WHERE {where}),
fit_counts AS MATERIALIZED (SELECT c.* FROM counts c JOIN fit_docs USING (doc_id)),
vocab AS MATERIALIZED (SELECT term, df, row_number() OVER (ORDER BY term) - 1 AS idx,
  ln((1.0 + (SELECT count(*) FROM fit_docs)) / (1.0 + df)) + 1.0 AS idf FROM (
  SELECT term, count(*) AS df, sum(n) AS tf FROM fit_counts GROUP BY term
  HAVING count(*) >= {min_df} AND count(*) <= {max_df} * (SELECT count(*) FROM fit_docs)
  ORDER BY tf DESC, term LIMIT {features}))"""


WEIGHTS = """raw_weights AS MATERIALIZED (SELECT doc_id, category, term, idx, (1.0 + ln(n)) * idf AS raw
  FROM counts JOIN vocab USING (term)),
weights AS MATERIALIZED (SELECT doc_id, category, term, idx,
  raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM raw_weights)"""


def bayes(alpha: float = 0.1, all_docs: str = "split") -> str:
    """Naive Bayes fit on ``fit_docs``; ``joint`` scores every document."""
    return f"""classes AS (SELECT category AS k, count(*) AS n_docs FROM fit_docs GROUP BY category),
sums AS (SELECT term, w.category AS k, sum(weight) AS s FROM weights w JOIN fit_docs USING (doc_id) GROUP BY ALL),
totals AS (SELECT classes.k, coalesce(sum(s), 0) + {alpha} * (SELECT count(*) FROM vocab) AS total
  FROM classes LEFT JOIN sums ON sums.k = classes.k GROUP BY classes.k),
logp AS MATERIALIZED (SELECT vocab.term, classes.k, ln(coalesce(s, 0) + {alpha}) - ln(total) AS lp
  FROM vocab CROSS JOIN classes JOIN totals ON totals.k = classes.k
  LEFT JOIN sums ON sums.term = vocab.term AND sums.k = classes.k),
joint AS MATERIALIZED (SELECT d.doc_id, d.category AS y_true, c.k,
  ln(c.n_docs / (SELECT count(*) FROM fit_docs)) + coalesce(x.s, 0) AS joint
  FROM {all_docs} d CROSS JOIN classes c LEFT JOIN (
    SELECT doc_id, k, sum(weight * lp) AS s FROM weights JOIN logp USING (term) GROUP BY ALL) x
  ON x.doc_id = d.doc_id AND x.k = c.k),
bayes_scores AS MATERIALIZED (SELECT doc_id, y_true, k,
  exp(joint - max(joint) OVER (PARTITION BY doc_id)) AS e FROM joint),
bayes AS MATERIALIZED (SELECT doc_id, y_true, arg_max(k, (e, -rank_k)) AS y_pred, max(e) / sum(e) AS confidence
  FROM (SELECT *, rank() OVER (PARTITION BY doc_id ORDER BY k) AS rank_k FROM bayes_scores) GROUP BY doc_id, y_true)"""


BAYES = ",\n".join(
    [USABLE, ranked("usable", "lang"), gram_counts(), vocabulary("split", "NOT is_test"), WEIGHTS, bayes()]
)


def centroid(rows: str, row_id: str, category: str) -> str:
    """Nearest centroid of all ``rows``, fit on those outside the test part of ``split``;
    ``near_scores`` is one row per class, ``near_test`` holds the test part."""
    return f"""parts AS (SELECT {category} AS k, unnest(generate_series(1, len(embedding))) AS i,
  unnest(embedding)::DOUBLE AS x FROM {rows} WHERE {row_id} NOT IN (SELECT {row_id} FROM split WHERE is_test)),
means AS (SELECT k, i, avg(x) AS x FROM parts GROUP BY k, i),
model AS MATERIALIZED (SELECT k, list(x ORDER BY i) AS c FROM means GROUP BY k),
margins AS MATERIALIZED (SELECT {row_id}, {category} AS y_true, k,
  list_cosine_similarity(embedding::DOUBLE[], c) AS m FROM {rows} CROSS JOIN model),
scaled AS (SELECT *, exp(2.0 * (m - avg(m) OVER w) / (stddev_pop(m) OVER w + 1e-6)) AS e
  FROM margins WINDOW w AS (PARTITION BY {row_id})),
near_scores AS MATERIALIZED (SELECT {row_id}, y_true, k, m, e / sum(e) OVER (PARTITION BY {row_id}) AS score FROM scaled),
near AS MATERIALIZED (SELECT {row_id}, y_true, arg_max(k, (m, -rank_k)) AS y_pred, max(score) AS confidence
  FROM (SELECT *, rank() OVER (PARTITION BY {row_id} ORDER BY k) AS rank_k FROM near_scores) GROUP BY {row_id}, y_true),
near_test AS (SELECT near.* FROM near JOIN split USING ({row_id}) WHERE is_test)"""


VECTORS = "doc_vectors AS MATERIALIZED (SELECT d.doc_id, d.lang AS category, e.embedding FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id)"
#: After a ``split`` of the documents.
NEAR_LANG = f"{VECTORS},\n{centroid('doc_vectors', 'doc_id', 'category')}"
NEAR_LABEL = ranked("embeddings", "label", "vec_id") + ",\n" + centroid("embeddings", "vec_id", "label")


def class_metrics(rows: str, name: str = "per_class") -> str:
    return f"""{name} AS (SELECT class, sum(t) AS support, sum(p) AS predicted, sum(h) AS hits,
  CASE WHEN sum(p) > 0 THEN sum(h) / sum(p) ELSE 0.0 END AS precision,
  CASE WHEN sum(t) > 0 THEN sum(h) / sum(t) ELSE 0.0 END AS recall,
  2.0 * sum(h) / (sum(t) + sum(p)) AS f1 FROM (
  SELECT y_true AS class, 1 AS t, 0 AS p, CASE WHEN y_true = y_pred THEN 1 ELSE 0 END AS h FROM {rows}
  UNION ALL SELECT y_pred, 0, 1, 0 FROM {rows}) GROUP BY class)"""


def averages(per_class: str = "per_class") -> str:
    return f"""SELECT sum(hits) / sum(support) AS accuracy, avg(precision) AS precision_macro,
  sum(precision * support) / sum(support) AS precision_weighted, avg(recall) AS recall_macro,
  sum(recall * support) / sum(support) AS recall_weighted, avg(f1) AS f1_macro,
  sum(f1 * support) / sum(support) AS f1_weighted, CAST(sum(support) AS BIGINT) AS num_test_samples FROM {per_class}"""
