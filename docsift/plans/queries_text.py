"""Queries for sources, text functions and per-document work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.functions import text as T
from docsift.functions import validate as VA
from docsift.functions.arrays import ngrams, settle, top_terms
from docsift.operators import lemmas as LM
from docsift.operators import profile as P
from docsift.plans import sqltext as Q
from docsift.plans.registry import documents, query, rounded, table
from docsift.session import new_path
from docsift.sources import corpus as SC
from docsift.sources import files as SF
from docsift.sources import store as ST
from docsift.sources import synthetic as SY


def _md5(column) -> F.Column:
    return F.md5(column).alias("h")


@query("S1 S3", f"SELECT lang AS category, length(text) AS n_chars, md5(text) AS h FROM documents")
def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "csv")
    rows = documents(spark, sf, "lang", "text").select(F.col("lang").alias("Category"), F.col("text").alias("Resume"))
    ST.write_report_csv(rows, path)
    back = SC.read_corpus_csv(spark, path)
    return back.select(F.col("Category").alias("category"), F.length("Resume").alias("n_chars"), _md5(F.col("Resume")))


@query("S1 S3", "SELECT lang AS category, length(text) AS n_chars, md5(text) AS h FROM documents")
def large_csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Written as CSV and read by file blocks instead of whole files."""
    path = new_path(spark, "large-csv")
    rows = documents(spark, sf, "lang", "text").select(F.col("lang").alias("Category"), F.col("text").alias("Resume"))
    ST.write_report_csv(rows, path)
    back = SC.read_large_csv(spark, path)
    return back.select(F.col("Category").alias("category"), F.length("Resume").alias("n_chars"), _md5(F.col("Resume")))


@query("S2", "SELECT lang AS \"Category\", count(*) AS n FROM documents GROUP BY lang")
def guarded_corpus(spark: SparkSession, sf: str) -> DataFrame:
    rows = documents(spark, sf, "lang", "text").select(F.col("lang").alias("Category"), F.col("text").alias("Resume"))
    return SC.require_corpus(rows).groupBy("Category").agg(F.count(F.lit(1)).alias("n"))


@query(
    "S4 S5",
    "SELECT lang AS category, source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY lang, source",
)
def json_report_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    counts = documents(spark, sf, "lang", "source", "n_chars").groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars")
    )
    report = counts.select("lang", F.struct("source", F.struct("n", "chars").alias("counts")).alias("part"))
    path = new_path(spark, "report")
    ST.write_report_json(report, path)
    schema = "lang STRING, part STRUCT<source: STRING, counts: STRUCT<n: BIGINT, chars: BIGINT>>"
    back = ST.read_report_json(spark, path, schema)
    return back.select(F.col("lang").alias("category"), "part.source", "part.counts.n", "part.counts.chars")


def _as_files(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as file contents: French and German in Latin-1, the rest in UTF-8."""
    latin = F.col("lang").isin("fr", "de")
    content = F.when(latin, F.encode("text", "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    ending = F.when(F.col("lang") == "en", ".txt").when(F.col("lang") == "fr", ".md").when(F.col("lang") == "de", ".bin").otherwise(".PDF")
    name = F.concat(F.lit("doc"), F.col("doc_id").cast("string"), ending)
    return documents(spark, sf, "lang", "text").select(
        name.alias("filename"), F.concat(F.lit("/in/"), name).alias("path"), content.alias("content")
    )


_FILE_NAME = "'doc' || doc_id || CASE lang WHEN 'en' THEN '.txt' WHEN 'fr' THEN '.md' WHEN 'de' THEN '.bin' ELSE '.PDF' END"


@query(
    "S6",
    f"""SELECT {_FILE_NAME} AS filename, CASE WHEN lang <> 'es' THEN md5({Q.stripped('text')}) END AS h,
  CASE WHEN lang = 'es' THEN 'no handler for .pdf' END AS error FROM documents""",
)
def extracted_files(spark: SparkSession, sf: str) -> DataFrame:
    return SF.extract_text(_as_files(spark, sf)).select("filename", _md5(F.col("text")), "error")


@query("S7", f"SELECT {_FILE_NAME} AS filename, md5({Q.stripped('text')}) AS h FROM documents")
def decoded_text(spark: SparkSession, sf: str) -> DataFrame:
    return _as_files(spark, sf).select("filename", _md5(SF.decode_text(F.col("content"))))


@query("S10")
def artifact_size(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ST.artifact_size(spark, f"{sf}/documents.parquet"), "size_mb")


def _catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """Brands as categories; their part names are the skills."""
    return (
        table(spark, sf, "part")
        .groupBy(F.col("p_brand").alias("name"))
        .agg(F.array_sort(F.collect_set("p_name")).alias("skills"))
        .select("name", F.concat(F.lit("Parts of "), "name").alias("description"), "skills")
    )


@query("S11", "SELECT p_brand AS category, CAST(50 AS BIGINT) AS n FROM part GROUP BY p_brand")
def synthetic_rows_per_category(spark: SparkSession, sf: str) -> DataFrame:
    rows = SY.synthetic_corpus(_catalogue(spark, sf))
    return rows.filter(F.length("text") > 100).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query("S11")
def synthetic_corpus(spark: SparkSession, sf: str) -> DataFrame:
    return SY.synthetic_corpus(_catalogue(spark, sf))


@query(
    "S12",
    """SELECT p_brand AS category, count(*) AS n FROM part GROUP BY p_brand
UNION ALL SELECT n_name, CAST(100 AS BIGINT) FROM nation""",
)
def filled_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """All parts by brand; the catalogue also lists nations, which no part has as its brand."""
    rows = table(spark, sf, "part").select(F.col("p_brand").alias("category"), F.col("p_name").alias("text"))
    nations = table(spark, sf, "nation").select(
        F.col("n_name").alias("name"), F.concat(F.lit("Parts of "), "n_name").alias("description"), F.array("n_name").alias("skills")
    )
    catalogue = _catalogue(spark, sf).unionByName(nations)
    return SY.add_missing_categories(rows, catalogue).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def _text_step(spark: SparkSession, sf: str, step) -> DataFrame:
    return documents(spark, sf, "text").select("doc_id", _md5(step(F.col("text"))))


@query("T1", f"WITH {Q.NORMAL} SELECT doc_id, md5(norm) AS h FROM normal")
def nfkd_text(spark: SparkSession, sf: str) -> DataFrame:
    """The check knows one combining mark, so marks are made equal first."""
    return _text_step(spark, sf, lambda t: F.regexp_replace(T.normalize_nfkd(t), r"\p{M}", "́"))


_TERMS = "[" + Q.in_list(w for w, _, _ in T.TECH_TERMS) + "]"
_TAGGED = f"text || ' (' || {_TERMS}[doc_id % 24 + 1] || ') ' || {_TERMS}[(doc_id * 7) % 24 + 1] || '.'"


def _tagged(text, doc_id):
    """Text with two technical terms of its own, since the test prose has none."""
    terms = F.array(*[F.lit(w) for w, _, _ in T.TECH_TERMS])
    first = F.get(terms, F.pmod(doc_id, F.lit(24)).cast("int"))
    second = F.get(terms, F.pmod(doc_id * 7, F.lit(24)).cast("int"))
    return F.concat(text, F.lit(" ("), first, F.lit(") "), second, F.lit("."))


@query("T2", f"WITH tagged AS (SELECT doc_id, {_TAGGED} AS t FROM documents) SELECT doc_id, md5({Q.protected('t')}) AS h FROM tagged")
def protected_terms(spark: SparkSession, sf: str) -> DataFrame:
    return _text_step(spark, sf, lambda t: T.protect_terms(_tagged(t, F.col("doc_id"))))


@query("T9", f"WITH tagged AS (SELECT doc_id, {_TAGGED} AS t FROM documents) SELECT doc_id, md5({Q.restored('lower(' + Q.protected('t') + ')')}) AS h FROM tagged")
def restored_terms(spark: SparkSession, sf: str) -> DataFrame:
    return _text_step(
        spark, sf, lambda t: T.restore_terms(F.lower(T.protect_terms(_tagged(t, F.col("doc_id")))))
    )


@query("T3", f"SELECT doc_id, md5({Q.without_urls('text')}) AS h FROM documents")
def urls_removed(spark: SparkSession, sf: str) -> DataFrame:
    return _text_step(spark, sf, T.remove_urls)


@query("T3", f"SELECT page_id, md5({Q.without_urls('url || chr(10) || html')}) AS h FROM pages")
def page_urls_removed(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    return pages.select("page_id", _md5(T.remove_urls(F.concat_ws("\n", "url", "html"))))


@query("T4", f"SELECT doc_id, md5({Q.without_emails('text')}) AS h FROM documents")
def emails_removed(spark: SparkSession, sf: str) -> DataFrame:
    return _text_step(spark, sf, T.remove_emails)


@query("T5", f"SELECT doc_id, md5({Q.without_phones('text')}) AS h FROM documents")
def phones_removed(spark: SparkSession, sf: str) -> DataFrame:
    return _text_step(spark, sf, T.remove_phones)


@query("T6", f"SELECT doc_id, md5({Q.without_social('text')}) AS h FROM documents")
def social_removed(spark: SparkSession, sf: str) -> DataFrame:
    return _text_step(spark, sf, T.remove_social)


@query("T7 T8", f"SELECT doc_id, md5(lower({Q.non_words_blank('text')})) AS h FROM documents")
def lowered_words(spark: SparkSession, sf: str) -> DataFrame:
    return _text_step(spark, sf, lambda t: F.lower(T.blank_non_words(t)))


@query("T10", f"SELECT doc_id, len({Q.words('text')}) AS n_words, md5(array_to_string({Q.words('text')}, ' ')) AS h FROM documents")
def blank_separated_words(spark: SparkSession, sf: str) -> DataFrame:
    words = settle(documents(spark, sf, "text"), words=T.split_words(F.col("text")))
    return words.select("doc_id", F.size("words").alias("n_words"), _md5(F.array_join("words", " ")))


@query(
    "T11 T12 T13",
    f"SELECT doc_id, len({Q.kept_tokens('lower(text)')}) AS n_tokens, md5(array_to_string({Q.kept_tokens('lower(text)')}, ' ')) AS h FROM documents",
)
def filtered_tokens(spark: SparkSession, sf: str) -> DataFrame:
    tokens = T.drop_stop_words(T.drop_short(T.trim_tokens(T.split_words(F.lower("text")))))
    rows = settle(documents(spark, sf, "text"), tokens=tokens)
    return rows.select("doc_id", F.size("tokens").alias("n_tokens"), _md5(F.array_join("tokens", " ")))


@query("T16 T15", f"WITH {Q.CLEAN} SELECT doc_id, clean FROM clean")
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf, "text").select("doc_id", T.clean_text(F.col("text")).alias("clean"))


_LEMMAS = f"{Q.CLEAN},\n{Q.lemmas('clean')}"


@query("T14", f"WITH {_LEMMAS} SELECT token, lemma FROM lemmas WHERE token <> lemma")
def lemma_map(spark: SparkSession, sf: str) -> DataFrame:
    rows = P.with_clean_text(documents(spark, sf, "text")).select(F.explode(F.array_distinct("tokens")).alias("token"))
    return LM.lemma_map(rows)


@query(
    "T14",
    f"""WITH {_LEMMAS}, placed AS (SELECT doc_id, unnest(tokens) AS token, unnest(generate_series(1, len(tokens))) AS pos FROM clean)
SELECT doc_id, md5(coalesce(string_agg(coalesce(lemma, token), ' ' ORDER BY pos), '')) AS h
FROM (SELECT doc_id FROM documents) LEFT JOIN (SELECT * FROM placed LEFT JOIN lemmas USING (token)) USING (doc_id) GROUP BY doc_id""",
)
def lemmatized_text(spark: SparkSession, sf: str) -> DataFrame:
    rows = P.with_clean_text(documents(spark, sf, "text")).select("doc_id", "tokens")
    return LM.lemmatize(ST.materialize(rows, "tokens"), "doc_id").select("doc_id", _md5(F.array_join("tokens", " ")))


@query("T17", f"SELECT doc_id, md5({Q.masked('text')}) AS h FROM documents")
def masked_text(spark: SparkSession, sf: str) -> DataFrame:
    return _text_step(spark, sf, T.mask_pii)


@query("T18", f"SELECT doc_id, md5({Q.regex('lower(text)', f'[^{Q.WORD}{Q.BLANK}]', '')}) AS h FROM documents")
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return _text_step(spark, sf, T.duplicate_key)


@query(
    "T19",
    f"""WITH {Q.CLEAN}, placed AS (SELECT doc_id, unnest(tokens) AS term, unnest(generate_series(1, len(tokens))) AS pos FROM clean),
ranked AS (SELECT doc_id, term, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) AS r FROM (
  SELECT doc_id, term, count(*) AS n, min(pos) AS first FROM placed GROUP BY ALL))
SELECT doc_id, coalesce(string_agg(term, ' ' ORDER BY r), '') AS keywords
FROM documents LEFT JOIN (SELECT * FROM ranked WHERE r <= 12) USING (doc_id) GROUP BY doc_id""",
)
def document_keywords(spark: SparkSession, sf: str) -> DataFrame:
    rows = P.with_clean_text(documents(spark, sf, "text"))
    return rows.select("doc_id", F.array_join(top_terms(F.col("tokens"), 12), " ").alias("keywords"))


_LOWERED = f"lower({Q.masked('text')})"


@query(
    "T20",
    f"""WITH trace AS MATERIALIZED (SELECT doc_id, {Q.masked('text')} AS masked, {Q.non_words_blank(_LOWERED)} AS lowered FROM documents),
steps AS MATERIALIZED (SELECT *, list_filter({Q.words('lowered')}, lambda k: k NOT IN ({Q.in_list(T.STOP_WORDS)})) AS tokens FROM trace),
{Q.lemmas('steps')}, placed AS (SELECT doc_id, unnest(tokens) AS token, unnest(generate_series(1, len(tokens))) AS pos FROM steps),
joined AS (SELECT doc_id, string_agg(coalesce(lemma, token), ' ' ORDER BY pos) AS lemmas FROM placed LEFT JOIN lemmas USING (token) GROUP BY doc_id)
SELECT doc_id, md5(masked) AS masked, md5(lowered) AS lowered, len({Q.words('lowered')}) AS n_tokens,
  md5(array_to_string(tokens, ' ')) AS kept, CASE WHEN masked IS NOT NULL THEN md5(coalesce(joined.lemmas, '')) END AS lemmas
FROM steps LEFT JOIN joined USING (doc_id)""",
)
def cleaning_trace(spark: SparkSession, sf: str) -> DataFrame:
    trace = P.cleaning_trace(documents(spark, sf, "text"), "doc_id")
    return trace.select(
        "doc_id",
        F.md5("masked").alias("masked"),
        F.md5("lowered").alias("lowered"),
        F.size("tokens").alias("n_tokens"),
        F.md5(F.array_join("without_stop_words", " ")).alias("kept"),
        F.md5(F.array_join("lemmas", " ")).alias("lemmas"),
    )


_PIECES = f"len(regexp_extract_all(text, '[{Q.WORD}]+|[^{Q.WORD}{Q.BLANK}]')) + 2"


@query(
    "T21 A11",
    f"""SELECT round(avg(CASE WHEN {_PIECES} > 256 THEN 100.0 ELSE 0.0 END), 6) AS pct_gt_256,
  round(avg(CASE WHEN {_PIECES} > 512 THEN 100.0 ELSE 0.0 END), 6) AS pct_gt_512 FROM documents""",
)
def token_budget(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(P.token_budget(documents(spark, sf, "text"), "text"), "pct_gt_256", "pct_gt_512")


_UNACCENTED = f"regexp_extract_all(strip_accents(lower(text)), '[{Q.WORD}]{{2,}}')"


@query("T22", f"SELECT doc_id, len({_UNACCENTED}) AS n, md5(array_to_string({_UNACCENTED}, ' ')) AS h FROM documents")
def vector_tokens(spark: SparkSession, sf: str) -> DataFrame:
    rows = settle(documents(spark, sf, "text"), t=T.vector_tokens(F.col("text")))
    return rows.select("doc_id", F.size("t").alias("n"), _md5(F.array_join("t", " ")))


@query(
    "T23",
    f"""WITH t AS (SELECT doc_id, {_UNACCENTED} AS t FROM documents)
SELECT doc_id, md5(array_to_string(list_concat(t, list_transform(generate_series(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1])), '|')) AS h FROM t""",
)
def word_ngrams(spark: SparkSession, sf: str) -> DataFrame:
    rows = settle(documents(spark, sf, "text"), t=T.vector_tokens(F.col("text")))
    return rows.select("doc_id", _md5(F.array_join(ngrams(F.col("t")), "|")))


@query("T24", "SELECT doc_id, quality, toxic, round(n_chars / 33.0, 4) AS ratio, printf('%.1f%%', (n_chars % 33)::DOUBLE / 33 * 100) AS share FROM documents JOIN labels USING (doc_id)")
def rounded_scores(spark: SparkSession, sf: str) -> DataFrame:
    rows = documents(spark, sf, "n_chars").join(table(spark, sf, "labels"), "doc_id")
    share = T.percent_text((F.col("n_chars") % 33).cast("double") / 33)
    return rows.select("doc_id", "quality", "toxic", F.round(F.col("n_chars") / 33.0, 4).alias("ratio"), share.alias("share"))


@query("T25", "SELECT c_custkey, replace(replace(replace(replace(replace(replace(lower(c_name || ' (' || c_mktsegment || ' + v-1)'), ' ', '_'), '(', ''), ')', ''), '-', '_'), '+', '_'), '#', '#') AS slug FROM customer")
def name_slugs(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat("c_name", F.lit(" ("), "c_mktsegment", F.lit(" + v-1)"))
    return table(spark, sf, "customer").select("c_custkey", T.slug(name).alias("slug"))


_INPUT_NAME = "CASE WHEN source = 'src0' THEN NULL WHEN lang = 'de' THEN 'd' || doc_id || '.exe' WHEN lang = 'fr' THEN 'd' || doc_id || '.Pdf' ELSE 'd' || doc_id || '.txt' END"
_INPUT_TEXT = "CASE WHEN doc_id % 50 = 3 THEN '' WHEN doc_id % 50 = 4 THEN '  ' || left(text, 4) ELSE text END"


def _inputs(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as uploads: some typed, some with a bad extension, some empty."""
    number = F.col("doc_id").cast("string")
    name = (
        F.when(F.col("source") == "src0", F.lit(None))
        .when(F.col("lang") == "de", F.concat(F.lit("d"), number, F.lit(".exe")))
        .when(F.col("lang") == "fr", F.concat(F.lit("d"), number, F.lit(".Pdf")))
        .otherwise(F.concat(F.lit("d"), number, F.lit(".txt")))
    )
    rest = F.pmod("doc_id", F.lit(50))
    text = F.when(rest == 3, "").when(rest == 4, F.concat(F.lit("  "), F.substring("text", 1, 4))).otherwise(F.col("text"))
    return documents(spark, sf, "lang", "source", "text").select("doc_id", name.alias("filename"), text.alias("text"))


@query(
    "P7",
    f"""WITH normal AS MATERIALIZED (SELECT doc_id, filename, text, {Q.decomposed('text')} AS norm FROM (
  SELECT doc_id, {_INPUT_NAME} AS filename, {_INPUT_TEXT} AS text FROM documents)),
checked AS (SELECT doc_id, CASE WHEN filename LIKE '%.exe' THEN 'unsupported_extension'
  WHEN filename IS NOT NULL AND text = '' THEN 'empty_file'
  WHEN length({Q.stripped('text')}) < 5 THEN 'empty_text'
  WHEN len({Q.kept_tokens(Q.prepared('norm'))}) < 3 THEN 'too_little_text' END AS reason FROM normal)
SELECT doc_id, reason, CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS status FROM checked""",
)
def validated_inputs(spark: SparkSession, sf: str) -> DataFrame:
    rows = settle(_inputs(spark, sf), tokens=T.clean_tokens(F.col("text")))
    return VA.validate(rows, filename="filename").select("doc_id", "reason", "status")


@query(
    "P8",
    """SELECT doc_id, CASE WHEN length(text) > 350 THEN left(text, 350) || '...' ELSE text END AS long,
  left(text, 80) AS short FROM documents""",
)
def text_previews(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("text")
    return documents(spark, sf, "text").select(
        "doc_id", T.preview(text, 350).alias("long"), T.preview(text, 80, dots=False).alias("short")
    )


@query("P9", f"SELECT doc_id, coalesce(nullif({_INPUT_NAME}, ''), 'Saisie directe') AS filename FROM documents")
def default_names(spark: SparkSession, sf: str) -> DataFrame:
    return _inputs(spark, sf).select("doc_id", VA.filename_or_default(F.col("filename")).alias("filename"))
