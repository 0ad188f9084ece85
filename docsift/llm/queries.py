"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm import bpe, fim, fingerprints, licences, mixing, nearest, neardup, negatives, quality, rules, sharding, toxicity, warc
from docsift.llm.common import held_out, read
from docsift.session import new_path
from docsift.sources.store import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
VOCABULARY = "word_bpe_49k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), mixing.label_weights(read(spark, sf_dir, "labels")))


SQL["op1_mix_sources"] = f"""
WITH labelled AS (
    SELECT doc_id, avg(quality::DOUBLE) * 1.5 + 0.5 AS weight FROM labels
    WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), units AS (
    SELECT d.doc_id, d.source, coalesce(len(regexp_extract_all(d.text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
           -ln((CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(d.doc_id::VARCHAR, '')), 1, {mixing.DIGITS})
                AS BIGINT)::DOUBLE + 0.5) / {float(16**mixing.DIGITS)!r}::DOUBLE) / coalesce(w.weight, 1.0::DOUBLE) AS key
    FROM documents d LEFT JOIN labelled w USING (doc_id)
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
    FROM units GROUP BY source
), filled AS (
    SELECT *, sum(source_size) OVER () * 1.5::DOUBLE AS budget, sum(weight) OVER () AS all_weight,
           coalesce(sum(source_size) OVER before, 0) * 2.0::DOUBLE AS full_words,
           coalesce(sum(weight) OVER before, 0) AS full_weight
    FROM sources
    WINDOW before AS (ORDER BY source_size * 2.0::DOUBLE / weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT max((budget - full_words) / (all_weight - full_weight)) AS height FROM filled
), plan AS (
    SELECT source, source_size, least(source_size * 2.0::DOUBLE, weight * height) AS target FROM sources, level
), parts AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM plan
), placed AS (
    SELECT u.*, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size AS rest,
           sum(u.size) OVER (PARTITION BY u.source ORDER BY u.key, u.doc_id, u.size
                             RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
           sum(u.size) OVER (PARTITION BY u.source, u.key, u.doc_id, u.size) AS equal_words
    FROM units u JOIN parts p ON u.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       ((epochs + CASE WHEN rest > 0 AND upto - equal_words / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END) * size)::BIGINT
       AS taken
FROM placed
"""


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(read(spark, sf_dir, "documents")).drop("expressions")


@query
def op3_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    model = quality.fit_quality(documents, read(spark, sf_dir, "labels"))
    return _predicted(quality.score_quality(documents, model), 0.3)


def _predicted(scored: DataFrame, least: float, *more: str) -> DataFrame:
    predicted = (F.col("score") >= least).cast("int").alias("predicted")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", predicted, *more)


@query
def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(read(spark, sf_dir, "documents"), bpe.load_vocabulary(vocabulary_path()), digests=True)


@query
def op5_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    return rules.apply_rules(documents, rules.fit_rules(documents, read(spark, sf_dir, "labels")))


@query
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "class_id")


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(documents, read(spark, sf_dir, "labels"))
    return _predicted(toxicity.score_toxicity(documents, model, 0.5), 0.5, "offending")


@query
def op8_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.hilbert_shards(read(spark, sf_dir, "documents"))
    return found.withColumn("grown_shard", F.lit(None).cast("int"))


@query
def op9_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write_archives(read(spark, sf_dir, "pages"), path)
    own = F.col("response.record_type") == "response"
    page_id = F.regexp_extract(F.col("metadata.payload").cast("string"), r"page_id: (-?\d+)", 1)
    found = warc.captures(warc.read_records(spark, path)).select(
        F.when(page_id != "", page_id).cast("long").alias("page_id"),
        F.when(own, F.col("response.payload_bytes")).otherwise(F.col("response.http_length")).alias("payload_bytes"),
        F.when(own, F.col("response.payload_digest"))
        .otherwise(F.col("response.recorded_digest"))
        .alias("payload_digest"),
        F.col("response.record_type").alias("record_type"),
        "record_id",
        F.col("response.refers_to").alias("refers_to_record"),
    )
    found = materialize(found, "captures")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    responses = found.filter("record_type = 'response'")
    names = responses.select(F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"))
    revisits = found.filter("record_type = 'revisit'").join(names.distinct(), "refers_to_record", "left")
    return responses.select(*columns, F.lit(None).cast("long").alias("refers_to")).unionAll(
        revisits.select(*columns, "refers_to")
    )


_BASE32 = "''".join(
    f" || substr('{warc.BASE32}', (('0x' || substr(h, {5 * (i // 4) + 1}, 5))::INT >> {15 - 5 * (i % 4)} & 31) + 1, 1)"
    for i in range(32)
).replace("''", "")
SQL["op9_warc_captures"] = f"""
WITH hashed AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
latest AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last_id FROM hashed)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, ''{_BASE32} AS payload_digest,
       CASE WHEN last_id IS NULL OR page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = last_id OR last_id IS NULL THEN NULL ELSE last_id END AS refers_to
FROM latest
"""


@query
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text against its edit and its neighbour, and the class of its near-duplicates."""
    documents = read(spark, sf_dir, "documents")
    found = fingerprints.compare_neighbours(documents)
    classes = fingerprints.near_duplicates(documents, found.select("doc_id", "node", "fingerprint")).select(
        F.col("doc_id").alias("of_id"), F.col("node").alias("of_node"), "class_id"
    )
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("node") == F.col("of_node"))
    found = found.join(classes.distinct(), same).drop("of_id", "of_node", "node")
    digests = {c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")}
    return found.withColumns(digests)


@query
def op11_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return nearest.nearest(rows, rows.filter("vec_id % 20 = 0"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, sf_dir, "embeddings").withColumn("label", label)
    return negatives.mine(rows, F.col("id") % 100 == 0)


SQL["op12_hard_negatives"] = f"""
WITH usable AS (
    SELECT vec_id::BIGINT AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor({negatives.SCALE} * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.id AS anchor_id, b.id, a.label = b.label AS same,
           list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT AS score
    FROM usable a JOIN usable b ON a.id % 100 = 0 AND a.id <> b.id AND len(a.v) = len(b.v)
), positives AS (
    SELECT * FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {negatives.POSITIVES}
)
SELECT p.anchor_id, p.id AS positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id))::INT AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
     AND {negatives.LOWEST} * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= {negatives.NEGATIVES}
"""


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fim.fill_in_middle(read(spark, sf_dir, "documents"))
    digests = {"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(fim.restored(), 256)}
    return found.withColumns(digests).drop("output")


SQL["op13_fill_in_middle"] = f"""
WITH units AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
           sha256('{fim.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS digest
    FROM documents
), drawn AS (
    SELECT *, len(u)::BIGINT AS n,
           {", ".join(f"('0x' || substr(digest, {8 * i + 1}, 8))::BIGINT AS h{i + 1}" for i in range(4))}
    FROM units
), formed AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR h3 % 100 >= {fim.TRANSFORMED} THEN 'plain'
                WHEN h4 % 100 < {fim.SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), parted AS (
    SELECT *, coalesce(array_to_string(u[1:low], ''), '') AS prefix,
           coalesce(array_to_string(u[low + 1:high], ''), '') AS middle,
           coalesce(array_to_string(u[high + 1:n], ''), '') AS suffix
    FROM formed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
              ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parted
"""
