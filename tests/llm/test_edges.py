"""Every operator over odd rows, empty tables and clashing columns; pipeline stages too."""

import pytest

import corpus_pipeline
from docsift.llm import bpe, fingerprints, licences, mixing, neardup, quality, rules, sharding, toxicity, warc
from docsift.llm.queries import vocabulary_path
from docsift.session import new_path


def _pages(df):
    return df.withColumnsRenamed({"doc_id": "page_id", "lang": "url", "text": "html"})


def _warc(spark, df):
    path = new_path(spark, "edge-warc")
    warc.write_archives(_pages(df), path)
    return warc.captures(warc.read_records(spark, path))


OPERATORS = {
    "mix": lambda s, d, y: mixing.mix(d, mixing.label_weights(y)),
    "licences": lambda s, d, y: licences.scan_licences(d),
    "quality": lambda s, d, y: quality.score_quality(d, quality.fit_quality(d, y)),
    "keep_quality": lambda s, d, y: quality.keep_quality(d, quality.fit_quality(d, y), 0.0),
    "bpe": lambda s, d, y: bpe.encode_texts(d, bpe.load_vocabulary(vocabulary_path())),
    "rules": lambda s, d, y: rules.apply_rules(d, rules.fit_rules(d, y)),
    "neardup": lambda s, d, y: neardup.near_duplicates(d),
    "toxicity": lambda s, d, y: toxicity.score_toxicity(d, toxicity.fit_toxicity(d, y), 0.5),
    "rows": lambda s, d, y: sharding.hilbert_shards(d),
    "bytes": lambda s, d, y: sharding.hilbert_shards(d, law="bytes"),
    "warc": lambda s, d, y: _warc(s, d),
    "neighbours": lambda s, d, y: fingerprints.compare_neighbours(d),
    "fingerprints": lambda s, d, y: fingerprints.fingerprints(d),
    "minhash": lambda s, d, y: fingerprints.near_duplicates(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_every_row(spark, odd, labels, odd_rows, name):
    assert OPERATORS[name](spark, odd, labels).count() == len(odd_rows)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(spark, empty, no_labels, name):
    assert OPERATORS[name](spark, empty, no_labels).count() == 0


def test_models_without_labels(spark, odd, odd_rows, no_labels):
    assert {r["score"] for r in quality.score_quality(odd, quality.fit_quality(odd, no_labels)).collect()} == {0.5}
    assert {r["score"] for r in toxicity.score_toxicity(odd, toxicity.fit_toxicity(odd, no_labels)).collect()} == {0.0}
    found = rules.apply_rules(odd, rules.fit_rules(odd, no_labels)).collect()
    assert all(r["content_share"] == (1.0 if r["n_words"] else 0.0) for r in found)


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stage_with_odd_rows(spark, odd, empty, labels, tmp_path, stage):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    run = corpus_pipeline.STAGES[stage][1]
    out = run(spark, odd, str(tmp_path))
    rows = out.collect()
    if stage < 4:
        assert out.columns == odd.columns
        known = {tuple(r) for r in odd.collect()}
        assert {tuple(r) for r in rows} <= known
    else:
        assert len(rows) == odd.count()
    assert run(spark, empty, str(tmp_path)).count() == 0
