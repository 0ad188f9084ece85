"""The pipeline against its own definition, stage by stage, without Spark."""

import hashlib
from collections import Counter

import tokenizers

import __spark_entry__
import corpus_pipeline
from docsift.llm import common, quality, rules
from docsift.llm.queries import QUERIES, vocabulary_path
from tests.llm.test_mixing import expected
from tests.llm.test_neardup import classes, naive


def test_equals_brute_force(spark, small):
    read = lambda t: spark.read.parquet(f"{small}/{t}.parquet")
    documents, labels = read("documents"), read("labels")
    score = quality.Scorer(quality.fit_quality(documents, labels))
    field, hasher = rules.fit_rules(documents, labels), rules.WordHasher()
    rows = [(r["doc_id"], r["text"], r["source"]) for r in documents.collect()]
    rows = [r for r in rows if score(r[1]) >= 0.3]
    rows = [r for r in rows if rules.verdict(r[1], field, hasher)[2]]
    firsts = {c for _, c in classes([r[:2] for r in rows], naive)}
    rows = [r for r in rows if r[0] in firsts]
    weights = {r["doc_id"]: 2.0 if r["quality"] else 0.5 for r in labels.collect()}
    library, want = tokenizers.Tokenizer.from_file(vocabulary_path()), Counter()
    texts = {r[0]: r[1] for r in rows}
    for doc_id, size, _, _, taken in expected(rows, weights):
        ids = library.encode(texts[doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[(doc_id, len(ids), hashlib.sha256(decoded.encode()).hexdigest())] += taken // size
    got = corpus_pipeline.run(spark, small).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["decoded_sha256"]) for r in got) == +want


def test_stages_and_registration():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "quality rules", "near duplicates", "mixing", "tokens",
    ]
    registered = __spark_entry__.queries()
    assert registered["pipeline"] is corpus_pipeline.run
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 11)) and QUERIES.keys() <= registered.keys()


def test_sql_checks(spark, small):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    sql = __spark_entry__.oracle_sql()
    for name in ("op1_mix_sources", "op9_warc_captures"):
        df = QUERIES[name](spark, small)
        columns = sorted(df.columns)
        got = Counter(tuple(r[c] for c in columns) for r in df.collect())
        cursor = con.execute(sql[name])
        places = {d[0]: i for i, d in enumerate(cursor.description)}
        assert sorted(places) == columns
        assert got == Counter(tuple(r[places[c]] for c in columns) for r in cursor.fetchall())


def test_readable_after_workers_lose_the_package():
    """Functions of the subpackage travel by value."""
    from pyspark import cloudpickle

    data = cloudpickle.dumps(common.pieces)
    assert b"def" in data or b"start" in data and len(data) > 300
