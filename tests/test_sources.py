import os

import duckdb
import pytest
from pyspark.sql import functions as F

from docsift.plans.compare import load_naive_bayes, save_naive_bayes
from docsift.plans.registry import naive_bayes
from docsift.sources import corpus as SC
from docsift.sources import files as SF
from docsift.sources import store as ST
from docsift.sources import synthetic as SY


@pytest.fixture
def catalogue(spark):
    rows = [(f"Cat {i}", f"About {i}.", [f"skill {i} {j}" for j in range(4 + i * 5)]) for i in range(3)]
    return spark.createDataFrame(rows, "name string, description string, skills array<string>")


def test_csv_keeps_quotes_and_lines(spark, tmp_path):
    rows = [("A, \"x\"", "line one\nline \"two\", end"), ("B", "back\\slash")]
    df = spark.createDataFrame(rows, SC.CORPUS_SCHEMA)
    ST.write_report_csv(df, str(tmp_path / "c"))
    assert sorted(map(tuple, SC.read_corpus_csv(spark, str(tmp_path / "c")).collect())) == sorted(rows)


def test_large_csv_cuts_records_across_ranges(spark, tmp_path):
    """Quotes, line ends and long records on the borders of blocks and chunks."""
    texts = ['line one\nline "two", end', "plain", '"', '""\n""', "\n\n\n", "a,b", "x\r\ny", "é\n" * 90, 'q"\n"' * 40, " "]
    rows = [(f"c{i}", t) for i, t in enumerate(texts * 6)]
    path = tmp_path / "one.csv"
    quoted = ["Category,Resume"] + [f'{c},"{t.replace(chr(34), chr(34) * 2)}"' for c, t in rows]
    path.write_bytes(("\r\n".join(quoted) + "\r\n\r\n").encode())
    want = duckdb.connect().execute(
        f"SELECT * FROM read_csv('{path}', header = true, quote = '\"', escape = '\"', delim = ',', all_varchar = true, strict_mode = false)"
    ).fetchall()
    assert sorted(want) == sorted(rows)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
        got = SC.read_large_csv(spark, str(path), chunk_chars=50).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(map(tuple, got)) == sorted(rows)
    path.write_text("Category,Resume\n")
    assert SC.read_large_csv(spark, str(path)).collect() == []


def test_guard_wants_columns_and_rows(spark):
    with pytest.raises(ValueError, match="lacks"):
        SC.require_corpus(spark.range(200).toDF("Category"))
    few = spark.range(100).select(F.lit("a").alias("Category"), F.lit("b").alias("Resume"))
    with pytest.raises(ValueError, match="more than 100"):
        SC.require_corpus(few)
    assert SC.require_corpus(few.union(few)).count() == 200


def test_json_report_keeps_nested_nulls(spark, tmp_path):
    df = spark.createDataFrame([("m", (1.5, None))], "model string, s struct<a: double, b: double>")
    ST.write_report_json(df, str(tmp_path / "j"))
    back = ST.read_report_json(spark, str(tmp_path / "j"), "model string, s struct<a: double, b: double>")
    assert back.first()["s"]["a"] == 1.5
    assert '"b":null' in spark.read.text(str(tmp_path / "j")).first()[0]


def make_files(folder):
    contents = {
        "a.txt": "café one ".encode(), "b.TXT": b"caf\xe9 two", "c.md": b"# three", "d.pdf": b"PDF four",
        "e.docx": b"DOCX five", "f.xyz": b"six", "g.pdf": b"broken",
    }
    for name, content in contents.items():
        (folder / name).write_bytes(content)
    return contents


def test_text_files_decode(spark, tmp_path):
    make_files(tmp_path)
    rows = {r["filename"]: r for r in SF.extract_text(SF.read_files(spark, str(tmp_path))).collect()}
    assert rows["a.txt"]["text"] == "café one" and rows["b.TXT"]["text"] == "café two"
    assert rows["f.xyz"]["text"] == "six"
    assert rows["d.pdf"]["text"] is None and "no handler" in rows["d.pdf"]["error"]


def test_handlers_and_fallback(spark, tmp_path):
    make_files(tmp_path)

    def pdf(content):
        if not content.startswith(b"PDF"):
            raise ValueError("not a pdf")
        return content.decode()[4:]

    def docx(content):
        return content.decode()[5:] if content.startswith(b"DOCX") else ""

    found = SF.extract_text(SF.read_files(spark, str(tmp_path)), {".pdf": pdf, ".docx": docx})
    rows = {r["filename"]: (r["text"], r["error"]) for r in found.collect()}
    assert len(rows) == 7
    assert rows["d.pdf"] == ("four", None) and rows["e.docx"] == ("five", None)
    assert rows["f.xyz"] == ("six", None)
    assert rows["g.pdf"] == (None, "not a pdf")


def test_artifact_size_of_a_tree(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.bin").write_bytes(os.urandom(1 << 19))
    (tmp_path / "b.bin").write_bytes(os.urandom(1 << 19))
    assert ST.artifact_size(spark, str(tmp_path)).first()["size_mb"] == 1.0


def test_synthetic_corpus_is_seeded(spark, catalogue):
    first = SY.synthetic_corpus(catalogue, 20).collect()
    again = SY.synthetic_corpus(catalogue.repartition(5), 20).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))
    assert len(first) == 60 and len({r["text"] for r in first}) > 50
    assert sorted(map(tuple, SY.synthetic_corpus(catalogue, 20, seed=1).collect())) != sorted(map(tuple, first))


def test_missing_categories_are_filled(spark, catalogue):
    corpus = spark.createDataFrame([("Cat 1", "text")], "category string, text string")
    counts = SY.add_missing_categories(corpus, catalogue).groupBy("category").count().collect()
    assert {r["category"]: r["count"] for r in counts} == {"Cat 0": 100, "Cat 1": 1, "Cat 2": 100}


def test_saved_model_scores_the_same(spark, small, tmp_path):
    model = naive_bayes(spark, small)
    save_naive_bayes(model, str(tmp_path / "m"))
    back = load_naive_bayes(spark, str(tmp_path / "m"))
    assert back.classes == model.classes and back.priors == model.priors and back.config == model.config
    assert back.terms.exceptAll(model.terms).count() == 0


def test_small_sides_are_checked(spark):
    assert ST.within(spark.range(10), 10) and not ST.within(spark.range(11), 10)
    plan = spark.range(5).join(ST.broadcast_within(spark.range(11), 10), "id")
    assert "ResolvedHint" not in plan._jdf.queryExecution().analyzed().toString()
