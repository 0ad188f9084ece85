import numpy as np
import pytest

from docsift.operators import embed as EM
from docsift.operators import labels as L
from docsift.sources import synthetic as SY


def test_whole_texts_are_encoded_in_windows(spark):
    def load_encoder():
        def encode(texts, most):
            assert all(len(t.split()) <= most for t in texts) and len(texts) <= 4
            return np.array([[t.split().count("a"), t.split().count("b"), 0.5] for t in texts])

        return encode

    rows = [(1, "a " * 10), (2, "a " * 8 + "b " * 4), (3, ""), (4, None), (5, "b " * 3)]
    df = spark.createDataFrame(rows, "id int, text string")
    got = {r["id"]: np.array(r["embedding"]) for r in EM.embed(df, "id", "text", load_encoder, batch=4, max_tokens=4).collect()}
    assert len(got) == 5 and all(abs(np.linalg.norm(v) - 1) < 1e-6 for v in got.values())
    assert got[2][1] > 0.4 and got[2][0] > got[2][1]  # what stands in the last window counts too
    assert got[3].tolist() == got[4].tolist() == [0.0, 0.0, 1.0]


def test_hashed_vectors_without_words(spark):
    df = spark.createDataFrame([(1, "x y x"), (2, ""), (3, None), (4, "  ")], "id int, text string")
    got = {r["id"]: r["embedding"] for r in EM.hashed_vectors(df, "id", "text", 8).collect()}
    assert all(len(v) == 8 for v in got.values()) and sum(map(abs, got[1])) in (1.0, 3.0)
    assert got[2] == got[3] == got[4] == [0.0] * 8


def test_class_limit_is_an_argument(spark):
    df = spark.createDataFrame([(str(i),) for i in range(12)], "c string")
    with pytest.raises(ValueError):
        L.class_names(df, "c", most=11)
    assert len(L.class_names(df, "c", most=12)) == 12


def test_missing_categories_get_rows(spark):
    corpus = spark.createDataFrame([("a", "text")] * 3, "category string, text string")
    catalogue = spark.createDataFrame(
        [("a", "d", ["x"]), ("b", "d", ["y", "z"]), ("c", "d", [])], "name string, description string, skills array<string>"
    )
    got = {r["category"]: r["count"] for r in SY.add_missing_categories(corpus, catalogue, 7).groupBy("category").count().collect()}
    assert got == {"a": 3, "b": 7, "c": 7}
