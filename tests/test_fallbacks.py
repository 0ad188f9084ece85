"""Results do not depend on which join or path a size check chooses."""

import math

from pyspark.sql import functions as F

from docsift.functions import text as T
from docsift.operators import classify as C
from docsift.operators import features as X
from docsift.operators import labels as L
from docsift.operators import lemmas as LM
from docsift.operators import splits as S
from docsift.plans import fits as FT
from docsift.plans.registry import corpus, documents, naive_bayes
from docsift.sources.store import materialize


def test_scores_without_broadcast(spark, small, monkeypatch):
    model, terms = naive_bayes(spark, small), corpus(spark, small).test_terms()
    want = {r["doc_id"]: (r["y_pred"], r["scores"]) for r in C.score_naive_bayes(terms, model, "doc_id").collect()}
    monkeypatch.setattr(C, "MAX_BROADCAST_VALUES", 0)
    got = {r["doc_id"]: (r["y_pred"], r["scores"]) for r in C.score_naive_bayes(terms, model, "doc_id").collect()}
    assert got.keys() == want.keys()
    for k, (label, scores) in want.items():
        assert got[k][0] == label
        assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(scores, got[k][1], strict=True))


def test_splits_without_broadcast(spark, small, monkeypatch):
    rows = documents(spark, small, "lang")
    want = S.stratified_split(rows, "doc_id", "lang").collect()
    monkeypatch.setattr(L, "MAX_CLASSES", 0)
    got = S.stratified_split(rows, "doc_id", "lang").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_lemmas_without_broadcast(spark, monkeypatch):
    rows = spark.createDataFrame([(i, ["cats", "cat", "dogs", "dog", "as"]) for i in range(50)], "id int, tokens array<string>")
    for bound in (0, 1):
        monkeypatch.setattr(LM, "MAX_BROADCAST_LEMMAS", bound)
        got = LM.lemmatize(rows, "id").collect()
        assert len(got) == 50 and all(r["tokens"] == ["cat", "cat", "dog", "dog", "as"] for r in got)


def test_grid_equals_one_fit_per_fold(spark, small):
    c = corpus(spark, small)
    folds = c.split.select("doc_id", "fold")
    train = c.train_terms()
    vocabulary = materialize(X.fit_vocabulary(train), "vocabulary")
    features = materialize(X.transform(train, vocabulary, "doc_id").join(folds, "doc_id"), "features")
    grid = C.naive_bayes_grid(features, "doc_id", "category", [0.1, 1.0]).filter("alpha = 0.1")
    fits = FT.naive_bayes_fold_predictions(train.join(folds, "doc_id"), "doc_id", "category", 0.1, vocabulary=vocabulary)
    pairs = grid.select("doc_id", "y_pred").join(fits.select("doc_id", F.col("y_pred").alias("other")), "doc_id")
    assert pairs.count() == features.count()
    assert pairs.filter("y_pred <> other").count() == 0


def test_a_very_long_text(spark):
    rows = spark.range(1).select(F.repeat(F.lit("Machine Learning "), 500_000).alias("t"))
    assert rows.select(F.size(T.clean_tokens(F.col("t")))).first()[0] == 1_000_000


def test_stop_words_of_other_languages(spark):
    french = T.stop_words("french")
    row = spark.createDataFrame([("le plan avec des tables",)], "t string")
    assert row.select(T.clean_text(F.col("t"), words=french)).first()[0] == "plan tables"
