"""Vocabulary and vectors straight from words equal those from counted n-grams, without the many rare ones."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docsift.functions import text as T
from docsift.operators import classify as C
from docsift.operators import features as X
from docsift.operators import linear as LN
from docsift.plans import corpus as CO
from docsift.plans import queries_models as QM
from docsift.plans import registry as R

TEXTS = ["a b a b c", "b a", "", None, "c c c d", "a b", "e f g h i j", "d e", "a b é"]


def words(spark):
    rows = [(i, "xy"[i % 2], t) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id int, category string, words string").repartition(3)


def counted(spark, config):
    return X.words_as_terms(words(spark), "doc_id", config, "category")


@pytest.mark.parametrize("low, high", [(1, 1), (1, 2), (2, 2), (1, 3)])
@pytest.mark.parametrize("cap, min_df, max_df", [(3, 1, 1.0), (6, 1, 0.4), (8, 2, 0.95), (1000, 1, 1.0), (1000, 2, 0.5)])
def test_vocabulary_and_vectors(spark, low, high, cap, min_df, max_df):
    config = X.TfidfConfig(cap, low, high, min_df, max_df)
    want = X.fit_vocabulary(counted(spark, config), config)
    got = X.fit_vocabulary(words(spark), config)
    assert sorted(got.collect()) == sorted(want.collect())
    vectors = {r["doc_id"]: r["features"] for r in X.transform(words(spark), got, "doc_id", config).collect()}
    for r in X.transform(counted(spark, config), want, "doc_id", config).collect():
        mine = vectors.pop(r["doc_id"])
        assert [e["idx"] for e in mine] == [e["idx"] for e in r["features"]]
        assert all(math.isclose(a["weight"], b["weight"]) for a, b in zip(mine, r["features"], strict=True))
    assert not vectors


@pytest.mark.parametrize("cap", [10, 300, 5000])
def test_capped_words_of_documents(spark, small, cap):
    config = X.TfidfConfig(cap, min_df=1, max_df=1.0)
    terms = R.corpus(spark, small).terms
    n = terms.count()
    want = X.capped(X.within_frequency(X.document_frequencies(terms), F.lit(n), config), config)
    assert sorted(X.capped_words(R.words(spark, small).words, config).collect()) == sorted(want.collect())


def test_rare_pairs_are_not_counted(spark, small):
    table = R.words(spark, small).words
    names = X._column(X._arrow(X.single_words(table).filter("tf >= 50").select("term")), "term")
    pairs = X.document_frequencies(R.corpus(spark, small).terms).filter(F.contains("term", F.lit(" ")))
    found = X.word_pairs(table, names, 50).filter("tf >= 50").collect()
    assert sorted(found) == sorted(pairs.filter("tf >= 50").collect())
    assert X.word_pairs(table, names, 50).count() < pairs.count() / 10


def test_words_and_split_are_those_of_the_corpus(spark, small):
    c, w = R.corpus(spark, small), R.words(spark, small)
    clean = CO.usable(c.clean).select("doc_id", F.array_join(T.vector_tokens(F.col("clean"), accents=False), " ").alias("w"))
    assert sorted(w.words.select("doc_id", "words").collect()) == sorted(clean.collect())
    assert sorted(w.split.collect()) == sorted(c.split.select(w.split.columns).collect())
    train = {r[0] for r in w.train().select("doc_id").collect()}
    assert train == {r[0] for r in c.train_terms().select("doc_id").collect()}


def test_queries_leave_the_terms_unwritten(spark, small):
    R.forget()
    for query in (QM.capped_vocabulary, QM.small_tfidf_norms, QM.ablation):
        assert query(spark, small).count()
    assert not [key for key in R._written if key[2] == "corpus"]


def test_blanks_at_the_ends(spark):
    texts = ["", " ", "a", " a", "a\n", "\u2003a b\u0085", "a b", None, "\ta\n\n", "a \u2028"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.regexp_replace("t", rf"^[{T.BLANK}]+|[{T.BLANK}]+$", "")
    assert all(r[0] == r[1] for r in rows.select(T.strip_blanks(F.col("t")), plain).collect())


def test_pieces_cover_every_row(monkeypatch):
    monkeypatch.setattr(X, "PIECE", 5)
    texts = pa.array(["abcdefgh", None, "a", "", "bb", "cccc"])
    assert [i for p in X._pieces(texts) for i in range(p.start, p.stop)] == list(range(6))


def test_few_vectors_remember_more_steps(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 40)) * (rng.random((300, 40)) < 0.4) * np.geomspace(1, 30, 40)
    rows = [("ab"[int(r[0] + rng.normal() > 0)], [(j, float(v)) for j, v in enumerate(r) if v]) for r in x]
    table = spark.createDataFrame(rows, "category string, features array<struct<idx:int,weight:double>>").repartition(2)
    blocks = LN.pack(table, "category", ["a", "b"], 40)
    fits = LN.fit(blocks, [LN.Problem(1.0)], LN.HINGE, tolerance=1e-6)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(LN, "MOST_MEMORY", LN.MEMORY)
        before = LN.fit(blocks, [LN.Problem(1.0)], LN.HINGE, tolerance=1e-6)
    assert fits.passes < before.passes and all(fits.converged)
    assert np.allclose(fits.weights, before.weights, atol=1e-4)


def test_bayes_of_words_scores_as_of_terms(spark):
    config = X.TfidfConfig(6, min_df=1, max_df=1.0)
    model = C.fit_naive_bayes(words(spark), "doc_id", "category", 0.1, config)
    want = {r["doc_id"]: r for r in C.score_naive_bayes(counted(spark, config), model, "doc_id").collect()}
    got = LN.score_bayes(words(spark), model, "doc_id").collect()
    assert len(got) == len(want) == len(TEXTS)
    for r in got:
        assert r["y_pred"] == want[r["doc_id"]]["y_pred"]
        assert np.allclose(r["scores"], want[r["doc_id"]]["scores"])


def test_rows_of_one_document_are_scored_as_one(spark):
    config = X.TfidfConfig(6, min_df=1, max_df=1.0)
    model = C.fit_naive_bayes(words(spark), "doc_id", "category", 0.1, config)
    twice = words(spark).union(words(spark).filter("doc_id % 3 = 0")).withColumn("doc_id", F.nullif("doc_id", F.lit(4)))
    terms = X.words_as_terms(twice, "doc_id", config, "category")
    want = {r["doc_id"]: r for r in C.score_naive_bayes(terms, model, "doc_id").collect()}
    got = LN.score_bayes(twice, model, "doc_id", merged=True).collect()
    assert len(got) == len(want) == len(TEXTS)
    for r in got:
        assert r["y_pred"] == want[r["doc_id"]]["y_pred"]
        assert np.allclose(r["scores"], want[r["doc_id"]]["scores"])


@pytest.mark.parametrize("limit", [0, 1000])
def test_folds_of_the_training_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(CO, "MAX_BROADCAST_IDS", limit)
    split = spark.createDataFrame([(i, i % 4 == 0, i % 5) for i in range(len(TEXTS) - 1)], "doc_id int, is_test boolean, fold int")
    w = CO.Words(words(spark))
    w.__dict__["split"] = split
    found = {r["doc_id"]: (r["words"], r["fold"]) for r in w.train_with_folds().collect()}
    assert found == {i: (TEXTS[i], i % 5) for i in range(len(TEXTS) - 1) if i % 4}
    assert {r["doc_id"] for r in w.test().collect()} == {0, 4}


@pytest.mark.parametrize("name", ["model_metrics", "best_and_worst_model", "fold_scores", "cv_summary", "latest_history"])
def test_queries_work_from_words(spark, small, name):
    """Neither the clean texts nor the table of n-grams, several times the input, are written."""
    R.forget()
    assert getattr(QM, name)(spark, small).count()
    assert not [key for key in R._written if key[2] == "corpus"]


@pytest.mark.parametrize("limit, shuffled", [(0, True), (1000, False)])
def test_vectors_meet_their_split_without_a_shuffle(spark, monkeypatch, limit, shuffled):
    monkeypatch.setattr(CO, "MAX_BROADCAST_IDS", limit)
    rows = [(i, i % 4 == 0, i % 5) for i in range(len(TEXTS)) for _ in range(1 + (i == 3))]
    w = CO.Words(words(spark))
    w.__dict__["split"] = spark.createDataFrame(rows, "doc_id int, is_test boolean, fold int")
    vocabulary = X.fit_vocabulary(words(spark), X.SMALL)
    with_split = w.with_split()
    plan = with_split._jdf.queryExecution().optimizedPlan().toString()
    assert ("broadcast" in plan) is not shuffled
    key = lambda r: (r["doc_id"], r["category"], r["is_test"], r["fold"], r["features"])
    got = map(key, X.transform(with_split, vocabulary, "doc_id", X.SMALL).collect())
    after = X.transform(w.words, vocabulary, "doc_id", X.SMALL).join(w.split, "doc_id")
    assert sorted(got) == sorted(map(key, after.collect()))


def test_the_linear_features_use_it(spark, small, monkeypatch):
    R.forget()
    asked, real = [], CO.Words.with_split
    monkeypatch.setattr(CO.Words, "with_split", lambda self: asked.append(1) or real(self))
    QM._features(spark, small)
    assert asked
