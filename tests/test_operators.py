import math
import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from docsift.functions import vectors as V
from docsift.functions.arrays import ngrams, term_counts
from docsift.operators import classify as C
from docsift.operators import evaluate as E
from docsift.operators import features as X
from docsift.operators import profile as P
from docsift.operators import splits as S


def pairs(spark, truth, predicted):
    rows = list(zip(range(len(truth)), truth, predicted, strict=True))
    return spark.createDataFrame(rows, "id int, y_true string, y_pred string")


def test_metrics_count_every_class(spark):
    df = pairs(spark, "aabc", "abbd")
    metrics = {r["class"]: r for r in E.class_metrics(df).collect()}
    assert set(metrics) == set("abcd")
    assert metrics["c"]["f1"] == metrics["d"]["f1"] == 0.0
    row = E.averages(E.class_metrics(df)).first()
    assert row["accuracy"] == 0.5
    assert math.isclose(row["f1_macro"], (2 / 3 + 2 / 3) / 4)
    assert row["num_test_samples"] == 4


def test_confusion_rows_sum_to_one(spark):
    cells = E.confusion_matrix(pairs(spark, "aabc", "abbd")).collect()
    assert len(cells) == 16
    sums = Counter()
    for c in cells:
        sums[c["y_true"]] += c["rate"]
    assert {k: round(v, 9) for k, v in sums.items()} == {"a": 1.0, "b": 1.0, "c": 1.0, "d": 0.0}


def test_confusion_with_fixed_labels(spark):
    cells = E.confusion_matrix(pairs(spark, "ab", "ab"), labels=["a", "b", "z"]).collect()
    assert len(cells) == 9 and sum(c["n"] for c in cells) == 2


def test_margins_to_confidence(spark):
    row = spark.range(1).select(
        V.margin_confidence(F.array(F.lit(1.0), F.lit(1.0), F.lit(1.0))).alias("even"),
        V.margin_confidence(F.array(F.lit(0.5))).alias("two"),
        V.softmax(F.array(F.lit(1000.0), F.lit(999.0))).alias("big"),
        V.l2_normalize(F.array(F.lit(0.0), F.lit(0.0))).alias("zero"),
        V.argmax(F.array(F.lit(0.2), F.lit(0.4), F.lit(0.4))).alias("first"),
    ).first()
    assert all(math.isclose(x, 1 / 3) for x in row["even"])
    assert math.isclose(row["two"][1], 1 / (1 + math.exp(-4.0)))
    assert math.isclose(sum(row["big"]), 1.0)
    assert row["zero"] == [0.0, 0.0] and row["first"] == 1


def test_top_candidates_break_ties_by_index(spark):
    scores = F.array(*[F.lit(x) for x in (0.1, 0.4, 0.1, 0.4)])
    names = F.array(*[F.lit(x) for x in "abcd"])
    top = spark.range(1).select(V.top_candidates(scores, names).alias("t")).first()["t"]
    assert [c["category"] for c in top] == ["b", "d", "a"]


def test_mean_pool(spark):
    rows = [(1, 1, [1.0, 2.0]), (1, 0, [9.0, 9.0]), (1, 1, [3.0, 4.0]), (2, 0, [5.0, 5.0])]
    df = spark.createDataFrame(rows, "id int, mask int, vec array<double>")
    assert {r["id"]: r["pooled"] for r in V.mean_pool(df, "id").collect()} == {1: [2.0, 3.0], 2: [0.0, 0.0]}


def test_cv_summary(spark):
    scores = spark.createDataFrame([(x,) for x in (1.0, 1.0, 1.0, 1.0, 0.0)], "s double")
    row = E.cv_summary(scores, "s").first()
    assert math.isclose(row["cv_mean"], 0.8) and math.isclose(row["cv_std"], 0.4)


def test_mcnemar_small_large_and_equal(spark):
    same = pairs(spark, "aab", "aba")
    row = E.mcnemar(E.align(same, same, "id")).first()
    assert (row["b"], row["c"], row["p_value"]) == (0, 0, 1.0)
    first, second = pairs(spark, "a" * 12, "a" * 10 + "bb"), pairs(spark, "a" * 12, "b" * 10 + "aa")
    row = E.mcnemar(E.align(first, second, "id")).first()
    exact = 2 * sum(math.comb(12, i) for i in range(3)) / 2**12
    assert (row["b"], row["c"]) == (10, 2) and math.isclose(row["p_value"], exact, rel_tol=1e-9)
    for b, c in ((541, 461), (700, 301), (30_000, 29_600), (1, 0), (5, 5)):
        many = spark.range(b + c).select(
            F.lit("a").alias("y_true"), F.when(F.col("id") < b, "a").otherwise("b").alias("pred_a"),
            F.when(F.col("id") < b, "b").otherwise("a").alias("pred_b"),
        )
        tail = sum(Fraction(math.comb(b + c, i), 2 ** (b + c)) for i in range(c + 1)) if b + c < 2000 else None
        row = E.mcnemar(many).first()
        if tail is not None:
            assert math.isclose(row["p_value"], min(1.0, float(2 * tail)), rel_tol=1e-6)
        row = E.mcnemar(many, method="normal").first()
        assert math.isclose(row["p_value"], math.erfc(math.sqrt(row["statistic"] / 2)), abs_tol=2e-7)
    close = E.mcnemar(many.limit(0)).first()
    assert close["p_value"] == 1.0


def test_auc_against_pair_counting(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), round(rng.random(), 2)) for _ in range(300)]
    df = spark.createDataFrame([(t, [s, 1 - s]) for t, s in rows], "y_true string, scores array<double>")
    got = {r["class"]: r["auc"] for r in E.roc_auc(df, ["a", "b"]).collect()}
    pos, neg = [s for t, s in rows if t == "a"], [s for t, s in rows if t == "b"]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert math.isclose(got["a"], wins / (len(pos) * len(neg)), rel_tol=1e-9)



def test_roc_tells_tiny_scores_apart(spark):
    df = spark.createDataFrame(
        [("a", [2e-8, 1.0]), ("b", [1e-8, 1.0 - 1e-12]), ("a", [0.6, 0.4]), ("b", [0.5, 0.0])],
        "y_true string, scores array<double>",
    )
    got = {r["class"]: r["auc"] for r in E.roc_auc(df, ["a", "b"]).collect()}
    assert got == {"a": 0.75, "b": 0.25}
    points = [(r["fpr"], r["tpr"]) for r in E.roc_points(df, ["a", "b"]).filter("class = 'a'").orderBy("fpr", "tpr").collect()]
    assert points == [(0.0, 0.5), (0.5, 0.5), (0.5, 1.0), (1.0, 1.0)]


def test_capped_terms_at_a_tie(spark):
    rows = spark.createDataFrame([(f"t{i:02}", 1, 3 if i % 2 else 7) for i in range(20)], "term string, df long, tf long")
    for n in (4, 12, 50):
        want = [r["term"] for r in rows.orderBy(F.desc("tf"), "term").limit(n).collect()]
        got = X.capped(rows, X.TfidfConfig(max_features=n)).orderBy(F.desc("tf"), "term").collect()
        assert [r["term"] for r in got] == want


def test_best_and_worst(spark):
    rows = spark.createDataFrame([("m1", 0.5), ("m0", 0.9), ("m2", 0.9)], "model string, f1_macro double")
    row = E.best_and_worst(rows).first()
    assert (row["best"], row["worst"]) == ("m0", "m1") and math.isclose(row["gap"], 0.4)


def test_overfitting_gap_needs_every_loss(spark):
    rows = spark.createDataFrame([(1, 0.9, 1.0), (2, 0.5, 0.8)], "epoch int, train double, val double")
    assert math.isclose(E.overfitting_gap(rows, "epoch", "train", "val").first()["loss_gap"], 0.3)
    rows = spark.createDataFrame([(1, None, 1.0), (2, 0.5, 0.8)], "epoch int, train double, val double")
    assert E.overfitting_gap(rows, "epoch", "train", "val").first()["loss_gap"] == 0.0


def test_split_is_exact_with_a_hot_class(spark):
    df = spark.range(5000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 40).cast("string"))).alias("c")
    )
    sizes = {r["c"]: r["count"] for r in df.groupBy("c").count().collect()}
    split = S.stratified_split(df, "id", "c")
    tests = {r["c"]: r["count"] for r in split.filter("is_test").groupBy("c").count().collect()}
    assert tests == {c: int(n * 0.2 + 0.5) for c, n in sizes.items()}
    folds = S.stratified_folds(df, "id", "c")
    assert folds.count() == 5000
    for r in folds.groupBy("c").pivot("fold").count().collect():
        counts = [r[str(k)] or 0 for k in range(5)]
        assert max(counts) - min(counts) <= 1


def test_tiny_classes_have_no_test_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id long, c string")
    assert S.stratified_split(df, "id", "c").filter("is_test").count() == 0


def test_duplicates_when_a_third_is_one_text(spark):
    df = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("t"))
    row = P.duplicates(df, F.col("t")).first()
    assert (row["total"], row["duplicates"], row["remaining"]) == (900, 299, 601)
    marked = P.mark_first(df, "id", F.col("t"))
    assert marked.filter("is_first").count() == 601
    assert marked.filter("is_first and t = 'same'").first()["id"] == 0
    assert P.drop_duplicates(df, "id", F.col("t")).count() == 601


def test_length_summary_interpolates(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 10)], "v int")
    row = P.length_summary(df, "v").first()
    assert (row["p25"], row["median"], row["p75"], row["mean"]) == (1.75, 2.5, 4.75, 4.0)
    assert P.length_summary(df, "v", approximate=True).first()["median"] in (2, 3)


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(7,), (7,)], "v int")
    assert [tuple(r) for r in P.histogram(df, "v", 30).collect()] == [(0, 7.0, 2)]


def brute_tfidf(docs):
    n = len(docs)
    df = Counter(t for d in docs for t in set(d))
    kept = {t: c for t, c in df.items() if 2 <= c <= 0.95 * n}
    out = []
    for d in docs:
        raw = {t: (1 + math.log(d.count(t))) * (math.log((1 + n) / (1 + kept[t])) + 1) for t in set(d) if t in kept}
        norm = math.sqrt(sum(x * x for x in raw.values())) or 1.0
        out.append({t: x / norm for t, x in raw.items()})
    return out


def test_tfidf_and_bayes_against_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(12)]
    docs = [[rng.choice(words[:8] if k % 2 else words[4:]) for _ in range(rng.randint(0, 9))] for k in range(40)]
    labels = ["x" if k % 2 else "y" for k in range(40)]
    config = X.TfidfConfig(high=1)
    rows = spark.createDataFrame([(i, c, d) for i, (c, d) in enumerate(zip(labels, docs, strict=True))], "id int, c string, t array<string>")
    terms = X.document_terms(rows, "id", F.col("t"), config, "c")
    vocabulary = X.fit_vocabulary(terms, config)
    want = brute_tfidf(docs)
    names_by_index = {r["idx"]: r["term"] for r in vocabulary.collect()}
    for r in X.transform(terms, vocabulary, "id", config).collect():
        got = {names_by_index[e["idx"]]: e["weight"] for e in r["features"]}
        assert got.keys() == want[r["id"]].keys()
        assert all(math.isclose(got[t], want[r["id"]][t]) for t in got)
    vectors = X.to_vectors(X.transform(terms, vocabulary, "id", config), 20)
    assert vectors.count() == 40 and str(vectors.schema["features"].dataType) == "VectorUDT()"

    names = sorted({t for w in want for t in w})
    sums = {c: {t: sum(w.get(t, 0.0) for w, k in zip(want, labels, strict=True) if k == c) for t in names} for c in "xy"}
    model = C.fit_naive_bayes(terms, "id", "c", 0.1, config)
    for r in C.score_naive_bayes(terms, model, "id").collect():
        joint = {}
        for c in "xy":
            total = sum(sums[c].values()) + 0.1 * len(names)
            joint[c] = math.log(0.5) + sum(x * math.log((sums[c][t] + 0.1) / total) for t, x in want[r["id"]].items())
        top = max(joint.values())
        shares = {c: math.exp(j - top) for c, j in joint.items()}
        share = shares["x"] / sum(shares.values())
        assert math.isclose(r["scores"][0], share, rel_tol=1e-6)
        assert r["y_pred"] == max("xy", key=lambda c: (joint[c], c == "x"))


@pytest.mark.parametrize(("share", "folds"), [(0.2, 5), (0.0, 1), (1.0, 3), (0.37, 4)])
def test_split_table_is_the_split_and_the_folds(spark, share, folds):
    rows = [(i, None if i % 50 == 7 else "hot" if i % 3 else f"c{i % 5}") for i in range(3_000)]
    df = spark.createDataFrame(rows, "id long, kind string")
    got = {(r["id"], r["is_test"], r["fold"]) for r in S.split_table(df, "id", "kind", share, folds).collect()}
    test = {r["id"]: r["is_test"] for r in S.stratified_split(df, "id", "kind", share).collect()}
    fold = {r["id"]: r["fold"] for r in S.stratified_folds(df, "id", "kind", folds).collect()}
    assert got == {(i, test[i], f) for i, f in fold.items()} and len(fold) == 2_940


def test_split_table_reads_its_input_once(spark, tmp_path):
    spark.range(2_000).selectExpr("id", "id % 4 AS kind", "repeat('x', 100) AS text").write.parquet(str(tmp_path / "in"))
    plan = S.split_table(spark.read.parquet(str(tmp_path / "in")), "id", "kind")._jdf.queryExecution().toString()
    assert str(tmp_path / "in") not in plan and "text" not in plan
    empty = spark.createDataFrame([], "id long, kind string")
    assert S.split_table(empty, "id", "kind").count() == 0


def test_terms_are_counted_and_weighted_in_place(spark):
    """Arrow batches give what the column functions and the join give, without a shuffle."""
    lists = [["b", "a", "b", "a"], [], None, ["é", "b"], ["a"], ["zz", "a", "é", "a", "é"]]
    rows = spark.createDataFrame(list(enumerate(lists)), "id int, t array<string>").repartition(1)
    for low, high in ((1, 1), (1, 2), (2, 2)):
        config = X.TfidfConfig(max_features=3, low=low, high=high, min_df=1, max_df=1.0)
        terms = X.document_terms(rows, "id", F.col("t"), config)
        plain = rows.select("id", term_counts(ngrams(F.col("t"), low, high)).alias("terms"))
        assert "MapInArrow" in terms._jdf.queryExecution().toString()
        assert terms.schema == plain.schema and sorted(terms.collect()) == sorted(plain.collect())
        vocabulary = X.fit_vocabulary(terms, config)
        found = X.transform(terms, vocabulary, "id", config)
        assert "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString()
        joined = {r["id"]: r["features"] for r in X._joined(terms, vocabulary, "id", [], config).collect()}
        for r in found.collect():
            assert [e["idx"] for e in r["features"]] == [e["idx"] for e in joined[r["id"]]]
            assert [e["weight"] for e in r["features"]] == pytest.approx([e["weight"] for e in joined[r["id"]]])
