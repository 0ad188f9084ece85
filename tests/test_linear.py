"""Shared-pass linear fits against a dense Newton method and numeric gradients."""

import numpy as np
import pytest
from pyspark.core.broadcast import Broadcast
from pyspark.sql import functions as F

from docsift.operators import linear as LN

CLASSES = ["a", "b", "c"]


def data(n=120, width=7, seed=1, classes=3):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, classes, n)
    y[: n // 2] = 0
    x = rng.normal(size=(n, width)) * (rng.random((n, width)) < 0.5)
    x[:, :classes] += np.eye(classes)[y] * 0.7
    x[3] = 0  # a row without terms
    return x, y, np.arange(n) % 4


def frame(spark, x, y, fold):
    rows = [
        (i, CLASSES[k], int(f), [(j, float(v)) for j, v in enumerate(row) if v]) for i, (row, k, f) in enumerate(zip(x, y, fold, strict=True))
    ]
    schema = "id int, category string, fold int, features array<struct<idx:int,weight:double>>"
    return spark.createDataFrame(rows, schema).repartition(2)


def weights_of(y, k):
    n = np.bincount(y, minlength=k)
    return n.sum() / (k * n)


def hinge_by_newton(x, positive, row_weight, c):
    """The optimum of |w|^2 / 2 + C sum s max(0, 1 - y f)^2 with the intercept among the weights."""
    x, sign, w = np.hstack([x, np.ones((len(x), 1))]), np.where(positive, 1.0, -1.0), np.zeros(x.shape[1] + 1)
    for _ in range(200):
        slack = np.maximum(1 - sign * (x @ w), 0)
        g = w - 2 * c * x.T @ (row_weight * sign * slack)
        h = np.eye(len(w)) + 2 * c * (x.T * (row_weight * (slack > 0))) @ x
        step = np.linalg.solve(h, g)
        w = w - step
        if np.abs(step).max() < 1e-13:
            break
    return w


@pytest.mark.parametrize("c", [0.1, 2.0])
def test_hinge_equals_newton(spark, c):
    x, y, fold = data()
    blocks = LN.pack(frame(spark, x, y, fold), "category", CLASSES, x.shape[1], "fold")
    fits = LN.fit(blocks, [LN.Problem(c), LN.Problem(c, 2)], LN.HINGE, tolerance=1e-7)
    assert all(fits.converged) and max(LN.optimality(blocks, fits)) <= 1.1e-7
    for left_out in (LN.NONE_LEFT_OUT, 2):
        kept = fold != left_out
        balanced = weights_of(y[kept], 3)
        for k in range(3):
            row_weight = np.where(y[kept] == k, balanced[k], 1.0)
            want = hinge_by_newton(x[kept], y[kept] == k, row_weight, c)
            assert np.allclose(fits.of(LN.Problem(c, left_out))[:, k], want, atol=1e-5)


def test_two_classes_mirror_each_other(spark):
    x, y, fold = data(classes=2)
    blocks = LN.pack(frame(spark, x, y, fold), "category", CLASSES[:2], x.shape[1])
    found = LN.fit(blocks, [LN.Problem(1.0)], LN.HINGE, tolerance=1e-7).weights
    assert np.allclose(found[:, 0], -found[:, 1], atol=1e-5)
    want = hinge_by_newton(x, y == 0, weights_of(y, 2)[y], 1.0)
    assert np.allclose(found[:, 0], want, atol=1e-5)


def test_softmax_is_optimal(spark):
    x, y, fold = data(seed=4)
    blocks = LN.pack(frame(spark, x, y, fold), "category", CLASSES, x.shape[1], "fold")
    fits = LN.fit(blocks, [LN.Problem(c) for c in (0.1, 5.0)], LN.SOFTMAX, tolerance=1e-7)
    s = weights_of(y, 3)[y]
    for c in (0.1, 5.0):
        w = fits.of(LN.Problem(c))
        z = x @ w[:-1] + w[-1]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        slope = c * s[:, None] * (p - np.eye(3)[y])
        assert np.abs(w[:-1] + x.T @ slope).max() < 1e-4 and np.abs(slope.sum(axis=0)).max() < 1e-4


@pytest.mark.parametrize("loss", [LN.HINGE, LN.SOFTMAX])
def test_gradient_is_that_of_the_loss(spark, loss):
    x, y, fold = data(n=40, width=4, seed=2)
    blocks = LN.pack(frame(spark, x, y, fold), "category", CLASSES, 4, "fold")
    columns = LN._columns(blocks, [LN.Problem(0.7, 1)], loss)
    rdd, rng = LN._unpacked(blocks), np.random.default_rng(3)
    w = rng.normal(size=(5, 3))
    f, g = LN._evaluate(rdd, columns, w)
    for place in ((0, 0), (2, 1), (4, 2)):
        near = w.copy()
        near[place] += 1e-6
        more, _ = LN._evaluate(rdd, columns, near)
        assert abs((more.sum() - f.sum()) / 1e-6 - g[place]) < 1e-3


def test_predictions_and_folds(spark):
    x, y, fold = data(seed=6)
    rows = frame(spark, x, y, fold)
    blocks = LN.pack(rows, "category", CLASSES, x.shape[1], "fold")
    problems = [LN.Problem(c, f) for c in (0.5, 1.0) for f in (*range(4), LN.NONE_LEFT_OUT)]
    fits = LN.fit(blocks, problems, LN.HINGE)
    for r in LN.predictions(rows, fits, LN.Problem(1.0), "id").collect():
        w = fits.of(LN.Problem(1.0))
        assert r["y_pred"] == CLASSES[int(np.argmax(x[r["id"]] @ w[:-1] + w[-1]))]
        assert abs(sum(r["scores"]) - 1) < 1e-9
    got = LN.out_of_fold(rows, fits, "category").groupBy("c", "fold").agg(F.count_if(F.col("y_true") == F.col("y_pred")).alias("n"))
    got = {(r["c"], r["fold"]): r["n"] for r in got.collect()}
    for c in (0.5, 1.0):
        for f in range(4):
            w = fits.of(LN.Problem(c, f))
            best = np.argmax(x @ w[:-1] + w[-1], axis=1)
            assert got[c, f] == int((best == y)[fold == f].sum())


def test_limit_of_rounds_warns(spark):
    x, y, fold = data(n=60)
    blocks = LN.pack(frame(spark, x, y, fold), "category", CLASSES, x.shape[1])
    with pytest.warns(UserWarning, match="stopped after 2 rounds"):
        fits = LN.fit(blocks, [LN.Problem(1.0)], LN.HINGE, tolerance=1e-7, max_iter=2)
    assert fits.rounds == [2] and fits.converged == [False]


def test_many_problems_go_in_turns(spark, monkeypatch):
    x, y, fold = data(n=60)
    blocks = LN.pack(frame(spark, x, y, fold), "category", CLASSES, x.shape[1], "fold")
    problems = [LN.Problem(c, f) for c in (0.1, 1.0) for f in range(4)]
    together = LN.fit(blocks, problems, LN.SOFTMAX, tolerance=1e-7)
    monkeypatch.setattr(LN, "COLUMNS", 7)
    assert np.allclose(LN.fit(blocks, problems, LN.SOFTMAX, tolerance=1e-7).weights, together.weights, atol=1e-4)


def test_folds_go_on_from_the_whole_and_broadcasts_are_dropped(spark, monkeypatch):
    x, y, fold = data(n=200)
    blocks = LN.pack(frame(spark, x, y, fold), "category", CLASSES, x.shape[1], "fold")
    dropped = []
    destroy = Broadcast.destroy
    monkeypatch.setattr(Broadcast, "destroy", lambda self, *a: dropped.append(1) or destroy(self, *a))
    alone = LN.fit(blocks, [LN.Problem(1.0, 1)], LN.HINGE, tolerance=1e-6)
    assert len(dropped) == alone.passes
    both = LN.fit(blocks, [LN.Problem(1.0, 1), LN.Problem(1.0)], LN.HINGE, tolerance=1e-6)
    assert both.rounds[0] < alone.rounds[0]
    assert np.allclose(both.of(LN.Problem(1.0, 1)), alone.of(LN.Problem(1.0, 1)), atol=1e-4)


@pytest.mark.parametrize("columns", [3, LN.NARROW + 3])
def test_products_row_by_row_and_column_by_column(columns):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(9, 6)) * (rng.random((9, 6)) < 0.4)
    x[[0, 4, 8]] = 0
    lengths = (x != 0).sum(axis=1).astype(np.int64)
    block = LN._Block.of({"lengths": lengths, "indices": np.nonzero(x)[1].astype(np.int32), "values": x[x != 0]})
    w, slopes = rng.normal(size=(7, columns)), rng.normal(size=(9, columns))
    out = np.zeros_like(w)
    block.add_transposed(slopes, out)
    assert np.allclose(block.times(w), x @ w[:-1] + w[-1])
    assert np.allclose(out, np.vstack([x.T @ slopes, slopes.sum(axis=0)]))
