"""Linear classifiers for many settings at once: each pass over the rows serves all of them.

Rows are packed once into blocks of sparse matrices. The weights of all settings (values
of C, folds left out, classes) go out as one matrix; a task multiplies its blocks with
it, and one tree-shaped sum brings back losses and gradients of all. The driver takes
an L-BFGS step for each setting; those that have settled leave the matrix. Settings
that leave out a fold go on from the one on all rows. The driver holds the
weights, gradients and a few steps of at most ``COLUMNS`` weight vectors at a time, whose
length the cap of the vocabulary bounds; the fewer vectors, the more steps of each.

Two losses: ``hinge`` (squared hinge, one against the rest, the intercept a regularised
feature, positive rows weighted) and ``softmax`` (multinomial, the intercept free, rows
weighted by class). Objectives are ``|w|^2 / 2 + C * loss``, unscaled. A fit is done when
the gradient is ``tolerance`` of what it was at zero; ``optimality`` sums it again from
given weights.
"""

from __future__ import annotations

import sys
import warnings
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.functions import vectors as V
from docsift.operators import classify as C
from docsift.operators import features as X
from docsift.sources.store import materialize

register_pickle_by_value(sys.modules[__name__])

HINGE, SOFTMAX = "hinge", "softmax"
#: Entries of a block, weight vectors fitted side by side, and steps remembered of each; fewer vectors remember more, up to a limit.
ENTRIES = 1 << 16
COLUMNS = 40
MEMORY = 6
MOST_MEMORY = 20
#: Up to so many columns are multiplied one by one.
NARROW = 12
#: A step must gain this share of what the slope promises.
GAIN = 1e-4
#: Losses that differ by less are equal; the gradient then tells whether a step is good.
ROUNDING = 1e-10
NONE_LEFT_OUT = -1


@dataclass(frozen=True)
class Problem:
    """One fit of all classes: a value of C and the fold it does not see."""

    c: float
    left_out: int = NONE_LEFT_OUT


@dataclass(frozen=True)
class Blocks:
    """Packed rows with their classes; ``sizes[fold][class]`` counts rows. All weigh the same unless ``balanced``."""

    table: DataFrame
    classes: list
    width: int
    sizes: dict[int, np.ndarray]
    balanced: bool = True

    def class_sizes(self, problem: Problem) -> np.ndarray:
        return sum((n for f, n in self.sizes.items() if f != problem.left_out), np.zeros(len(self.classes)))

    def class_weights(self, problem: Problem) -> np.ndarray:
        """Weights of the classes among the rows that a problem sees."""
        n = self.class_sizes(problem)
        if not self.balanced:
            return np.ones(len(n))
        return n.sum() / (np.count_nonzero(n) * np.maximum(n, 1))


def _products(lengths: np.ndarray, indices: np.ndarray, values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Products of sparse rows with the weight vectors in the columns; the last weight is the intercept.

    Few columns go one by one over all entries, many row by row, so that what is gathered stays in the cache.
    """
    ends = np.cumsum(lengths)
    starts = ends - lengths
    out = np.tile(weights[-1], (len(lengths), 1))
    if weights.shape[1] > NARROW:
        for row in np.flatnonzero(lengths):
            own = slice(starts[row], ends[row])
            out[row] += values[own] @ weights.take(indices[own], axis=0)
    elif len(rows := np.flatnonzero(lengths)):
        places = indices.astype(np.intp)  # once, not for each column
        for j in range(weights.shape[1]):
            products = weights[:, j].take(places)
            products *= values
            out[rows, j] += np.add.reduceat(products, starts[rows])
    return out


class _Block:
    """A sparse matrix by rows."""

    @classmethod
    def of(cls, held: dict) -> _Block:
        block = cls.__new__(cls)
        block.__dict__.update(held)
        return block

    def __init__(self, row: dict):
        read = lambda name, kind: np.frombuffer(row[name], kind)
        self.labels, self.folds = read("labels", np.int32), read("folds", np.int32)
        self.lengths, self.indices, self.values = read("lengths", np.int64), read("indices", np.int32), read("entries", float)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return _products(self.lengths, self.indices, self.values, weights)

    def add_transposed(self, slopes: np.ndarray, out: np.ndarray) -> None:
        out[-1] += slopes.sum(axis=0)
        if out.shape[1] > NARROW:
            ends = np.cumsum(self.lengths)
            for row in np.flatnonzero(self.lengths):
                own = slice(ends[row] - self.lengths[row], ends[row])
                out[self.indices[own]] += self.values[own, None] * slopes[row]  # no index twice in a row
        else:
            places = self.indices.astype(np.intp)
            for j in range(out.shape[1]):
                products = np.repeat(slopes[:, j], self.lengths)
                products *= self.values
                out[:, j] += np.bincount(places, products, minlength=len(out))


def pack(
    rows: DataFrame, label: str, classes: Sequence, width: int, fold: str | None = None, balanced: bool = True
) -> Blocks:
    """Blocks of ``rows`` with ``features array<struct<idx, weight>>``, written once; rows without class are left out."""
    place = F.array_position(C.class_array(list(classes)), F.col(label)) - 1
    table = rows.dropna(subset=[label]).select(
        place.cast("int").alias("label"),
        (F.col(fold).cast("int") if fold else F.lit(0)).alias("fold"),
        F.transform("features", lambda e: e["idx"].cast("int")).alias("indices"),
        F.transform("features", lambda e: e["weight"].cast("double")).alias("entries"),
    )
    names = ["labels", "folds", "lengths", "indices", "entries"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("indices").value_lengths().to_numpy().astype(np.int64)
            ends = np.cumsum(lengths)
            at = 0
            while at < batch.num_rows:
                before = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, before + ENTRIES, "right")))
                part = batch.slice(at, to - at)
                held = [
                    part.column("label").to_numpy().astype(np.int32),
                    part.column("fold").to_numpy().astype(np.int32),
                    lengths[at:to],
                    part.column("indices").flatten().to_numpy().astype(np.int32),
                    part.column("entries").flatten().to_numpy().astype(float),
                ]
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in held], names)
                at = to

    packed = materialize(table.mapInArrow(run, ", ".join(f"{n} binary" for n in names)), "blocks")
    sizes: dict[int, np.ndarray] = {}
    for r in table.groupBy("fold", "label").count().collect():  # folds times classes
        sizes.setdefault(r["fold"], np.zeros(len(classes)))[r["label"]] = r["count"]
    return Blocks(packed, list(classes), width, sizes, balanced)


@dataclass(frozen=True)
class _Columns:
    """What a task needs to know of the weight vectors: for each its C, fold left out, class, and row weights."""

    loss: str
    c: np.ndarray
    left_out: np.ndarray
    of_class: np.ndarray
    weights: np.ndarray  # (columns, classes)

    def take(self, some: np.ndarray) -> _Columns:
        return _Columns(self.loss, self.c[some], self.left_out[some], self.of_class[some], self.weights[some])

    def loss_and_slope(self, block: _Block, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Loss of every column, summed over the rows, and its slope for every row."""
        row_weight = self.weights[:, block.labels].T * (block.folds[:, None] != self.left_out) * self.c
        mine = block.labels[:, None] == self.of_class
        if self.loss == HINGE:
            sign = np.where(mine, 1.0, -1.0)
            slack = np.maximum(1 - sign * z, 0)
            return (row_weight * slack * slack).sum(axis=0), -2 * row_weight * sign * slack
        classes = self.weights.shape[1]
        grouped = z.reshape(len(z), -1, classes)
        top = grouped.max(axis=2, keepdims=True)
        grown = np.exp(grouped - top)
        total = grown.sum(axis=2, keepdims=True)
        share = (grown / total).reshape(z.shape)
        log_share = (grouped - top - np.log(total)).reshape(z.shape)
        return -(row_weight * np.where(mine, log_share, 0)).sum(axis=0), row_weight * (share - mine)


def _columns(blocks: Blocks, problems: Sequence[Problem], loss: str) -> _Columns:
    k = len(blocks.classes)
    rows = []
    for p in problems:
        weight = blocks.class_weights(p)
        for own in range(k):
            # one against the rest weights the rows of its own class; with two classes both are one's own
            only = loss == HINGE and k > 2
            rows.append((p.c, p.left_out, own, np.where(np.arange(k) == own, weight, 1.0) if only else weight))
    c, left_out, own, weight = zip(*rows, strict=True)
    return _Columns(loss, np.array(c), np.array(left_out), np.array(own), np.stack(weight))


def _unpacked(blocks: Blocks):
    """The blocks as plain arrays, which workers keep without this package."""
    return blocks.table.rdd.map(lambda r: vars(_Block(r.asDict())))


def _evaluate(rdd, columns: _Columns, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loss and gradient of every column over all blocks: one job."""
    order = "C" if weights.shape[1] > NARROW else "F"
    sent = rdd.context.broadcast(np.asarray(weights, order=order))

    def part(held: Iterator[dict]) -> Iterator[tuple]:
        loss, gradient = np.zeros(sent.value.shape[1]), np.zeros(sent.value.shape, order=order)
        for block in map(_Block.of, held):
            value, slope = columns.loss_and_slope(block, block.times(sent.value))
            loss += value
            block.add_transposed(slope, gradient)
        yield loss, gradient

    loss, gradient = rdd.mapPartitions(part).treeReduce(lambda x, y: (x[0] + y[0], x[1] + y[1]))
    sent.destroy()  # the driver, too, lets go of the weights of this pass
    kept = weights if columns.loss == HINGE else np.vstack([weights[:-1], np.zeros_like(weights[-1:])])
    return loss + 0.5 * (kept * kept).sum(axis=0), gradient + kept


class _Descent:
    """L-BFGS of one setting, from zero or from where a ``like`` one, with its steps, has ended."""

    def __init__(self, shape: tuple[int, int], like: _Descent | None = None, memory: int = MEMORY):
        self.x, self.steps, self.like, self.memory = np.zeros(shape), [], like, memory
        self.f = self.g = self.start = None
        self.rounds = 0
        self.trial = self.x

    def slope(self) -> np.ndarray:
        q = self.g.copy()
        used = []
        for s, y, inner in reversed(self.steps):
            a = np.vdot(s, q) / inner
            used.append(a)
            q -= a * y
        if self.steps:
            s, y, inner = self.steps[-1]
            q *= inner / np.vdot(y, y)
        for (s, y, inner), a in zip(self.steps, reversed(used), strict=True):
            q += s * (a - np.vdot(y, q) / inner)
        return -q

    def propose(self) -> None:
        self.d = self.slope()
        self.promise = (self.d * self.g).sum()
        if self.promise >= 0:
            self.steps, self.d = [], -self.g
            self.promise = -(self.g * self.g).sum()
        self.t = 1.0 if self.steps else min(1.0, 1.0 / max(np.linalg.norm(self.g), 1e-300))
        self.trial = self.x + self.t * self.d

    def take(self, f: float, g: np.ndarray, tolerance: float) -> bool:
        """Accept the trial or shorten it; true when settled or stuck."""
        if self.start is None:
            self.start = np.linalg.norm(g)
            if self.like is not None:  # the gradient at zero is known; go on from there
                self.x = self.trial = self.like.x
                self.steps, self.like = self.like.steps[-self.memory :], None
                return False
        if self.g is None:
            self.f, self.g = f, g
        elif f <= self.f + GAIN * self.t * self.promise or (f <= self.f + ROUNDING * abs(self.f) and self.shorter(g)):
            s, y = self.trial - self.x, g - self.g
            inner = np.vdot(s, y)
            if inner > 1e-12 * np.vdot(y, y):
                self.steps = [*self.steps[1 - self.memory :], (s, y, inner)]
            self.x, self.f, self.g, self.rounds = self.trial, f, g, self.rounds + 1
        elif self.t < 1e-8:
            return True  # no step gains any more
        else:
            best = -self.promise * self.t * self.t / (2 * (f - self.f - self.promise * self.t))
            self.t = min(max(best, 0.1 * self.t), 0.5 * self.t)
            self.trial = self.x + self.t * self.d
            return False
        if self.norm() <= tolerance:
            return True
        self.propose()
        return False

    def shorter(self, g: np.ndarray) -> bool:
        return np.linalg.norm(g) < np.linalg.norm(self.g)

    def norm(self) -> float:
        """The gradient's length as a share of what it was at zero."""
        return float(np.linalg.norm(self.g) / self.start) if self.start else 0.0


@dataclass(frozen=True)
class LinearFits:
    """Weights ``(features and intercept, problems x classes)`` and how each problem's fit ended."""

    problems: list[Problem]
    classes: list
    loss: str
    weights: np.ndarray
    rounds: list[int]
    gradients: list[float]
    converged: list[bool]
    passes: int

    def of(self, problem: Problem) -> np.ndarray:
        at = self.problems.index(problem) * len(self.classes)
        return self.weights[:, at : at + len(self.classes)]


def fit(
    blocks: Blocks, problems: Sequence[Problem], loss: str, tolerance: float = 1e-4, max_iter: int = 1000
) -> LinearFits:
    """All problems in shared passes; a problem that stops on the limit of its rounds warns.

    Problems that leave out a fold start at the fit of their C on all rows, if that is asked for, too.
    """
    k = len(blocks.classes)
    together = max(1, COLUMNS // k)
    width = k if loss == SOFTMAX else 1
    rdd = _unpacked(blocks).persist(StorageLevel.MEMORY_AND_DISK)
    whole = [p for p in problems if p.left_out == NONE_LEFT_OUT]
    rest = [p for p in problems if p.left_out != NONE_LEFT_OUT]
    likes: dict[float, list[_Descent]] = {}
    ends: dict[Problem, tuple] = {}
    passes = 0
    try:
        for some in (part[at : at + together] for part in (whole, rest) for at in range(0, len(part), together)):
            columns = _columns(blocks, some, loss)
            memory = min(MOST_MEMORY, max(MEMORY, MEMORY * COLUMNS // (k * len(some))))
            runs = [
                _Descent((blocks.width + 1, width), like, memory)
                for p in some
                for like in likes.get(p.c, [None] * (k // width))
            ]
            open_ = list(range(len(runs)))
            while open_:
                own = np.concatenate([np.arange(i * width, (i + 1) * width) for i in open_])
                f, g = _evaluate(rdd, columns.take(own), np.hstack([runs[i].trial for i in open_]))
                passes += 1
                left = []
                for at, i in enumerate(open_):
                    mine = slice(at * width, (at + 1) * width)
                    if not runs[i].take(f[mine].sum(), g[:, mine].copy(), tolerance) and runs[i].rounds < max_iter:
                        left.append(i)
                open_ = left
            for i, p in enumerate(some):
                own = runs[i * k // width : (i + 1) * k // width]
                ends[p] = np.hstack([r.x for r in own]), max(r.rounds for r in own), max(r.norm() for r in own)
                if p.left_out == NONE_LEFT_OUT and rest:
                    likes[p.c] = own
    finally:
        rdd.unpersist()
    weights, rounds, norms = zip(*(ends[p] for p in problems), strict=True)
    done = [n <= tolerance for n in norms]
    if not all(done):
        warnings.warn(f"{done.count(False)} fits stopped after {max_iter} rounds", stacklevel=2)
    return LinearFits(list(problems), blocks.classes, loss, np.hstack(weights), list(rounds), list(norms), done, passes)


def optimality(blocks: Blocks, fits: LinearFits) -> list[float]:
    """For every problem the gradient at its written weights, as a share of the gradient at zero."""
    rdd = _unpacked(blocks)
    k = len(blocks.classes)
    out = []
    for at in range(0, len(fits.problems), max(1, COLUMNS // k)):
        some = fits.problems[at : at + max(1, COLUMNS // k)]
        columns = _columns(blocks, some, fits.loss)
        weights = fits.weights[:, at * k : (at + len(some)) * k]
        here, zero = (_evaluate(rdd, columns, w)[1] for w in (weights, np.zeros_like(weights)))
        width = k if fits.loss == SOFTMAX else 1
        share = [
            np.linalg.norm(here[:, i : i + width]) / max(np.linalg.norm(zero[:, i : i + width]), 1e-300)
            for i in range(0, weights.shape[1], width)
        ]
        out += [max(share[i * k // width : (i + 1) * k // width]) for i in range(len(some))]
    return out


def margins(rows: DataFrame, weights: np.ndarray, *keep: str) -> DataFrame:
    """``(*keep, margins)`` of rows with ``features``: one number for each column of the weights."""
    columns = rows.select(
        *keep,
        F.transform("features", lambda e: e["idx"].cast("int")).alias("indices"),
        F.transform("features", lambda e: e["weight"].cast("double")).alias("entries"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("indices").value_lengths().to_numpy().astype(np.int64)
            ends = np.cumsum(lengths)
            out, at = [], 0
            while at < batch.num_rows:
                before = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, before + ENTRIES, "right")))
                part = batch.slice(at, to - at)
                indices, entries = (part.column(c).flatten().to_numpy() for c in ("indices", "entries"))
                z = _products(lengths[at:to], indices, entries, weights)
                out.append(z)
                at = to
            flat = np.concatenate(out).ravel() if out else np.zeros(0)
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * weights.shape[1]
            found = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], found], [*keep, "margins"])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields]
    return columns.mapInArrow(run, ", ".join([*kept, "margins array<double>"]))


def score_bayes(words: DataFrame, model: C.NaiveBayes, row_id: str, merged: bool = False) -> DataFrame:
    """``classify.score_naive_bayes`` of documents that come as ``words``, in place.

    Class scores of unit vectors are products with the weights of the model, whose size the cap of the
    vocabulary bounds; the log priors are the intercept. ``merged`` takes rows that are equal but for
    their words as one document: their sums, not their texts, are shuffled.
    """
    others = [c for c in words.columns if c not in ("words", row_id)]
    if merged and not X.by_words(model.config):
        return C.score_naive_bayes(X.words_as_terms(words, row_id, model.config, *others), model, row_id)
    terms = materialize(model.terms, "bayes-terms").toPandas()
    table = pd.DataFrame({"term": terms["term"], "idx": range(len(terms)), "idf": terms["idf"]})
    vocabulary = words.sparkSession.createDataFrame(table, "term string, idx int, idf double")
    priors = np.array(model.priors)
    weights = np.vstack([*terms["weights"], np.zeros_like(priors) if merged else priors])
    features = X.transform(words, vocabulary, row_id, model.config, unit=not merged)
    if merged:
        square = V.array_sum(F.transform("features", lambda e: e["weight"] * e["weight"]))
        sums = margins(features.withColumn("square", square), weights, row_id, *others, "square")
        places = range(len(priors))
        found = sums.groupBy(row_id, *others).agg(
            F.sqrt(F.sum("square")).alias("norm"), *[F.sum(F.col("margins")[i]).alias(f"s{i}") for i in places]
        )
        norm = F.nullif(F.col("norm"), F.lit(0.0))
        joint = [F.coalesce(F.col(f"s{i}") / norm, F.lit(0.0)) + F.lit(model.priors[i]) for i in places]
        found = found.select(row_id, *others, F.array(*joint).alias("joint"))
    else:
        found = margins(features, weights, row_id, *others).withColumnRenamed("margins", "joint")
    return C.with_prediction(found, V.softmax(F.col("joint")), model.classes, "joint")


def predictions(rows: DataFrame, fits: LinearFits, problem: Problem, *keep: str) -> DataFrame:
    """``(*keep, scores, y_pred)``: probabilities, or confidences from margins; ties go to the first class."""
    found = margins(rows, fits.of(problem), *keep)
    scores = V.softmax(F.col("margins")) if fits.loss == SOFTMAX else V.margin_confidence(F.col("margins"))
    y_pred = F.get(C.class_array(fits.classes), V.argmax(F.col("margins")))
    return found.select(*keep, scores.alias("scores"), y_pred.alias("y_pred"))


def out_of_fold(rows: DataFrame, fits: LinearFits, label: str, fold: str = "fold") -> DataFrame:
    """``(c, fold, y_true, y_pred)``: every row as predicted by the fits that left its fold out, one for each C."""
    cs = sorted({p.c for p in fits.problems})
    k = len(fits.classes)
    found = margins(rows, fits.weights, label, fold)
    mine = [
        F.struct(
            F.lit(p.c).alias("c"),
            F.lit(p.left_out).alias("left_out"),
            V.argmax(F.slice("margins", i * k + 1, k)).alias("best"),
        )
        for i, p in enumerate(fits.problems)
        if p.c in cs and p.left_out != NONE_LEFT_OUT
    ]
    rows = found.select(F.col(fold).alias("fold"), F.col(label).alias("y_true"), F.inline(F.array(*mine)))
    y_pred = F.get(C.class_array(fits.classes), F.col("best"))
    return rows.filter("left_out = fold").select("c", "fold", "y_true", y_pred.alias("y_pred"))
