"""Hard negatives by a secondary sort: rows of another label that score just below a positive.

Rows are scored against every anchor by exact integer inner products, in blocks: a
block of anchors travels to every share of the rows, and a task multiplies the two
while it reads its share. It keeps only what can still count: per anchor the best
rows of the same label, and in a second pass, with the positives known, the best rows
of another label within the window of each positive. So no task holds more than a
block of anchors with a few rows each, and what it hands on does not grow with its
share. The kept scores, packed into keys of anchor, descending score and id, are
dealt by anchor and sorted by ``repartitionAndSortWithinPartitions``; an iterator then
walks through them, opens a window at every positive and emits the negatives that fall
into open windows, without holding the rows of an anchor.

Defined results: rows with a null id or label, a null vector, a null or non-finite
component, or components so large that a product might leave the range of a long
take no part; of rows that share an id the one with the smallest label, then vector,
counts; vectors of different lengths never meet; ties go to the smaller id; a positive
without a negative in its window has no row; extra columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from docsift.sources.store import materialize

POSITIVES = 5
NEGATIVES = 5
#: A negative scores at least so many hundredths of its positive, and at most as much.
LOWEST = 80
#: Components become ``floor(SCALE * x)``.
SCALE = 256
#: Anchors that travel together, and rows of a share.
ANCHORS = 4_096
SHARE = 1 << 16
#: Rows multiplied with a block of anchors at once.
STEP = 1_024
#: Sums of products up to here are exact in floating point.
EXACT = 1 << 53
NO_SCORE = np.iinfo(np.int64).min

_KEY = ">QQBQ"
_SIGN = 1 << 63


def usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``(id, label, vector)`` of the rows that take part, one for each id."""
    vector = F.col("vector")
    bound = F.sqrt(F.lit(2.0**62) / F.greatest(F.size(vector), F.lit(1))) - 1
    fits = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double") * SCALE) <= bound, F.lit(False)))
    found = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector")
    )
    found = found.dropna().filter(F.size("vector") > 0).filter(fits)
    least = found.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("least"))
    return least.select("id", "least.label", "least.vector")


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch, which all have one length, as integers in floating point."""
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * flat).reshape(batch.num_rows, -1)


class Best:
    """The ``k`` best ``(score, id)`` of every anchor so far, ties by smaller id."""

    def __init__(self, anchors: int, k: int):
        self.scores = np.full((anchors, k), NO_SCORE, np.int64)
        self.ids = np.full((anchors, k), np.iinfo(np.int64).max, np.int64)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` of a block of rows in ascending order of ``ids``; NO_SCORE does not count."""
        k = self.ids.shape[1]
        some = np.flatnonzero((scores.max(axis=1) >= self.scores[:, -1]) & (scores.max(axis=1) > NO_SCORE))
        scores = scores[some]
        if scores.shape[1] > k:
            # larger than the k-th best, or equal to it and among the first k that are
            kth = np.partition(scores, -k, axis=1)[:, -k, None]
            equal = scores == kth
            kept = (scores > kth) | (equal & (np.cumsum(equal, axis=1) <= k))
            order = np.argsort(~kept, axis=1, kind="stable")[:, : 2 * k]
            kept = np.take_along_axis(kept, order, axis=1)
            scores = np.where(kept, np.take_along_axis(scores, order, axis=1), NO_SCORE)
            ids = np.where(kept, ids[order], np.iinfo(np.int64).max)
        else:
            ids = np.broadcast_to(ids, scores.shape)
        scores = np.concatenate([self.scores[some], scores], axis=1)
        ids = np.concatenate([self.ids[some], ids], axis=1)
        by_id = np.argsort(ids, axis=1, kind="stable")
        scores, ids = np.take_along_axis(scores, by_id, axis=1), np.take_along_axis(ids, by_id, axis=1)
        best = np.argsort(-np.maximum(scores, NO_SCORE + 1), axis=1, kind="stable")[:, :k]
        self.scores[some] = np.take_along_axis(scores, best, axis=1)
        self.ids[some] = np.take_along_axis(ids, best, axis=1)

    def rows(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(anchor, id, score)`` of all that is kept."""
        at, _ = found = np.nonzero(self.scores > NO_SCORE)
        return anchors[at], self.ids[found], self.scores[found]


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    most = max(np.abs(anchors).max(initial=0), 1) * max(np.abs(rows).max(initial=0), 1) * anchors.shape[1]
    if most < EXACT:
        return (anchors @ rows.T).astype(np.int64)
    return anchors.astype(np.int64) @ rows.astype(np.int64).T


def _meeting(rows: DataFrame, anchors: DataFrame, shares: int, blocks: int) -> DataFrame:
    """Every share of the rows behind every block of the anchors, one meeting after the other.

    ``(length, block, share, is_row, id, label, vector, scores)``, where anchors may
    bring scores. A meeting is read in this order within one partition.
    """
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    columns = ["length", "block", "share", "is_row", "id", "label", "vector", "scores"]
    none = F.lit(None).cast("array<bigint>")
    left = anchors.withColumns({"is_row": F.lit(False), "block": own(blocks)}).withColumn("share", numbers(shares))
    right = rows.withColumns({"is_row": F.lit(True), "share": own(shares), "scores": none})
    right = right.withColumn("block", numbers(blocks))
    both = left.withColumn("length", F.size("vector")).select(columns).unionByName(
        right.withColumn("length", F.size("vector")).select(columns)
    )
    key = ["length", "block", "share"]
    return both.repartition(max(shares * blocks, 1), *key).sortWithinPartitions(*key, "is_row", "id")


class _Meeting:
    """The anchors of one meeting, and what is kept for them."""

    def __init__(self, width: int, windows: int):
        self.parts: list[tuple] = []
        self.width, self.windows = width, windows
        self.ready = False

    def add(self, batch: pa.RecordBatch) -> None:
        scores = [(s or []) + [None] * (self.windows - len(s or [])) for s in batch.column("scores").to_pylist()]
        table = np.array([[NO_SCORE if x is None else x for x in s] for s in scores], np.int64)
        table = table.reshape(batch.num_rows, self.windows)
        self.parts.append((batch.column("id").to_numpy(), batch.column("label").to_numpy(), matrix(batch), table))

    def start(self) -> None:
        self.ready = True
        self.ids, self.labels, self.vectors, self.tops = (
            np.concatenate([p[i] for p in self.parts]) if self.parts else np.zeros(0) for i in range(4)
        )
        self.best = [Best(len(self.ids), self.width) for _ in range(max(self.windows, 1))]

    def meet(self, batch: pa.RecordBatch, lowest: int) -> None:
        if not self.ready:
            self.start()
        if not len(self.ids):
            return
        all_ids, all_labels, all_rows = batch.column("id").to_numpy(), batch.column("label").to_numpy(), matrix(batch)
        for at in range(0, len(all_ids), STEP):
            ids, labels = all_ids[at : at + STEP], all_labels[at : at + STEP]
            scores = products(self.vectors, all_rows[at : at + STEP])
            same = self.labels[:, None] == labels
            if not self.windows:
                same &= self.ids[:, None] != ids
                self.best[0].offer(np.where(same, scores, NO_SCORE), ids)
                continue
            for w, best in enumerate(self.best):
                top = self.tops[:, w, None]
                low = lowest * (top // 100) - (-lowest * (top % 100)) // 100  # rounded up
                inside = ~same & (top >= 0) & (scores <= top) & (scores >= low)
                best.offer(np.where(inside, scores, NO_SCORE), ids)

    def rows(self) -> pa.RecordBatch:
        if not self.ready:
            self.start()
        found = [b.rows(self.ids) for b in self.best]
        columns = np.stack([np.concatenate([f[i] for f in found]) for i in range(3)]).astype(np.int64)
        columns = np.unique(columns, axis=1)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "id", "score"])


def _kept(
    rows: DataFrame, anchors: DataFrame, shares: int, blocks: int, width: int, windows: int, lowest: int
) -> DataFrame:
    """``(anchor, id, score)`` that every share keeps for every anchor.

    Without windows the best rows of the anchor's label; else those of another
    label in the window below each of the anchor's ``scores``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = meeting = None
        for batch in batches:
            parts = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "block", "share", "is_row"))
            keys = np.stack([p.astype(np.int64) for p in parts])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                if a == b:
                    continue
                if key != (now := tuple(keys[:3, a])):
                    if meeting is not None:
                        yield meeting.rows()
                    key, meeting = now, _Meeting(width, windows)
                part = batch.slice(a, b - a)
                if keys[3, a]:
                    meeting.meet(part, lowest)
                else:
                    meeting.add(part)
        if meeting is not None:
            yield meeting.rows()

    return _meeting(rows, anchors, shares, blocks).mapInArrow(run, "anchor long, id long, score long")


def pack(anchor: int, score: int, negative: int, row_id: int) -> bytes:
    """A key whose bytes order by anchor, descending score, positives first, id."""
    return struct.pack(_KEY, anchor + _SIGN, _SIGN - 1 - score, negative, row_id + _SIGN)


def unpack(key: bytes) -> tuple[int, int, int, int]:
    anchor, score, negative, row_id = struct.unpack(_KEY, key)
    return anchor - _SIGN, _SIGN - 1 - score, negative, row_id - _SIGN


def walk(keys: Iterator[bytes], positives: int, negatives: int, lowest: int) -> Iterator[tuple]:
    """``(anchor, positive, rank, negative, positive score, negative score)`` of keys in order.

    Holds the open windows of one anchor: positive, its score, negatives so far.
    """
    current, opened, windows = None, 0, []
    for key in keys:
        anchor, score, negative, row_id = unpack(key)
        if anchor != current:
            current, opened, windows = anchor, 0, []
        if not negative:
            if opened < positives:
                windows.append([row_id, score, 0])
                opened += 1
            continue
        windows = [w for w in windows if w[2] < negatives and lowest * w[1] <= 100 * score]
        for window in windows:
            if score <= window[1]:
                window[2] += 1
                yield anchor, window[0], window[2], row_id, window[1], score


def mine(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    share: int = SHARE,
    anchors_of_block: int = ANCHORS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``is_anchor`` is a condition on ``id`` and ``label``. A positive is one of an
    anchor's first rows of the same label; its negatives are the first rows of
    another label with ``lowest * positive <= 100 * negative <= 100 * positive``.
    """
    spark = rows.sparkSession
    rows = materialize(usable(rows, id_col, vector_col, label_col), "scored-rows")
    counts = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(is_anchor).alias("anchors")).first()
    shares = max(spark.sparkContext.defaultParallelism, -(-counts["rows"] // share))
    blocks = max(1, -(-counts["anchors"] // anchors_of_block))
    anchors = rows.filter(is_anchor)
    no_scores = anchors.withColumn("scores", F.lit(None).cast("array<bigint>"))
    near = _kept(rows, no_scores, shares, blocks, positives, 0, lowest)
    place = F.row_number().over(W.partitionBy("anchor").orderBy(F.desc("score"), "id"))
    chosen = materialize(near.withColumn("place", place).filter(F.col("place") <= positives), "positives")
    scores = F.sort_array(F.collect_list("score"), asc=False).alias("scores")
    known = anchors.join(chosen.groupBy(F.col("anchor").alias("id")).agg(scores), "id")
    far = _kept(rows, known, shares, blocks, negatives, positives, lowest)
    opened = chosen.select("anchor", "id", "score", F.lit(0).alias("negative"))
    scored = opened.unionByName(far.withColumn("negative", F.lit(1)))
    keys = scored.select("anchor", "score", "negative", "id").rdd.map(lambda r: (pack(*r), None))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = keys.repartitionAndSortWithinPartitions(parts, lambda key: crc32(key[:8]))
    emitted = dealt.mapPartitions(lambda held: walk((key for key, _ in held), positives, negatives, lowest))
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    schema = StructType([StructField(n, LongType(), False) for n in names])
    found = spark.createDataFrame(emitted, schema)
    return found.withColumn("rank", F.col("rank").cast("int"))
