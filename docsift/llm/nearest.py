"""Nearest vectors by inner product: a forest of random-projection trees and exact reranking.

Vectors lie on a sphere after one more component has taken up what their length
lacks of the longest one, so the largest inner product is the smallest distance. The
trees split at the median along the difference of two points of a bounded sample.
Every vector is indexed: it goes to its leaf in each tree. A query walks through all
trees with one priority queue, ordered by the squared distances to the planes on
whose far side a subtree lies, until these exceed what the distance to its nearest
sample points makes likely; it is then compared exactly with all vectors of its leaves.

Equal vectors fold into one node with their first ids, and so do equal queries, so
copies cost nothing. Leaves next to each other form a group of bounded size, larger
ones are cut into parts, and each group meets its queries in one stream.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do those whose length is not the most frequent one; a
query's own vectors are those with its id; rows equal in id and vector count once;
rows without id are no queries and no candidates; ties go to the smaller id; fewer
than ``k`` candidates are all returned; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docsift.llm.common import join_lookup
from docsift.sources.store import materialize

K = 20
TREES = 6
#: Vectors that fit the trees; they also tell how far a query's neighbours lie.
SAMPLE = 20_000
#: Nodes a leaf should hold, and leaves of a tree at most.
LEAF = 256
LEAVES = 4_096
#: How far a query looks: squared distance to planes for each level, in variances of a neighbour's offset.
REACH = 0.1
#: Nodes of a cell at most; few large cells, because each one hands on its best of every query it meets.
GROUP = 1 << 16
#: Queries led to their leaves at once, scores held at once, and rows handed on at once.
QUERIES = 256
SCORES = 1 << 22
ROWS_OUT = 4_096
#: Answers that may be broadcast to their queries.
LISTS = 20_000
SEED = 20_240_611


@dataclass(frozen=True)
class Forest:
    """Complete trees in heap order: plane ``i`` has the children ``2 i`` and ``2 i + 1``."""

    planes: np.ndarray
    offsets: np.ndarray
    sample: np.ndarray
    longest: float
    leaves: int
    near: int

    @property
    def trees(self) -> int:
        return len(self.planes)

    @property
    def depth(self) -> int:
        return self.leaves.bit_length() - 1

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """Points of the unit sphere; a vector keeps its direction within the first components."""
        scaled = vectors / self.longest
        rest = 1 - (scaled * scaled).sum(axis=1, keepdims=True)
        return np.concatenate([scaled, np.sqrt(np.maximum(rest, 0))], axis=1)

    def leaf(self, points: np.ndarray, tree: int) -> np.ndarray:
        node = np.ones(len(points), np.int64)
        for _ in range(self.depth):
            side = np.einsum("ij,ij->i", points, self.planes[tree, node]) > self.offsets[tree, node]
            node = 2 * node + side
        return node - self.leaves

    def reach(self, queries: np.ndarray, own: np.ndarray, reach: float) -> np.ndarray:
        """The limit of every query, from the distance to its nearest other sample points.

        ``own`` is what a query would score with itself.
        """
        near = queries @ self.sample.T
        near[np.abs(near - own[:, None]) < 1e-9] = -1.0
        k = min(self.near, near.shape[1])
        nearest = np.partition(near, -k, axis=1)[:, -k]
        return reach * self.depth * (2 - 2 * nearest) / queries.shape[1]

    def search(self, margins: np.ndarray, limit: float, sizes: np.ndarray, least: int) -> dict[int, list[int]]:
        """Leaves of every tree within the limit, and more until one tree gives ``least`` nodes."""
        heap = [(0.0, tree, 1) for tree in range(len(margins))]
        found: dict[int, list[int]] = {tree: [] for tree in range(len(margins))}
        held = [0] * len(margins)
        enough = False
        while heap:
            cost, tree, node = heapq.heappop(heap)
            if cost > limit and enough:
                break
            if node >= self.leaves:
                found[tree].append(node - self.leaves)
                held[tree] += int(sizes[tree, node - self.leaves])
                enough = enough or held[tree] >= least
                continue
            margin = margins[tree][node]
            far = cost + margin * margin
            heapq.heappush(heap, (far if margin > 0 else cost, tree, 2 * node))
            heapq.heappush(heap, (cost if margin > 0 else far, tree, 2 * node + 1))
        return found


def fit(sample: np.ndarray, nodes: int, longest: float, trees: int = TREES, k: int = K, leaf: int = LEAF) -> Forest:
    """Trees over a sample of ``nodes`` vectors; their depth follows the number of all of them."""
    random = np.random.default_rng(SEED)
    leaves = 1
    while leaves < LEAVES and leaves * 2 * leaf <= nodes:
        leaves *= 2
    trees = trees if leaves > 1 else 1
    near = max(1, round(k * len(sample) / max(nodes, 1)))
    width = sample.shape[1] + 1
    forest = Forest(
        np.zeros((trees, leaves, width)), np.zeros((trees, leaves)), np.zeros((0, width)), longest, leaves, near
    )
    points = forest.lifted(sample)
    for tree in range(trees):
        groups = {1: np.arange(len(points))}
        for node in range(1, leaves):
            held = groups.pop(node)
            plane = random.standard_normal(width)
            if len(held) > 1:
                first, second = points[random.choice(held, 2, replace=False)]
                if (first != second).any():
                    plane = first - second
            plane /= np.linalg.norm(plane)
            along = points[held] @ plane
            offset = float(np.median(along)) if len(held) else 0.0
            forest.planes[tree, node], forest.offsets[tree, node] = plane, offset
            groups[2 * node], groups[2 * node + 1] = held[along <= offset], held[along > offset]
    return Forest(forest.planes, forest.offsets, points, longest, leaves, near)


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(batch.num_rows, -1)


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, vector, node)`` of the rows that take part; equal vectors are one node."""
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    zero = F.forall("vector", lambda x: x.cast("double") == 0)
    vectors = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).dropna()
    node = F.struct(F.xxhash64("vector").alias("x"), F.xxhash64(F.lit(SEED), "vector").alias("y"))
    return vectors.filter(finite & ~zero).withColumn("node", node)


def folded(vectors: DataFrame, ids: int) -> DataFrame:
    """``(node, vector, first, ids)``: every distinct vector with its ``ids`` smallest ids, in order.

    Only ids, not vectors, are ranked, so the copies of a vector do not meet.
    """
    place = F.row_number().over(W.partitionBy("node").orderBy("id"))
    few = vectors.select("node", "id").distinct().withColumn("place", place).filter(F.col("place") <= ids)
    few = few.groupBy("node").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    found = vectors.groupBy("node").agg(F.first("vector").alias("vector")).join(few, "node")
    return found.select("node", "vector", F.col("ids")[0].alias("first"), "ids")


@dataclass(frozen=True)
class Cells:
    """Leaves next to each other in a tree form a cell of bounded size; the nodes of a larger leaf are dealt into parts."""

    numbers: np.ndarray
    parts: np.ndarray

    @classmethod
    def of_sizes(cls, sizes: np.ndarray, group: int) -> Cells:
        numbers, parts = np.zeros(sizes.shape, np.int64), []
        for tree, row in enumerate(sizes.tolist()):
            held = group + 1
            for leaf, size in enumerate(row):
                if held + size > group:
                    held = 0
                    parts.append(1)
                held += size
                numbers[tree, leaf] = len(parts) - 1
                parts[-1] = max(1, -(-held // group))
        return cls(numbers, np.array(parts, np.int64))

    def of(self, tree: int, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = self.numbers[tree, leaves]
        return own, self.parts[own]


def _probing(forest: Forest, cells: Cells, sizes: np.ndarray, reach: float, least: int):
    """From queries to one row for each cell that holds leaves of theirs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, QUERIES):
                batch = whole.slice(at, QUERIES)
                vectors = matrix(batch)
                length = np.linalg.norm(vectors, axis=1)
                points = np.zeros((len(vectors), vectors.shape[1] + 1))
                points[:, :-1] = vectors / length[:, None]
                limits = forest.reach(points, length / forest.longest, reach)
                margins = np.einsum("qd,tnd->qtn", points, forest.planes, optimize=True) - forest.offsets
                asked, found, leaves = [], [], []
                for i, limit in enumerate(limits):
                    for tree, some in forest.search(margins[i], limit, sizes, least).items():
                        some = np.sort(np.array(some, np.int32))
                        own = cells.numbers[tree, some]
                        for a, b in zip(*runs_of(own[None, :]), strict=True):
                            asked.append(i)
                            found.append(int(own[a]))
                            leaves.append(some[a:b])
                    if len(asked) >= ROWS_OUT or i + 1 == len(limits):
                        columns = [c.take(pa.array(asked, pa.int64())) for c in batch.columns]
                        columns += [pa.array(found, pa.int32()), pa.array(cells.parts[found], pa.int32())]
                        columns.append(pa.array(leaves, pa.list_(pa.int32())))
                        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "cell", "parts", "leaves"])
                        asked, found, leaves = [], [], []

    return run


def runs_of(keys: np.ndarray) -> tuple[list[int], list[int]]:
    """Starts and ends of the runs of equal columns."""
    if not keys.shape[1]:
        return [], []
    cuts = (np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()
    return [0, *cuts], [*cuts, keys.shape[1]]


def _best(queries: np.ndarray, points: np.ndarray, scores: np.ndarray, first: np.ndarray, keep: int):
    """``(query, point, score)`` of the best points of every query; scores are summed anew in one order."""
    keep = min(keep, scores.shape[1])
    kth = np.partition(scores, -keep, axis=1)[:, -keep]
    size = np.abs(kth, where=np.isfinite(kth), out=np.zeros(len(kth)))
    q, p = np.nonzero((scores >= (kth - 1e-9 * (1 + size))[:, None]) & (scores > -np.inf))
    exact = np.zeros(len(q))
    for a in range(0, len(q), ROWS_OUT):
        b = slice(a, a + ROWS_OUT)
        exact[b] = np.cumsum(queries[q[b]] * points[p[b]], axis=1)[:, -1]
    order = np.lexsort((first[p], -exact, q))
    q, p, exact = q[order], p[order], exact[order]
    place = np.arange(len(q)) - np.searchsorted(q, q, "left")
    kept = place < keep
    return q[kept], p[kept], exact[kept]


def _compared(meetings: DataFrame, keep: int) -> DataFrame:
    """``(query, node, first, score)`` from streams of the points of a cell, leaf by leaf, and then its queries."""

    def table(parts: list[pa.RecordBatch]) -> tuple:
        whole = pa.Table.from_batches(parts)
        leaf, first = (whole.column(c).to_numpy() for c in ("leaf", "first"))
        return leaf, first, whole.column("node").combine_chunks(), np.concatenate([matrix(p) for p in parts])

    def answers(batch: pa.RecordBatch, leaf, first, nodes, vectors) -> Iterator[pa.RecordBatch]:
        step = max(1, SCORES // len(leaf))
        for at in range(0, batch.num_rows, step):
            some = batch.slice(at, step)
            asked = matrix(some)
            leaves = some.column("leaves")
            where = np.repeat(np.arange(some.num_rows), leaves.value_lengths().to_numpy())
            wanted = leaves.flatten().to_numpy()
            order = np.argsort(wanted, kind="stable")
            where, wanted = where[order], wanted[order]
            scores = np.full((some.num_rows, len(leaf)), -np.inf)
            for a, b in zip(*runs_of(wanted[None, :]), strict=True):
                low, high = np.searchsorted(leaf, [wanted[a], wanted[a] + 1])
                scores[where[a:b], low:high] = asked[where[a:b]] @ vectors[low:high].T
            q, p, score = _best(asked, vectors, scores, first, keep)
            found = [some.column("node").take(pa.array(q)), nodes.take(pa.array(p)), pa.array(first[p]), pa.array(score)]
            yield pa.RecordBatch.from_arrays(found, ["query", "node", "first", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, points = None, [], None
        for batch in batches:
            columns = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "part", "is_query"))
            keys = np.stack([c.astype(np.int64) for c in columns])
            for a, b in zip(*runs_of(keys), strict=True):
                part = batch.slice(a, b - a)
                if key != (now := tuple(keys[:2, a])):
                    key, parts, points = now, [], None
                if not keys[2, a]:
                    parts.append(part)
                elif parts:
                    points = points or table(parts)
                    yield from answers(part, *points)

    node = "struct<x: bigint, y: bigint>"
    return meetings.mapInArrow(run, f"query {node}, node {node}, first long, score double")


def nearest(
    rows: DataFrame,
    queries: DataFrame,
    k: int = K,
    trees: int = TREES,
    reach: float = REACH,
    sample: int = SAMPLE,
    leaf: int = LEAF,
    group: int = GROUP,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best rows found for every query, ranks from 1."""
    spark = rows.sparkSession
    keep = k + 1  # the query's own vector may be among them
    nodes = materialize(folded(usable(rows, id_col, vector_col), keep), "nodes")
    most = nodes.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    fits = F.size("vector") == most["n"]
    nodes = nodes.filter(fits)
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    count, longest = nodes.agg(F.count(F.lit(1)), F.sqrt(F.max(square))).first()
    drawn = nodes.orderBy(F.xxhash64("node"), "node").limit(sample).select("vector").toArrow()
    drawn = np.concatenate([matrix(b) for b in drawn.to_batches() if b.num_rows])
    forest = fit(drawn, count, longest * (1 + 1e-12), trees, k, leaf)
    vector = nodes.schema["vector"].dataType.simpleString()
    head = f"node struct<x: bigint, y: bigint>, vector {vector}"

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = forest.lifted(matrix(batch))
            for tree in range(forest.trees):
                own = forest.leaf(points, tree)
                at = np.stack([np.full(len(own), tree), own, *(cells.of(tree, own) if cells else ())])
                columns = [*batch.columns, *(pa.array(a, pa.int32()) for a in at)]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "tree", "leaf", "cell", "parts"][: len(columns)])

    cells = None
    sizes = np.zeros((forest.trees, forest.leaves), np.int64)
    counted = nodes.select("vector").mapInArrow(assign, f"vector {vector}, tree int, leaf int")
    for row in counted.groupBy("tree", "leaf").count().collect():  # at most trees times leaves
        sizes[row["tree"], row["leaf"]] = row["count"]
    tasks = spark.sparkContext.defaultParallelism
    cells = Cells.of_sizes(sizes, min(group, max(forest.trees * count // tasks, leaf)))
    indexed = nodes.select("node", "vector", "first").mapInArrow(
        assign, f"{head}, first long, tree int, leaf int, cell int, parts int"
    )
    points = indexed.withColumns(
        {
            "part": F.pmod(F.col("node.x"), F.col("parts")).cast("int"),
            "is_query": F.lit(False),
            "leaves": F.lit(None).cast("array<int>"),
        }
    )

    asked = usable(queries, id_col, vector_col).filter(fits)
    probes = asked.groupBy("node").agg(F.first("vector").alias("vector")).mapInArrow(
        _probing(forest, cells, sizes, reach, keep), f"{head}, cell int, parts int, leaves array<int>"
    )
    probes = probes.withColumns(
        {
            "part": F.explode(F.sequence(F.lit(0), F.col("parts") - 1)),
            "is_query": F.lit(True),
            "leaf": F.lit(None).cast("int"),
            "first": F.lit(None).cast("long"),
        }
    )
    names = ["cell", "part", "is_query", "leaf", "node", "vector", "first", "leaves"]
    both = points.select(names).unionByName(probes.select(names))
    meetings = both.repartition(int(cells.parts.sum()), "cell", "part")
    meetings = meetings.sortWithinPartitions("cell", "part", "is_query", "leaf")

    # a pair that met in several trees has the same score in each and takes one place
    place = F.dense_rank().over(W.partitionBy("query").orderBy(F.desc("score"), "first", "node"))
    near = _compared(meetings, keep).withColumn("place", place).filter(F.col("place") <= keep)
    near = near.select("query", "node", "score").distinct()
    members = near.join(nodes.select("node", "ids"), "node").select("query", "score", F.explode("ids").alias("vec_id"))
    place = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    members = members.withColumn("place", place).filter(F.col("place") <= keep)
    lists = members.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("list"))
    ids = asked.select(F.col("node").alias("query"), F.col("id").alias("query_id")).distinct()
    answers = join_lookup(ids, materialize(lists, "lists"), "query", LISTS)
    others = F.slice(F.filter("list", lambda m: m["vec_id"] != F.col("query_id")), 1, k)
    ranked = answers.select("query_id", F.posexplode(others).alias("at", "found"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), "found.vec_id", "found.score")
