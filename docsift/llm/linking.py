"""From signatures to classes of near-duplicates, without a pass over all pairs of a group.

Equal texts fold into one node. Nodes that share a band of their signatures meet
in a bucket. The node that sees most others in its buckets is the centre of each:
every node is compared with its centres, exactly, on the whole texts, which joins
most copies at a cost of a few comparisons each. In the buckets that still hold
several components, what lies outside the largest one is compared with the rest by
sketches, in blocks of a fixed size inside a task; only pairs whose sketches agree
nearly as often as the wanted similarity go on to the exact comparison. A sketch
keeps one bit of each component of a long signature, made for these nodes only.
No bucket is capped or left out. Classes are the connected components of the links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import free_name, text_or_empty, texts
from docsift.llm.words import mixed
from docsift.sources.store import broadcast_within, materialize

#: Nodes of a bucket in a block, and blocks that ask the same block in one task.
BLOCK = 1_024
TURN = 8
#: Pairs with the same centre that are compared in one task.
PAIRS = 256
#: Wanted nodes up to which they are sent to the texts; beyond, the texts are sent to them.
WANTED = 300_000
#: Standard deviations by which the agreement of sketches may lie below the wanted similarity:
#: a pair just at that similarity is passed over in 2 of 10,000 cases.
DEVIATIONS = 3.6
NODE_BYTES = 16


def text_node(text_col: str) -> Column:
    """Identity of a text; null is the empty text."""
    return F.unhex(F.md5(text_or_empty(text_col)))


def sketch_bits(kept: np.ndarray) -> bytes:
    """One bit of each component of a signature; where components differ, the bits agree by half."""
    step = np.arange(1, len(kept) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return np.packbits((mixed(kept ^ step) & np.uint64(1)).astype(np.uint8)).tobytes()


def signed(
    documents: DataFrame, sign: Callable[[], Callable[[str], np.ndarray]], id_col: str, text_col: str
) -> DataFrame:
    """``(doc_id, node, bands)`` of every whole text, in one Arrow pass."""
    rows = documents.select(
        F.col(id_col).alias("doc_id"), text_node(text_col).alias("node"), F.col(text_col).alias("text")
    )
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands_of = sign()
        for batch in batches:
            bands = pa.array([bands_of(t) for t in texts(batch, "text")], pa.list_(pa.int64()))
            out = [batch.column("doc_id"), batch.column("node"), bands]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "node", "bands"])

    return rows.mapInArrow(run, f"doc_id {id_type}, node binary, bands array<bigint>")


def _sketched(node_texts: DataFrame, sketch: Callable[[], Callable[[str], bytes]]) -> DataFrame:
    """``(node, sketch)`` of whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch_of = sketch()
        for batch in batches:
            found = pa.array([sketch_of(t) for t in texts(batch, "text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("node"), found], ["node", "sketch"])

    return node_texts.select("node", "text").mapInArrow(run, "node binary, sketch binary")


def _measured(pairs: DataFrame, node_texts: DataFrame, profile: Callable, similarity: Callable) -> DataFrame:
    """``(a, b, far)``: one minus the similarity of the two whole texts of every pair.

    The pairs of an ``a`` are dealt into turns of bounded number. A turn is read as a
    stream, the text of ``a`` first, so that text moves once for a turn, not for a pair.
    """
    pairs = materialize(pairs, "pairs")
    counts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PAIRS).cast("int").alias("turns"))
    turned = pairs.join(counts, "a").withColumn("turn", F.pmod(F.xxhash64("b"), F.col("turns")).cast("int"))
    names = ["a", "turn", "is_b", "node", "text"]
    text_b = turned.join(node_texts.select(F.col("node").alias("b"), "text"), "b").withColumn("is_b", F.lit(True))
    text_a = counts.join(node_texts.select(F.col("node").alias("a"), "text"), "a").withColumns(
        {"turn": F.explode(F.sequence(F.lit(0), F.col("turns") - 1)), "is_b": F.lit(False), "node": F.col("a")}
    )
    met = text_b.withColumnRenamed("b", "node").select(names).unionByName(text_a.select(names))
    met = met.repartition("a", "turn").sortWithinPartitions("a", "turn", "is_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiled, first = profile(), None
        for batch in batches:
            a, b, far = [], [], []
            columns = (batch.column(c).to_pylist() for c in ("a", "is_b", "node"))
            for centre, is_b, node, text in zip(*columns, texts(batch, "text"), strict=True):
                if not is_b:
                    first = profiled(text)
                    continue
                a.append(min(centre, node))
                b.append(max(centre, node))
                far.append(1 - similarity(first, profiled(text)))
            out = [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(far, pa.float64())]
            yield pa.RecordBatch.from_arrays(out, ["a", "b", "far"])

    return met.mapInArrow(run, "a binary, b binary, far double").dropDuplicates(["a", "b"])


def _parted(rooted: DataFrame) -> DataFrame:
    """``(key, largest, n)``: largest component and nodes of every bucket that holds several components."""
    sizes = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = F.max(F.struct("n", "root"))["root"].alias("largest")
    sizes = sizes.groupBy("key").agg(largest, F.count(F.lit(1)).alias("parts"), F.sum("n").alias("n"))
    return sizes.filter("parts > 1").drop("parts")


def _agreeing(parted: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """``(a, b)``: pairs of a bucket in different components whose sketches agree often enough.

    All buckets that two such nodes share are among these; the one with the smallest key returns the pair.
    """
    keys = parted.groupBy("node").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    rows = parted.join(sketches, "node").join(keys, "node").select(
        "key",
        F.struct(F.concat("node", "root", "sketch").alias("held"), "keys").alias("packed"),
        (F.col("root") != F.col("largest")).alias("outside"),
        F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / BLOCK)).alias("block"),
    )
    inside = rows.groupBy("key", "block").agg(F.collect_list("packed").alias("others"))
    outside = rows.filter("outside").groupBy("key", F.col("block").alias("outer"))
    outside = outside.agg(F.collect_list("packed").alias("asked"))
    # pairs of blocks are dealt by bucket, block and a bounded number of blocks that ask
    turn = F.floor(F.col("outer") / TURN).alias("turn")
    turns = rows.filter("outside").select("key", F.floor(F.col("block") / TURN).alias("turn")).distinct()
    inside = inside.join(turns, "key")
    blocks = rows.select("key", "block").distinct()
    asking = blocks.join(rows.filter("outside").select("key", F.col("block").alias("outer")).distinct(), "key")
    met = asking.join(outside, ["key", "outer"]).select("key", "block", turn, "asked")
    met = met.join(inside, ["key", "block", "turn"]).select("key", "asked", "others")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def unpack(rows: list[dict]):
            packed = [r["held"] for r in rows]
            table = np.frombuffer(b"".join(packed), np.uint64).reshape(len(packed), -1)
            nodes, roots = [p[:NODE_BYTES] for p in packed], [p[NODE_BYTES : 2 * NODE_BYTES] for p in packed]
            return nodes, roots, table[:, 4:], [r["keys"] for r in rows]

        for batch in batches:
            a, b = [], []
            for row in range(batch.num_rows):
                key = batch.column("key")[row].as_py()
                nodes, roots, table, keys = unpack(batch.column("others")[row].as_py())
                asked_nodes, asked_roots, asked_table, asked_keys = unpack(batch.column("asked")[row].as_py())
                outer = set(asked_nodes)
                bits, agree = 64 * table.shape[1], (1 + least) / 2
                unlike = bits * (1 - agree + DEVIATIONS * (agree * (1 - agree) / bits) ** 0.5)
                for node, root, sketch, own in zip(asked_nodes, asked_roots, asked_table, asked_keys, strict=True):
                    shared = {k for k in own if k < key}
                    differ = np.bitwise_count(table ^ sketch).sum(axis=1, dtype=np.int64)
                    for i in np.flatnonzero(differ <= unlike).tolist():
                        if roots[i] == root or (nodes[i] in outer and nodes[i] < node):
                            continue
                        if not shared.isdisjoint(keys[i]):
                            continue  # a bucket with a smaller key returns the pair
                        a.append(min(node, nodes[i]))
                        b.append(max(node, nodes[i]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return met.mapInArrow(run, "a binary, b binary").distinct()


def links(
    buckets: DataFrame,
    node_texts: DataFrame,
    sketch: Callable[[], Callable[[str], bytes]],
    profile: Callable,
    similarity: Callable,
    least: float,
) -> DataFrame:
    """``(a, b)``: links that connect all nodes which links within buckets connect.

    ``buckets`` has ``(key, node, n)`` with the number of nodes of the bucket.
    """
    near = F.col("far") <= F.lit(1 - least + 1e-9)
    seen = buckets.groupBy("node").agg(F.sum("n").alias("seen"))
    ranked = materialize(buckets.join(seen, "node"), "ranked")
    centres = ranked.groupBy("key").agg(F.max(F.struct("seen", "node"))["node"].alias("centre"))
    met = ranked.join(centres, "key").filter("node <> centre")
    pairs = met.select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    first = materialize(_measured(pairs, node_texts, profile, similarity), "measured")
    roots = components(first.filter(near))
    rooted = ranked.select("key", "node").join(roots, "node", "left")
    rooted = materialize(rooted.withColumn("root", F.coalesce("root", "node")), "rooted")
    parted = materialize(rooted.join(_parted(rooted), "key"), "parted")
    # a few texts are much work: a fixed number of partitions, which are not merged for their few bytes; by
    # another value than the node, or the join would pass as this repartition and be merged
    parts = int(parted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    apart = node_texts.join(parted.select("node").distinct(), "node").repartition(parts, F.xxhash64("node"))
    sketches = materialize(_sketched(apart, sketch), "sketches")
    pairs = _agreeing(parted, sketches, least).join(first, ["a", "b"], "left_anti")
    second = materialize(_measured(pairs, node_texts, profile, similarity), "measured")
    return first.unionAll(second).filter(near).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node with an edge; the root is the smallest node of its component.

    Every round points neighbours at the smallest node they know, larger ones
    first, then smaller ones, until nothing changes: a number of rounds that
    grows with the logarithm of the component, each written to shared storage.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = materialize(edges.filter("u <> v").distinct(), "edges")
    mark = _mark(edges)
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), "larger")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = materialize(small.unionAll(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def near_classes(
    documents: DataFrame,
    members: DataFrame,
    sketch: Callable[[], Callable[[str], bytes]],
    profile: Callable[[], Callable],
    similarity: Callable,
    least: float,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, node, class_id, first_node)`` of every document.

    ``members`` is the written ``(doc_id, node, bands)`` of every document. ``class_id``
    is the smallest id of the class, ``first_node`` the text it stands for. ``sketch``
    and ``profile`` make the functions from text to a sketch, and to what
    ``similarity`` compares. Only texts of nodes that share a bucket move.
    """
    nodes = members.groupBy("node").agg(F.min("doc_id").alias("first"), F.first("bands").alias("bands"))
    nodes = materialize(nodes, "nodes")
    buckets = nodes.select("node", F.explode("bands").alias("key"))
    many = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    buckets = materialize(buckets.join(many, "key"), "buckets")
    wanted = buckets.select("node").distinct().join(nodes.select("node", "first"), "node")
    wanted = broadcast_within(materialize(wanted, "wanted"), WANTED)
    of_text = documents.select(
        F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"), text_node(text_col).alias("id")
    )
    same = (F.col("id") == F.col("node")) & F.col("doc_id").eqNullSafe(F.col("first"))
    node_texts = of_text.join(wanted, same).dropDuplicates(["id", "doc_id"]).select("node", "text")
    node_texts = materialize(node_texts, "texts")
    found = components(links(buckets, node_texts, sketch, profile, similarity, least))
    rooted = nodes.select("node", "first").join(found, "node", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "node"))
    firsts = rooted.groupBy("root").agg(F.min(F.struct(F.col("first").isNull(), "first", "node")).alias("least"))
    of_node = rooted.select("node", "root").join(firsts, "root")
    of_node = of_node.select("node", F.col("least.first").alias("class_id"), F.col("least.node").alias("first_node"))
    return members.select("doc_id", "node").join(of_node, "node").select("doc_id", "node", "class_id", "first_node")


def keep_first(
    documents: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of every class, with all its columns: the one with the smallest id."""
    node = free_name(documents.columns, "node")
    names = {x: free_name(documents.columns, f"first_{x}") for x in ("id", "text")}
    first = classes.filter(
        F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("node") == F.col("first_node"))
    )
    first = first.select(F.col("doc_id").alias(names["id"]), F.col("node").alias(names["text"])).distinct()
    rows = documents.withColumn(node, text_node(text_col))
    same = (rows[node] == first[names["text"]]) & rows[id_col].eqNullSafe(first[names["id"]])
    return rows.join(first, same).dropDuplicates([node, id_col]).select(*documents.columns)
