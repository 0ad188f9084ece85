"""Document fingerprints: MinHash signatures over word shingles in numpy.

``PERMUTATIONS`` universal hash functions (multiply, add, keep the high bits) map
the shingles of a text; the smallest value under each makes up the fingerprint.
The share of equal values estimates the Jaccard similarity of two texts. Bands of
signatures joined in Spark and verified by exact Jaccard give near-duplicates.

Defined results: null text counts as empty; texts without words share one
fingerprint, that of no shingle; equal texts have equal fingerprints; rows with
equal ids follow each other by a hash of the text, rows without id come first;
a single document is its own neighbour.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docsift.llm.common import text_or_empty, texts
from docsift.llm.linking import near_classes, sketch_bits, text_node
from docsift.llm.neardup import SKETCH, band_keys
from docsift.llm.words import WordHasher, plain_bytes, shingles
from docsift.sources.store import materialize

SIZE = 5
LEAST = 0.8
PERMUTATIONS = 64
BANDS = 16
SEED = 20_240_601
#: Shingles hashed at once, so that a block stays in the processor's cache.
BLOCK = 512
#: Rows a task holds back before it hands them on.
ROWS_OUT = 1_024
#: Kinds of rows of the neighbour pass.
DONE, HEAD, TAIL = 0, 1, 2


class Fingerprinter:
    def __init__(self, size: int = SIZE, permutations: int = PERMUTATIONS, seed: int = SEED):
        random = np.random.default_rng(seed)
        top = np.iinfo(np.uint64).max
        self.factor = random.integers(0, top, permutations, np.uint64, endpoint=True)[:, None] | np.uint64(1)
        self.offset = random.integers(0, top, permutations, np.uint64, endpoint=True)[:, None]
        self.size, self.hasher = size, WordHasher()

    def shingles(self, text: str) -> np.ndarray:
        data = plain_bytes(text)
        return shingles(self.hasher.words(data, data != 32), self.size)

    def signature(self, text: str) -> np.ndarray:
        """Smallest 32-bit hash under every permutation."""
        least = np.full(len(self.factor), np.iinfo(np.uint64).max, np.uint64)
        found = self.shingles(text)
        for at in range(0, len(found), BLOCK):
            values = self.factor * found[at : at + BLOCK] + self.offset
            np.minimum(least, values.min(axis=1), out=least)
        return (least >> np.uint64(32)).astype(">u4")


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    return float((x == y).mean())


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many, or all, of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, node, fingerprint)`` of every whole text as binary; no shuffle."""
    rows = documents.select(
        F.col(id_col).alias("doc_id"), text_node(text_col).alias("node"), F.col(text_col).alias("text")
    )
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Fingerprinter()
        for batch in batches:
            prints = pa.array([make.signature(t).tobytes() for t in texts(batch, "text")], pa.binary())
            columns = [batch.column("doc_id"), batch.column("node"), prints]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "fingerprint"])

    return rows.mapInArrow(run, f"doc_id {id_type}, node binary, fingerprint binary")


def banded(prints: DataFrame, bands: int = BANDS) -> DataFrame:
    """``(doc_id, node, bands)`` of a ``(doc_id, node, fingerprint)`` table; a text without words has no bands."""
    id_type = prints.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for held in batch.column("fingerprint").to_pylist():
                kept = np.frombuffer(held, ">u4").astype(np.uint64)
                keys.append([] if (kept == np.iinfo(np.uint32).max).all() else band_keys(kept, bands))
            columns = [batch.column("doc_id"), batch.column("node"), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "bands"])

    columns = prints.select("doc_id", "node", "fingerprint")
    return columns.mapInArrow(run, f"doc_id {id_type}, node binary, bands array<bigint>")


def near_duplicates(
    documents: DataFrame,
    prints: DataFrame | None = None,
    least: float = LEAST,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, node, class_id, first_node)`` by bands of fingerprints and exact Jaccard.

    ``prints`` are the written ``(doc_id, node, fingerprint)`` of all documents where
    they are known already, as :func:`compare_neighbours` returns them.
    """
    if prints is None:
        prints = materialize(fingerprints(documents, id_col, text_col), "prints")

    def sketch():
        make = Fingerprinter(permutations=SKETCH)
        return lambda text: sketch_bits(make.signature(text).astype(np.uint64))

    def profile():
        make = Fingerprinter()
        return lambda text: np.unique(make.shingles(text))

    members = materialize(banded(prints), "signed")
    return near_classes(documents, members, sketch, profile, jaccard, least, id_col, text_col)


def jaccard(x: np.ndarray, y: np.ndarray) -> float:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if len(x) + len(y) else 1.0


def _finished(
    doc_id, text: str, mine: np.ndarray, node: bytes, following: str, next_: np.ndarray, make: Fingerprinter
) -> dict:
    changed = edited(text, following)
    after = make.signature(changed)
    return {
        "doc_id": doc_id,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(changed.encode("utf-8")).digest(),
        "fingerprint": mine.tobytes(),
        "edited_fingerprint": after.tobytes(),
        "near_edited": likeness(mine, after),
        "near_next": likeness(mine, next_),
        "node": node,
    }


def compare_neighbours(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness to each other and to the next;
    ``node`` is the identity of the text.

    Texts are range-partitioned by id once; each task walks through its range in
    order with two documents in hand. The first and last document of every range
    are kept with their text and matched across ranges afterwards.
    """
    rows = documents.select(
        F.col(id_col).alias("doc_id"),
        text_or_empty(text_col).alias("text"),
        F.xxhash64(text_or_empty(text_col)).alias("text_hash"),
        text_node(text_col).alias("node"),
    )
    ordered = rows.repartitionByRange("doc_id", "text_hash").sortWithinPartitions("doc_id", "text_hash")
    id_type = rows.schema["doc_id"].dataType
    results = (
        "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
        "near_edited double, near_next double, node binary"
    )
    schema = f"doc_id {id_type.simpleString()}, {results}"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, part, held, out, kind = Fingerprinter(), TaskContext.get().partitionId(), None, [], None
        shape = None

        def end(which: int) -> dict:
            doc_id, text, mine, node = held
            ends = {"doc_id": doc_id, "fingerprint": mine.tobytes(), "node": node}
            return ends | {"part": part, "kind": which, "text": text}

        for batch in batches:
            shape = shape or _arrow_shape(batch.schema.field("doc_id").type)
            ids, nodes = (batch.column(c).to_pylist() for c in ("doc_id", "node"))
            for doc_id, text, node in zip(ids, texts(batch, "text"), nodes, strict=True):
                mine = make.signature(text)
                last, held = held, (doc_id, text, mine, node)
                if last is None:
                    out.append(end(HEAD))
                else:
                    out.append(_finished(*last, text, mine, make) | {"part": part, "kind": DONE, "text": None})
                if len(out) >= ROWS_OUT:
                    yield pa.RecordBatch.from_pylist(out, shape)
                    out = []
        if held is not None:
            out.append(end(TAIL))
            yield pa.RecordBatch.from_pylist(out, shape)

    walked = ordered.select("doc_id", "text", "node").mapInArrow(walk, f"{schema}, part int, kind int, text string")
    walked = materialize(walked, "neighbours")
    columns = [c.split()[0] for c in schema.split(", ")]
    done = walked.filter(F.col("kind") == DONE).select(*columns)

    # one row per range: which range comes next; the last one is followed by the first
    heads = walked.filter(F.col("kind") == HEAD)
    order = W.orderBy("part")
    first = F.first("part").over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    ranges = heads.select("part", F.coalesce(F.lead("part").over(order), first).alias("next_part"))
    following = heads.select(
        F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print")
    )
    tails = walked.filter(F.col("kind") == TAIL).select("doc_id", "text", "fingerprint", "node", "part")
    ends = tails.join(ranges, "part").join(following, "next_part")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Fingerprinter()
        for batch in batches:
            shape = _arrow_shape(batch.schema.field("doc_id").type, DONE_FIELDS)
            out = []
            for row in batch.to_pylist():
                prints = [np.frombuffer(row[c], ">u4") for c in ("fingerprint", "next_print")]
                mine = (row["doc_id"], row["text"], prints[0], row["node"])
                out.append(_finished(*mine, row["next_text"], prints[1], make))
            yield pa.RecordBatch.from_pylist(out, shape)

    closed = ends.select("doc_id", "text", "fingerprint", "node", "next_text", "next_print").mapInArrow(close, schema)
    return done.unionAll(closed)


DONE_FIELDS = [
    ("n_chars", pa.int64()),
    ("edited_sha256", pa.binary()),
    ("fingerprint", pa.binary()),
    ("edited_fingerprint", pa.binary()),
    ("near_edited", pa.float64()),
    ("near_next", pa.float64()),
    ("node", pa.binary()),
]
ALL_FIELDS = [*DONE_FIELDS, ("part", pa.int32()), ("kind", pa.int32()), ("text", pa.string())]


def _arrow_shape(id_type: pa.DataType, fields=tuple(ALL_FIELDS)) -> pa.Schema:
    return pa.schema([("doc_id", id_type), *fields])
