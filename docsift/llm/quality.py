"""Quality scores from compressed sizes under two dictionaries.

A zstandard dictionary built from good text and one built from bad text compress
the same document; the difference of the two sizes, relative to the size without
a dictionary, says which kind it resembles. Two views are compressed: the bytes,
and their shape (letters, capitals and digits each as one sign). A logistic curve
over both differences and the plain compression ratio, fit on labelled documents
that built no dictionary, turns them into a probability.

Defined results: null text counts as empty; a text without words gets the share
of good documents in the sample; repeated rows get equal scores; with labels of
one kind only every document gets that share; without labels it is 0.5.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import Sample, labelled_sample, texts

#: Documents of either label that may be drawn to fit; longer ones are not drawn.
PER_LABEL = 3_000
MAX_CHARS = 20_000
#: Bytes of a dictionary for each view, shared equally by the texts that build it, and of the blocks in which a text is compressed:
#: within a short block the dictionary matters more than the text's own repetitions.
DICTIONARY_BYTES = (400_000, 400_000)
BLOCK_BYTES = 2_048
LEVEL = 3
SHAPE = bytes(
    ord("A") if chr(c).isupper() and c < 128 else ord("0") if 48 <= c < 58 else
    ord("a") if chr(c).isalpha() or c >= 128 else c for c in range(256)
)


def views(text: str) -> list[bytes]:
    data = text.encode("utf-8", "surrogatepass")
    return [data, data.translate(SHAPE)]


@dataclass(frozen=True)
class QualityModel:
    """``dictionaries`` holds (good, bad) for each view; ``weights`` end with the intercept."""

    dictionaries: list[tuple[bytes, bytes]]
    weights: list[float]
    share: float


class Features:
    """Size under the bad less that under the good dictionary by plain size, for each view; log ratio."""

    def __init__(self, dictionaries: list[tuple[bytes, bytes]]):
        self.compressors = [[_compressor(b""), *map(_compressor, pair)] for pair in dictionaries]

    def __call__(self, text: str) -> list[float] | None:
        found, ratio = [], 0.0
        for data, compressors in zip(views(text), self.compressors, strict=True):
            if not data.strip():
                return None
            blocks = [data[at : at + BLOCK_BYTES] for at in range(0, len(data), BLOCK_BYTES)]
            plain, good, bad = [sum(len(c.compress(b)) for b in blocks) for c in compressors]
            found.append((bad - good) / plain)
            ratio = ratio or math.log(plain / len(data))
        return [*found, ratio]


def _compressor(data: bytes) -> zstandard.ZstdCompressor:
    options = {}
    if data:
        options["dict_data"] = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        options["dict_data"].precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, **options
    )


def dictionary(samples: list[bytes], size: int) -> bytes:
    """A piece of every sample, in equal shares of ``size``, from a place that its own bytes choose."""
    share = max(1, size // max(1, len(samples)))
    starts = (zlib.crc32(s) % max(1, len(s) - share + 1) for s in samples)
    return b"".join(s[at : at + share] for s, at in zip(samples, starts, strict=True))


def calibrate(x: np.ndarray, y: np.ndarray, mass: np.ndarray) -> list[float]:
    """Weights and intercept of a logistic curve by Newton's method, with a weak ridge."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([x / scale, np.ones(len(x))])
    beta = np.zeros(z.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        gradient = z.T @ (mass * (p - y)) + 1e-2 * beta
        curvature = (z * (mass * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(beta))
        step = np.linalg.solve(curvature, gradient)
        beta -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-9:
            break
    return [*(beta[:-1] / scale).tolist(), float(beta[-1])]


def fit(sample: Sample) -> QualityModel:
    """Half of the sample builds the dictionaries, the other half calibrates.

    Calibration weighs the labels as they occur among all labelled documents.
    """
    share = sample.share
    by = {k: [t for t, y in sample.rows if y == k and t.strip()] for k in (0, 1)}
    if not (by[0] and by[1]):
        return QualityModel([], [], share)
    build = {k: [views(t) for t in v[: (len(v) + 1) // 2]] for k, v in by.items()}
    rest = {k: v[(len(v) + 1) // 2 :] or v for k, v in by.items()}
    dictionaries = [
        (dictionary([v[i] for v in build[1]], size), dictionary([v[i] for v in build[0]], size))
        for i, size in enumerate(DICTIONARY_BYTES)
    ]
    features = Features(dictionaries)
    x = [(features(t), k) for k in (0, 1) for t in rest[k]]
    x = [(f, k) for f, k in x if f is not None]
    y = np.array([k for _, k in x], float)
    mass = np.where(y == 1, share / max(1, y.sum()), (1 - share) / max(1, (1 - y).sum())) * len(y)
    weights = calibrate(np.array([f for f, _ in x]), y, mass)
    return QualityModel(dictionaries, weights, share)


class Scorer:
    def __init__(self, model: QualityModel):
        self.model = model
        self.features = Features(model.dictionaries) if model.dictionaries else None

    def __call__(self, text: str) -> float:
        x = self.features(text) if self.features else None
        if x is None:
            return self.model.share
        z = sum(w * v for w, v in zip(self.model.weights, [*x, 1.0], strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit_quality(documents: DataFrame, labels: DataFrame, label: str = "quality") -> QualityModel:
    return fit(labelled_sample(documents, labels, label, PER_LABEL, MAX_CHARS))


def score_quality(
    documents: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, score)`` of every whole text; one Arrow pass over the scan, no shuffle."""
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(model)
        for batch in batches:
            scores = pa.array([score(t) for t in texts(batch, "text")], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])

    return rows.mapInArrow(run, f"doc_id {id_type}, score double")


def keep_quality(
    documents: DataFrame, model: QualityModel, least: float = 0.3, text_col: str = "text"
) -> DataFrame:
    """The documents that score at least ``least``, with all their columns."""
    place = documents.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(model)
        for batch in batches:
            yield batch.filter(pa.array([score(t) >= least for t in texts(batch, place)], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
