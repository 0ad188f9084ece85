"""Toxicity by multiple-instance learning: a document is a bag of sentences.

Each sentence has a logistic score over its hashed words and their beginnings
(insults come inflected), and a document is toxic unless all its sentences are
clean (noisy-or). The sentence model is
trained from document labels alone and then also locates the offending sentences.

Defined results: null text counts as empty; a text without sentences scores 0;
repeated rows get equal scores; without labels of both kinds every document
with a sentence scores the sample's share of toxic documents (0 without any).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import Sample, labelled_sample, texts
from docsift.llm.words import WordHasher, lowered, runs

#: Documents of either label that may be drawn to fit; longer ones are not drawn.
PER_LABEL = 3_000
MAX_CHARS = 20_000
HASH_BITS = 20
#: A feature counts if at least this many sampled documents have it.
LEAST_DOCUMENTS = 10
#: Bytes of the word beginnings that are features besides the word.
BEGINNINGS = (4,)
STEPS = 250
RATE = 0.1
RIDGE = 2e-5
START = -6.0
#: ASCII signs and capitals: sentence ends become full stops, other signs spaces.
_SIGNS = bytes(
    46 if chr(c) in ".!?\n" else c + 32 if 65 <= c < 91 else c if c >= 128 or chr(c).isalnum() else 32
    for c in range(256)
)
SENTENCE_END = re.compile(r"[.!?\n]")


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray | None
    bias: float
    share: float


def instances(text: str, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """The distinct words of every sentence: number of the sentence, and feature slots of the word."""
    data = np.frombuffer(lowered(text).translate(_SIGNS), np.uint8)
    mark = data == 46
    starts, ends = runs((data != 32) & ~mark)
    sums = hasher.sums(data)
    whole = hasher.ranges(sums, starts, ends)
    sentence = np.cumsum(mark)[starts] if len(starts) else starts
    pair = whole + sentence.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    chosen = np.unique(pair, return_index=True)[1]
    starts, ends = starts[chosen], ends[chosen]
    slots = [whole[chosen]]
    for n in BEGINNINGS:
        slots.append(hasher.ranges(sums, starts, np.minimum(ends, starts + n)) * np.uint64(2 * n + 1))
    return sentence[chosen], (np.stack(slots, 1) >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def fit(sample: Sample) -> ToxicityModel:
    """Full-batch Adam on the likelihood of the document labels under noisy-or.

    The sample holds as many documents of either label as it can; their weights
    restore the shares of the labels among all labelled documents.
    """
    hasher = WordHasher()
    bags = [(instances(text, hasher), y) for text, y in sample.rows]
    bags = [(b, y) for b, y in bags if len(b[0])]
    toxic = np.array([y == 1 for _, y in bags], bool)
    if toxic.all() or not toxic.any():
        return ToxicityModel(None, 0.0, sample.share if sample.rows else 0.0)
    documents = np.zeros(1 << HASH_BITS, np.int64)
    for (_, slots), _ in bags:
        documents[np.unique(slots)] += 1
    sentence, slot, per_doc = [], [], []
    for (number, slots), _ in bags:
        dense = np.unique(number, return_inverse=True)[1]
        sentence.append(np.repeat(dense, slots.shape[1]))
        slot.append(slots.ravel())
        per_doc.append(int(dense.max()) + 1)
    per_doc = np.array(per_doc)
    first = np.concatenate([[0], np.cumsum(per_doc)[:-1]])
    sentence = np.concatenate([s + f for s, f in zip(sentence, first, strict=True)])
    slot = np.concatenate(slot)
    frequent = documents[slot] >= LEAST_DOCUMENTS
    used, place = np.unique(slot[frequent], return_inverse=True)
    sentence, n = sentence[frequent], int(per_doc.sum())
    share = max(1e-3, min(1 - 1e-3, sample.share))
    mass = np.where(toxic, share / toxic.sum(), (1 - share) / (~toxic).sum())
    w, bias = np.zeros(len(used)), START
    mean, square = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(sentence, w[place], n) + bias
        clean = np.logaddexp(0, z)  # -log of the chance that the sentence is clean
        total = np.maximum(np.add.reduceat(clean, first), 1e-12)
        # of the log likelihood by each -log(clean): -1 for clean documents, else the odds of the bag
        pull = mass * np.where(toxic, np.exp(-total) / -np.expm1(-total), -1.0)
        by_z = np.repeat(pull, per_doc) / (1 + np.exp(-z))
        gradient = np.append(np.bincount(place, by_z[sentence], len(used)) - RIDGE * w, by_z.sum())
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        move = RATE * mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
        w, bias = w + move[:-1], bias + float(move[-1])
    weights = np.zeros(1 << HASH_BITS, np.float32)
    weights[used] = w
    return ToxicityModel(weights, bias, sample.share)


class Scorer:
    """Sentence and document scores."""

    def __init__(self, model: ToxicityModel):
        self.model, self.hasher = model, WordHasher()

    def sentences(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Number (sentence ends before it) and logit of every sentence that has a word."""
        sentence, slots = instances(text, self.hasher)
        if not len(sentence):
            return np.zeros(0, np.int64), np.zeros(0)
        number = sentence - sentence.min()
        sums = np.bincount(number, self.model.weights[slots].sum(1, dtype=np.float64))
        used = np.flatnonzero(np.bincount(number))
        return used + sentence.min(), sums[used] + self.model.bias

    def logits(self, text: str) -> np.ndarray:
        """One per sentence that has a word."""
        return self.sentences(text)[1]

    def document(self, text: str) -> float:
        return self.scored(text)[0]

    def located(self, text: str, least: float) -> list[dict]:
        """Character spans of the sentences that score at least ``least``."""
        return self.scored(text, least)[1]

    def scored(self, text: str, least: float | None = None) -> tuple[float, list[dict]]:
        """Score of the document and, with ``least``, its offending sentences, in one pass."""
        if self.model.weights is None:
            return self.model.share if len(instances(text, self.hasher)[0]) else 0.0, []
        numbers, logits = self.sentences(text)
        score, out = float(-np.expm1(-np.logaddexp(0, logits).sum())), []
        if least is not None:
            scores = np.exp(-np.logaddexp(0, -logits))
            found = np.flatnonzero(scores >= least)
            ends = [-1, *(m.start() for m in SENTENCE_END.finditer(text)), len(text)] if len(found) else []
            for i in found.tolist():
                n = int(numbers[i])
                out.append({"start": ends[n] + 1, "end": ends[n + 1], "score": float(scores[i])})
        return score, out


def fit_toxicity(documents: DataFrame, labels: DataFrame, label: str = "toxic") -> ToxicityModel:
    return fit(labelled_sample(documents, labels, label, PER_LABEL, MAX_CHARS))


def score_toxicity(
    documents: DataFrame,
    model: ToxicityModel,
    least: float | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, score)`` of every whole text; with ``least`` also the offending sentences."""
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, score double"
    if least is not None:
        schema += ", offending array<struct<start:int,end:int,score:double>>"
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            found = [scorer.scored(t, least) for t in texts(batch, "text")]
            out = [batch.column("doc_id"), pa.array([score for score, _ in found], pa.float64())]
            if least is not None:
                out.append(pa.array([spans for _, spans in found], span))
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "score", "offending"][: len(out)])

    return rows.mapInArrow(run, schema)
