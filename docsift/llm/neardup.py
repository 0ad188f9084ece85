"""Near-duplicate documents by ProbMinHash over weighted word shingles.

A shingle (five words) weighs as often as it occurs in the document. Each shingle
is a Poisson process with its weight as rate whose arrivals fall on random
components of the signature; a component keeps the shingle that arrives first.
Arrivals are drawn in steps until the latest kept one is earlier than all that
can still come. Two signatures agree in a component with the probability Jaccard
similarity of the documents. Bands of components find candidates, which are
verified by the exact probability Jaccard of their shingles.

Defined results: null text counts as empty. Words are runs of letters and digits
in small letters; a text of fewer than five words is one shingle, one without
words is equal only to the same text. Equal texts always share a class. With
repeated ids each row has the class of its text. The smallest id names a class
(null if no row of it has an id).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame

from docsift.llm.linking import near_classes, signed, sketch_bits
from docsift.llm.words import WordHasher, mixed, plain_bytes, shingles
from docsift.sources.store import materialize

SIZE = 5
LEAST = 0.8
#: Bands and components of a band: a pair at 0.8 shares no band in 5 of 100,000 cases.
BANDS = 25
WIDTH = 5
#: Components of the long signature that a sketch keeps a bit of.
SKETCH = 2_048


def weighted_shingles(text: str, hasher: WordHasher, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles as sorted 64-bit hashes, and how often each occurs."""
    data = plain_bytes(text)
    found, counts = np.unique(shingles(hasher.words(data, data != 32), size), return_counts=True)
    return found, counts.astype(float)


def signature(elements: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """The element that arrives first in each component."""
    first = np.full(size, np.inf)
    kept = np.zeros(size, np.uint64)
    time, drawn = np.zeros(len(elements)), 0
    enough = size * (math.log(size) + 1)
    while len(elements):
        n = max(1, min(64, math.ceil(enough / len(elements))))
        steps = np.arange(drawn + 1, drawn + n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        random = mixed(elements[:, None] + steps)
        component = (random % np.uint64(size)).astype(np.int64)
        uniform = ((mixed(random) >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)
        arrival = time[:, None] + np.cumsum(-np.log(uniform), axis=1) / weights[:, None]
        time, drawn = arrival[:, -1], drawn + n
        np.minimum.at(first, component, arrival)
        won = arrival == first[component]
        kept[component[won]] = elements[np.nonzero(won)[0]]
        alive = time < first.max()
        elements, weights, time = elements[alive], weights[alive], time[alive]
    return kept


def band_keys(kept: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key for each band of a signature; equal only within the same band."""
    rows = kept.reshape(bands, -1)
    key = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(rows.shape[1]):
        key = mixed(key ^ rows[:, k])
    return key.view(np.int64)


def probability_jaccard(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """The chance that two processes with these rates meet first in the same element."""
    (ex, wx), (ey, wy) = x, y
    if not (len(ex) and len(ey)):
        return float(len(ex) == len(ey))
    _, ix, iy = np.intersect1d(ex, ey, assume_unique=True, return_indices=True)
    cx, cy = wx[ix], wy[iy]
    only_x, only_y = wx.sum() - cx.sum(), wy.sum() - cy.sum()
    order = np.argsort(cx / cy, kind="stable")
    cx, cy = cx[order], cy[order]
    ratio = cx / cy
    # for the ratio r of an element: sum of max(x, r y) over all elements
    place = np.searchsorted(ratio, ratio, "left")
    below_y = np.concatenate([[0], np.cumsum(cy)])[place]
    from_x = cx.sum() - np.concatenate([[0], np.cumsum(cx)])[place]
    return float((cx / (only_x + from_x + ratio * (only_y + below_y))).sum())


def near_duplicates(
    documents: DataFrame,
    size: int = SIZE,
    least: float = LEAST,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, node, class_id, first_node)``: see :func:`docsift.llm.linking.near_classes`."""

    def profile():
        hasher = WordHasher()
        return lambda text: weighted_shingles(text, hasher, size)

    def sign():
        shingled = profile()

        def bands_of(text: str) -> np.ndarray:
            elements, weights = shingled(text)
            return band_keys(signature(elements, weights, BANDS * WIDTH)) if len(elements) else np.zeros(0, np.int64)

        return bands_of

    def sketch():
        shingled = profile()
        return lambda text: sketch_bits(signature(*shingled(text), SKETCH))

    members = materialize(signed(documents, sign, id_col, text_col), "signed")
    return near_classes(documents, members, sketch, profile, probability_jaccard, least, id_col, text_col)
