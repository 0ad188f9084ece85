"""Quality rules: counts over words and lines, and a labelling of the lines.

A linear-chain conditional random field marks every line that has a word as
content or boilerplate (Viterbi decoding); the share of words in content lines
decides. The field is trained on lines of labelled documents: those of good
documents are content; those of bad ones start as boilerplate and are then
labelled anew by the field itself, as a bad document may have good lines.

Defined results: null text counts as empty; a text without words has all counts
0, content share 0 and fails the base rule; repeated rows get equal results;
without labels of both kinds every line is content. Words are compared by 64-bit
hashes.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import Sample, labelled_sample, texts
from docsift.llm.words import WordHasher, cut, shingles

#: Documents of either label that may be drawn to fit; longer ones are not drawn.
PER_LABEL = 1_500
MAX_CHARS = 20_000
STEPS = 150
ROUNDS = 2
LEAST_WORDS = 50
LEAST_CONTENT = 0.5
SYMBOLS = "#*$%&|<>"
SPACE = re.compile(r"[\x20\x09-\x0D]")
#: Kinds of characters, as columns of the counts per line.
BLANK, LETTER, CAPITAL, DIGIT, SYMBOL, SHOUT, MARK, OTHER = range(8)


def _kind(c: int) -> int:
    sign, category = chr(c), unicodedata.category(chr(c))
    if sign in "\t\n\v\f\r ":
        return BLANK
    if sign in SYMBOLS:
        return SYMBOL
    if sign == "!":
        return SHOUT
    by_category = {"Lu": CAPITAL, "Lt": CAPITAL, "N": DIGIT, "L": LETTER, "M": LETTER, "P": MARK}
    return by_category.get(category, by_category.get(category[0], OTHER))


#: Kinds of the first characters; nearly all beyond are letters.
KINDS = np.array([_kind(c) for c in range(0x3000)], np.uint8)


@dataclass
class Lines:
    """Counts of one text, and per line that has a word its features and words."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    features: np.ndarray
    words: np.ndarray

    @property
    def base_failed(self) -> bool:
        return self.n_words < LEAST_WORDS or 100 * self.n_repeat_words > 50 * self.n_words


def _repeated(windows: np.ndarray) -> np.ndarray:
    order = np.argsort(windows, kind="stable")
    equal = windows[order][1:] == windows[order][:-1]
    out = np.zeros(len(windows), bool)
    out[order[1:]] |= equal
    out[order[:-1]] |= equal
    return out


def read_lines(text: str, hasher: WordHasher) -> Lines:
    n_lines = text.count("\n") + 1
    kinds = np.zeros((n_lines, 8), np.int64)
    hashes, places, line = [], [], 0
    for piece in cut(text, SPACE):
        points = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = np.where(points < len(KINDS), KINDS[np.minimum(points, len(KINDS) - 1)], LETTER)
        number = np.cumsum(points == 10, dtype=np.int64) - (points == 10)  # a line end belongs to its line
        here = slice(line, line + piece.count("\n") + 1)
        rows = here.stop - here.start
        kinds[here] += np.bincount(number * 8 + kind, minlength=rows * 8).reshape(rows, 8)
        solid = kind != BLANK
        starts = np.flatnonzero(solid & ~np.concatenate([[False], solid[:-1]]))
        data = np.frombuffer(piece.encode("utf-8", "surrogatepass"), np.uint8)
        hashes.append(hasher.words(data, (data != 32) & ((data < 9) | (data > 13))))
        places.append(line + number[starts])
        line = here.stop - 1
    found, place = np.concatenate(hashes), np.concatenate(places)
    words = np.bincount(place, minlength=n_lines)
    echo = (found[1:] == found[:-1]) & (place[1:] == place[:-1])
    echoes = np.bincount(place[1:][echo], minlength=n_lines)
    covered = np.zeros(len(found), bool)
    if len(found) > 3:
        again = _repeated(shingles(found, 3))
        for k in range(3):
            covered[k : k + len(again)] |= again
    solid_lines = words > 0
    kept_lines = [s for s, solid in zip(text.split("\n"), solid_lines.tolist(), strict=True) if solid]
    seen: set[str] = set()
    copy = np.array([s in seen or bool(seen.add(s)) for s in kept_lines], bool)
    kinds, words, echoes = kinds[solid_lines], words[solid_lines], echoes[solid_lines]
    return Lines(
        len(found),
        int(kinds[:, 1:].sum()),
        int(kinds[:, SYMBOL].sum()),
        int(copy.sum()),
        int(covered.sum()),
        _features(kinds, words, echoes, copy),
        words,
    )


def _features(kinds: np.ndarray, words: np.ndarray, echoes: np.ndarray, copy: np.ndarray) -> np.ndarray:
    chars = np.maximum(kinds[:, 1:].sum(1), 1)
    letters = np.maximum(kinds[:, LETTER] + kinds[:, CAPITAL], 1)
    capital, digit = kinds[:, CAPITAL] / letters, kinds[:, DIGIT] / chars
    symbol, shout, echo = kinds[:, SYMBOL] / chars, kinds[:, SHOUT] / chars, echoes / np.maximum(words, 1)
    mark, other = kinds[:, MARK] / chars, kinds[:, OTHER] / chars
    columns = [
        np.ones(len(words)), capital, capital > 0.5, digit, digit > 0.3, symbol, symbol > 0.05, shout,
        shout > 0.02, mark, mark > 0.3, other, echo, echo > 0.3, copy, np.log1p(words) / 4, words < 4,
        np.minimum(chars / np.maximum(words, 1), 40) / 10,
    ]
    return np.column_stack([np.asarray(c, float) for c in columns]) if len(words) else np.zeros((0, len(columns)))


@dataclass(frozen=True)
class LineField:
    """Log odds of boilerplate by feature; ``moves[i, j]`` from state i to j; 0 is content."""

    weights: np.ndarray | None
    moves: np.ndarray

    def content(self, features: np.ndarray) -> np.ndarray:
        """Which lines are content on the best path."""
        if self.weights is None or not len(features):
            return np.ones(len(features), bool)
        odds = (features @ self.weights).tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        best0, best1, back = 0.0, odds[0], []
        for odd in odds[1:]:
            from0, from1 = best0 + m00 < best1 + m10, best0 + m01 < best1 + m11
            best0, best1 = (
                best1 + m10 if from0 else best0 + m00,
                (best1 + m11 if from1 else best0 + m01) + odd,
            )
            back.append((from0, from1))
        state = best1 > best0
        path = [state]
        for step in reversed(back):
            state = step[state]
            path.append(state)
        return ~np.array(path[::-1], bool)


def fit(sample: Sample) -> LineField:
    """Maximum likelihood by forward-backward sums over all sampled documents at once."""
    hasher = WordHasher()
    documents = [(read_lines(t, hasher).features, y) for t, y in sample.rows]
    documents = sorted(((f, y) for f, y in documents if len(f)), key=lambda d: -len(d[0]))
    bad = np.array([y == 0 for _, y in documents], bool)
    if bad.all() or not bad.any():
        return LineField(None, np.zeros((2, 2)))
    mass = np.where(bad, (1 - sample.share) / bad.sum(), sample.share / (~bad).sum())
    states = [np.full(len(f), y == 0) for f, y in documents]
    field = _maximise([f for f, _ in documents], states, mass)
    for _ in range(ROUNDS - 1):
        for i in np.flatnonzero(bad):
            content = field.content(documents[i][0])
            if not content.all():
                states[i] = ~content
        field = _maximise([f for f, _ in documents], states, mass)
    return field


def _maximise(features: list[np.ndarray], states: list[np.ndarray], mass: np.ndarray) -> LineField:
    """Adam on the conditional likelihood; documents come longest first."""
    length = np.array([len(f) for f in features])
    # position-major layout: all first lines, all second lines, ...
    active = [int((length > k).sum()) for k in range(length[0])]
    rows = np.concatenate([np.array([f[k] for f in features[:n]]) for k, n in enumerate(active)])
    state = np.concatenate([np.array([s[k] for s in states[:n]]) for k, n in enumerate(active)]).astype(int)
    weight = np.concatenate([mass[:n] for n in active])
    start = np.concatenate([[0], np.cumsum(active)])
    observed = rows.T @ (weight * state)
    counted = np.zeros((2, 2))
    for k in range(1, len(active)):
        n = active[k]
        before, now = state[start[k - 1] : start[k - 1] + n], state[start[k] : start[k + 1]]
        np.add.at(counted, (before, now), mass[:n])
    x = np.zeros(rows.shape[1] + 4)
    mean, square = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, STEPS + 1):
        w, moves = x[:-4], x[-4:].reshape(2, 2)
        expected, passed = _expected(rows @ w, moves, active, start, weight, mass)
        gradient = np.concatenate([observed - rows.T @ expected, (counted - passed).ravel()]) - 1e-4 * x
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        x = x + 0.1 * mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return LineField(x[:-4], x[-4:].reshape(2, 2))


def _expected(odds, moves, active, start, weight, mass):
    """Expected boilerplate mass of every line and expected moves, by forward-backward."""
    emit = np.column_stack([np.zeros(len(odds)), odds])
    forward = np.empty_like(emit)
    backward = np.zeros_like(emit)
    forward[: active[0]] = emit[: active[0]]
    for k in range(1, len(active)):
        before = forward[start[k - 1] : start[k - 1] + active[k]]
        step = np.logaddexp(before[:, :1] + moves[:1], before[:, 1:] + moves[1:])
        forward[start[k] : start[k + 1]] = step + emit[start[k] : start[k + 1]]
    passed = np.zeros((2, 2))
    for k in range(len(active) - 1, 0, -1):
        n, here = active[k], slice(start[k], start[k + 1])
        ahead = emit[here] + backward[here]
        before = slice(start[k - 1], start[k - 1] + n)
        joint = forward[before][:, :, None] + moves[None] + ahead[:, None, :]
        total = np.logaddexp.reduce(joint.reshape(n, 4), axis=1)
        passed += (np.exp(joint - total[:, None, None]) * mass[:n, None, None]).sum(0)
        backward[before] = np.logaddexp(moves[:, 0] + ahead[:, :1], moves[:, 1] + ahead[:, 1:])
    both = forward + backward
    return weight * np.exp(both[:, 1] - np.logaddexp(both[:, 0], both[:, 1])), passed


def fit_rules(documents: DataFrame, labels: DataFrame, label: str = "quality") -> LineField:
    return fit(labelled_sample(documents, labels, label, PER_LABEL, MAX_CHARS))


def verdict(text: str, field: LineField, hasher: WordHasher) -> tuple[Lines, float, bool]:
    """Counts, content share, and whether the document stays."""
    lines = read_lines(text, hasher)
    content = int(lines.words[field.content(lines.features)].sum()) / max(1, lines.n_words)
    return lines, content, not lines.base_failed and content >= LEAST_CONTENT


def apply_rules(
    documents: DataFrame, field: LineField, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Counts and verdict of every whole text; one Arrow pass over the scan, no shuffle."""
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            found = [verdict(t, field, hasher) for t in texts(batch, "text")]
            out = [pa.array([getattr(f[0], c) for f in found], pa.int64()) for c in counts]
            out.append(pa.array([f[0].base_failed for f in found], pa.bool_()))
            out.append(pa.array([f[2] for f in found], pa.bool_()))
            out.append(pa.array([f[1] for f in found], pa.float64()))
            names = ["doc_id", *counts, "base_failed", "kept", "content_share"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *out], names)

    longs = ", ".join(f"{c} long" for c in counts)
    schema = f"doc_id {id_type}, {longs}, base_failed boolean, kept boolean, content_share double"
    return rows.mapInArrow(run, schema)


def keep_by_rules(documents: DataFrame, field: LineField, text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    place = documents.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            stays = [verdict(t, field, hasher)[2] for t in texts(batch, place)]
            yield batch.filter(pa.array(stays, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
