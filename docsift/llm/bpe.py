"""Byte-pair encoding and decoding of whole texts with a public vocabulary.

Words are encoded by the contiguous rank array: the parts of a short word lie in
one array, the ranks of adjacent parts in another; the smallest rank is looked
up, its boundary deleted and the neighbouring ranks refreshed, until no adjacent
parts merge. Many words of like length take these steps together in numpy. Long
words use a heap over linked parts, whose cost does not grow with the square of
the length. A task remembers the ids of words it has seen, up to a bound.

Defined results: null text counts as empty; an empty text has no ids and decodes
to an empty text; repeated rows get equal results; the strings of special tokens
in a text become special tokens, as in the library the vocabulary is made for.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import pieces, texts

NONE = np.iinfo(np.int32).max
#: Parts up to which a word counts as short.
SHORT = 64
#: Words encoded together, words a task remembers, characters split at once.
TOGETHER = 4_096
REMEMBERED = 400_000
CHARS = 2_000_000
#: Splitting rule of the vocabulary, after lower-casing (fixed value).
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
_WHITE = r"\t-\r \x85\xa0  -     　"
ASCII_WORDS = re.compile(_ENDINGS + r"|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
ANY_WORDS = regex.compile(_ENDINGS + r"|\p{L}+|\p{N}|[^\p{L}\p{N}" + _WHITE + "]+")


@dataclass(frozen=True)
class Vocabulary:
    """Merges as sorted pair keys with rank and product; tokens by id; first ids by byte."""

    keys: np.ndarray
    ranks: np.ndarray
    products: np.ndarray
    tokens: list[str]
    inner: np.ndarray
    final: np.ndarray
    specials: dict[str, int]


def byte_signs() -> list[str]:
    """The printable sign that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(others)) for b in range(256)]


def load_vocabulary(path: str) -> Vocabulary:
    """Read a byte-level BPE file with word ends, on the driver; tasks get its tables."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    end, ids = model["end_of_word_suffix"], model["vocab"]
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = [""] * (max([*ids.values(), *specials.values()]) + 1)
    for token, i in [*ids.items(), *specials.items()]:
        tokens[i] = token
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    key = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
    product = np.array([ids[a + b] for a, b in pairs], np.int32)
    order = np.argsort(key, kind="stable")
    signs = byte_signs()
    return Vocabulary(
        key[order],
        order.astype(np.int32),
        product[order],
        tokens,
        np.array([ids[s] for s in signs], np.int32),
        np.array([ids[s + end] for s in signs], np.int32),
        specials,
    )


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.by_rank = np.empty(len(vocabulary.ranks), np.int32)
        self.by_rank[vocabulary.ranks] = vocabulary.products
        self.known: dict[str, bytes] = {}
        self.specials = re.compile("|".join(map(re.escape, sorted(vocabulary.specials, key=len, reverse=True))))

    def split(self, text: str) -> list[str]:
        """Words in order; special tokens stand alone."""
        if not self.v.specials or not self.specials.search(text):
            return self._words(text)
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += self._words(text[at : m.start()])
            out.append(m.group())
            at = m.end()
        return out + self._words(text[at:])

    @staticmethod
    def _words(text: str) -> list[str]:
        if text.isascii():
            return ASCII_WORDS.findall(text.lower())
        # each character is lower-cased on its own, so a final sigma is no special case
        return ANY_WORDS.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        place = np.minimum(np.searchsorted(self.v.keys, key), len(self.v.keys) - 1)
        return np.where(self.v.keys[place] == key, self.v.ranks[place], NONE)

    def first_parts(self, data: bytes, ends: np.ndarray) -> np.ndarray:
        """Ids of single bytes; ``ends`` are the places after the last byte of each word."""
        found = np.frombuffer(data, np.uint8)
        out = self.v.inner[found]
        out[ends - 1] = self.v.final[found[ends - 1]]
        return out

    def short_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of many words of like length at once."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        columns = np.arange(length.max())
        parts = np.zeros((len(words), len(columns)), np.int32)
        parts[columns < length[:, None]] = self.first_parts(b"".join(words), np.cumsum(length))
        ranks = np.full(parts.shape, NONE, np.int32)
        ranks[:, :-1] = self.pair_ranks(parts[:, :-1], parts[:, 1:])
        ranks[columns >= length[:, None] - 1] = NONE
        final, sizes = np.zeros_like(parts), length.copy()
        rows = np.arange(len(words))
        while len(rows):
            at = ranks.argmin(axis=1)
            smallest = ranks[np.arange(len(rows)), at]
            done = smallest == NONE
            final[rows[done], : parts.shape[1]], sizes[rows[done]] = parts[done], length[done]
            rows, parts, ranks, length, at, smallest = (
                x[~done] for x in (rows, parts, ranks, length, at, smallest)
            )
            # delete the boundary: what stands after the pair moves up
            here, later = np.arange(len(rows)), columns[: parts.shape[1] - 1] > at[:, None]
            parts = np.where(later, parts[:, 1:], parts[:, :-1])
            ranks = np.where(later, ranks[:, 1:], ranks[:, :-1])
            if not parts.shape[1]:
                continue
            parts[here, at] = self.by_rank[smallest]
            length = length - 1
            # refresh the two pairs the new part belongs to
            ranks[here, at] = NONE
            for first in (at, at - 1):
                some = np.flatnonzero((first >= 0) & (first + 1 < length))
                left = first[some]
                ranks[some, left] = self.pair_ranks(parts[some, left], parts[some, left + 1])
        flat = final[columns < sizes[:, None]].astype("<u4").tobytes()
        ends = (4 * np.cumsum(sizes)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def long_word(self, word: bytes) -> bytes:
        part = self.first_parts(word, np.array([len(word)])).tolist()
        n = len(part)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]

        def offer(i: int, j: int) -> None:
            rank = ranks.get((part[i], part[j]))
            if rank is not None:
                heapq.heappush(heap, (rank, i, part[i], j, part[j]))

        ranks = _RankLookup(self)
        heap: list[tuple] = []
        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            rank, i, a, j, b = heapq.heappop(heap)
            if part[i] != a or right[i] != j or part[j] != b:
                continue  # one of the parts has merged since
            part[i], part[j] = int(self.by_rank[rank]), -1
            right[i] = right[j]
            if right[i] >= 0:
                left[right[i]] = i
                offer(i, right[i])
            if left[i] >= 0:
                offer(left[i], i)
        return np.array([p for p in part if p >= 0], "<u4").tobytes()

    def learn(self, words: set[str]) -> None:
        """Encode words that are not known yet."""
        if len(self.known) + len(words) > REMEMBERED:
            self.known = {}
        for special, i in self.v.specials.items():
            self.known[special] = np.array([i], "<u4").tobytes()
        new = [(w, w.encode("utf-8", "surrogatepass")) for w in words if w not in self.known]
        new.sort(key=lambda w: len(w[1]))
        short = [w for w in new if len(w[1]) <= SHORT]
        for at in range(0, len(short), TOGETHER):
            some = short[at : at + TOGETHER]
            ids = self.short_words([data for _, data in some])
            self.known.update(zip((w for w, _ in some), ids, strict=True))
        for word, data in new[len(short) :]:
            self.known[word] = self.long_word(data)

    def encode(self, some_texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for part in pieces(some_texts, CHARS):
            split = [self.split(t) for t in some_texts[part]]
            self.learn(set().union(*split))
            out += [b"".join(map(self.known.__getitem__, words)) for words in split]
        return out

    def decode(self, ids: bytes) -> str:
        """Tokens joined by a space, the rule for a vocabulary without a decoder."""
        return " ".join(map(self.v.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _RankLookup:
    def __init__(self, encoder: Encoder):
        self.encoder, self.known = encoder, {}

    def get(self, pair: tuple[int, int]) -> int | None:
        if pair not in self.known:
            rank = int(self.encoder.pair_ranks(np.array([pair[0]]), np.array([pair[1]]))[0])
            self.known[pair] = None if rank == NONE else rank
        return self.known[pair]


def encode_texts(
    documents: DataFrame,
    vocabulary: Vocabulary,
    id_col: str = "doc_id",
    text_col: str = "text",
    digests: bool = False,
) -> DataFrame:
    """``(doc_id, ids, decoded)`` of every whole text in one Arrow pass without a shuffle.

    With ``digests``: ``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` instead.
    """
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["doc_id", "ids", "decoded"]
    types = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for whole in batches:
            found = texts(whole, "text")
            for part in pieces(found, CHARS):
                ids = encoder.encode(found[part])
                decoded = [encoder.decode(i) for i in ids]
                if digests:
                    out = [
                        pa.array([len(i) // 4 for i in ids], pa.int64()),
                        pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
                        pa.array([hashlib.sha256(d.encode("utf-8")).hexdigest() for d in decoded]),
                    ]
                else:
                    arrays = [np.frombuffer(i, "<u4").astype(np.int32) for i in ids]
                    out = [pa.array(arrays, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                doc_ids = whole.column("doc_id").slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([doc_ids, *out], names)

    return rows.mapInArrow(run, f"doc_id {id_type}, {types}")
