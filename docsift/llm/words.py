"""Words of whole texts as hashes in numpy, without a Python object per word."""

from __future__ import annotations

import re

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: ASCII capitals become small, ASCII signs spaces; bytes of other characters stay.
_PLAIN = bytes(
    c + 32 if 65 <= c < 91 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)
#: General and Latin-1 punctuation in UTF-8.
_FAR_SIGNS = re.compile(rb"\xe2[\x80\x81].|\xc2.", re.S)
#: Bytes handled at once; longer texts are cut at a space.
PIECE = 1 << 22


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lowered(text: str) -> bytes:
    """Small letters in UTF-8 with spaces for punctuation beyond ASCII."""
    data = text.lower().encode("utf-8", "surrogatepass")
    return data if text.isascii() else _FAR_SIGNS.sub(b" ", data)


def plain_bytes(text: str) -> np.ndarray:
    """The text as small letters, digits and spaces only."""
    return np.frombuffer(lowered(text).translate(_PLAIN), np.uint8)


class WordHasher:
    """Polynomial hashes of byte ranges from running sums; remembers the powers."""

    def __init__(self):
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) >= n:
            return
        n = max(n, 1 << 16, 2 * len(self.powers))
        base = np.full(n, _BASE, np.uint64)
        inverse = np.full(n, _INVERSE, np.uint64)
        base[0] = inverse[0] = 1
        self.powers, self.inverses = np.multiply.accumulate(base), np.multiply.accumulate(inverse)

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=out[1:])
        return out

    def ranges(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((sums[ends] - sums[starts]) * self.inverses[starts])

    def words(self, data: np.ndarray, is_word: np.ndarray) -> np.ndarray:
        """Hashes of the runs of ``is_word``, in order."""
        if len(data) <= PIECE:
            starts, ends = runs(is_word)
            return self.ranges(self.sums(data), starts, ends)
        out, at = [], 0
        while at < len(data):
            end = min(len(data), at + PIECE)
            if end < len(data):
                spaces = np.flatnonzero(~is_word[end:])
                end = end + int(spaces[0]) if len(spaces) else len(data)
            starts, ends = runs(is_word[at:end])
            out.append(self.ranges(self.sums(data[at:end]), starts, ends))
            at = end
        return np.concatenate(out)


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    padded = np.zeros(len(mask) + 2, np.int8)
    padded[1:-1] = mask
    edges = np.flatnonzero(padded[1:] != padded[:-1])
    return edges[0::2], edges[1::2]


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words; a shorter text is one shingle, an empty one has none."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    out = words[:n].copy()
    for k in range(1, size):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += words[k : n + k]
    return mixed(out)


def cut(text: str, at: re.Pattern, size: int = 1 << 20) -> list[str]:
    """Pieces of at least ``size`` characters that end after a match of ``at``; most texts are one piece."""
    out, start = [], 0
    while len(text) - start > size and (m := at.search(text, start + size)):
        out.append(text[start : m.end()])
        start = m.end()
    return [*out, text[start:]]
