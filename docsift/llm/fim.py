"""Fill-in-the-middle examples: a text is cut at two units and its middle moves to the end.

A unit is a run of ASCII letters or any other single character. A Fenwick tree over
fixed blocks of the text keeps how many units and code points each block holds; a
binary-lifting descent finds the block in which a wanted unit starts, and only this
block is looked at again to find the place. Cuts, form and order of the parts follow
from a hash of seed and id, so reruns agree and rows need not meet.

Defined results: null text counts as empty; an empty text and one that already holds
a sentinel stay plain; a null id is hashed as no digits; repeated rows give equal
rows; texts of any length are cut whole; extra columns are not carried along.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import pieces, texts

SENTINELS = ("<P>", "<S>", "<M>")
SEED = 1
#: Of 100 texts, those transformed, and of these the ones with the suffix first.
TRANSFORMED = 90
SUFFIX_FIRST = 20
#: Code points of a block.
BLOCK = 16_384
#: Characters of the texts handed on at once.
PIECE = 1 << 22


class UnitTree:
    """Units and code points of a text in Fenwick trees over its blocks."""

    def __init__(self, text: str, block: int = BLOCK):
        self.text, self.block = text, block
        size = -(-len(text) // block)
        units = [int(self.starts(b).sum()) for b in range(size)]
        chars = [min(block, len(text) - b * block) for b in range(size)]
        ends = np.arange(1, size + 1)
        before = ends - (ends & -ends)  # node i covers the blocks after this one up to i
        self.units, self.chars = [0], [0]
        for tree, counts in ((self.units, units), (self.chars, chars)):
            upto = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
            tree.extend((upto[ends] - upto[before]).tolist())
        self.n = sum(units)

    def starts(self, number: int) -> np.ndarray:
        """Where in block ``number`` a unit starts; a run of letters may have started earlier."""
        at = number * self.block
        part = self.text[max(at - 1, 0) : at + self.block]
        code = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = (code | np.uint32(32)) - np.uint32(97) < 26
        goes_on = np.zeros(len(letter), bool)
        goes_on[1:] = letter[1:] & letter[:-1]
        return ~goes_on[1:] if at else ~goes_on

    def place(self, unit: int) -> int:
        """Code points before unit ``unit`` (from 0); the length of the text beyond its last unit."""
        at = units = chars = 0
        step = 1 << len(self.units).bit_length()
        while step:
            if at + step < len(self.units) and units + self.units[at + step] <= unit:
                at += step
                units += self.units[at]
                chars += self.chars[at]
            step >>= 1
        if at + 1 == len(self.units):
            return len(self.text)
        return chars + int(np.flatnonzero(self.starts(at))[unit - units])


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four 32-bit numbers from the hash of seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def transform(
    text: str, chance: list[int], transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST, block: int = BLOCK
) -> tuple[int, str, int | None, int | None, str]:
    """``(n, form, prefix_chars, middle_chars, output)`` of a text."""
    tree = UnitTree(text, block)
    if not text or chance[2] % 100 >= transformed or any(s in text for s in SENTINELS):
        return tree.n, "plain", None, None, text
    low, high = sorted(tree.place(h % (tree.n + 1)) for h in chance[:2])
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    p, s, m = SENTINELS
    if chance[3] % 100 < suffix_first:
        return tree.n, "spm", low, high - low, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return tree.n, "psm", low, high - low, f"{p}{prefix}{s}{suffix}{m}{middle}"


def fill_in_middle(
    documents: DataFrame,
    seed: int = SEED,
    transformed: int = TRANSFORMED,
    suffix_first: int = SUFFIX_FIRST,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)`` of every whole text; no shuffle."""
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, held = batch.column("doc_id"), texts(batch, "text")
            for part in pieces(held, PIECE):
                some = ids.slice(part.start, part.stop - part.start)
                made = [
                    transform(t, draws(i, seed), transformed, suffix_first)
                    for i, t in zip(some.to_pylist(), held[part], strict=True)
                ]
                columns = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([some, *columns], names)

    schema = f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(run, schema)


def restored(form: str = "form", output: str = "output") -> Column:
    """The text that an output of this form was made of."""
    part = F.split(F.col(output), "|".join(re.escape(s) for s in SENTINELS), -1)
    first, second, middle = (F.get(part, F.lit(i)) for i in (1, 2, 3))
    return (
        F.when(F.col(form) == "psm", F.concat(first, middle, second))
        .when(F.col(form) == "spm", F.concat(second, middle, first))
        .otherwise(F.col(output))
    )
