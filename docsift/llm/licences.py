"""License scans: notice phrases and identifier tags found in one pass over each text.

An Aho-Corasick automaton over the words of the text finds all notice phrases and
the words that announce a licence expression. Expressions are read from the text
behind each announcement by a shunting-yard parser (``with`` before ``and`` before
``or``, brackets) and evaluated against a set of permissive licences.

Defined results: null text counts as empty; a text without evidence has empty
labels, score 0, null places and null permission; repeated rows get equal
results. An expression ends where its grammar does: in prose behind it, at a
dangling operator, at the line end; open brackets close at its end. It counts if
one of its licences is listed or a ``LicenseRef-``; its other words give no label
and allow nothing. A notice inside a longer one is part of that one. Labels have
one form (``licence_names.label_of``); a family's label goes when a version of it
is found, but labels of base phrases stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import texts
from docsift.llm.licence_names import PERMISSIVE, identifiers, label_of, less_general, notices as known_notices

#: Base phrases and their labels (fixed values).
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
ANNOUNCEMENT = "spdx license identifier"
#: How sure each kind of evidence makes that a licence is stated; kinds add up by noisy-or.
CERTAINTY = {"tag": 0.95, "base": 0.9, "notice": 0.6}
_WORD_BYTES = bytes(
    c + 32 if 65 <= c < 91 else c if c >= 128 or 48 <= c < 58 or 97 <= c < 123 else 32 for c in range(256)
)
_TAG = re.compile(r"spdx-license-identifier\s*:[ \t]*([^\r\n]*)", re.I)
_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+\-]*(?::LicenseRef-[A-Za-z0-9.\-]+)?|\S")
_BINDS = {"or": 1, "and": 2, "with": 3}


def parse(expression: str) -> list[str]:
    """Postfix form of the longest licence expression at the start."""
    out: list[str] = []
    waiting: list[str] = []
    operand_next = True
    for token in _TOKEN.findall(expression):
        lower = token.lower()
        if lower in _BINDS:
            if operand_next:
                break
            while waiting and waiting[-1] != "(" and _BINDS[waiting[-1]] >= _BINDS[lower]:
                out.append(waiting.pop())
            waiting.append(lower)
            operand_next = True
        elif token == "(":
            if not operand_next:
                break
            waiting.append(token)
        elif token == ")":
            if operand_next or "(" not in waiting:
                break
            while (top := waiting.pop()) != "(":
                out.append(top)
        elif operand_next and token[0].isalnum():
            out.append(lower.rstrip(".-"))
            operand_next = False
        else:
            break
    if operand_next:  # an operator without its right side does not count
        while waiting and waiting[-1] == "(":
            waiting.pop()
        if waiting:
            waiting.pop()
    return out + [w for w in reversed(waiting) if w != "("]


def evaluate(postfix: list[str], allowed: frozenset[str]) -> bool:
    """Whether the allowed licences suffice; an exception leaves its licence as it is."""
    stack: list[bool] = []
    for token in postfix:
        if token not in _BINDS:
            stack.append(token in allowed)
            continue
        right, left = stack.pop(), stack.pop()
        stack.append(left if token == "with" else left and right if token == "and" else left or right)
    return bool(stack) and stack[-1]


def licences(postfix: list[str]) -> set[str]:
    """The licences of an expression, without exceptions."""
    stack: list[set[str]] = []
    for token in postfix:
        if token not in _BINDS:
            stack.append({token})
            continue
        right, left = stack.pop(), stack.pop()
        stack.append(left if token == "with" else left | right)
    return stack[-1] if stack else set()


@dataclass
class Found:
    n_words: int = 0
    places: list[int] = field(default_factory=list)
    base_labels: set[str] = field(default_factory=set)
    labels: set[str] = field(default_factory=set)
    expressions: list[str] = field(default_factory=list)
    score: float = 0.0
    permissive: bool | None = None


class Scanner:
    def __init__(
        self,
        base: dict[str, str] | None = None,
        notices: dict[str, str] | None = None,
        listed: frozenset[str] | None = None,
    ):
        base, notices = BASE if base is None else base, known_notices() if notices is None else notices
        self.listed = identifiers() if listed is None else listed
        self.automaton = ahocorasick.Automaton()
        known: dict[str, list[tuple[str, str]]] = {ANNOUNCEMENT: [("tag", "")]}
        for kind, phrases in (("base", base), ("notice", notices)):
            for phrase, label in phrases.items():
                known.setdefault(phrase, []).append((kind, label))
        for phrase, meanings in known.items():
            self.automaton.add_word(f" {phrase} ", (len(phrase) + 1, meanings))
        self.automaton.make_automaton()

    def __call__(self, text: str) -> Found:
        words = text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()
        line = b" " + b" ".join(words) + b" "
        found, evidence, verdicts = Found(len(words)), set(), []
        announced, covered = False, -1
        word = at = 0
        hits = [(end - back, end, m) for end, (back, m) in self.automaton.iter(line.decode("latin-1"))]
        for start, end, meanings in sorted(hits, key=lambda h: (h[0], -h[1])):
            word, at = word + line.count(b" ", at, start), start
            inside, covered = end <= covered, max(end, covered)
            for kind, label in meanings:
                if kind == "tag":
                    announced = True
                elif kind == "base":
                    found.places.append(word)
                    found.base_labels.add(label)
                    evidence.add((kind, label))
                elif not inside:
                    evidence.add((kind, label))
        found.labels = {label for _, label in evidence}
        if announced:
            for m in _TAG.finditer(text):
                postfix = parse(m.group(1))
                stated = {label_of(name, self.listed) for name in licences(postfix)} - {None}
                if stated:
                    found.expressions.append(" ".join(postfix))
                    found.labels |= stated
                    names = [t if t in _BINDS else label_of(t, self.listed) or "" for t in postfix]
                    verdicts.append(evaluate(names, PERMISSIVE))
                    evidence.add(("tag", found.expressions[-1]))
        found.labels = less_general(found.labels, found.base_labels)
        verdicts += [label in PERMISSIVE for kind, label in evidence if kind != "tag" and label in found.labels]
        doubt = 1.0
        for kind, _ in evidence:
            doubt *= 1 - CERTAINTY[kind]
        found.score = round(1 - doubt, 9)
        found.permissive = all(verdicts) if verdicts else None
        return found


def scan_licences(
    documents: DataFrame,
    base: dict[str, str] | None = None,
    notices: dict[str, str] | None = None,
    listed: frozenset[str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row of findings per document; one Arrow pass over the scan, no shuffle.

    ``base`` and ``notices`` are phrases with their labels, ``listed`` the known
    identifiers (by default those of ``licence_names``).
    ``expressions`` are in postfix form; ``permissive`` says whether all stated
    licences allow free use.
    """
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    columns = {
        "n_words": (pa.int64(), lambda f: f.n_words),
        "n_base": (pa.int64(), lambda f: len(f.places)),
        "first_word": (pa.int64(), lambda f: min(f.places, default=None)),
        "last_word": (pa.int64(), lambda f: max(f.places, default=None)),
        "base_labels": (pa.string(), lambda f: ",".join(sorted(f.base_labels))),
        "labels": (pa.string(), lambda f: ",".join(sorted(f.labels))),
        "score": (pa.float64(), lambda f: f.score),
        "expressions": (pa.list_(pa.string()), lambda f: f.expressions),
        "permissive": (pa.bool_(), lambda f: f.permissive),
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(base, notices, listed)
        for batch in batches:
            found = [scan(t) for t in texts(batch, "text")]
            out = [pa.array([get(f) for f in found], kind) for kind, get in columns.values()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *out], ["doc_id", *columns])

    return rows.mapInArrow(
        run,
        f"doc_id {id_type}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, expressions array<string>, permissive boolean",
    )
