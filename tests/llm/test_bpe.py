import hashlib

import numpy as np
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from docsift.llm import bpe
from docsift.llm.queries import vocabulary_path

LIBRARY = tokenizers.Tokenizer.from_file(vocabulary_path())
ENCODER = bpe.Encoder(bpe.load_vocabulary(vocabulary_path()))


def same(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    got = ENCODER.encode([text])[0]
    assert np.frombuffer(got, "<u4").tolist() == ids
    assert ENCODER.decode(got) == LIBRARY.decode(ids, skip_special_tokens=False)


# signs assigned for long: libraries differ in the newest Unicode version they know
SIGNS = st.characters(codec="utf-8", max_codepoint=0x2FFF, categories=("L", "M", "N", "P", "S", "Z", "Cc"))


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aAbBzZ019 '\n.!sStT"), SIGNS.filter(lambda c: c.isascii() or ord(c) < 0x2000))))
def test_any_text(text):
    same(text)


@pytest.mark.parametrize(
    "text",
    [
        "", " \t\n", "Hello  WORLD's <|endoftext|> ΑΣ İx 12a\x1c z\u0085k ", "<|startoftext|><|endoftext|>x<|endoftext",
        "don't I'LL we'Re 'sS 'VE'M'D", "ﬁ ½ ² Ⅷ x²y ٣٤ 你好，世界。", "é é ẞ ǅ \U0001f600\U0001f468‍\U0001f469",
        "ab" * 500 + "!" * 300, "Σ ΣΑΣ ς", "x　y z﻿", "aaaaaaaaaaaaa " * 50, "the" * 30_000,
    ],
)
def test_odd_texts(text):
    same(text)


def test_short_and_long_words_agree():
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdeinorst!é"), n)).encode() for n in rng.integers(1, 60, 400)]
    words.sort(key=len)
    assert ENCODER.short_words(words) == [ENCODER.long_word(w) for w in words]


def test_forgetting_changes_nothing(monkeypatch):
    texts = [f"some words numbered {i} walking" for i in range(50)]
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    monkeypatch.setattr(bpe, "CHARS", 100)
    small = bpe.Encoder(ENCODER.v)
    assert small.encode(texts) == ENCODER.encode(texts) and len(small.known) < 60


def test_query_equals_library(spark, odd, odd_rows, documents, texts_of):
    for df, rows in ((odd, [(r[0], r[1]) for r in odd_rows]), (documents, list(texts_of.items()))):
        want = []
        for i, text in rows:
            ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
            decoded = LIBRARY.decode(ids, skip_special_tokens=False)
            data = np.array(ids, "<u4").tobytes()
            want.append((str(i), len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
        got = bpe.encode_texts(df, ENCODER.v, digests=True).collect()
        assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)
    row = bpe.encode_texts(documents.limit(1), ENCODER.v).first()
    assert row["ids"] == LIBRARY.encode(texts_of[row["doc_id"]], add_special_tokens=False).ids
