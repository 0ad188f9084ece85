import hashlib
import random

import numpy as np
import pytest

from docsift.llm import fingerprints as P
from docsift.llm.queries import QUERIES
from docsift.llm.words import WordHasher, plain_bytes


def expected(rows):
    """``rows`` of (doc_id, text) in their order."""
    make, out = P.Fingerprinter(), []
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        n = len(text) // 4
        changed = text[: len(text) - n] + following[:n]
        mine, after, next_ = (make.signature(t) for t in (text, changed, following))
        near = [float((mine == x).mean()) for x in (after, next_)]
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), mine.tobytes().hex(), *near))
    return out


def found(df):
    rows = df.collect()
    return [
        (r["doc_id"], r["n_chars"], r["edited_sha256"].hex(), r["fingerprint"].hex(), r["near_edited"], r["near_next"])
        for r in rows
    ]


@pytest.mark.parametrize("parts", [1, 4, 400])
def test_neighbours_equal_brute_force(spark, documents, texts_of, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = found(P.compare_neighbours(documents))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert sorted(got) == sorted(expected(sorted(texts_of.items())))


@pytest.mark.parametrize("rows", [[(1, "abcd efgh")], [(2, ""), (1, "a b c d e f g h")], [(3, None), (None, "x y")]])
def test_few_rows(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted(found(P.compare_neighbours(df)), key=str) == sorted(expected(ordered), key=str)


def test_fingerprints_estimate_jaccard():
    rng, make = random.Random(1), P.Fingerprinter(permutations=2000)
    a = [f"w{rng.randrange(5000)}" for _ in range(400)]
    for change in (0, 20, 100, 400):
        b = a[: 400 - change] + [f"z{i}" for i in range(change)]
        x, y = " ".join(a), " ".join(b)
        exact = P.jaccard(np.unique(make.shingles(x)), np.unique(make.shingles(y)))
        assert abs(P.likeness(make.signature(x), make.signature(y)) - exact) < 0.04


def test_equal_and_empty_texts():
    make = P.Fingerprinter()
    assert (make.signature("") == make.signature(" !? ")).all() and P.jaccard(np.zeros(0), np.zeros(0)) == 1
    assert (make.signature("One, two") == make.signature("one TWO")).all()
    assert not (make.signature("one two") == make.signature("two one")).all()


def test_hashes_of_long_texts_in_pieces(monkeypatch):
    from docsift.llm import words

    text = " ".join(f"word{i}" for i in range(5000)) + " " + "y" * 3000
    data = plain_bytes(text)
    whole = WordHasher().words(data, data != 32)
    monkeypatch.setattr(words, "PIECE", 1000)
    assert (WordHasher().words(data, data != 32) == whole).all() and len(set(whole.tolist())) == 5001


def test_query_gives_the_classes_of_near_copies(spark, tmp_path):
    rng = random.Random(5)
    base = [f"w{rng.randrange(10_000)}x" for _ in range(300)]
    copies = [" ".join([*base[:k], f"changed{k}", *base[k + 1 :]]) for k in (20, 150, 290)]
    other = " ".join(f"w{rng.randrange(10_000)}x" for _ in range(300))
    near = [(4, " ".join(base)), (5, " ".join(base)), *zip((6, 7, 8), copies, strict=True)]
    rows = [*near, (9, other), (9, copies[0]), (None, other), (3, None), (2, ""), (1, "a few own words of its own")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op10_fingerprints"](spark, str(tmp_path)).collect()
    make = P.Fingerprinter()
    expected_ids = [(i, 4) for i in (4, 5, 6, 7, 8, 9)] + [(9, 9), (None, 9), (3, 2), (2, 2), (1, 1)]
    assert sorted(((r["doc_id"], r["class_id"]) for r in got), key=str) == sorted(expected_ids, key=str)
    prints = {make.signature(t or "").tobytes().hex() for _, t in rows}
    assert {r["fingerprint"] for r in got} == prints
