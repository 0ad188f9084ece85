import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from docsift.llm import fingerprints, linking, neardup
from docsift.llm.words import WordHasher


def shingles(text):
    data = re.sub(rb"\xe2[\x80\x81].|\xc2.", b" ", (text or "").lower().encode(), flags=re.S)
    found = re.findall(rb"[0-9a-z\x80-\xff]+", data)
    n = min(5, len(found))
    return Counter(tuple(found[i : i + n]) for i in range(len(found) - n + 1)) if found else Counter()


def naive(x, y):
    """Probability Jaccard by its definition."""
    if not x or not y:
        return float(x == y)
    both = x.keys() & y.keys()
    return sum(1 / sum(max(x[j] / x[d], y[j] / y[d]) for j in x.keys() | y.keys()) for d in both)


def classes(rows, similarity):
    """Connected components over all pairs of different texts."""
    texts = sorted({t or "" for _, t in rows})
    bags = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if bags[i] and bags[j] and similarity(bags[i], bags[j]) >= 0.8:
                root[find(i)] = find(j)
    members = defaultdict(list)
    for doc_id, t in rows:
        members[find(texts.index(t or ""))].append(doc_id)
    out = []
    for ids in members.values():
        known = [i for i in ids if i is not None]
        out += [(i, min(known) if known else None) for i in ids]
    return sorted(out, key=str)


def jaccard(x, y):
    return len(x.keys() & y.keys()) / len(x.keys() | y.keys())


@pytest.fixture(scope="module")
def family():
    """Copies of one text that drift apart word by word, so that links form a chain."""
    rng = random.Random(8)
    now = [f"v{rng.randrange(10_000)}" for _ in range(150)]
    rows = []
    for i in range(30):
        rows.append((i, " ".join(now)))
        now = list(now)
        now[(i * 37) % 150] = f"n{i}"
    return rows + [(100 + i, rows[0][1]) for i in range(20)]


@pytest.mark.parametrize(("operator", "similarity"), [(neardup, naive), (fingerprints, jaccard)])
def test_classes_equal_brute_force(spark, odd, odd_rows, family, operator, similarity):
    frame = spark.createDataFrame(family, "doc_id long, text string")
    for df, rows in ((odd, [(r[0], r[1]) for r in odd_rows if len(r[1] or "") < 20_000]), (frame, family)):
        got = operator.near_duplicates(df.filter("text is null or length(text) < 20000")).collect()
        assert sorted(((r["doc_id"], r["class_id"]) for r in got), key=str) == classes(rows, similarity)


def test_one_document_of_each_class_stays(spark, odd, odd_rows, family):
    found = neardup.near_duplicates(odd).collect()
    kept = linking.keep_first(odd, neardup.near_duplicates(odd))
    assert kept.columns == odd.columns
    assert kept.count() == len({r["first_node"] for r in found})
    ids = [r["doc_id"] for r in kept.collect()]
    assert {0, 5, 10, 12} <= set(ids) and not {1, 2, 3, 4, 6, 11} & set(ids) and ids.count(10) == 1


def test_signatures_estimate_probability_jaccard():
    hasher, rng = WordHasher(), random.Random(2)
    for change in (0, 5, 40, 150):
        a = [f"a{rng.randrange(60)}" for _ in range(300)]
        b = a[: 300 - change] + [f"b{i}" for i in range(change)]
        x, y = (neardup.weighted_shingles(" ".join(t), hasher) for t in (a, b))
        exact = neardup.probability_jaccard(x, y)
        assert exact == pytest.approx(naive(shingles(" ".join(a)), shingles(" ".join(b))))
        agree = np.mean(neardup.signature(*x, 4000) == neardup.signature(*y, 4000))
        assert abs(agree - exact) < 0.05


def test_weighted_similarity_of_repeated_lines():
    hasher = WordHasher()
    a, b = "one two three four five six " * 20, "one two three four five six " * 19 + "one two three four five seven"
    x, y = (neardup.weighted_shingles(t, hasher) for t in (a, b))
    assert neardup.probability_jaccard(x, y) == pytest.approx(naive(shingles(a), shingles(b)))
    assert neardup.probability_jaccard(x, x) == pytest.approx(1)


@pytest.mark.parametrize("block", [8, linking.BLOCK])
def test_graded_copies_of_one_text(spark, monkeypatch, block):
    """Copies with few to many changes: most share buckets, many are no link of the first text."""
    monkeypatch.setattr(linking, "BLOCK", block)
    rng = random.Random(4)
    base = [f"b{rng.randrange(10_000)}" for _ in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 90):
        copy = list(rng.choice(rows)[1].split()) if i % 3 == 0 else list(base)
        for _ in range(i % 12):
            copy[rng.randrange(len(copy))] = f"c{i}x{rng.randrange(10_000)}"
        rows.append((i, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["class_id"]) for r in neardup.near_duplicates(df).collect()), key=str)
    assert got == classes(rows, naive) and 5 < len({c for _, c in got}) < 80


def test_components_of_chains_and_stars(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 200)] + [(500, 501), (501, 500), (600, 600)]
    rng.shuffle(edges)
    name = lambda i: bytearray(f"{i * 7919 % 1000:04d}".encode())
    df = spark.createDataFrame([(name(a), name(b)) for a, b in edges], "a binary, b binary")
    got = defaultdict(set)
    for r in linking.components(df).collect():
        got[bytes(r["root"])] |= {bytes(r["node"]), bytes(r["root"])}
    groups = [set(range(61)), set(range(100, 300)), {500, 501}]
    assert sorted(map(sorted, got.values())) == sorted(sorted(bytes(name(i)) for i in g) for g in groups)
    assert all(root == min(nodes) for root, nodes in got.items())
