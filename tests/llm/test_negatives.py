import random
from math import floor, isfinite

import pytest
from pyspark.sql import functions as F

from docsift.llm import negatives

VECTORS = "vec_id long, embedding array<float>, label int, score string, anchor string, is_row string"


def by_hand(rows, is_anchor, positives=5, count=5, lowest=80):
    def valid(row):
        return None not in row[:3] and row[1] and all(x is not None and isfinite(x) for x in row[1])

    usable = {}
    for row_id, vector, label, *_ in filter(valid, rows):
        held = (label, list(vector))
        usable[row_id] = min(usable.get(row_id, held), held)
    v = {i: [floor(256 * x) for x in vector] for i, (_, vector) in usable.items()}
    out = []
    for a, (label, _) in usable.items():
        if not is_anchor(a):
            continue
        found = sorted(
            (-sum(x * y for x, y in zip(v[a], v[b], strict=True)), b) for b in usable if b != a and len(v[a]) == len(v[b])
        )
        for p, positive in [(-s, b) for s, b in found if usable[b][0] == label][:positives]:
            inside = [(-s, b) for s, b in found if usable[b][0] != label and lowest * p <= -100 * s <= 100 * p]
            out += [(a, positive, k + 1, b, p, s) for k, (s, b) in enumerate(inside[:count])]
    return sorted(out)


def mined(spark, rows, every=10, **more):
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], VECTORS).repartition(3)
    return sorted(map(tuple, negatives.mine(df, F.col("id") % every == 0, **more).collect()))



def grid(rng, n, length, levels):
    return [(i, [rng.randrange(-levels // 4, levels) / 16 for _ in range(length)], rng.randrange(3)) for i in range(n)]


@pytest.mark.parametrize("levels", [2, 8, 64])
def test_equals_brute_force(spark, levels):
    rows = grid(random.Random(levels), 400, 6, levels)
    want = by_hand(rows, lambda i: i % 10 == 0)
    assert want
    assert mined(spark, rows) == want
    assert mined(spark, rows, share=30, anchors_of_block=7) == want


def test_copies_odd_rows_and_lengths(spark):
    rng = random.Random(5)
    rows = grid(rng, 150, 4, 8)
    hot = [0.5, 0.25, 0.75, 0.5]
    rows += [(1_000 + i, hot, i % 3) for i in range(300)]
    rows += [(2_000 + i, [0.5] * (1 + i % 3), i % 2) for i in range(40)]
    rows += [(-10, hot, 0), (-20, [-1.0, -1.0, 0.0, 0.0], 1), (3_000, [0.0] * 4, 2), (3_010, [0.0] * 4, 1)]
    rows += [
        (None, hot, 0), (4_000, None, 0), (4_010, hot, None), (4_020, [], 1), (4_030, [0.5, None, 0.5, 0.5], 1),
        (4_040, [0.5, float("nan"), 0.5, 0.5], 1), (4_050, [float("inf")] * 4, 1), (1_000, hot, 0), (1_000, hot, 1),
    ]
    want = by_hand(rows, lambda i: i % 10 == 0)
    assert mined(spark, rows, share=64, anchors_of_block=16) == want
    assert {r[0] for r in want} >= {-10, 1_000, 2_000}


def test_products_beyond_floating_point(spark):
    rng = random.Random(9)
    rows = [(i, [float(rng.randrange(1, 1 << 20)) for _ in range(4)], rng.randrange(2)) for i in range(120)]
    assert mined(spark, rows) == by_hand(rows, lambda i: i % 10 == 0)
    rows.append((500, [1e30] * 4, 0))  # no long holds its products
    assert mined(spark, rows) == by_hand(rows[:-1], lambda i: i % 10 == 0)


def test_no_rows_no_anchors_no_negatives(spark):
    assert mined(spark, []) == []
    rows = [(i, [1.0, 0.5], 0) for i in range(1, 30)]
    assert mined(spark, rows, every=10) == []
    assert mined(spark, rows, every=1_000) == []


def test_keys_sort_as_numbers():
    rng = random.Random(2)
    big = 1 << 62
    some = [(rng.randrange(-3, 3), rng.choice([-big, -1, 0, 1, big, 7]), rng.randrange(2), rng.randrange(-9, 9)) for _ in range(300)]
    assert all(negatives.unpack(negatives.pack(*k)) == k for k in some)
    by_number = sorted(some, key=lambda k: (k[0], -k[1], k[2], k[3]))
    assert sorted(some, key=lambda k: negatives.pack(*k)) == by_number
