import random

import numpy as np
import pytest

from docsift.llm import nearest

ODD = "vec_id long, embedding array<float>, label int, node string, score string, Query string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "x", "x") for i, v in rows], ODD).repartition(4)


def by_hand(rows, is_query, k):
    """All neighbours of every query in order; vectors as they are in 32 bits."""
    usable = {(i, tuple(np.float32(v).tolist())) for i, v in rows if i is not None and v and None not in v}
    usable = [(i, np.array(v)) for i, v in usable if np.isfinite(v).all() and np.any(v)]
    out = {}
    for q, x in usable:
        if is_query(q):
            found = sorted((-float(np.cumsum(x * y)[-1]), i) for i, y in usable if i != q and len(y) == len(x))[:k]
            out[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect()):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def run(spark, rows, every=5, **more):
    df = frame(spark, rows)
    return found(nearest.nearest(df, df.filter(f"vec_id % {every} = 0"), **more))


def recall(got, want):
    hits = sum(len({i for _, i, _ in got.get(q, [])} & {i for _, i, _ in w}) for q, w in want.items())
    return hits / sum(map(len, want.values()))


def test_one_leaf_is_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(200)]
    assert run(spark, rows, k=7) == by_hand(rows, lambda i: i % 5 == 0, 7)


@pytest.mark.parametrize("lengths", [False, True])
def test_recall_with_many_leaves(spark, lengths):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    vectors = centres[rng.integers(0, 30, 4_000)] + 0.4 * rng.normal(size=(4_000, 16))
    if not lengths:
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = list(enumerate(vectors.tolist()))
    want = by_hand(rows, lambda i: i % 50 == 0, 20)
    got = run(spark, rows, every=50, leaf=32, group=200, sample=1_500)
    assert recall(got, want) >= 0.9
    assert all(len(got[q]) == 20 and q not in {i for _, i, _ in got[q]} for q in want)
    score = {(q, i): s for q, w in by_hand(rows, lambda i: i % 50 == 0, 4_000).items() for _, i, s in w}
    assert all(score[q, i] == s for q, w in got.items() for _, i, s in w)
    # a far reach is exact
    assert run(spark, rows, every=50, leaf=32, group=200, sample=1_500, reach=1e9) == want


def test_copies_ties_and_odd_rows(spark):
    rng = random.Random(3)
    hot = [1.0, 0.5, 0.0, 0.25]
    rows = [(i, hot) for i in range(0, 600)]
    rows += [(1_000 + i, [float(rng.randrange(-2, 3)) for _ in range(4)]) for i in range(200)]
    rows += [(5, hot), (5, [0.0, 1.0, 0.0, 0.0]), (7_000, hot), (-5, [2.0] * 4), (-10, [-1.0, 0.0, 0.0, 0.0])]
    odd = [(None, hot), (2_000, None), (2_005, [0.0] * 4), (2_010, []), (2_015, [1.0, None, 1.0, 1.0])]
    odd += [(2_020, [float("nan")] * 4), (2_025, [float("inf"), 1.0, 1.0, 1.0]), (2_030, [1.0, 1.0])]
    got = run(spark, rows + odd, k=20, group=64)
    want = by_hand(rows, lambda i: i % 5 == 0, 20)
    want[5] = got[5]  # an id with two vectors has the answers of both
    assert got == want
    assert len(got[5]) == 40


def test_few_or_no_rows(spark):
    assert run(spark, []) == {}
    assert run(spark, [(0, [1.0, 0.0])]) == {}
    assert run(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, -1.0])]) == {0: [(1, 1, 0.5), (2, 2, 0.0)]}
    assert run(spark, [(1, [1.0, 0.0])]) == {}
    assert nearest.nearest(frame(spark, []), frame(spark, [])).columns == ["query_id", "rank", "vec_id", "score"]


def test_large_leaves_are_dealt_into_parts():
    cells = nearest.Cells.of_sizes(np.array([[5, 5, 90, 1], [0, 0, 10, 11]]), 20)
    assert cells.numbers.tolist() == [[0, 0, 1, 2], [3, 3, 3, 4]]
    assert cells.parts.tolist() == [1, 5, 1, 1, 1]


def test_recall_on_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = [tuple(r) for r in rows]
    got = run(spark, rows, every=20)
    assert recall(got, by_hand(rows, lambda i: i % 20 == 0, 20)) >= 0.95
