import itertools
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsift.llm import sharding


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_neighbours(spark, dims, bits):
    side = range(1 << bits)
    points = list(itertools.product(side, repeat=dims))
    names = [f"x{i}" for i in range(dims)]
    df = spark.createDataFrame(points, ", ".join(f"{n} int" for n in names))
    rows = df.withColumn("h", sharding.hilbert_index([F.col(n) for n in names], bits)).collect()
    path = [tuple(r[n] for n in names) for r in sorted(rows, key=lambda r: r["h"])]
    assert sorted(r["h"] for r in rows) == list(range(len(points)))
    assert all(np.abs(np.subtract(a, b)).sum() == 1 for a, b in itertools.pairwise(path))


def test_rows_law_equals_brute_force(spark, odd, odd_rows):
    rows = sharding.hilbert_shards(odd).collect()
    facts = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows)
    assert facts == Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in odd_rows)
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for shard in counts:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(counts[shard]))
    order = [r["hilbert"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order)


def test_bytes_law(spark, documents):
    rows = sharding.hilbert_shards(documents, shards=8, law="bytes").collect()
    sizes = Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    largest = max(r["size"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest
    for shard in sizes:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    with pytest.raises(ValueError):
        sharding.hilbert_shards(documents, law="key")


def test_fewer_rows_than_shards(spark, odd):
    rows = sharding.hilbert_shards(odd.limit(3)).collect()
    assert sorted((r["shard"], r["slot"]) for r in rows) == [(0, 0), (1, 0), (2, 0)]


def test_sizes_fall_into_cells_in_order(spark):
    df = spark.range(1, 5000).select(sharding.size_cell(F.col("id")).alias("c"))
    cells = [r["c"] for r in df.collect()]
    assert cells == sorted(cells) and cells[0] == 0 and max(cells) < 256


def test_runs_are_written_and_prune(spark, documents, tmp_path):
    assigned = sharding.hilbert_shards(documents)
    rows = documents.select("doc_id", "lang", "source").join(assigned, "doc_id")
    sharding.write_runs(rows, f"{tmp_path}/runs")
    back = spark.read.parquet(f"{tmp_path}/runs")
    assert back.count() == documents.count()
    boxes = sharding.shard_boxes(back, ["lang"]).collect()
    asked = [b for b in boxes if b["min_lang"] <= "fr" <= b["max_lang"]]
    assert sum(b["n_rows"] for b in boxes) == documents.count() and len(asked) < len(boxes)
