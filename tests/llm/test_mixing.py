import hashlib
import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from docsift.llm import common, mixing


def filled(sizes, weights, share, cap):
    """Targets by handing the excess on until none is above."""
    budget, full, level = share * sum(sizes), set(), {}
    while True:
        rest = [i for i in range(len(sizes)) if i not in full]
        left = budget - sum(cap * sizes[i] for i in full)
        total = sum(weights[i] for i in rest)
        level = {i: left * weights[i] / total for i in rest}
        over = {i for i in rest if level[i] > cap * sizes[i]}
        if not over:
            return [cap * s if i in full else level[i] for i, s in enumerate(sizes)]
        full |= over


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def expected(rows, weight_of):
    """``rows``: (doc_id, text, source)."""
    by = defaultdict(list)
    for r in rows:
        by[r[2]].append((r[0], size(r[1])))
    names = sorted((s for s in by if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in by)
    sizes = [sum(n for _, n in by[s]) for s in names]
    wanted = filled(sizes, [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5, 2.0)
    out = []
    for s, total, target in zip(names, sizes, wanted, strict=True):
        epochs = int(target // total) if total else 0
        left, before, units = target - epochs * total, 0, defaultdict(int)
        for unit in by[s]:
            units[unit] += 1

        def key(unit):
            name = "" if unit[0] is None else str(unit[0])
            u = (int(hashlib.md5(f"7:{name}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
            return -math.log(u) / weight_of.get(unit[0], 1.0), unit[0] is not None, unit[0] or 0, unit[1]

        for unit in sorted(units, key=key):
            mass = unit[1] * units[unit]
            taken = (epochs + (left > 0 and before + mass / 2 <= left)) * unit[1]
            out += [(unit[0], unit[1], total, round(target, 6), taken)] * units[unit]
            before += mass
    return sorted(out, key=str)


def found(df):
    rows = [(r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in df.collect()]
    return sorted(rows, key=str)


def test_equals_brute_force(spark, odd, odd_rows, labels):
    weights = {r["doc_id"]: r["weight"] for r in mixing.label_weights(labels).collect()}
    rows = [(r[0], r[1], r[3]) for r in odd_rows]
    assert found(mixing.mix(odd, mixing.label_weights(labels))) == expected(rows, weights)


def test_many_sources(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randrange(1, 50), f"s{min(rng.randrange(40), rng.randrange(40))}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = found(mixing.mix(df))
    assert got == expected(rows, {})
    assert all(r[4] <= 2 * r[1] for r in got)


def test_takes_come_near_targets_and_runs_agree(spark, documents, small):
    weights = mixing.label_weights(spark.read.parquet(f"{small}/labels.parquet"))
    first, second = found(mixing.mix(documents, weights)), found(mixing.mix(documents.repartition(5), weights))
    assert first == second
    by = defaultdict(lambda: [0, 0.0, 0])
    sources = {r["doc_id"]: r["source"] for r in documents.select("doc_id", "source").collect()}
    for doc_id, n, _, target, taken in first:
        x = by[sources[doc_id]]
        x[0], x[1], x[2] = x[0] + taken, target, max(x[2], n)
    assert all(abs(got - target) <= largest for got, target, largest in by.values())


def test_better_documents_come_first(spark):
    rows = [(i, "a b c d", "s") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = df.select("doc_id", F.when(F.col("doc_id") < 1000, 4.0).otherwise(1.0).alias("weight"))
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(df, weights, share=0.5).collect()}
    good = sum(taken[i] > 0 for i in range(1000))
    assert 700 < good < 900 and sum(t > 0 for t in taken.values()) == 1000


def test_unusable_weights_come_last(spark):
    df = spark.createDataFrame([(i, "a b", "s") for i in range(10)], "doc_id long, text string, source string")
    weights = df.select("doc_id", F.when(F.col("doc_id") < 5, 0.0).alias("weight"))
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(df, weights, share=0.5).collect()}
    assert [taken[i] for i in range(5)] == [0] * 5 and all(taken[i] for i in range(5, 10))


def test_mixed_documents_repeat_whole_rows(spark, odd, labels):
    plan = mixing.plan_mix(odd, mixing.label_weights(labels))
    rows = mixing.mixed_documents(odd, plan)
    assert rows.columns == odd.columns
    got = rows.withColumn("n", common.n_words("text")).agg(F.sum("n")).first()[0]
    assert got == plan.agg(F.sum(F.col("taken") * F.col("n_rows"))).first()[0]


def test_running_totals_of_a_hot_group(spark):
    rows = [("hot" if i % 3 else f"g{i % 7}", i * 37 % 101, i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, o long, v long")
    got = common.running_totals(df, ["v"], ["o", "v"], ["g"]).collect()
    for g in {r[0] for r in rows}:
        before, total = 0, sum(v for x, _, v in rows if x == g)
        for r in sorted((r for r in got if r["g"] == g), key=lambda r: (r["o"], r["v"])):
            assert (r["before_v"], r["all_v"]) == (before, total)
            before += r["v"]


@pytest.mark.parametrize("limit", [0, 100])
def test_lookup_join_both_ways(spark, limit):
    df = spark.createDataFrame([(i, "k" if i % 3 else "l") for i in range(50)], "i long, k string")
    lookup = spark.createDataFrame([("k", 1), ("l", 2), ("m", 3)], "k string, v int")
    got = {(r["i"], r["v"]) for r in common.join_lookup(df, lookup, "k", limit).collect()}
    assert got == {(i, 1 if i % 3 else 2) for i in range(50)}


def test_repeat_rows_in_chunks(spark):
    df = spark.createDataFrame([(0,), (1,), (10_000,), (25_001,)], "n long")
    got = {r["n"]: r["c"] for r in common.repeat_rows(df, F.col("n")).groupBy("n").agg(F.count("*").alias("c")).collect()}
    assert got == {1: 1, 10_000: 10_000, 25_001: 25_001}
