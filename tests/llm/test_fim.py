import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docsift.llm import fim

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


def by_hand(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    a, b, c = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < 20:
        return len(units), "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return len(units), "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aZé<PSM> \n0\U0001f600")), st.integers(1, 7))
def test_every_unit_is_found(text, block):
    tree = fim.UnitTree(text, block)
    places = [m.start() for m in UNIT.finditer(text)]
    assert tree.n == len(places)
    assert [tree.place(k) for k in range(len(places) + 1)] == [*places, len(text)]


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**9), st.text(st.sampled_from("abZ<PS M>é\n")), st.integers(1, 9))
def test_form_and_cuts(doc_id, text, block):
    assert fim.transform(text, fim.draws(doc_id), block=block) == by_hand(doc_id, text)


def test_long_runs_and_long_texts():
    rng = random.Random(1)
    for text in ("x" * 100_000, "x" * 40_000 + " " + "y" * 40_000, "é" * 50_000, "".join(rng.choices("ab é\n", k=120_000))):
        places = [m.start() for m in UNIT.finditer(text)]
        tree = fim.UnitTree(text)
        asked = {0, len(places) - 1, len(places), *(rng.randrange(len(places)) for _ in range(50))}
        assert all(tree.place(k) == [*places, len(text)][k] for k in asked)


def test_rows_and_round_trip(odd, odd_rows):
    found = fim.fill_in_middle(odd).withColumn("back", fim.restored()).collect()
    want = sorted((repr(r[0]), *by_hand(r[0], r[1]), r[1] or "") for r in odd_rows)
    got = sorted((repr(r.doc_id), r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in found)
    assert repr(got) == repr(want)


@pytest.mark.parametrize("text", ["<<S>", "a<", "<P", "M>", "<<<>>>", "S><P"])
def test_pieces_of_sentinels_in_the_text(spark, text):
    rows = [(i, text * (1 + i % 3)) for i in range(200)]
    df = fim.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("back", fim.restored())
    assert {r.doc_id: r.back for r in df.collect()} == dict(rows)


def test_empty_table_and_shares(spark, empty, documents):
    assert fim.fill_in_middle(empty).count() == 0
    forms = {r.form: r["count"] for r in fim.fill_in_middle(documents).groupBy("form").count().collect()}
    assert set(forms) == {"plain", "psm", "spm"} and forms["psm"] > forms["spm"] > 0
    assert fim.fill_in_middle(documents, transformed=0).filter(F.col("form") != "plain").count() == 0
