"""Quality, toxicity and line rules: held-out accuracy and brute-force counts."""

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from docsift.llm import quality, rules, toxicity
from docsift.llm.common import Sample, labelled_sample
from docsift.llm.queries import QUERIES

TENTH = "/root/testdata/sf0.01"


def held_out_results(spark, name, label):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{TENTH}/labels.parquet").collect()}
    rows = QUERIES[name](spark, TENTH).collect()
    assert len(rows) == spark.read.parquet(f"{TENTH}/documents.parquet").count()
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    return [(r["predicted"], labels[r["doc_id"]], r["score"]) for r in rows if r["held_out"] and r["doc_id"] in labels]


def test_quality_on_held_out_documents(spark):
    rows = held_out_results(spark, "op3_compression_quality", "quality")
    assert all(p == int(s >= 0.3) for p, _, s in rows)
    assert np.mean([p == y for p, y, _ in rows]) >= 0.93


def test_toxicity_on_held_out_documents(spark):
    rows = held_out_results(spark, "op7_toxicity", "toxic")
    assert all(p == int(s >= 0.5) for p, _, s in rows)
    assert np.mean([p == y for p, y, _ in rows]) >= 0.9


def test_labels_outside_the_held_out_fold_only(spark, odd, odd_rows, labels):
    sample = labelled_sample(odd, labels, "quality", 1000, 10**9)
    bad = {r[0] for r in odd_rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0}
    texts = Counter(r[1] or "" for r in odd_rows if r[0] not in bad)
    assert sample.rows and all(texts[t] for t, _ in sample.rows)
    assert len(labelled_sample(odd, labels, "quality", 3, 10**9).rows) <= 6
    assert all(len(t) <= 500 for t, _ in labelled_sample(odd, labels, "quality", 1000, 500).rows)


def test_located_sentences():
    clean, toxic = "a calm line here. ", "you are a wug today. "
    sample = Sample([(clean * 3, 0), (clean + toxic + clean, 1)] * 40, 0.5)
    scorer = toxicity.Scorer(toxicity.fit(sample))
    text = clean + toxic + clean
    (span,) = scorer.located(text, 0.5)
    assert text[span["start"] : span["end"]] == " you are a wug today"
    assert scorer.document(text) > 0.5 > scorer.document(clean * 50)
    assert scorer.document(text) == pytest.approx(1 - np.prod(1 / (1 + np.exp(scorer.logits(text)))))
    assert scorer.document("") == 0 and scorer.located("...", 0) == []


def test_located_sentences_one_by_one():
    clean, toxic = "a calm line here. ", "you are a wug today. "
    scorer = toxicity.Scorer(toxicity.fit(Sample([(clean * 3, 0), (clean + toxic + clean, 1)] * 40, 0.5)))
    text = f"...\n\n{clean}İstanbul 你好… {toxic}?!{clean * 30}You are a WUG!\nlast wug"
    alone = [(m.start(), m.end()) for m in re.finditer(r"[^.!?\n]+", text) if scorer.document(m.group()) >= 0.5]
    score, spans = scorer.scored(text, 0.5)
    assert len(alone) >= 2 and [(x["start"], x["end"]) for x in spans] == alone
    assert score == scorer.document(text) and scorer.scored(text)[1] == []


def test_toxicity_query_locates_the_sentences(spark):
    found = QUERIES["op7_toxicity"](spark, "/root/testdata/sf0.01")
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = found.collect()
    assert len(rows) == 1_000 and any(r["offending"] for r in rows)
    for r in rows:
        ends = [0, *(x for s in r["offending"] for x in (s["start"], s["end"])), len(texts[r["doc_id"]])]
        assert ends == sorted(ends) and all(0.5 <= s["score"] <= r["score"] + 1e-9 for s in r["offending"])
        assert r["predicted"] or not r["offending"]


def test_compression_features_follow_the_dictionaries():
    good, bad = "the river runs to the sea and rests. ", "BUY!! NOW!! CHEAP!! "
    sample = Sample([(good * n, 1) for n in range(2, 40)] + [(bad * n, 0) for n in range(2, 40)], 0.5)
    score = quality.Scorer(quality.fit(sample))
    assert score(good * 5) > 0.5 > score(bad * 5) and score("") == 0.5 and score(good * 5000) > 0.5


def brute(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered |= {i, i + 1, i + 2}
    n, repeated = len(found), len(covered)
    failed = n < 50 or 100 * repeated > 50 * n
    return n, sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), dup, repeated, failed


def test_rule_counts_equal_brute_force(spark, odd, odd_rows, documents, texts_of, labels):
    for df, rows in ((odd, [(r[0], r[1]) for r in odd_rows]), (documents, list(texts_of.items()))):
        got = rules.apply_rules(df, rules.fit_rules(df, labels)).collect()
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
        assert Counter((r["doc_id"], *[r[c] for c in names]) for r in got) == Counter(
            (i, *brute(t or "")) for i, t in rows
        )
        for r in got:
            assert r["kept"] == (not r["base_failed"] and r["content_share"] >= rules.LEAST_CONTENT)


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = "one two\n three three four\n\none two\n" * 30 + "é" * 200 + "\nlast"
    whole = rules.read_lines(text, rules.WordHasher())
    cut = rules.cut
    monkeypatch.setattr(rules, "cut", lambda t, at: cut(t, at, 25))
    pieces = rules.read_lines(text, rules.WordHasher())
    assert brute(text)[:5] == tuple(
        getattr(pieces, c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    )
    assert (whole.words == pieces.words).all() and (whole.features == pieces.features).all()


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(5)
    for n in (1, 2, 5, 8):
        field = rules.LineField(rng.normal(size=3), rng.normal(size=(2, 2)))
        x = rng.normal(size=(n, 3))

        def score(path, x=x, field=field):
            value = sum(float(x[i] @ field.weights) for i, s in enumerate(path) if s)
            return value + sum(field.moves[a, b] for a, b in itertools.pairwise(path))

        best = max(itertools.product((0, 1), repeat=n), key=score)
        assert field.content(x).tolist() == [s == 0 for s in best]


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(6)
    odds, moves = rng.normal(size=3), rng.normal(size=(2, 2))
    expected, passed = rules._expected(odds, moves, [1, 1, 1], np.array([0, 1, 2, 3]), np.ones(3), np.ones(1))
    total, by_line, by_move = 0.0, np.zeros(3), np.zeros((2, 2))
    for path in itertools.product((0, 1), repeat=3):
        p = np.exp(sum(odds[i] for i, s in enumerate(path) if s) + sum(moves[a, b] for a, b in itertools.pairwise(path)))
        total += p
        by_line += p * np.array(path)
        for a, b in itertools.pairwise(path):
            by_move[a, b] += p
    assert np.allclose(expected, by_line / total) and np.allclose(passed, by_move / total)


def test_field_learns_junk_lines():
    good = "\n".join(f"Quiet{i} sentence{i} number{i} walks{i} along{i} the shore, and rests{i}." for i in range(8))
    junk = "\n".join("BUY!! NOW!! " * 6 for _ in range(8))
    field = rules.fit(Sample([(good, 1)] * 30 + [(good.split("\n")[0] + "\n" + junk, 0)] * 30, 0.5))
    lines = rules.read_lines(good.split("\n")[0] + "\n" + junk, rules.WordHasher())
    assert field.content(lines.features).sum() <= 1
    assert rules.verdict(good, field, rules.WordHasher())[2]


def test_dictionaries_hold_a_piece_of_every_text_from_anywhere():
    opening = b"the same opening of every text " * 20
    samples = [opening + f"<{i:04d}>".encode() * 200 for i in range(500)]
    held = quality.dictionary(samples, 50_000)
    assert len(held) == 50_000
    found = {i for i in range(500) if f"<{i:04d}>".encode() in held}
    assert len(found) > 300  # about two thirds of a text follow its opening
    assert len(quality.dictionary([b"ab", b"c" * 900], 400)) == 202


def test_bad_text_that_begins_after_the_opening():
    rng = __import__("random").Random(8)
    words = [f"{a}{b}" for a in ("river", "stone", "cloud", "light", "north") for b in ("side", "fall", "path", "ward")]
    junk = ["#$%", "@@!!", "<<>>", "|||", "~~^^"]
    text = lambda pool, n: " ".join(rng.choice(pool) for _ in range(n))
    rows = [(text(words, 300), 1) for _ in range(60)] + [(text(words, 90) + " " + text(junk, 400), 0) for _ in range(60)]
    score = quality.Scorer(quality.fit(Sample(rows, 0.5)))
    assert score(text(words, 90) + " " + text(junk, 400)) < 0.3 < score(text(words, 300))
