import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use or return, as extra columns with other content.
CLASHES = "size string, score string, node string, bands string, shard string, key string, range_no string, Text_Hash string"


def words(rng, n, pool=400):
    return " ".join(f"w{rng.randrange(pool)}x" for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls everywhere, empty and very long texts, copies, ties and repeated rows."""
    rng = random.Random(3)
    base = words(rng, 300, 10_000)
    parts = base.split()
    near = [" ".join([*parts[:k], f"changed{k}", *parts[k + 1 :]]) for k in (20, 150, 290)]
    rows = [
        (0, base, "en", "a", 1), (1, base, "de", "b", 2), (2, near[0], "en", "a", None), (3, near[1], None, "a", 4),
        (4, near[2], "fr", None, 5), (5, None, None, None, None), (6, "", "en", "a", 0), (7, " \n\t ", "en", "b", 4),
        (8, words(rng, 60_000, 50_000), "en", "a", 9), (9, "x" * 300_000, "en", "c", 9),
        (10, "one two three", "en", "b", 1), (10, "one two three", "en", "b", 1), (11, "one two three", "en", "c", 1),
        (None, "nobody knows this row and its six words", "en", "b", 3), (None, None, None, None, None),
        (12, "## ** $$ !!! ???", "es", "é", 1), (13, "Straße Ünïcode ñandú 你好 \U0001f600 ΑΣ", "de", "é", 2),
        (14, "repeat this line now\n" * 120, "en", "a", 1), (15, "a\x00b\r\nc\x0bd", "en", "\U0001f600", 1),
    ]
    rows += [(100 + i, words(rng, rng.randrange(40, 120), 9_000), "en", "abc"[i % 3], i) for i in range(40)]
    return rows


def _frame(spark, rows):
    df = spark.createDataFrame([(*r, *["x"] * 8) for r in rows], f"{COLUMNS}, {CLASHES}")
    return df.repartition(3)


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return _frame(spark, odd_rows).persist()


@pytest.fixture(scope="session")
def empty(spark):
    return _frame(spark, [])


LABELS = "doc_id long, quality int, toxic int, text string"


@pytest.fixture(scope="session")
def labels(spark, odd_rows):
    """Labels of most rows, with nulls, contradictions, other values and unknown ids."""
    rows = [(r[0], i % 2, (i // 2) % 2, "x") for i, r in enumerate(odd_rows)]
    rows += [(0, 1, 0, "x"), (0, 0, 1, "x"), (1, None, None, None), (2, 5, 5, "x"), (99_999, 1, 1, "x"), (None, 1, 1, "x")]
    return spark.createDataFrame(rows, LABELS)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], LABELS)


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="session")
def texts_of(documents):
    return {r["doc_id"]: r["text"] for r in documents.collect()}
