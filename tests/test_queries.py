"""Every registered query against its SQL check on whole test tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_point
from docsift.plans import all_queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SQL = entry_point.oracle_sql()
RUN = entry_point.queries()
#: Fitted with fewer trees in test_model_runs.
LONG_FITS = {"random_forest_metrics", "forest_grid_scores", "trained_models"}


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, small, name):
    df = RUN[name](spark, small)
    columns = sorted(df.columns)
    got = ordered(tuple(r[c] for c in columns) for r in df.collect())
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    places = sorted(range(len(names)), key=lambda i: names[i])
    want = ordered(tuple(r[i] for i in places) for r in cursor.fetchall())
    assert columns == [names[i] for i in places]
    assert got == want


@pytest.mark.parametrize("name", sorted(set(RUN) - set(SQL) - LONG_FITS))
def test_query_without_sql_gives_rows(spark, small, name):
    assert RUN[name](spark, small).count() > 0


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() == 15


def test_fits_beat_a_guess(spark, small):
    for name in ("logistic_regression_metrics", "linear_svm_metrics"):
        row = RUN[name](spark, small).first()
        assert row["f1_macro"] > 0.9 and not math.isnan(row["f1_macro"])


def test_every_operator_group_is_registered():
    seen = {o for q in all_queries().values() for o in q.operators}
    expected = {f"A{i}" for i in range(1, 30)} | {f"P{i}" for i in range(1, 13)} | {f"J{i}" for i in range(1, 9)}
    expected |= {f"T{i}" for i in range(1, 26)} | {f"W{i}" for i in range(1, 9)} | {f"M{i}" for i in range(1, 23)}
    expected |= {f"S{i}" for i in range(1, 13)} | {f"L{i}" for i in range(1, 6)} | {"U1", "U2", "U3"} | {f"R{i}" for i in range(1, 5)}
    assert expected - seen == set()
