"""Every registered query against its SQL counterpart on the smallest test tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as registered

SF_DIR = registered.SMOKE_DIR
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in sorted(os.listdir(SF_DIR)):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{name}'")
    return con


def shown(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else repr(value)


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(shown(r[i]) for i in order) for r in rows)


#: Those for training text have tests of their own.
NAMES = sorted(set(registered.queries()) - set(registered.TRAINING_QUERIES))


def test_same_names():
    assert set(NAMES) == set(registered.oracle_sql()) - set(registered.TRAINING_SQL)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    df = registered.queries()[name](spark, SF_DIR)
    relation = duck.sql(registered.oracle_sql()[name])
    assert sorted(df.columns) == sorted(relation.columns)
    assert as_rows(df.columns, df.collect()) == as_rows(relation.columns, relation.fetchall())


def test_entry(spark):
    assert registered.entry(spark).count() > 0
