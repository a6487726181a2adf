"""Every named query against its SQL, on the smallest tables."""

import re

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(None if pd.isna(v) else v for v in row) for row in frame.itertuples(index=False, name=None)), key=repr)


#: The text operators have tests of their own.
NAMES = sorted(n for n in contract.queries() if n != "pipeline" and not re.match(r"op\d+_", n))


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf_dir, duck, name):
    ours = contract.queries()[name](spark, sf_dir).toPandas()
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert len(ours) > 0
        return
    theirs = duck.execute(sql).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_every_query_has_sql():
    assert set(NAMES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    found = contract.entry(spark)
    assert found.count() > 0 and "crashes" in found.columns
