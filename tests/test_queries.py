"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os

import pytest

from stormspan.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def ordered(table):
    frame = table.to_pandas()
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), na_position="last").reset_index(drop=True)


def kinds(table):
    return {field.name: str(field.type).removeprefix("large_") for field in table.schema}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    mine = QUERIES[name](spark, FOLDER).toArrow()
    theirs = duck.sql(ORACLES[name]).to_arrow_table()
    assert kinds(mine) == kinds(theirs)
    left, right = ordered(mine), ordered(theirs)
    assert len(left) == len(right)
    for column in left.columns:
        same = (left[column] == right[column]) | (left[column].isna() & right[column].isna())
        assert same.all(), (column, left[~same].head(3), right[~same].head(3))
