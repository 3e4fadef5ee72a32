"""Every query with reference SQL, against DuckDB on the smallest tables."""

import os
from pathlib import Path

import pytest

import __spark_entry__

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS FROM '{path}'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((x is None, str(type(x)), x if x is not None else 0) for x in row))


def test_every_reference_belongs_to_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_query_equals_reference(spark, tables, name):
    df = __spark_entry__.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    expected = tables.execute(f"SELECT {', '.join(f'\"{c}\"' for c in columns)} FROM ({__spark_entry__.oracle_sql()[name]})")
    assert sorted(df.columns) == columns
    mine, theirs = (ordered(map(tuple, rows)) for rows in (df.select(*columns).collect(), expected.fetchall()))
    assert len(mine) == len(theirs)
    for a, b in zip(mine, theirs):
        assert a == b


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
