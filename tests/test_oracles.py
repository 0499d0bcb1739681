"""Every registered query against its SQL twin, over whole tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from orderloom.catalog import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda r: [repr(v) for v in r])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, sf, name):
    df = entry_points.queries()[name](spark, sf)
    columns = sorted(df.columns)
    rows = [tuple(r[c] for c in columns) for r in df.collect()]
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    result = duck.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    assert sorted(names) == columns
    assert {f.name: SQL_TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    expected = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
    assert len(rows) == len(expected)
    assert _sorted(rows) == _sorted(expected)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_points.oracle_sql())


def test_entry_runs(spark):
    df = entry_points.entry(spark)
    assert df.columns[0] == "total_orders" and df.count() == 1
